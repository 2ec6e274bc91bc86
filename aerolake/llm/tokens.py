"""Token ids of whole texts, with one vocabulary look-up per distinct chunk.

Byte-level BPE never joins characters across a space that stands between two other
characters than white space, so a text is cut at its spaces and each distinct chunk
is encoded once by the tokenizers library.  Under the library's own byte-level rule
(``use_regex``) a run of letters also ends at any other character, and a line end
between two other characters than white space stands alone, so chunks are cut there
too: words meet again without their marks.  Texts in which that does not hold for
certain (a space beside any white space, a special token's string) are given to the
library as they are: a run of white space is one pre-token, whatever it is made of.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct chunks a task remembers; a chunk beyond that is encoded again in each batch.
REMEMBERED = 300_000
#: Text encoded at once: the encoder holds many times a slice's size in arrays by chunk.
SLICE_BYTES = 2 << 20
#: Any white space of Unicode, and what some regular expression engines take for it.
_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
#: Chunks that are one pre-token for certain: letters of the Latin alphabets (of every version of Unicode), or digits.
_WORD = r"^ ?([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+|[0-9]+)$"
#: Chunks encoded as one text: longer ones cost the library more a chunk.
_WORDS_AT_ONCE, _LINES_AT_ONCE = 256, 16
# Fixed values, by byte: ASCII letters, and ASCII characters that are seen.
_LETTER, _SEEN = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SEEN[33:127] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def slices_by_bytes(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, number) of consecutive texts that hold ``most`` bytes together at most, or are one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, end - at
        at = end


def _cuts(data: np.ndarray, by_rule: bool) -> np.ndarray:
    """Which bytes begin a chunk: spaces, and ``by_rule`` what follows an ASCII letter and is none, and single line ends and what follows them."""
    starts = data == 32
    if by_rule and len(data) > 1:
        letter, seen = _LETTER[data], _SEEN[data]
        starts[1:] |= letter[:-1] & ~letter[1:] & (data[1:] < 128)
        ends = np.flatnonzero(data[1:-1] == 10) + 1
        ends = ends[seen[ends - 1] & seen[ends + 1]]
        starts[ends] = starts[ends + 1] = True
    return starts


def _spelling() -> np.ndarray:
    """The character that a byte-level vocabulary spells each byte with: itself if it is seen in Latin-1, else one from U+0100 on."""
    table = np.arange(256, dtype="<u2")
    unseen = np.r_[0:33, 127:161, 173]
    table[unseen] = 256 + np.arange(len(unseen))
    return table


class Encoder:
    """Encodes batches of texts with a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path or default_tokenizer())
        self.places: dict[str, int] = {}
        self.known_ids, self.known_counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        (self.newline,) = self.library.encode("\n", add_special_tokens=False).ids
        rule = self.library.pre_tokenizer
        self.by_rule = isinstance(rule, pre_tokenizers.ByteLevel) and rule.use_regex and self.library.normalizer is None
        if self.by_rule:
            # The same model for words cut and spelled by bytes already: the library's rule takes most of its time.
            self.by_words = Tokenizer.from_file(path or default_tokenizer())
            self.by_words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            self.spelling, self.sizes = _spelling(), token_bytes(path)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text); a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        plain = pc.invert(pc.match_substring_regex(texts, f" {_WHITE}|{_WHITE} "))
        for string in self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring(texts, string)))
        simple = np.asarray(plain.to_numpy(zero_copy_only=False))
        counts = np.zeros(len(texts), np.int64)
        easy_ids, counts[simple] = self._by_chunks(texts.filter(plain))
        if simple.all():
            return easy_ids, counts
        other = [e.ids for e in self.library.encode_batch_fast(texts.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)]
        counts[~simple] = [len(ids) for ids in other]
        ends = np.cumsum(counts)
        out = np.empty(int(counts.sum()), np.uint32)
        from_easy = np.repeat(simple, counts)
        out[from_easy] = easy_ids
        for place, ids in zip(np.flatnonzero(~simple), other):
            out[ends[place] - len(ids):ends[place]] = ids
        return out, counts

    def _by_chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pa.concat_arrays([texts])  # one run of bytes from the first text on
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        bounds = offsets - offsets[0]
        starts = _cuts(data, self.by_rule)
        starts[bounds[:-1][bounds[:-1] < len(data)]] = True
        begins = np.append(np.flatnonzero(starts), len(data))
        per_text = np.diff(np.searchsorted(begins[:-1], bounds))
        pieces = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.places.get, chunks))
        unknown = np.array([k is None for k in known], bool)
        is_word = pc.match_substring_regex(coded.dictionary, _WORD).to_numpy(zero_copy_only=False).astype(bool)[unknown] & self.by_rule
        missing = list(compress(chunks, unknown))
        kind = np.where(is_word, 0, 2)
        kind[~is_word] -= np.array([missing[i].isprintable() and len(missing[i].split()) == 1 for i in np.flatnonzero(~is_word)], bool)
        order = np.argsort(kind, kind="stable")
        missing = [missing[i] for i in order]
        new_ids, new_counts = self._encode_chunks(missing, int((kind == 0).sum()), int((kind == 1).sum()))
        place = np.array([-1 if k is None else k for k in known], np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place[place < 0] = len(self.known_counts) + rank
        ids, counts = np.concatenate([self.known_ids, new_ids]), np.concatenate([self.known_counts, new_counts])
        room = max(0, REMEMBERED - len(self.places))
        if room and missing:
            kept = missing[:room]
            self.places.update(zip(kept, range(len(self.known_counts), len(self.known_counts) + len(kept))))
            self.known_counts = counts[:len(self.known_counts) + len(kept)]
            self.known_ids = ids[:int(self.known_counts.sum())]
        starts = np.cumsum(counts) - counts
        return _gathered(ids, starts, counts, place[coded.indices.to_numpy()], per_text)

    def _encode_chunks(self, chunks: list[str], words: int, lines: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each chunk, the space before it included.

        The first ``words`` chunks are one pre-token each; they are spelled by bytes here, encoded as one
        text, and cut by their lengths.  The next ``lines`` chunks hold no white space inside; they are
        encoded as one text, one chunk a line, and cut at the line ends.
        """
        ids, counts = [], []
        groups = ["\n".join(chunks[at:min(at + _WORDS_AT_ONCE, words)]) for at in range(0, words, _WORDS_AT_ONCE)]
        if groups:
            data = np.frombuffer("\n".join(groups).encode(), np.uint8)
            spelled = np.where(data == 10, np.uint16(10), self.spelling[data])
            spelled = spelled.astype("<u2").tobytes().decode("utf-16-le")
            bounds = np.append(np.flatnonzero(data == 10), len(data))
            cuts = [0, *(bounds[_WORDS_AT_ONCE - 1:-1:_WORDS_AT_ONCE] + 1).tolist(), len(spelled) + 1]
            found = self.by_words.encode_batch_fast([spelled[i:j - 1] for i, j in zip(cuts, cuts[1:])], add_special_tokens=False)
            found = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)
            ends = bounds - np.arange(len(bounds))  # of each word, line ends left out
            last = np.searchsorted(np.cumsum(self.sizes[found]), ends) + 1
            ids.append(found)
            counts.append(np.diff(last, prepend=0))
        for at in range(words, words + lines, _LINES_AT_ONCE * 256):
            part = chunks[at:min(at + _LINES_AT_ONCE * 256, words + lines)]
            texts = ["\n".join(part[i:i + _LINES_AT_ONCE]) for i in range(0, len(part), _LINES_AT_ONCE)]
            end = [self.newline]
            found = np.fromiter(chain.from_iterable(x for e in self.library.encode_batch_fast(texts, add_special_tokens=False) for x in (e.ids, end)), np.uint32)
            cut = found == self.newline
            bounds = np.concatenate([[-1], np.flatnonzero(cut)])
            if len(bounds) != len(part) + 1:
                raise RuntimeError("This tokenizer joins line ends with other characters")
            ids.append(found[~cut])
            counts.append(np.diff(bounds) - 1)
        rest = [e.ids for e in self.library.encode_batch_fast(chunks[words + lines:], add_special_tokens=False)]
        ids.append(np.fromiter(chain.from_iterable(rest), np.uint32))
        counts.append(np.array([len(r) for r in rest], np.int64))
        return np.concatenate(ids), np.concatenate(counts)


@lru_cache(maxsize=1)
def shared_encoder(path: str | None = None) -> Encoder:
    """The encoder of this Python worker: later tasks find the chunks of earlier ones."""
    return Encoder(path)


def _gathered(ids, starts, counts, places, per_text) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``places`` of ``ids`` one after the other, and the length of each text's runs together."""
    runs = counts[places]
    ends = np.cumsum(runs)
    total = int(ends[-1]) if len(ends) else 0
    out = ids[np.repeat(starts[places] - (ends - runs), runs) + np.arange(total)]
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
    return out, np.diff(bounds)


def token_bytes(path: str | None = None) -> np.ndarray:
    """Number of UTF-8 bytes each id stands for; a byte-level vocabulary spells one character a byte."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path or default_tokenizer())
    sizes = np.zeros(library.get_vocab_size(), np.int64)
    special = {i: t.content for i, t in library.get_added_tokens_decoder().items()}
    for text, i in library.get_vocab().items():
        sizes[i] = len(special[i].encode()) if i in special else len(text)
    return sizes


def packed(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per text holding its ids as little-endian unsigned 32-bit integers."""
    data = np.ascontiguousarray(ids, "<u4")
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
