"""Style of whole texts as bytes of a vector: what a quality model sees of a document.

A text is described by shares between 0 and 1, stored as round(255 * sqrt(share)):
of its bytes by class, of its pairs of neighbouring bytes by classes, of its words
by length and make-up, of its lines by ending and length, of distinct words and
lines, and by its length on a logarithmic scale.  No single word is a feature, so the
vector means the same in every language.  A null text is empty; an empty text has
only its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from aerolake.llm.shingles import mixed

# The class of each byte.
CLASSES = ("lower", "upper", "digit", "blank", "line end", "stop", "comma", "bracket", "symbol", "beyond ascii", "control")
_CLASS = np.full(256, 10, np.uint8)
for _name, _members in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("blank", b" \t"), ("line end", b"\n\v\f\r"),
                        ("stop", b".?!"), ("comma", b",;:"), ("bracket", b"'\"()[]{}<>"), ("symbol", b"#$%&*+-/=@\\^_`|~"),
                        ("beyond ascii", range(128, 256))):
    _CLASS[list(_members)] = CLASSES.index(_name)

#: Upper ends of the classes of word lengths (bytes), line lengths (bytes) and text lengths (bytes, powers of 4).
WORD_ENDS, LINE_ENDS = (1, 2, 3, 4, 6, 8, 11, 15, 24), (3, 15, 40, 80, 160, 400)
TEXT_STEPS = 10

_N = len(CLASSES)
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64))
NAMES = ([f"bytes: {c}" for c in CLASSES] + [f"pair: {a}, {b}" for a in CLASSES for b in CLASSES]
         + [f"words up to {e}" for e in (*WORD_ENDS, "any")] + [f"words with {c}" for c in CLASSES if c not in ("blank", "line end")]
         + ["words of letters", "distinct words", "words beginning upper"]
         + [f"lines up to {e}" for e in (*LINE_ENDS, "any")] + ["lines ended by stop", "distinct lines"] + [f"length about 4^{i}" for i in range(TEXT_STEPS)])
WIDTH = len(NAMES)
_SLICE_BYTES = 1 << 19


def _spans(solid: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last + 1, text) of the runs of ``solid`` bytes within the texts."""
    before, after = np.append(False, solid[:-1]), np.append(solid[1:], False)
    before[bounds[:-1]] = False
    after[bounds[1:] - 1] = False
    first, last = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return first, last, np.searchsorted(bounds, first, "right") - 1


def _distinct(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct values in each text."""
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return np.bincount(text[new], minlength=n)


def _slice(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Shares of the non-empty texts data[bounds[i]:bounds[i + 1]]."""
    n, size = len(bounds) - 1, np.diff(bounds)
    text = np.repeat(np.arange(n), size)
    kind = _CLASS[data].astype(np.int64)
    count = lambda where, of, width: np.bincount(where * width + of, minlength=n * width).reshape(n, width)
    share = lambda counts, total: counts / np.maximum(np.asarray(total), 1)[:, None]
    parts = [share(count(text, kind, _N), size)]
    inner = text[1:] == text[:-1]
    parts.append(share(count(text[1:][inner], (kind[:-1] * _N + kind[1:])[inner], _N * _N), size - 1))

    # Words are told apart by their letters, length and beginning, lines by their letters and length.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[data])])
    first, last, of = _spans((kind != 3) & (kind != 4), bounds)
    words = np.bincount(of, minlength=n)
    parts.append(share(count(of, np.searchsorted(WORD_ENDS, last - first), len(WORD_ENDS) + 1), words))
    letters = np.ones(len(first), bool)
    for c in range(_N):
        if c in (3, 4):
            continue
        held = np.concatenate([[0], np.cumsum(kind == c)])
        has = held[last] > held[first]
        parts.append(share(np.bincount(of[has], minlength=n)[:, None], words))
        if c not in (0, 1, 5, 6, 9):
            letters &= ~has
    value = mixed((sums[last] - sums[first]) + mixed(data[first].astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)))
    parts += [share(x[:, None], words) for x in (np.bincount(of[letters], minlength=n), _distinct(value, of, n), np.bincount(of[kind[first] == 1], minlength=n))]

    first, last, of = _spans(kind != 4, bounds)
    lines = np.bincount(of, minlength=n)
    parts.append(share(count(of, np.searchsorted(LINE_ENDS, last - first), len(LINE_ENDS) + 1), lines))
    value = mixed((sums[last] - sums[first]) + mixed((last - first).astype(np.uint64)))
    parts += [share(x[:, None], lines) for x in (np.bincount(of[kind[last - 1] == 5], minlength=n), _distinct(value, of, n))]
    return np.hstack([*parts, _lengths(size)])


def _lengths(size: np.ndarray) -> np.ndarray:
    """The length between two powers of 4, as weights of both."""
    at = np.minimum(np.log2(np.maximum(size, 1)) / 2, TEXT_STEPS - 1)
    return np.maximum(0, 1 - np.abs(at[:, None] - np.arange(TEXT_STEPS)))


def describe(texts: pa.Array) -> np.ndarray:
    """One row of ``WIDTH`` bytes for each text."""
    texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
    out = np.zeros((len(texts), WIDTH), np.uint8)
    if not len(texts):
        return out
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    out[:, -TEXT_STEPS:] = 255 * np.sqrt(_lengths(np.zeros(len(texts), np.int64)))
    filled = np.flatnonzero(np.diff(offsets))
    at = 0
    while at < len(filled):  # slices of whole texts
        end = max(at + 1, int(np.searchsorted(offsets[filled + 1], offsets[filled[at]] + _SLICE_BYTES, "right")))
        low, high = offsets[filled[at]], offsets[filled[end - 1] + 1]
        bounds = np.append(offsets[filled[at:end]], high) - low
        out[filled[at:end]] = np.rint(255 * np.sqrt(_slice(data[low:high], bounds)))
        at = end
    return out
