"""Phrase collocation mining with Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and into
words at blanks and tabs.  Phrases are runs of 1 to ``MAX_WORDS`` words of a piece.

* Prefix polynomials over a block's bytes give every word's hash as a difference of
  two of them; the hash of a phrase follows from those of its words and their
  lengths (as if joined by one blank).  Two bases make the 62-bit fingerprint, a
  third an independent check value.
* Phrases are counted order by order.  Equal fingerprints of some blocks are added
  up with a pointer to one occurrence (text hash, start, length in bytes), and the
  shuffle adds up those sums.  An order takes only phrases whose two parts of one
  word less are frequent, as told by a bit filter of fixed size an order:
   however much is frequent, it may let through too much, never too little.
* Collisions: all occurrences of a fingerprint must agree in the check value.  Those
  of fingerprints that do not are counted again by their text.
* Only frequent phrases become text, read at their pointer; no pass moves any text
  but the documents pointed at.

Scores and the choice of phrases are SQL over the frequent phrases.

Defined results: a null text is empty; documents without a language form the
language ``und``; repeated rows count each time; an empty table gives no phrases;
a word is never cut, whatever its length.  Key columns are not needed, and columns
other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.bitfilter import BITS, bit_filter, passes
from aerolake.llm.common import small_batches, stored
from aerolake.llm.shingles import mixed

MAX_WORDS, MIN_COUNT, TOP, ABSORBED = 4, 30, 2000, 80
SCALE = 2_000_000
#: The modulus, and the bases of the fingerprint and of the check value.
PRIME = (1 << 31) - 1
BASES = (1000003, 998244353), (69069069,)
#: Bytes of text hashed at once (a longer text is cut between two pieces), and phrases added up at once.
BLOCK_BYTES, SUMMED = 1 << 18, 1 << 19
#: Rows handed to Spark at once.
BATCH_ROWS = 1 << 16
#: Top lists are first cut within so many parts of a language.
PARTS = 64

# A-Z become lower case; pieces end at . , ; : ! ? and line ends, words at blank and tab.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\v\f\r")] = 2

COUNTED = "print long, count int, check int, text_hash long, span long"


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo PRIME: 2^31 is 1 there, so the upper bits are added to the lower ones."""
    p, bits = np.uint64(PRIME), np.uint64(31)
    x = (x & p) + (x >> bits)
    x = (x & p) + (x >> bits)
    return np.where(x >= p, x - p, x)


class Hasher:
    """Hashes of the words of a block and of their runs, for each of some bases."""

    def __init__(self, bases, prime: int = PRIME):
        self.prime, self.bases = prime, bases
        self.powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in bases]

    def _mod(self, x: np.ndarray) -> np.ndarray:
        return _reduced(x) if self.prime == PRIME else x % np.uint64(self.prime)

    def _grow(self, n: int) -> None:
        for at, x in enumerate(self.bases):
            have, back = self.powers[at]
            while len(have) < n:  # the table doubles: x^(m+i) = x^m x^i
                step, step_back = pow(x, len(have), self.prime), pow(x, -len(have), self.prime)
                have = np.concatenate([have, self._mod(have * np.uint64(step))])
                back = np.concatenate([back, self._mod(back * np.uint64(step_back))])
            self.powers[at] = have, back

    def words(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        """Per base the hash of each span [first, last) of ``data``."""
        self._grow(len(data) + 2)
        wide = data.astype(np.uint64) + np.uint64(1)
        out = []
        for powers, back in self.powers:
            terms = wide * powers[:len(data)]
            if len(data) >= 1 << 24:  # below, sums of unreduced terms (under 2^39) are exact
                terms = self._mod(terms)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
            out.append(self._mod(self._mod(sums[last] - sums[first]) * back[first]))
        return out

    def runs(self, words: list[np.ndarray], sizes: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
        """One 64-bit value for the run of ``order`` words from each word of ``at``, as if joined by blanks."""
        value = np.zeros(len(at), np.uint64)
        for word, x, (powers, _) in zip(words, self.bases, self.powers):
            found = word[at + order - 1]
            for k in range(order - 2, -1, -1):
                tail = self._mod(np.uint64(33) + np.uint64(x) * found)
                found = self._mod(word[at + k] + self._mod(powers[sizes[at + k]] * tail))
            value = (value << np.uint64(31)) ^ found
        return value


def blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, number of the text, place in the text) of blocks that cover all texts; the two last by run of bytes.

    A run is [start, end) of the block's bytes: a text, or the part of a long one
    between two ends of pieces.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    runs, held = [], 0
    for number, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        at = start
        while at < end:
            stop = end
            if end - at > BLOCK_BYTES:
                cut = np.flatnonzero(_KIND[data[at:at + BLOCK_BYTES]] == 2)
                step = BLOCK_BYTES
                while not len(cut) and at + step < end:  # one piece longer than a block stays whole
                    cut = step + np.flatnonzero(_KIND[data[at + step:at + 2 * step]] == 2)
                    step *= 2
                stop = min(end, at + int(cut[-1]) + 1) if len(cut) else end
            runs.append((number, at - start, at, stop))
            held += stop - at
            at = stop
            if held >= BLOCK_BYTES:
                yield _block(data, runs)
                runs, held = [], 0
    if runs:
        yield _block(data, runs)


def _block(data: np.ndarray, runs: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([stop - at for _, _, at, stop in runs])])
    return (_LOWER[np.concatenate([data[at:stop] for _, _, at, stop in runs])], bounds,
            np.array([r[0] for r in runs]), np.array([r[1] for r in runs]))


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, run, piece) of every word of a block."""
    kind = _KIND[data]
    solid = kind == 0
    before, after = np.concatenate([[False], solid[:-1]]), np.concatenate([solid[1:], [False]])
    before[bounds[:-1]] = False
    after[bounds[1:] - 1] = False
    first, last = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    run = np.searchsorted(bounds, first, "right") - 1
    return first, last, run, np.cumsum(kind == 2)[first] + run


def _phrases(block, order: int, hasher: Hasher, checker: Hasher, languages: np.ndarray, held: list[np.ndarray]):
    """(fingerprint, check, first byte, byte after, run) of the runs of ``order`` words that can be frequent.

    ``held`` has the filters of the orders 1, 2, ... below.
    """
    data, bounds, number, _ = block
    first, last, run, piece = _words(data, bounds)
    salt = languages[number][run]
    words, size = hasher.words(data, first, last), last - first
    at = np.arange(len(first))
    for n in range(1, order):
        if n <= len(held):
            at = at[passes(held[n - 1], mixed(hasher.runs(words, size, at, n) ^ salt[at]))]
        # The next order begins where both this run and the one a word on are frequent, in one piece.
        follows = np.zeros(len(first) + 1, bool)
        follows[at] = True
        at = at[follows[at + 1]]
        at = at[piece[at] == piece[at + n]]
    return (mixed(hasher.runs(words, size, at, order) ^ salt[at]),
            (checker.runs(checker.words(data, first, last), size, at, order) ^ (salt[at] >> np.uint64(33))).astype(np.int32),
            first[at], last[at + order - 1], run[at])


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(text, lang, lang_hash, text_hash): all that the tasks see of a document; the text hash tells languages apart."""
    lang = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    text = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(text.alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), F.xxhash64(lang, text).alias("text_hash"))


def count_phrases(rows: DataFrame, order: int, filters: list = (), bases=BASES, prime: int = PRIME, min_count: int = MIN_COUNT) -> DataFrame:
    """Written rows (print, count, clash, text_hash, start, size): the fingerprints of ``order`` words found ``min_count`` times.

    Order 1 has the empty phrase of every language as well, which stands once at every word.

    ``filters`` has the broadcast filters of the orders below.  ``clash`` marks fingerprints of several phrases.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, checker, held = Hasher(bases[0], prime), Hasher(bases[1]), [f.value for f in filters]
        waiting, n = [], 0

        def summed() -> Iterator[pa.RecordBatch]:
            prints, checks, hashes, spans = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            by = np.argsort(prints)
            same = prints[by][1:] == prints[by][:-1]
            if (same & (checks[by][1:] != checks[by][:-1])).any():  # a collision, hardly ever
                by = np.lexsort((checks, prints))
            prints, checks = prints[by], checks[by]
            # Equal fingerprints side by side; should they differ in the check value, each value is a row.
            heads = np.flatnonzero(np.append(True, (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])))
            counts, prints, checks, one = np.diff(np.append(heads, len(by))), prints[heads], checks[heads], by[heads]
            for at in range(0, len(heads), BATCH_ROWS):
                part = slice(at, at + BATCH_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[part].view(np.int64)), pa.array(counts[part].astype(np.int32)), pa.array(checks[part]),
                     pa.array(hashes[one[part]].view(np.int64)), pa.array(spans[one[part]])], ["print", "count", "check", "text_hash", "span"])

        for batch in batches:
            texts = batch.column(0).cast(pa.large_string())
            languages, hashes = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)).view(np.uint64) for i in (1, 2))
            for block in blocks(texts):
                prints, checks, first, last, of_run = _phrases(block, order, hasher, checker, languages, held)
                of_text, span = block[2][of_run], (first - block[1][of_run] + block[3][of_run]) << 31 | last - first
                if len(prints):
                    waiting.append((prints, checks, hashes[of_text], span))
                    n += len(prints)
                    if order == 1:
                        empty = mixed(languages[of_text] ^ np.uint64(1 << 63))  # no phrase of the language has this bit
                        waiting.append((empty, np.zeros(len(span), np.int32), hashes[of_text], np.zeros(len(span), np.int64)))
                if n >= SUMMED:
                    yield from summed()
                    n = 0
        if waiting:
            yield from summed()

    counted = rows.select("text", "lang_hash", "text_hash").mapInArrow(run, COUNTED).groupBy("print").agg(
        F.sum("count").alias("count"), F.min("check").alias("low"), F.max("check").alias("high"),
        F.min("text_hash").alias("text_hash"), F.min_by("span", "text_hash").alias("span"))
    # The empty phrase is a language's number of words and stays, however small.
    counted = counted.where((F.col("count") >= min_count) | (F.col("span") == 0))
    with small_batches(rows.sparkSession):
        return stored(counted.select("print", "count", (F.col("low") != F.col("high")).alias("clash"), "text_hash",
                                     F.shiftright("span", 31).alias("start"), F.col("span").bitwiseAND(F.lit((1 << 31) - 1)).alias("size")), f"phrases-{order}", "zstd")


def _read_pointers(rows: DataFrame, found: DataFrame, bits: int) -> DataFrame:
    """``found`` with lang and phrase, read from the documents pointed at (those alone are moved)."""
    wanted = bit_filter(found.select("text_hash"), bits)

    def pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.asarray(batch.column(2).to_numpy(zero_copy_only=False)).view(np.uint64)
            yield batch.filter(pa.array(passes(wanted.value, hashes)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["print", "count", "clash", "lang", "phrase"]
        for batch in batches:
            phrases = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                lower = bytes(_LOWER[np.frombuffer(data, np.uint8)])
                phrases.append([b" ".join(lower[s["start"]:s["start"] + s["size"]].replace(b"\t", b" ").split(b" ")).decode() for s in spans])
            spans = [s for found in batch.column(2).to_pylist() for s in found]
            lang = np.repeat(np.arange(batch.num_rows), [len(p) for p in phrases])
            yield pa.RecordBatch.from_arrays(
                [pa.array([s[n] for s in spans], kind) for n, kind in (("print", pa.int64()), ("count", pa.int64()), ("clash", pa.bool_()))]
                + [batch.column(0).take(pa.array(lang)), pa.array([" ".join(filter(None, p.split(" "))) for found in phrases for p in found], pa.string())], names)

    # Phrases of one text are dealt with a part at a time: a text may hold all of them.
    part = F.pmod("print", F.lit(PARTS))
    spans = found.groupBy("text_hash", part.alias("part")).agg(F.collect_list(F.struct("print", "count", "clash", "start", "size")).alias("spans"))
    texts = rows.select("text", "lang", "text_hash").mapInArrow(pointed, "text string, lang string, text_hash long")
    texts = texts.groupBy("text_hash").agg(F.first("lang").alias("lang"), F.first("text").alias("text"))
    return texts.join(spans, "text_hash").select("lang", "text", "spans").mapInArrow(
        cut, "print long, count long, clash boolean, lang string, phrase string")


def _counted_by_text(rows: DataFrame, clashing: DataFrame, order: int, bases, prime: int, min_count: int, bits: int) -> DataFrame:
    """(lang, phrase, f) of all phrases whose fingerprints clash, counted by their text."""
    wanted = bit_filter(clashing, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, checker = Hasher(bases[0], prime), Hasher(bases[1])
        for batch in batches:
            texts = batch.column(0).cast(pa.large_string())
            languages = np.asarray(batch.column(2).to_numpy(zero_copy_only=False)).view(np.uint64)
            for block in blocks(texts):
                found = _phrases(block, order, hasher, checker, languages, [])
                at = np.flatnonzero(passes(wanted.value, found[0]))
                spans = [bytes(block[0][a:b]).replace(b"\t", b" ").split(b" ") for a, b in zip(found[2][at].tolist(), found[3][at].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0][at].view(np.int64)), batch.column(1).take(pa.array(block[2][found[4][at]])),
                     pa.array([b" ".join(filter(None, words)).decode() for words in spans], pa.string())], ["print", "lang", "phrase"])

    found = rows.mapInArrow(run, "print long, lang string, phrase string")
    return found.groupBy("print", "lang", "phrase").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= min_count).join(
        clashing.select("print"), "print", "left_semi").select("lang", "phrase", "f")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, bases=BASES, prime: int = PRIME,
                     bits: int = BITS) -> DataFrame:
    """Written rows (lang, phrase, f) of the phrases of 0 to ``MAX_WORDS`` words found ``min_count`` times; the empty one gives the number of words.

    ``prime`` and the first of ``bases`` make the fingerprint.
    """
    rows = _rows(docs, text, lang)
    levels, filters, again = [], [], []
    for order in range(1, MAX_WORDS + 1):
        level = count_phrases(rows, order, filters, bases, prime, min_count)
        levels.append(level)
        if order < MAX_WORDS:
            filters.append(bit_filter(level.select("print"), bits))
        clashing = level.where("clash").select("print")
        if not clashing.isEmpty():
            again.append(_counted_by_text(rows, clashing, order, bases, prime, min_count, bits))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    out = _read_pointers(rows, found.where("NOT clash"), bits).select("lang", "phrase", F.col("count").alias("f"))
    for more in again:
        out = out.unionByName(more)
    with small_batches(rows.sparkSession):
        return stored(out, "frequent-phrases", "zstd")


def collocations(phrases: DataFrame, top: int = TOP, absorbed: int = ABSORBED) -> DataFrame:
    """The ``top`` phrases of two and more words of each language by score: lang, rank, phrase, a, l, r, n, score.

    ``phrases`` is what :func:`frequent_phrases` gives.  A phrase's score is the
    least of ``floor(SCALE * a / (l + r))`` over its cuts in two.  A phrase inside a
    longer one that is at least ``absorbed`` percent as frequent is dropped.
    """
    words = F.split("phrase", " ")
    several = phrases.withColumn("w", words).where("size(w) > 1").withColumnRenamed("f", "a")
    cuts = several.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"), "w").select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    score = F.expr(f"CAST(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    longer = several.where("size(w) > 2").select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("m"))
    longer = longer.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("at"))
    inside = longer.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("around"))
    big = "DECIMAL(24,0)"
    kept = best.join(inside, ["lang", "phrase"], "left").where(
        f"around IS NULL OR 100 * CAST(around AS {big}) < {absorbed} * CAST(a AS {big})").select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    kept = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = phrases.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return kept.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, absorbed: int = ABSORBED) -> DataFrame:
    return collocations(frequent_phrases(docs, text, lang, min_count), top, absorbed)
