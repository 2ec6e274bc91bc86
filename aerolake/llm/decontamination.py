"""Benchmark decontamination with a positional inverted index.

The index holds, for every training document, the postings (term, positions) of
all terms of the test items; it is kept document by document, so building it
moves no text.  Terms are counted over the whole index, and each test window is
looked up from its rarest term on: the offset-adjusted position lists of its
terms are intersected, rarest first, until the list is empty or all terms agree.
With ``slop`` above 0 a term may stand that many words off its place (proximity).

Test items are taken in blocks of bounded size, each with its own index, so what a
task needs of them is bounded however large the benchmark is.

Defined results: a null or wordless text has no words and no hits; a wordless or
null item has no window; equal items count once each by their id; an item without
an id can be hit but is not listed; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import stored

WINDOW = 10
#: UTF-8 bytes of test items handled at a time.
BLOCK_BYTES = 4 << 20
# A-Z become lower case; digits, a-z and all bytes of other letters make words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

INDEX = "key long, text_hash long, n_words long, terms array<int>, sizes array<int>, positions array<int>"
FOUND = "key long, text_hash long, items array<long>, spans array<struct<start: int, end: int, exact: boolean>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()


@dataclass
class Windows:
    """Distinct windows of a block: term ids, and the items each belongs to."""

    vocabulary: dict[bytes, int]
    windows: list[tuple[int, ...]]
    items: list[list[int]]


def item_windows(items: list[tuple[int | None, str | None]], size: int = WINDOW) -> Windows:
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[int]] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(text)]
        for at in range(max(1, len(ids) - size + 1) if ids else 0):
            owner = owners.setdefault(tuple(ids[at:at + size]), set())
            if item is not None:
                owner.add(item)
    return Windows(vocabulary, list(owners), [sorted(v) for v in owners.values()])


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Written postings of the ``vocabulary`` terms, one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # terms of at most BLOCK_BYTES of text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.get
        for batch in batches:
            counts, terms, sizes, positions = [], [], [], []
            for value in batch.column(2).to_pylist():
                found = words(value)
                ids = np.fromiter((find(w, -1) for w in found), np.int32, len(found))
                at = np.flatnonzero(ids >= 0).astype(np.int32)
                at = at[np.argsort(ids[at], kind="stable")]
                of = ids[at]
                first = np.flatnonzero(np.diff(of, prepend=-1))
                counts.append(len(found))
                terms.append(of[first])
                sizes.append(np.diff(first, append=len(of)).astype(np.int32))
                positions.append(at)
            lists = [_lists(x) for x in (terms, sizes, positions)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), *lists],
                ["key", "text_hash", "n_words", "terms", "sizes", "positions"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    return stored(rows.mapInArrow(run, INDEX), "postings", "zstd")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int32), *arrays]))


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """Occurrences of every term over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["term", "n"])

    counts = np.zeros(n_terms, np.int64)
    for row in index.select("terms", "sizes").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]  # one row per term of the block
    return counts


def phrase_starts(postings: dict[int, np.ndarray], lookups: list[tuple[int, int]], slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(starts, exact) of the places where every (offset, term) of ``lookups`` agrees; the rarest comes first."""
    offset, term = lookups[0]
    starts = postings[term] - offset
    exact = np.ones(len(starts), bool)
    for offset, term in lookups[1:]:
        there = postings[term]
        wanted = starts + offset
        place = np.searchsorted(there, wanted - slop)
        ok = there[np.minimum(place, len(there) - 1)] <= wanted + slop
        ok &= place < len(there)
        if slop:
            exact &= there[np.minimum(np.searchsorted(there, wanted), len(there) - 1)] == wanted
        starts, exact = starts[ok], exact[ok]
        if not len(starts):
            break
    return starts, exact


def search(index: DataFrame, block: Windows, slop: int = 0) -> DataFrame:
    """Documents that hold a window: the items, and the merged spans [start, end) of words they cover."""
    counts = term_counts(index, len(block.vocabulary))
    by_rarest: dict[int, list[tuple[list[tuple[int, int]], int, list[int]]]] = {}
    for window, items in zip(block.windows, block.items):
        if all(counts[t] for t in window):
            lookups = sorted(enumerate(window), key=lambda x: (counts[x[1]], x[0]))
            by_rarest.setdefault(lookups[0][1], []).append((lookups, len(window), items))
    shared = index.sparkSession.sparkContext.broadcast(by_rarest)  # WINDOW entries for each word of a block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        rarest = np.fromiter(entries, np.int32, len(entries))
        for batch in batches:
            rows = []
            terms, sizes, positions = (batch.column(i) for i in (2, 3, 4))
            t_at, p_at = terms.offsets.to_numpy(), positions.offsets.to_numpy()
            all_terms, all_sizes, all_positions = (c.values.to_numpy() for c in (terms, sizes, positions))
            hopeful = np.isin(all_terms, rarest)
            for i in range(batch.num_rows):
                part = slice(t_at[i], t_at[i + 1])
                if not hopeful[part].any():
                    continue
                own = all_terms[part]
                cuts = np.cumsum(all_sizes[part])[:-1]
                postings = dict(zip(own.tolist(), np.split(all_positions[p_at[i]:p_at[i + 1]], cuts)))
                spans, items = [], set()
                for term in own[hopeful[part]].tolist():
                    for lookups, length, owners in entries[term]:
                        if any(t not in postings for _, t in lookups):
                            continue
                        starts, exact = phrase_starts(postings, lookups, slop)
                        if len(starts):
                            items.update(owners)
                            spans += [(int(s), int(s) + length, bool(e)) for s, e in zip(starts, exact)]
                if spans:
                    rows.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), sorted(items), merged(spans)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["key", "text_hash", "items", "spans"])

    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()),
             pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("exact", pa.bool_())]))]
    return index.select("key", "text_hash", "terms", "sizes", "positions").mapInArrow(run, FOUND)


def merged(spans: list[tuple[int, int, bool]]) -> list[dict]:
    """Overlapping or touching spans of one kind joined."""
    out: list[dict] = []
    for start, end, exact in sorted(spans, key=lambda s: (not s[2], s[0], s[1])):
        if out and out[-1]["exact"] == exact and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end, "exact": exact})
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per document: ``key``, text_hash, n_words, items (sorted distinct ids) and spans of hit words.

    Spans of several blocks may overlap; ``covered`` counts their words.
    """
    items = stored(benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).cast("string").alias("text"))
                   .where("text IS NOT NULL").distinct(), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = total // BLOCK_BYTES + 1
    words_of, results = None, []
    for block in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block).collect()  # about BLOCK_BYTES
        windows = item_windows([(r["item"], r["text"]) for r in rows], window)
        index = build_index(docs, windows.vocabulary, key, text)
        words_of = index.select("key", "text_hash", "n_words") if words_of is None else words_of
        # Repeated rows have equal results.
        results.append(search(index, windows, slop).groupBy("key", "text_hash").agg(F.first("items").alias("items"), F.first("spans").alias("spans")))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    # One entry per block at most; written, so that Spark sees how few they are.
    found = stored(found.groupBy("key", "text_hash").agg(F.flatten(F.collect_list("items")).alias("items"),
                                                         F.flatten(F.collect_list("spans")).alias("spans")), "contaminated")
    found = found.withColumnRenamed("key", "found_key").withColumnRenamed("text_hash", "found_hash")
    same = F.col("key").eqNullSafe(F.col("found_key")) & F.col("text_hash").eqNullSafe(F.col("found_hash"))
    nothing = F.array().cast("array<struct<start: int, end: int, exact: boolean>>")
    return words_of.join(found, same, "left").select(
        F.col("key").alias(key), "text_hash", "n_words", F.array_sort(F.array_distinct(F.coalesce("items", F.array().cast("array<long>")))).alias("items"),
        F.coalesce("spans", nothing).alias("spans"))


def covered(spans):
    """Number of words inside at least one of the ``spans``, which are taken in order of their start."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    step = F.aggregate(ordered, zero, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["reach"]))).alias("n"),
        F.greatest(acc["reach"], s["end"]).alias("reach")))
    return step["n"].cast("long")
