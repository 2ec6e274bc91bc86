"""Exact n-gram Jaccard join over a metric space of shingle sets.

Two sets are linked when intersection / union >= PERCENT / 100.  The Jaccard
distance is a metric, and the join works by pivots and regions:

* Pivots are the single-shingle sets {s}, in one global order (rarest first).  The
  distance from a set A to {s} is 1 - 1/|A| when s is in A, and 1 otherwise, so A's
  nearest pivots are its own shingles; the order breaks ties and makes the first of
  them A's home region.  Within the link distance a set can lose at most
  |A| - ceil(t |A|) shingles, so only A's first |A| - ceil(t |A|) + 1 pivots can be
  the first one it shares with a partner: these regions get a replica of A.  Linked
  sets therefore meet in a region, and a set leaves a region where no set of matching
  size lies early enough for the two to meet there first.
* A region is joined by a pivot of its own, its least set: the pivot's distance to
  every member is computed exactly from the texts if their parities (below) admit a
  link, else bounded by them, and linked members form components.
* A region whose members lie in more than one component is joined recursively: it
  is one block if it is small, else cut into blocks by set size, pairs of blocks whose sizes cannot match are
  skipped, and in each pair the triangle inequality opens the windows: the distances
  to the region's pivot may differ by the link distance at most, and the parities of the counts of
  shingles by class (distances to sets that part the universe, more of them for larger
  sets) by the largest possible difference.  Sets within all windows and in different components are
  compared exactly.
* Near copies meet in many regions.  A set knows some crowded regions it lies in, those of the least pivots, and a
  pair that has one in common is left to the first of them: it is found there once, not in every region.
* The recursive join has two passes.  The first takes every set in its most crowded region only and
  compares the blocks with the region's first block, each set there with the candidate that has most
  candidates of its own: a number of pairs linear in the sets, which makes a large group of linked
  sets one component.  The second takes all regions and all blocks, with those components.

Equal sets are one class, joined once.  Sets are compared in full; hashes of 64
bits stand for shingles.

Defined results: a null or wordless text has an empty set and links with nothing;
its component is its own key; a null key belongs to a component without giving it a
name; equal keys with different texts are separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.bitfilter import bit_filter, passes
from aerolake.llm.common import discard, release, small_batches, stored
from aerolake.llm.components import components
from aerolake.llm.shingles import Shingler, mixed

WIDTH, PERCENT = 3, 90
#: Shingles with the lowest hashes are counted and come first, rarest first: so many for each place of a prefix.  A set finds
#: its prefix among those that it shares with nobody, unless a fifth of what it has are common ones: these crowd no region.
COUNTED_A_PLACE = 1.25
#: A set of n shingles is counted in n to 2 n classes, a power of two within these bounds, and one bit a class is kept.
#: Those of unrelated sets then differ in about half of n, and linked ones in 2 (1 - t) / (1 + t) of n at most: 0.22 n at t = 0.8.
MIN_CLASSES, MAX_CLASSES = 64, 16384
#: Members of a block in the recursive join.
BLOCK = 256
#: Regions of more members are crowded; a set knows so many of its crowded regions.
CROWDED, CROWDS = 32, 6
#: Words of 64 classes compared at once in a task.
WORDS_AT_ONCE = 1 << 19
#: Pairs handed to Spark at once, and pairs of blocks handed to Python at once.
PAIRS_AT_ONCE, BLOCKS_AT_ONCE = 1 << 17, 128

SIGNATURE = "key long, text_hash long, n long, print_1 long, print_2 long, n_counted long, prefix array<long>, classes binary"


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def counted_limit(percent: int) -> np.uint64:
    """The hash below which shingles are counted."""
    return np.uint64(min((1 << 64) - 1, int((1 << 64) * max(0.125, COUNTED_A_PLACE * (1 - percent / 100)))))


def _strip(n, percent: int):
    """Class of a set size: a power of 1 / t, so that only sets of one class or of neighbouring ones can link."""
    return F.floor(F.log(n.cast("double")) / F.lit(-np.log(percent / 100)) + F.lit(1e-9)).cast("long")


def class_bits(found: np.ndarray) -> bytes:
    """Whether the shingles of each class are odd in number, one bit each."""
    classes = min(MAX_CLASSES, max(MIN_CLASSES, 1 << len(found).bit_length()))
    return np.packbits(np.bincount((found & np.uint64(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint8) & 1).tobytes()


def folded(bits: list[bytes], n_bytes: int) -> np.ndarray:
    """Rows of bits brought to ``n_bytes``, as 64-bit words: classes with equal low bits are added up."""
    return np.array([np.bitwise_xor.reduce(np.frombuffer(b, np.uint8).reshape(-1, n_bytes), axis=0) for b in bits]).view(np.uint64)


def differing(left: list[bytes], right: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many classes the sets ``x`` of ``left`` and ``y`` of ``right`` differ for certain; the fewer classes of a pair count."""
    out = np.zeros(len(x), np.int64)
    size_x, size_y = (np.array([len(b) for b in side]) for side in (left, right))
    size = np.minimum(size_x[x], size_y[y])
    for n_bytes in np.unique(size).tolist():
        pairs = np.flatnonzero(size == n_bytes)
        (of_x, x_at), (of_y, y_at) = np.unique(x[pairs], return_inverse=True), np.unique(y[pairs], return_inverse=True)
        one, other = (folded([side[i] for i in used.tolist()], n_bytes) for side, used in ((left, of_x), (right, of_y)))
        step = max(1, WORDS_AT_ONCE * 8 // n_bytes)
        for at in range(0, len(pairs), step):
            found = np.bitwise_count(one[x_at[at:at + step]] ^ other[y_at[at:at + step]])
            out[pairs[at:at + step]] = found.sum(axis=1, dtype=np.int64)
    return out


def signatures(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """Written rows: a row number, set size, two fingerprints, the shingles that can lie in the prefix, counts by class.

    Hashes are kept with their bits shifted so that their signed order is the hash order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, limit = Shingler(width), counted_limit(percent)
        for batch in batches:
            rows = []
            for found in shingler.sets(batch.column(2)):
                n = len(found)
                counted = int(np.searchsorted(found, limit))
                kept = found[:max(counted, prefix_length(n, percent))] if n else found
                marks = mixed(found)
                rows.append((n, int(np.bitwise_xor.reduce(marks).view(np.int64)), int(marks.sum(dtype=np.uint64).view(np.int64)), counted,
                             (kept ^ np.uint64(1 << 63)).view(np.int64),
                             class_bits(found)))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                                             ["key", "text_hash", "n", "print_1", "print_2", "n_counted", "prefix", "classes"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    signed = rows.mapInArrow(run, SIGNATURE).withColumn("row", F.monotonically_increasing_id())
    return stored(signed, "signatures", "zstd")


def regions(signed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Written rows (pivot, cid, n, leader, n_leader): the regions each class lies in, without those where nobody can link with it."""
    owner = classes.select("cid", "first_row").hint("shuffle_hash")
    sets = stored(signed.join(owner, signed["row"] == owner["first_row"]).select("cid", "n", "n_counted", "prefix"), "prefixes", "zstd")
    # Hashes do not compress: their shuffle goes before they are counted, and the counts' before regions are made.
    release(signed.sparkSession)
    shared = stored(sets.select(F.explode("prefix").alias("pivot")).groupBy("pivot").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-pivots")
    release(signed.sparkSession)
    held = bit_filter(shared.select("pivot"))

    def may_be_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per shingle that the filter of the shared ones lets through: nearly all others are met once only."""
        for batch in batches:
            offsets = batch.column(3).offsets.to_numpy()
            pivots = batch.column(3).flatten().to_numpy()
            kept = np.flatnonzero(passes(held.value, pivots.view(np.uint64)))
            row = np.searchsorted(offsets - offsets[0], kept, "right") - 1
            at = kept - (offsets - offsets[0])[row]
            counted = at < batch.column(2).to_numpy()[row]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(pa.array(row)) for i in range(3)), pa.array(counted), pa.array(at), pa.array(pivots[kept])],
                ["cid", "n", "n_counted", "counted", "at", "pivot"])

    found = sets.mapInArrow(may_be_shared, "cid long, n long, n_counted long, counted boolean, at long, pivot long").join(shared, "pivot")
    # A class's unshared counted shingles come first in the order and need no region.
    own = Window.partitionBy("cid")
    alone = F.col("n_counted") - F.sum(F.col("counted").cast("int")).over(own)
    place = F.row_number().over(own.orderBy(F.col("counted").desc(), "df", "pivot"))
    length = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    # The others follow by their hash.
    rows = found.withColumn("place", F.when(F.col("counted"), alone + place).otherwise(F.col("at") + 1)).where(
        ~F.col("counted") | (F.col("place") <= length))
    # Of two linked sets the smaller has 2 t / (1 + t) of itself at least from their first common pivot on.
    early = F.col("place") <= F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent)) + 1
    rows = stored(rows.select("pivot", "cid", "n", early.alias("early"), _strip(F.col("n"), percent).alias("strip")), "region-rows")
    matched = stored(_matched(rows, percent), "matched-rows")
    leaders = matched.groupBy("pivot").agg(F.min(F.struct("cid", "n")).alias("first"))
    leaders = leaders.select("pivot", F.col("first.cid").alias("leader"), F.col("first.n").alias("n_leader"))
    regions = stored(matched.join(leaders, "pivot"), "regions")
    discard(sets, shared, rows, matched)
    held.destroy()
    release(signed.sparkSession)
    return regions


def _matched(rows: DataFrame, percent: int) -> DataFrame:
    """(pivot, cid, n) of the ``rows`` whose region has a set that can link with theirs and meet it there first.

    Sizes must match, and the smaller set must lie there early.  A set is early or late for itself, so that both
    sets of a pair stay in the first region they share; which other regions it stays in does not matter.
    """
    early = F.when(F.col("early"), F.col("n"))
    late = F.when(~F.col("early"), F.col("n"))
    strips = rows.groupBy("pivot", "strip").agg(
        F.count(F.lit(1)).alias("m"), F.count(early).alias("m_early"), F.min("n").alias("low"), F.max("n").alias("high"),
        F.min(early).alias("low_early"), F.max(early).alias("high_early"), F.max(late).alias("high_late"))
    # A region's strips are few.
    by_size = Window.partitionBy("pivot").orderBy("strip")
    below = F.when(F.lag("strip").over(by_size) == F.col("strip") - 1, F.lag("high_early").over(by_size))
    above = F.when(F.lead("strip").over(by_size) == F.col("strip") + 1, F.lead("low").over(by_size))
    strips = strips.withColumn("below", below).withColumn("above", above)
    # Strips without any partner go before their rows are joined.
    inside = (F.col("m") > 1) & (F.col("m_early") > 0)
    from_below = F.col("below") * 100 >= F.col("low") * percent
    from_above = (F.col("high_early") * 100 >= F.col("above") * percent)
    strips = strips.where(inside | F.coalesce(from_below, F.lit(False)) | F.coalesce(from_above, F.lit(False))).select(
        "pivot", "strip", "m_early", "low_early", "high_late", "below", "above")
    larger = (F.col("low_early") <= F.col("n")) & (~F.col("early") | (F.col("m_early") > 1)) | (F.col("below") * 100 >= F.col("n") * percent)
    smaller = F.col("early") & ((F.col("m_early") > 1) | (F.col("high_late") >= F.col("n")) | (F.col("n") * 100 >= F.col("above") * percent))
    met = F.coalesce(larger, F.lit(False)) | F.coalesce(smaller, F.lit(False))
    return rows.join(strips, ["pivot", "strip"]).where(met).select("pivot", "cid", "n")


def compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Written rows (a, b, common, total): sizes of intersection and union of each pair's sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                a, b = part.column(0).to_numpy(), part.column(1).to_numpy()
                sides = []
                for ids, text in ((a, part.column(2)), (b, part.column(3))):
                    _, first, back = np.unique(ids, return_index=True, return_inverse=True)
                    sides.append((shingler.sets(text.take(pa.array(first))), back))
                (left, of_left), (right, of_right) = sides
                common = [len(np.intersect1d(left[i], right[j], assume_unique=True)) for i, j in zip(of_left, of_right)]
                total = [len(left[i]) + len(right[j]) - c for i, j, c in zip(of_left, of_right, common)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64())],
                                                 ["a", "b", "common", "total"])

    # Written, so that Spark sees how few they are and moves only the texts they name.
    pairs = stored(pairs, "pairs")
    left = texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")).join(pairs.select("a").distinct(), "a", "left_semi")
    right = texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")).join(pairs.select("b").distinct(), "b", "left_semi")
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    found = stored(joined.mapInArrow(run, "a long, b long, common long, total long"), "compared")
    discard(pairs)
    return found


def _most_apart(both: np.ndarray, percent: int) -> np.ndarray:
    """In how many shingles linked sets of so many together can differ: they share at least t / (1 + t) of the sum."""
    t = percent / 100
    return both - 2 * np.ceil(both * t / (1 + t) - 1e-9)


def parted(pairs: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Written rows (a, b, apart, may_link): a least distance of each pair's sets, by the parities of their classes, and whether it admits a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            place = np.arange(batch.num_rows)
            differ = differing(batch.column(4).to_pylist(), batch.column(5).to_pylist(), place, place)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(2 * differ / (both + differ)), pa.array(differ <= _most_apart(both, percent))],
                ["a", "b", "apart", "may_link"])

    # Written, so that Spark sees how few they are.
    pairs = stored(pairs, "pairs")
    joined = pairs.join(counts.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("classes").alias("classes_a")), "a").join(
        counts.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("classes").alias("classes_b")), "b")
    found = stored(joined.select("a", "b", "n_a", "n_b", "classes_a", "classes_b").mapInArrow(run, "a long, b long, apart double, may_link boolean"), "parted")
    discard(pairs)
    return found


def _size_window(a, b, percent: int):
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _to_busiest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the pairs that join each node with its partner of most partners: one per node at most."""
    _, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    partners, others = np.bincount(ends), np.concatenate([ends[len(a):], ends[:len(a)]])
    order = np.lexsort((others, partners[others], ends))
    last = np.append(ends[order][1:] != ends[order][:-1], True)
    return np.unique(order[last] % len(a))


def _windows(percent: int, busiest: bool):
    """Task function: pairs of two blocks that lie within all windows and in different components.

    ``busiest`` keeps of these one pair a member, that with the busiest partner.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = percent / 100
        for batch in batches:
            sides = [_members(batch.column(i)) for i in (0, 1)]
            same, before = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found, n_found = [], 0
            for i in range(batch.num_rows):
                (of_a, left), (of_b, right) = sides[0], sides[0 if same[i] else 1]
                a, b = slice(of_a[i], of_a[i + 1]), slice(of_b[i], of_b[i + 1])
                n_a, n_b = left["n"][a][:, None], right["n"][b][None, :]
                ok = (left["component"][a][:, None] != right["component"][b]) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))
                if same[i]:
                    ok &= left["cid"][a][:, None] < right["cid"][b]
                ok &= np.maximum(left["near"][a][:, None] - right["far"][b], right["near"][b] - left["far"][a][:, None]) <= 1 - t + 1e-9
                ok &= ~_met_before(left["crowds"], a, right["crowds"], b, before[i])
                x, y = np.nonzero(ok)
                if not len(x):
                    continue
                both = n_a[x, 0] + n_b[0, y]
                bits = [side["classes"][k].to_pylist() for side, k in ((left, a), (right, b))]
                keep = differing(*bits, x, y) <= _most_apart(both, percent)
                one, other = left["cid"][a][x[keep]], right["cid"][b][y[keep]]
                if busiest and len(one):
                    chosen = _to_busiest(one, other)
                    one, other = one[chosen], other[chosen]
                found.append((one, other))
                n_found += len(one)
                if n_found >= PAIRS_AT_ONCE:
                    yield _pairs(found)
                    found, n_found = [], 0
            if found:
                yield _pairs(found)

    return run


def _members(column: pa.ListArray) -> tuple[np.ndarray, dict]:
    """(bounds of each row's members, their columns) of a column of lists of members."""
    values = column.values
    fields = {f.name: values.field(i) for i, f in enumerate(values.type)}
    return column.offsets.to_numpy(), {k: v if k in ("classes", "crowds") else v.to_numpy(zero_copy_only=False) for k, v in fields.items()}


def _met_before(left: pa.ListArray, a: slice, right: pa.ListArray, b: slice, before: int | None) -> np.ndarray:
    """Which pairs of members of two blocks know a crowded region in common, one of a pivot below ``before`` if that is given."""
    known = []
    for lists, rows in ((left, a), (right, b)):
        bounds = lists.offsets.to_numpy()[rows.start:rows.stop + 1]
        pivots = lists.values.to_numpy()[bounds[0]:bounds[-1]]
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        earlier = slice(None) if before is None else pivots < before
        known.append((pivots[earlier], owner[earlier], len(bounds) - 1))
    (p, of_p, n_a), (q, of_q, n_b) = known
    shared = np.intersect1d(p, q)
    held = []
    for pivots, owner, n in known:
        marks = np.zeros((n, len(shared)), np.float32)
        inside = np.isin(pivots, shared)
        marks[owner[inside], np.searchsorted(shared, pivots[inside])] = 1
        held.append(marks)
    return held[0] @ held[1].T > 0


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _block_pairs(members: DataFrame, counts: DataFrame, percent: int, block: int, busiest: bool) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs (a, b), and the tables they are read from, inside regions that pass the windows; ``members`` has pivot, cid, n, component, near, far, before, crowds, ``counts`` cid and classes.

    ``busiest`` compares all blocks with the first one only and keeps one pair a member.
    """
    # Members by size are cut into blocks; a region's rows are numbered by their size class first, so that
    # no task sorts a region: the class is a power of 1 / t, and only neighbouring classes can link.
    rows = members.withColumn("strip", _strip(F.col("n"), percent))
    strips = stored(rows.groupBy("pivot", "strip").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high")), "strips")
    # A strip is done if it and its neighbours lie in one component.
    around = strips.withColumn("strip", F.explode(F.array(F.col("strip") - 1, F.col("strip"), F.col("strip") + 1))).groupBy("pivot", "strip").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("pivot", "strip")
    still_open = strips.select("pivot", "strip", "m").join(around, ["pivot", "strip"])
    # Regions of one block meet nobody but themselves, and need no join.
    in_region = Window.partitionBy("pivot")
    has_next = F.coalesce(F.lead("strip").over(in_region.orderBy("strip")) - F.col("strip") == 1, F.lit(False))
    sizes = stored(still_open.withColumn("has_next", has_next).withColumn("small", F.sum("m").over(in_region) <= block), "open-strips")
    rows = rows.join(sizes, ["pivot", "strip"])
    member = F.struct("cid", "n", "component", "near", "far", "classes", "crowds")
    side = [F.collect_list(member).alias("side"), F.min("component").alias("low"), F.max("component").alias("high"), F.first("before").alias("before")]
    whole = rows.where("small").join(counts, "cid").groupBy("pivot").agg(*side).where("low < high")
    rows = rows.where("NOT small").withColumn("block", F.pmod(F.xxhash64("cid"), F.ceil(F.col("m") / block)).cast("long"))
    # About ``block`` rows each.
    blocks = stored(rows.join(counts, "cid").groupBy("pivot", "strip", "block").agg(*side, F.max("has_next").alias("has_next")), "blocks")
    first_blocks = blocks.where("block = 0") if busiest else blocks
    partners = F.when(F.col("has_next"), F.array("strip", F.col("strip") + 1)).otherwise(F.array("strip"))
    left = first_blocks.select("pivot", F.explode(partners).alias("strip"), F.col("strip").alias("own"), "before",
                         F.col("block").alias("block_a"), F.col("side").alias("left"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    right = blocks.select("pivot", "strip", F.col("block").alias("block_b"), F.col("side").alias("right"), "low", "high")
    pairs = left.join(right, ["pivot", "strip"]).where(
        ((F.col("own") < F.col("strip")) | (F.col("block_a") <= F.col("block_b")))
        & ~((F.col("low") == F.col("high")) & (F.col("low_a") == F.col("low")) & (F.col("high_a") == F.col("high"))))
    # A block that meets itself is handed over once.
    same = (F.col("own") == F.col("strip")) & (F.col("block_a") == F.col("block_b"))
    pairs = pairs.select("left", F.when(~same, F.col("right")).alias("right"), same.alias("same"), "before")
    none = F.lit(None).cast(blocks.schema["side"].dataType)
    pairs = pairs.unionByName(whole.select(F.col("side").alias("left"), none.alias("right"), F.lit(True).alias("same"), "before"))
    return pairs.mapInArrow(_windows(percent, busiest), "a long, b long").distinct(), [strips, sizes, blocks]


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT,
         block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``key``, text_hash, n_shingles, class_id (equal sets) and component_id (its least key)."""
    signed = signatures(docs, key, text, width, percent)
    prints = ["n", "print_1", "print_2"]
    classes = signed.where("n > 0").groupBy(*prints).agg(F.min("key").alias("least_key"), F.min("row").alias("first_row"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = regions(signed, classes, percent)

    active = stored(found.select("cid").distinct().join(classes, "cid").join(
        signed.select(F.col("row").alias("first_row"), "key", "text_hash", "classes"), "first_row"), "active")
    # The bits by class are the bulk of the signatures, and the active ones have them.
    read, signed = signed, stored(signed.select("key", "text_hash", *prints), "keys")
    discard(read)

    # Joined by key and text; a repeated row is one text, found in the join's own partitions.
    place = [F.coalesce("key", F.lit(0)).alias("k"), F.col("key").isNull().alias("null_key"), "text_hash"]
    held = bit_filter(active.select("text_hash"))

    @F.arrow_udf("boolean")
    def may_be_active(hashes: pa.Array) -> pa.Array:
        return pa.array(passes(held.value, hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    named = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    # Only texts that are compared are moved, and a few beside them.
    named = named.where(may_be_active("text_hash"))
    at = ["k", "null_key", "text_hash"]
    texts = named.select(*place, "text").join(active.select(*place, "cid"), at).groupBy(*at, "cid").agg(F.first("text").alias("text"))
    texts = stored(texts.select("cid", "text"), "active-texts", "zstd")
    release(docs.sparkSession)

    # Round 1: every region's own pivot against its members.
    stars = found.where((F.col("cid") != F.col("leader")) & _size_window(F.col("n"), F.col("n_leader"), percent))
    apart = parted(stars.select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct(), active.select("cid", "n", "classes"), percent)
    first = compared(apart.where("may_link").select("a", "b"), texts, width)
    linked = F.col("common") * 100 >= F.col("total") * percent
    links = first.where(linked).select("a", "b")
    named_by = components(links)
    release(docs.sparkSession)

    # Round 2: what is left of the regions with several components, the pivot itself being done.
    exact = (1 - F.col("common") / F.col("total")).alias("d")
    distance = first.select("a", "b", exact, exact.alias("apart")).unionByName(
        apart.where("NOT may_link").select("a", "b", F.lit(None).cast("double").alias("d"), "apart"))
    distance = distance.select(F.col("a").alias("leader"), F.col("b").alias("cid"), "d", "apart")
    # Where sizes alone exclude a link the distance is only known to be at least 1 - smaller / larger.
    at_least = 1 - F.least("n", "n_leader") / F.greatest("n", "n_leader")
    done, written = first.select("a", "b"), [first, apart]
    for busiest in (True, False):
        joined = found.where("cid <> leader").join(named_by, F.col("cid") == F.col("node"), "left").withColumn(
            "component", F.coalesce("component", "cid")).drop("node")
        several = joined.groupBy("pivot").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("m"))
        several = stored(several.where("lo < hi").select("pivot", "m"), "open-regions")
        members = joined.join(several, "pivot")
        if busiest:
            crowded = members.groupBy("cid").agg(F.max(F.struct("m", "pivot")).alias("most")).select("cid", F.col("most.pivot").alias("pivot"))
            members = members.join(crowded, ["cid", "pivot"], "left_semi").withColumn("crowds", F.array().cast("array<long>"))
        else:
            crowds = members.where(F.col("m") > CROWDED).groupBy("cid").agg(F.slice(F.sort_array(F.collect_set("pivot")), 1, CROWDS).alias("crowds"))
            members = members.join(crowds, "cid", "left").withColumn("crowds", F.coalesce("crowds", F.array().cast("array<long>")))
        members = members.withColumn("before", F.when(F.col("m") > CROWDED, F.col("pivot")))
        members = members.join(distance, ["leader", "cid"], "left").select(
            "pivot", "cid", "n", "component", "before", "crowds", F.coalesce("apart", at_least).alias("near"), F.coalesce("d", F.lit(1.0)).alias("far"))
        pairs, read = _block_pairs(members, active.select("cid", "classes"), percent, block, busiest)
        with small_batches(docs.sparkSession, BLOCKS_AT_ONCE):
            pairs = stored(pairs, "window-pairs")
        discard(several, *read)
        release(docs.sparkSession)
        second = compared(pairs.join(done, ["a", "b"], "left_anti"), texts, width)
        discard(pairs)
        done = done.unionByName(second.select("a", "b"))
        known = named_by.select(F.col("node").alias("a"), F.col("component").alias("b"))
        written += [second, named_by]
        named_by = components(known.unionByName(second.where(linked).select("a", "b")))

    # A component is named by the least key of its classes.
    member = classes.join(named_by, F.col("cid") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cid"))
    least = member.groupBy("component").agg(F.min("least_key").alias("component_id"))
    named_class = stored(member.select(*prints, "cid", "component").join(least, "component").select(*prints, "cid", "component_id"), "class-names")
    # What the result does not read goes, the texts and bits above all.
    discard(classes, found, active, texts, named_by, *written)
    held.destroy()
    release(docs.sparkSession)
    return signed.select("key", "text_hash", *prints).join(named_class, prints, "left").select(
        F.col("key").alias(key), "text_hash", F.col("n").alias("n_shingles"), F.col("cid").alias("class_id"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))
