"""Hard-negative mining over embeddings with STR-packed R-trees.

Components become whole numbers, floor(scale * x); scores are their exact inner
products, higher first, ties by smaller key.  An anchor's positives are its best
other rows of the same label; a positive's hard negatives are the best rows of
other labels whose score lies within ``low`` to ``high`` percent of the positive's.

* Packing is sort-tile-recursive over (dimension, label, first coordinates): the
  rows are numbered in order of the first coordinate and cut into slices, the
  slices in order of the second and cut into blocks of ``BLOCK`` rows.  A task
  goes on by the coordinates of the widest spread, down to leaves of ``LEAF`` rows,
  whose bounding boxes are gathered ``FANOUT`` at a time.
* A box [lo, hi] bounds an anchor's inner product coordinate by coordinate, between
  the sums of min(a lo, a hi) and of max(a lo, a hi).
* An anchor descends a tree with a best-first queue.  Boxes go when they miss the
  label or every score window, or lie strictly below the k-th best so far.
* The queries stand against all rows in blocks: a task has ``CHUNK`` anchors at most
  and one block.  For positives an anchor meets only blocks that hold its label.
  Each task returns its k best, and the best of all are taken by a window.

Defined results: rows with a null key, label or vector, or with a null or
non-finite component take no part; rows of different dimensions have no score with
one another; equal keys are separate rows, whose ties are settled by their order of
storage; an empty table gives an empty result.  Keys and labels are whole numbers.
Inner products too large for exact doubles are taken in Python's whole numbers; a
score beyond 64 bits is an error.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import stored
from aerolake.llm.numbering import numbered_in_order

BLOCK, LEAF, FANOUT, CHUNK = 4096, 128, 8, 8192
#: Sums of whole numbers are exact in doubles below this.
EXACT = 2.0 ** 53

FOUND = "anchor long, place int, score long, key long, row long"


def points(rows: DataFrame, key: str, label: str, vector: str, anchor: Column, scale: int) -> DataFrame:
    """Written rows (row, key, label, vec, is_anchor) that take part."""
    vec = F.transform(F.col(vector), lambda x: x.cast("double"))
    used = rows.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), vec.alias("vec"),
                       F.coalesce(anchor, F.lit(False)).alias("is_anchor")).where("key IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    used = used.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # Doubles from 2^52 on are whole.
    whole = F.expr(f"transform(transform(vec, x -> {scale} * x), y -> CASE WHEN abs(y) < {1 << 52} THEN CAST(floor(y) AS DOUBLE) ELSE y END)")
    return stored(used.withColumn("vec", whole).withColumn("row", F.monotonically_increasing_id()), "points")


def packed(found: DataFrame) -> DataFrame:
    """Written ``found`` with its block."""
    keys = found.select("row", F.size("vec").alias("dim"), "label", F.get("vec", F.lit(0)).alias("x"), F.get("vec", F.lit(1)).alias("y"))
    n = max(1, found.count())
    slice_rows = BLOCK * max(1, round((n / BLOCK) ** 0.5))
    sliced = numbered_in_order(keys, ["dim", "label", "x", "row"], "place").withColumn("slice", F.floor(F.col("place") / slice_rows)).drop("place")
    tiled = numbered_in_order(sliced, ["slice", "dim", "label", "y", "row"], "place").select("row", F.floor(F.col("place") / BLOCK).alias("block"))
    return stored(found.join(tiled, "row"), "packed-points")


class Tree:
    """An R-tree of the rows of a block, packed by sort-tile-recursive tiling."""

    def __init__(self, vec: np.ndarray, label: np.ndarray, key: np.ndarray, row: np.ndarray):
        spread = np.argsort(-(vec.max(axis=0) - vec.min(axis=0)).astype(float), kind="stable") if vec.shape[1] else np.zeros(0, int)
        leaves = list(self._tiles(np.argsort(label, kind="stable"), [label[:, None], *(vec[:, [d]] for d in spread)]))
        order = np.concatenate(leaves)
        self.vec, self.label, self.key, self.row = vec[order], label[order], key[order], row[order]
        self.starts = np.cumsum([0] + [len(x) for x in leaves])
        self.leaf_boxes = self._boxes(self.vec, self.label, self.starts[:-1])
        self.groups = np.arange(0, len(leaves), FANOUT)
        lo, hi, low_label, high_label = self.leaf_boxes
        at = self.groups
        self.node_boxes = (np.minimum.reduceat(lo, at, axis=0), np.maximum.reduceat(hi, at, axis=0),
                           np.minimum.reduceat(low_label, at), np.maximum.reduceat(high_label, at))

    def _tiles(self, rows: np.ndarray, axes: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Rows sorted by the first axis, cut into slices, and each slice tiled by the next axes."""
        if len(rows) <= LEAF or not axes:
            yield from (rows[i:i + LEAF] for i in range(0, len(rows), LEAF))
            return
        rows = rows[np.argsort(axes[0][rows, 0], kind="stable")]
        leaves = -(-len(rows) // LEAF)
        width = LEAF * -(-leaves // round(leaves ** 0.5 + 0.5))
        for i in range(0, len(rows), width):
            yield from self._tiles(rows[i:i + width], axes[1:])

    @staticmethod
    def _boxes(vec, label, starts):
        return (np.minimum.reduceat(vec, starts, axis=0), np.maximum.reduceat(vec, starts, axis=0),
                np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts))

    def bounds(self, anchors: np.ndarray, boxes) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each anchor with a point of each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        lo, hi = boxes[0].T, boxes[1].T
        return up @ lo + down @ hi, up @ hi + down @ lo


class Best:
    """The k best (score, key, row) so far within a score window."""

    __slots__ = ("k", "low", "high", "found", "least")

    def __init__(self, k: int, low=None, high=None):
        self.k, self.low, self.high, self.found = k, low, high, []
        self.least = low  # a lower score is of no use

    def wants(self, least, largest) -> bool:
        return (self.high is None or least <= self.high) and (self.least is None or largest >= self.least)

    def add(self, score, key, row) -> None:
        found = sorted([*self.found, *((-s, k, r) for s, k, r in zip(score, key, row))])[:self.k]
        self.found = found
        if len(found) == self.k:
            self.least = -found[-1][0]


def search(tree: Tree, anchors: np.ndarray, labels: np.ndarray, rows: np.ndarray, wanted: list[list[Best]], same: bool) -> None:
    """Fill every anchor's ``wanted`` from the tree: rows of its label (``same``; not itself) or of others."""
    node_low, node_high = tree.bounds(anchors, tree.node_boxes)
    leaf_low, leaf_high = tree.bounds(anchors, tree.leaf_boxes)
    _, _, node_first, node_last = tree.node_boxes
    _, _, leaf_first, leaf_last = tree.leaf_boxes
    n_leaves = len(leaf_first)
    for i, (label, lists) in enumerate(zip(labels, wanted)):
        if same:
            nodes, leaf_ok = (node_first <= label) & (label <= node_last), (leaf_first <= label) & (label <= leaf_last)
        else:
            nodes, leaf_ok = (node_first != label) | (node_last != label), (leaf_first != label) | (leaf_last != label)
        # Largest bound first; node numbers settle ties.
        queue = [(-node_high[i, n], False, int(n)) for n in np.flatnonzero(nodes)]
        heapq.heapify(queue)
        low, high, anchor = leaf_low[i], leaf_high[i], anchors[i]
        while queue:
            bound, is_leaf, n = heapq.heappop(queue)
            if not any(b.least is None or -bound >= b.least for b in lists):
                break  # strictly below all that is still wanted, and so are the rest
            if not is_leaf:
                if any(b.wants(node_low[i, n], node_high[i, n]) for b in lists):
                    for leaf in range(tree.groups[n], min(tree.groups[n] + FANOUT, n_leaves)):
                        if leaf_ok[leaf] and any(b.wants(low[leaf], high[leaf]) for b in lists):
                            heapq.heappush(queue, (-high[leaf], True, leaf))
                continue
            open_lists = [b for b in lists if b.wants(low[n], high[n])]
            if not open_lists:
                continue
            start, stop = tree.starts[n], tree.starts[n + 1]
            scores = tree.vec[start:stop] @ anchor
            ok = (tree.label[start:stop] == label) & (tree.row[start:stop] != rows[i]) if same else tree.label[start:stop] != label
            for b in open_lists:
                fits = ok
                if b.least is not None:
                    fits = fits & (scores >= b.least)
                if b.high is not None:
                    fits = fits & (scores <= b.high)
                at = np.flatnonzero(fits)
                if len(at):
                    b.add([int(s) for s in scores[at]], tree.key[start:stop][at].tolist(), tree.row[start:stop][at].tolist())


def _matrix(values: pa.Array, at: np.ndarray, dim: int) -> np.ndarray:
    """The vectors of the rows ``at``, all of ``dim`` components."""
    return values.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)


def _whole(m: np.ndarray) -> np.ndarray:
    out = np.empty(m.shape, object)
    out[:] = [[int(x) for x in v] for v in m]
    return out


def _searched(k: int, same: bool):
    """Group function: the k best of a block for the anchors of a chunk (per window, if they have some)."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        column = {name: group.column(name).combine_chunks() for name in group.column_names}
        vectors = column["vec"]
        dims = np.diff(vectors.offsets.to_numpy())
        is_row, label, key, row = (np.asarray(column[c].to_numpy(zero_copy_only=False)) for c in ("is_row", "label", "key", "row"))
        out = []
        for dim in np.unique(dims[is_row]).tolist():
            of_row, of_anchor = np.flatnonzero(is_row & (dims == dim)), np.flatnonzero(~is_row & (dims == dim))
            if not len(of_anchor):
                continue
            points, anchors = _matrix(vectors, of_row, dim), _matrix(vectors, of_anchor, dim)
            if dim and np.abs(points).max() * np.abs(anchors).max() * dim >= EXACT:
                points, anchors = _whole(points), _whole(anchors)
            if same:
                wanted = [[Best(k)] for _ in of_anchor]
            else:
                windows = column["windows"].take(pa.array(of_anchor)).to_pylist()
                wanted = [[Best(k, w["low"], w["high"]) for w in found] for found in windows]
            search(Tree(points, label[of_row], key[of_row], row[of_row]), anchors, label[of_anchor], row[of_anchor], wanted, same)
            for anchor, lists in zip(row[of_anchor].tolist(), wanted):
                for place, b in enumerate(lists):
                    out += [(anchor, place, -s, k, r) for s, k, r in b.found]
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["anchor", "place", "score", "key", "row"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and place, with their rank."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "key", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _side(df: DataFrame, is_row: bool, windows: Column) -> DataFrame:
    return df.select("chunk", "block", F.lit(is_row).alias("is_row"), "label", "key", "row", "vec", windows.alias("windows"))


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n, 1) - 1).cast("long")))


def mine(rows: DataFrame, anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
         n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """One row per anchor, positive and hard negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells which rows of ``rows`` are anchors; ``low`` and ``high`` are percents of the positive's score.
    """
    found = packed(points(rows, key, label, vector, anchor, scale))
    none = F.lit(None).cast("array<struct<low:long,high:long>>")
    # Anchors are dealt into chunks in order of label and place, so that a chunk has few labels.
    chunks = numbered_in_order(found.where("is_anchor").select(F.col("row").alias("r"), "label", "block"), ["label", "block", "r"], "place")
    chunks = chunks.select("r", F.floor(F.col("place") / CHUNK).alias("chunk"))
    anchors = stored(found.where("is_anchor").join(chunks, F.col("row") == F.col("r")).select("chunk", "label", "key", "row", "vec"), "anchors")

    # Positives: rows and anchors meet only where a block holds the label of a chunk's anchors.
    of_chunk, of_block = anchors.select("label", "chunk").distinct(), found.select("label", "block").distinct()
    both = _side(anchors.join(of_block, "label"), False, none).unionByName(_side(found.join(of_chunk, "label"), True, none))
    positives = both.groupBy("chunk", "block").applyInArrow(_searched(n_positives, True), FOUND)
    positives = stored(_best(positives, n_positives).select("anchor", F.col("rank").alias("j"), F.col("key").alias("positive_id"), "score"), "positives")

    # Windows that hold a whole number, in order; a percent of a score is exact in decimals.
    percent = "CAST(score AS DECIMAL(20,0)) * {}"
    windows = positives.select("anchor", "j", "positive_id", "score", F.expr(f"CAST(-floor(-({percent.format(low)}) / 100) AS BIGINT)").alias("low"),
                               F.expr(f"CAST(floor({percent.format(high)} / 100) AS BIGINT)").alias("high")).where("low <= high")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy("j")) - 1
    windows = stored(windows.withColumn("place", place.cast("int")), "windows")
    per_anchor = windows.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "low", "high"))).alias("w")).select(
        "anchor", F.transform("w", lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high"))).alias("w"))  # n_positives at most

    # Negatives: all anchors against all rows, in blocks.
    n_chunks, n_blocks = (df.agg(F.coalesce(F.max(c), F.lit(-1))).first()[0] + 1 for df, c in ((anchors, "chunk"), (found, "block")))
    asked = anchors.join(per_anchor, F.col("row") == F.col("anchor")).withColumn("block", _each(n_blocks))
    both = _side(asked, False, F.col("w")).unionByName(_side(found.withColumn("chunk", _each(n_chunks)), True, none))
    negatives = _best(both.groupBy("chunk", "block").applyInArrow(_searched(n_negatives, False), FOUND), n_negatives)
    names = anchors.select(F.col("row").alias("anchor"), F.col("key").alias("anchor_id"))
    out = negatives.select("anchor", "place", "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    return out.join(windows, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")
