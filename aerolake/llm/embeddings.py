"""Embedding near-duplicates by an epsilon grid order join.

Vectors of one label whose cosine reaches a bound are linked.  Scaled to length 1
they lie within epsilon = sqrt(2 - 2 * bound) of each other, and so do their
projections on orthogonal axes.  Every vector gets its cell in a grid of width
epsilon on the leading principal axes; vectors are sorted by label and cell, and
the order is cut into blocks.  The join starts with the whole sequence against
itself and goes on recursively: an interval is cut into ``FAN_OUT`` smaller ones,
and pairs of intervals with different labels, or whose boxes lie more than epsilon
apart, are skipped.  The pairs of blocks that are left are compared in full.

A pair of blocks gives the number of links per vector and the edges of a spanning
forest of its links, never the links one by one.  Equal vectors are one class with a
weight and are compared once.

The axes come from a bounded sample; they decide how much is skipped, and nothing else.

Defined results: a vector that is null, empty or zero, or that has a null or
non-finite component, or whose label is null, links with nothing and is its own
component; vectors of different lengths do not link; a row with a null key can be
linked and counted and has the component's least key, or null if there is none;
repeated rows are separate vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.common import stored
from aerolake.llm.components import components
from aerolake.llm.numbering import numbered_in_order

COSINE = 0.98
AXES, AXES_SAMPLE = 8, 8192
BLOCK, FAN_BITS = 2048, 4
FAN_OUT = 1 << FAN_BITS
#: Cosines so near to the bound are computed again with exactly rounded sums.
_UNSURE = 1e-12


def unit_rows(data: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 without overflow."""
    scaled = data / np.abs(data).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def principal_axes(sample: list[bytes], width: int, n_axes: int) -> np.ndarray:
    """Orthonormal axes (width x n_axes) of greatest variance, vectors padded with zeros to ``width``."""
    if not sample:
        return np.eye(width, min(n_axes, width))
    units = unit_rows(_matrix(sample, width))
    _, _, axes = np.linalg.svd(np.cov(units, rowvar=False, bias=True).reshape(width, width))
    return axes[:n_axes].T.copy()


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    rows = np.zeros((len(vectors), width))
    for i, data in enumerate(vectors):
        found = np.frombuffer(data, "<f8")
        rows[i, :len(found)] = found
    return rows


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node reachable from each of ``n`` nodes by the edges (u, v)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _packed(vectors: DataFrame) -> DataFrame:
    """cid, group, weight, vector: the components as little-endian doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, at = lists.values.to_numpy(zero_copy_only=False).astype("<f8"), lists.offsets.to_numpy()
            data = [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(data, pa.binary())], ["cid", "label", "weight", "vector"])

    kinds = T.StructType([vectors.schema["cid"], vectors.schema["label"], vectors.schema["weight"], T.StructField("vector", T.BinaryType())])
    return vectors.select("cid", "label", "weight", "vector").mapInArrow(run, kinds)


def grid_order(packed: DataFrame, axes: np.ndarray, epsilon: float, block: int) -> DataFrame:
    """Written rows of ``packed`` with their projections p0, p1, ... and their block in the order of label and cells."""
    width, n_axes = axes.shape
    names, columns = [f"p{i}" for i in range(n_axes)], packed.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = unit_rows(_matrix(batch.column(3).to_pylist(), width)) @ axes if batch.num_rows else np.zeros((0, n_axes))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in places.T.copy()]], [*columns, *names])

    kinds = T.StructType([*packed.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    cells = [F.floor(F.col(n) / epsilon).alias(f"c{i}") for i, n in enumerate(names)]
    rows = packed.mapInArrow(run, kinds).select("*", *cells)
    order = ["label", *[f"c{i}" for i in range(n_axes)], "cid"]
    numbered = numbered_in_order(rows, order, "place")
    return numbered.select(*packed.columns, *names, F.floor(F.col("place") / block).cast("long").alias("block"))


def _boxes(rows: DataFrame, node: str, names: list[str]) -> DataFrame:
    return rows.groupBy(node).agg(*[F.min(f"lo_{n}").alias(f"lo_{n}") for n in names], *[F.max(f"hi_{n}").alias(f"hi_{n}") for n in names])


def block_pairs(blocks: DataFrame, names: list[str], epsilon: float) -> DataFrame:
    """Written pairs (a, b), a <= b, of blocks that can hold links; ``blocks`` has block and lo_, hi_ of label and ``names``."""
    last = blocks.agg(F.max("block")).first()[0]
    levels = 0
    while last is not None and last >> (FAN_BITS * levels):
        levels += 1
    spark = blocks.sparkSession
    pairs = spark.createDataFrame([] if last is None else [(0, 0)], "a long, b long")
    for level in reversed(range(levels)):
        node = F.shiftright("block", FAN_BITS * level).alias("node")
        nodes = _boxes(blocks.select(node, *[c for c in blocks.columns if c != "block"]), "node", ["label", *names])
        left = nodes.select(F.shiftright("node", FAN_BITS).alias("a"), *[F.col(c).alias(f"a_{c}") for c in nodes.columns])
        right = nodes.select(F.shiftright("node", FAN_BITS).alias("b"), *[F.col(c).alias(f"b_{c}") for c in nodes.columns])
        gaps = [F.greatest(F.col(f"a_lo_{n}") - F.col(f"b_hi_{n}"), F.col(f"b_lo_{n}") - F.col(f"a_hi_{n}"), F.lit(0.0)) for n in names]
        near = sum((g * g for g in gaps), F.lit(0.0)) <= epsilon * epsilon
        labels = (F.col("a_lo_label") <= F.col("b_hi_label")) & (F.col("b_lo_label") <= F.col("a_hi_label"))
        met = pairs.join(left, "a").join(right, "b").where((F.col("a_node") <= F.col("b_node")) & labels & near)
        pairs = stored(met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "block-pairs")
    return pairs


def _compare(bound: float):
    """Task function: links per vector (cid, null, n) and forest edges (cid, other, 0) of pairs of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                same = batch.column(0)[at].as_py()
                left, right = (_side(batch.column(i)[at].values) for i in ((1, 1) if same else (1, 2)))
                cid, weight, n_left = np.concatenate([left[0], right[0]]), np.concatenate([left[2], right[2]]), len(left[0])
                u, v = [], []
                for group in set(left[1]) & set(right[1]):
                    i, j = left[1][group], right[1][group]
                    a, b = unit_rows(left[3][group]), unit_rows(right[3][group])
                    found = a @ b.T
                    linked = found >= bound
                    for x, y in zip(*np.nonzero(np.abs(found - bound) < _UNSURE)):
                        linked[x, y] = exact_cosine(left[3][group][x], right[3][group][y]) >= bound
                    if same:
                        linked = np.triu(linked, 1)
                    x, y = np.nonzero(linked)
                    u.append(i[x])
                    v.append(j[y])
                u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (u, v))
                if not len(u):
                    continue
                if not same:
                    v = v + n_left
                n = np.bincount(u, weight[v], len(cid)) + np.bincount(v, weight[u], len(cid))
                root = forest(len(cid), u, v)
                counted, edge = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(cid)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([cid[counted], cid[edge]])),
                     pa.array(np.concatenate([np.zeros(len(counted), np.int64), cid[root[edge]]]),
                              mask=np.concatenate([np.ones(len(counted), bool), np.zeros(len(edge), bool)])),
                     pa.array(np.concatenate([n[counted].astype(np.int64), np.zeros(len(edge), np.int64)]))], ["a", "b", "n"])

    return run


def _side(rows: pa.StructArray) -> tuple:
    """(cid, places by group, weight, vectors by group) of one block; a group is a label and a vector length."""
    cid, label, weight, vector = (rows.field(i) for i in range(4))
    groups: dict[tuple, list[int]] = {}
    data = vector.to_pylist()
    for place, (name, content) in enumerate(zip(label.to_pylist(), data)):
        groups.setdefault((name, len(content)), []).append(place)
    places = {g: np.array(p, np.int64) for g, p in groups.items()}
    vectors = {g: np.frombuffer(b"".join(data[i] for i in p), "<f8").reshape(len(p), -1) for g, p in groups.items()}
    return cid.to_numpy(), places, weight.to_numpy(), vectors


def join(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE,
         n_axes: int = AXES, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: ``key``, n_links (other rows linked directly), component_id and kept."""
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind == "float" else "double"
    plain = F.transform(F.col(vector), lambda x: x.cast(kind) + F.lit(0).cast(kind))  # -0.0 becomes 0.0
    usable = F.exists("vector", lambda x: x != 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), plain.alias("vector"))
    rows = rows.withColumn("usable", F.coalesce(F.col("label").isNotNull() & usable, F.lit(False)))
    prints = [F.xxhash64(F.lit(i), "label", "vector").alias(f"print_{i}") for i in (1, 2)]
    names = ["print_1", "print_2"]
    # Equal vectors are added up before the shuffle.
    classes = rows.where("usable").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("weight"), F.min("key").alias("least_key"))
    classes = stored(classes.select("*", *prints, F.size("vector").alias("width")).withColumn("cid", F.monotonically_increasing_id()), "classes")

    packed = _packed(classes)
    n, width = classes.agg(F.count(F.lit(1)), F.max("width")).first()
    part = F.shiftrightunsigned(F.xxhash64("cid"), 12) / float(1 << 52) <= AXES_SAMPLE / max(n, 1)
    sample = [r[0] for r in packed.where(part).select("vector").collect()]  # about AXES_SAMPLE vectors
    axes = principal_axes([bytes(x) for x in sample], width or 1, n_axes)
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6
    projected = [f"p{i}" for i in range(axes.shape[1])]
    ordered = grid_order(packed, axes, epsilon, block)
    # ``block`` rows each.
    side = F.collect_list(F.struct("cid", "label", "weight", "vector")).alias("side")
    blocks = stored(ordered.groupBy("block").agg(side, F.min("label").alias("lo_label"), F.max("label").alias("hi_label"),
                                                 *[F.min(p).alias(f"lo_{p}") for p in projected],
                                                 *[F.max(p).alias(f"hi_{p}") for p in projected]), "grid-blocks")
    pairs = block_pairs(blocks.drop("side"), projected, epsilon)
    left = blocks.select(F.col("block").alias("a"), F.col("side").alias("left"))
    right = blocks.select(F.col("block").alias("b"), F.col("side").alias("right"))
    same = pairs.where("a = b").join(left, "a").select(F.lit(True).alias("same"), "left", F.lit(None).cast(right.schema["right"].dataType).alias("right"))
    other = pairs.where("a < b").join(left, "a").join(right, "b").select(F.lit(False).alias("same"), "left", "right")
    found = stored(same.unionByName(other).mapInArrow(_compare(cosine), "a long, b long, n long"), "found-links")

    counts = found.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    named_by = components(found.where("b IS NOT NULL").select("a", "b"))
    member = classes.select("cid", "weight", "least_key", *names).join(counts, "cid", "left").join(
        named_by, F.col("cid") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cid"))
    least = member.groupBy("component").agg(F.min("least_key").alias("component_id"))
    named = stored(member.join(least, "component").select(
        *names, (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"), "class-names")
    # Unusable vectors find no class.
    hashed = rows.select("key", *[F.when(F.col("usable"), p).alias(n) for p, n in zip(prints, names)])
    result = hashed.join(named, names, "left").withColumn(
        "component_id", F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("component_id")))
    return result.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                         F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
