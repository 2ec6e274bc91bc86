"""Hard-negative mining against plain Python in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows, n_pos=5, n_neg=3, low=50, high=95):
    points = [(k, l, tuple(math.floor(256 * x) for x in v)) for k, l, v in rows
              if k is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (k, l, v) in enumerate(points):
        if k % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), key, label) for j, (key, label, w) in enumerate(points) if j != i and len(w) == len(v)]
        for score, pos, _ in sorted(x for x in scored if x[2] == l)[:n_pos]:
            fits = sorted(x for x in scored if x[2] != l and -low * score <= -100 * x[0] <= -high * score)[:n_neg]
            out += [(k, pos, r + 1, neg, -score, -s) for r, (s, neg, _) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("row", "key", "block", "chunk", "score", "place", "anchor")])
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **options).collect()))


def vectors(n, dim, labels, seed, skew=0.0):
    draw = random.Random(seed)
    return [(i, 0 if draw.random() < skew else draw.randrange(labels), [draw.gauss(0.3, 0.5) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("block, chunk", [(4096, 8192), (300, 7)])
def test_equals_plain_python_in_one_and_in_many_blocks(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "CHUNK", chunk)
    rows = vectors(1500, 5, 4, 1, skew=0.4)
    want = plain(rows)
    assert len(want) > 200
    assert mined(spark, rows) == want


def test_edge_cases(spark):
    rows = vectors(200, 3, 3, 2) + [
        (None, 1, [1.0, 1.0, 1.0]), (400, None, [1.0, 1.0, 1.0]), (450, 1, None), (451, 1, [None, 1.0, 1.0]), (452, 1, [math.nan, 1.0, 1.0]),
        (453, 1, [math.inf, 0.0, 0.0]), (500, 1, [2.0, 1.0]), (501, 1, [1.0, 1.0]), (502, 2, [1.0, 0.5]), (550, 1, []), (551, 1, []), (552, 2, []),
        (600, 9, [0.1, 0.1, 0.1]), (650, 1, [0.0, 0.0, 0.0]), (700, 2, [-1.0, -1.0, -1.0])]
    want = plain(rows)
    assert {r[0] for r in want} >= {500, 550}  # a score of 0 has the window 0
    assert mined(spark, rows) == want


def test_ties_and_repeated_rows(spark):
    rows = [(i, i % 3, [1.0, 0.5]) for i in range(120)] + [(i, i % 3, [0.9, 0.2]) for i in range(120, 260)]
    rows += [(50, 2, [1.0, 0.5]), (50, 2, [1.0, 0.5])]
    assert mined(spark, rows, low=10, high=100) == plain(rows, low=10, high=100)


def test_products_beyond_exact_doubles(spark):
    rows = [(0, 1, [3e5, 1 / 256]), (1, 1, [2.9e5, 3 / 256]), (2, 2, [2.7e5, 5 / 256]), (3, 2, [2.7e5, 6 / 256]), (4, 2, [1e3, 0.0])]
    want = plain(rows)
    assert mined(spark, rows) == want and len(want) == 2 and want[0][5] - want[1][5] == 1


def test_empty_and_without_anchors(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
    assert mined(spark, [(1, 1, [1.0]), (2, 1, [1.0]), (3, 2, [0.7])]) == []


def test_boxes_bound_their_points_and_prune():
    draw = np.random.default_rng(3)
    vec = np.floor(draw.normal(0, 100, (4000, 3)))
    tree = hard_negatives.Tree(vec, draw.integers(0, 3, 4000), np.arange(4000), np.arange(4000))
    anchors = np.floor(draw.normal(0, 100, (20, 3)))
    low, high = tree.bounds(anchors, tree.leaf_boxes)
    scores = tree.vec @ anchors.T
    for i, (a, b) in enumerate(zip(tree.starts[:-1], tree.starts[1:])):
        assert (scores[a:b].min(axis=0) >= low[:, i]).all() and (scores[a:b].max(axis=0) <= high[:, i]).all()
    fifth = -np.sort(-scores, axis=0)[4]
    assert (high >= fifth[:, None]).mean() < 0.5
