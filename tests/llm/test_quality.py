"""Positive-unlabelled quality scores: held-out accuracy, the risk against plain sums, and edge cases."""

import binascii
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerolake.llm import quality, style
from aerolake.llm import queries as Q


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in Q.op11_quality_classifier(spark, sf_dir).collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (binascii.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for i, r in found.items())
    held = [(r.quality, found[r.doc_id]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if found[r.doc_id].held_out]
    good, bad = [x for q, x in held if q == 1], [x for q, x in held if q == 0]
    assert len(good) > 500 and len(bad) > 80
    assert np.mean([x.predicted for x in good]) >= 0.99
    assert np.mean([1 - x.predicted for x in bad]) >= 0.95
    assert np.mean([g.score > b.score for g in good for b in bad]) >= 0.99


def test_labels_of_held_out_rows_and_negatives_are_not_learnt(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    turned = F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))
    labels.select("doc_id", turned.alias("quality")).where(held | (F.col("quality") == 1)).write.parquet(f"{tmp_path}/labels.parquet")
    a, b = (sorted(map(tuple, Q.op11_quality_classifier(spark, str(d)).collect())) for d in (sf_dir, tmp_path))
    assert a == b


def test_sums_and_risk_equal_plain_ones(spark):
    draw = random.Random(2)
    texts = ["".join(draw.choice("ab cD. \n#é") for _ in range(draw.randrange(200))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = quality.described(docs)
    x = np.hstack([style.describe(pa.array(texts)) / 255, np.ones((300, 1))])
    kinds = rows.withColumn("kind", (F.col("key") % 3 == 0).cast("int"))
    w = np.random.default_rng(1).normal(size=x.shape[1]) / 10
    for kind, found in enumerate(quality.sums(kinds, 2)):
        part = x[[i for i in range(300) if (i % 3 == 0) == bool(kind)]]
        assert found.n == len(part)
        np.testing.assert_allclose(found.gram, part.T @ part / len(part), atol=1e-12)
        for y in (1, -1):
            assert found.risk(w, y) == pytest.approx(np.mean((1 - y * (part @ w)) ** 2 / 4))


def test_descent_ends_at_a_least_risk():
    """With few rows the unbiased risk of the negatives is below 0 at its minimum; the non-negative one is smaller after the descent."""
    draw = np.random.default_rng(4)
    make = lambda n, at: np.hstack([draw.normal(at, 1, (n, 12)), np.ones((n, 1))])
    sums = lambda x: quality.Sums(len(x), x.mean(axis=0), x.T @ x / len(x))
    positive, unlabelled = sums(make(15, 0.4)), sums(np.vstack([make(30, 0.4), make(10, -0.4)]))
    prior = 0.9
    unbiased = np.linalg.solve(unlabelled.gram / 2 + 2 * quality.RIDGE * np.eye(13), prior * positive.mean - unlabelled.mean / 2)
    assert unlabelled.risk(unbiased, -1) < prior * positive.risk(unbiased, -1)
    w = quality.minimise(positive, unlabelled, prior)
    risk = lambda v: quality.nonnegative_risk(positive, unlabelled, prior, v) + quality.RIDGE * v @ v
    assert risk(w) < risk(unbiased)
    assert all(risk(w + draw.normal(0, 1e-3, 13)) > risk(w) - 1e-4 for _ in range(200))


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_class_prior_of_a_known_mixture(share):
    draw = np.random.default_rng(7)
    bins = lambda x: np.bincount(np.clip((x * 100 + 1000).astype(int), 0, 1999), minlength=2000)
    n = 40_000
    mixture = np.concatenate([draw.normal(2, 1, int(n * share)), draw.normal(-2, 1, n - int(n * share))])
    assert quality.class_prior(bins(draw.normal(2, 1, 10_000)), bins(mixture)) == pytest.approx(share, abs=0.05)


def test_edge_cases(spark):
    long_text = " ".join(f"word{i % 977}." for i in range(300_000))
    rows = [(0, None), (1, ""), (2, "  \n "), (3, "one two."), (3, "one two."), (None, "no key"), (4, long_text), (5, "#" * 1000), (6, "漢字 é\n漢字 é"), (7, "\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("key", "style", "kind", "score", "n")])
    described = quality.described(docs)
    positives = spark.createDataFrame([(3,), (4,), (6,), (99,), (None,), (4,)], "doc_id long")
    model = quality.learn(described, positives)
    found = quality.score(described, model).collect()
    assert sorted((r.key is None, r.key or 0) for r in found) == sorted((i is None, i or 0) for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in found if r.key in (0, 1)} == {[r.score for r in found if r.key == 0][0]}
    nothing = quality.learn(described, positives.limit(0))
    assert {r.score for r in quality.score(described, nothing).collect()} == {0.5}
    empty = quality.described(docs.limit(0))
    assert quality.score(empty, quality.learn(empty, positives)).collect() == []


def test_a_text_is_described_alike_in_any_company():
    draw = random.Random(3)
    texts = ["".join(draw.choice("abc XYZ.,\n\t#$1é漢") for _ in range(draw.choice([0, 1, 2, 50, 3000]))) for _ in range(60)] + ["w " * 400_000]
    together = style.describe(pa.array(texts))
    assert (together == np.vstack([style.describe(pa.array([t])) for t in texts])).all()
    assert (style.describe(pa.array(["x", *texts]).slice(1)) == together).all()


def test_pooling_gives_the_nearest_rising_sequence():
    draw = random.Random(1)
    for _ in range(50):
        n = draw.randrange(1, 8)
        values, weights = [draw.random() for _ in range(n)], [draw.randrange(1, 5) for _ in range(n)]
        # The rising least-squares fit at i is the largest over starts of the least mean over ends.
        mean = lambda a, b: np.average(values[a:b + 1], weights=weights[a:b + 1])
        want = [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        np.testing.assert_allclose(quality.rising(np.array(values), np.array(weights)), want)


def test_the_curve_follows_the_share_of_positives():
    draw = np.random.default_rng(5)
    bins = lambda x: np.bincount(np.clip(((x / 2 + 1) / 2 * 2000).astype(int), 0, 1999), minlength=2000)
    mixture = np.concatenate([draw.normal(0.5, 0.5, 60_000), draw.normal(-0.5, 0.5, 40_000)])
    slope, offset = quality.logistic_curve(bins(draw.normal(0.5, 0.5, 60_000)), bins(mixture), 0.6)
    # Of two normals the share is a logistic curve: slope 2 * 0.5 / 0.25, and log(0.6 / 0.4) at 0.
    assert slope == pytest.approx(4, rel=0.1) and offset == pytest.approx(np.log(1.5), abs=0.1)
