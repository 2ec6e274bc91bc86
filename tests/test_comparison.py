"""Metrics, bootstrap, t-test and promotion against plain Python."""

import math
import statistics

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from aerolake.functions import draws
from aerolake.operators import bootstrap, metrics


def scored(spark, n=400):
    rng = np.random.default_rng(1)
    y = rng.normal(1000, 5, n)
    rows = [(i, float(v), float(v + e), float(v + 0.9 * e))
            for i, (v, e) in enumerate(zip(y, rng.normal(0, 2, n)))]
    return rows, spark.createDataFrame(rows, "id long, y double, a double, b double")


def test_metrics_agree_with_the_evaluator(spark):
    _, frame = scored(spark)
    row = metrics.regression_metrics(frame, "y", "a").first()
    for name in metrics.METRIC_NAMES:
        want = RegressionEvaluator(labelCol="y", predictionCol="a", metricName=name).evaluate(frame)
        assert row[name] == pytest.approx(want, rel=1e-9)


def test_metrics_of_no_rows_and_of_a_constant(spark):
    empty = spark.createDataFrame([], "y double, prediction double")
    assert metrics.regression_metrics(empty, "y").first().r2 is None
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, prediction double")
    row = metrics.regression_metrics(constant, "y").first()
    assert row.r2 is None and row.mse == 0.5


def brute_r2(rows, column, replicate, seed):
    weights = draws.resample_weights(len(rows), [len(rows)], [draws.block_salt(seed, replicate, 0)])[0]
    y, p = np.array([r[1] for r in rows]), np.array([r[column] for r in rows])
    mean = (weights * y).sum() / weights.sum()
    return 1 - (weights * (y - p) ** 2).sum() / (weights * (y - mean) ** 2).sum()


def test_bootstrap_against_brute_force(spark):
    rows, frame = scored(spark)
    got = bootstrap.bootstrap_r2(frame, F.col("id"), "y", {"old": "a", "new": "b"}, 7, seed=5).collect()
    assert len(got) == 14
    for r in got:
        want = brute_r2(rows, {"old": 2, "new": 3}[r.model], r.replicate, 5)
        assert r.r2 == pytest.approx(want, rel=1e-6)


def test_bootstrap_does_not_depend_on_the_layout(spark):
    _, frame = scored(spark)
    one, many = (
        {(r.replicate, r.model): round(r.r2, 9) for r in bootstrap.bootstrap_r2(
            frame.repartition(k), F.col("id"), "y", {"old": "a"}, 5).collect()}
        for k in (1, 13))
    assert one == many


def test_bootstrap_of_no_rows_is_empty(spark):
    _, frame = scored(spark)
    assert bootstrap.bootstrap_r2(frame.limit(0), F.col("id"), "y", {"old": "a"}, 5).count() == 0


def test_bootstrap_spread_is_that_of_exact_resampling(spark):
    """In one block and in several, against numpy."""
    rows, frame = scored(spark)
    found = {blocks: [r.r2 for r in bootstrap.bootstrap_r2(frame, F.col("id"), "y", {"m": "a"}, 1500, blocks=blocks).collect()] for blocks in (1, 7)}
    y, p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    rng = np.random.default_rng(42)
    exact = []
    for _ in range(1500):
        i = rng.integers(0, len(y), len(y))
        exact.append(1 - ((y[i] - p[i]) ** 2).sum() / ((y[i] - y[i].mean()) ** 2).sum())
    for drawn in found.values():
        assert np.mean(drawn) == pytest.approx(np.mean(exact), abs=0.003)
        assert np.std(drawn) == pytest.approx(np.std(exact), rel=0.1)


def test_every_resample_draws_exactly_n_rows(spark):
    """A target of 0 or 1 and a prediction of 0: the sums of weights follow from R2 and must be whole and add up to n."""
    rows = [(i, float(i % 2), float(i % 2 == 0)) for i in range(501)]
    df = spark.createDataFrame(rows, "id long, y double, p double")
    for blocks in (1, 4):
        sums = bootstrap._weighted_sums
        sizes = [0] * blocks
        keyed = df.select(F.col("id").alias("key"), "y", (F.col("y") * F.col("y")).alias("yy"), F.lit(0.0).alias("se0"),
                          F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("part"))
        for r in keyed.groupBy("block").count().collect():
            sizes[r["block"]] = r["count"]
        names = ["n", "sy", "syy", "se0"]
        found = keyed.repartitionById(blocks, F.col("block")).mapInArrow(
            sums(sizes, 200, 1, 42, names), "replicate int, " + ", ".join(f"{c} double" for c in names))
        assert [r["n"] for r in found.groupBy("replicate").agg(F.sum("n").alias("n")).collect()] == [501.0] * 200


def test_blocks_and_parts_see_all_rows(spark, monkeypatch):
    _, frame = scored(spark)
    whole = bootstrap.bootstrap_r2(frame, F.col("id"), "y", {"m": "a"}, 20, blocks=3).collect()
    monkeypatch.setattr(bootstrap, "TASK_DRAWS", 500)
    parted = bootstrap.bootstrap_r2(frame.repartition(5), F.col("id"), "y", {"m": "a"}, 20, blocks=3).collect()
    assert {(r.replicate, round(r.r2, 9)) for r in whole} == {(r.replicate, round(r.r2, 9)) for r in parted} and len(parted) == 20


# One-sided 5% points of the t distribution.
@pytest.mark.parametrize("df,point", [(1, 6.313752), (2, 2.919986), (3, 2.353363), (4, 2.131847), (5, 2.015048),
                                      (38, 1.685954), (120, 1.657651)])
def test_t_distribution_points(spark, df, point):
    low, high, middle = spark.range(1).select(*(
        bootstrap.student_t_below(F.lit(t), F.lit(df)) for t in (-point, point, 0.0))).first()
    assert low == pytest.approx(0.05, abs=1e-6)
    assert low + high == pytest.approx(1.0, abs=1e-12)
    assert middle == pytest.approx(0.5, abs=1e-12)


def test_t_distribution_is_nearly_normal_for_many_replicates(spark):
    got = spark.range(1).select(bootstrap.student_t_below(F.lit(-1.6449), F.lit(5998))).first()[0]
    assert got == pytest.approx(0.5 * math.erfc(1.6449 / math.sqrt(2)), abs=1e-4)


def replicates(spark, old, new):
    rows = [(i, m, float(v)) for m, values in (("old", old), ("new", new)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "replicate int, model string, r2 double")


def test_promotion_decision(spark):
    old, new = [0.50, 0.52, 0.54, 0.51], [0.55, 0.56, 0.58, 0.54]
    row = bootstrap.promotion_decision(replicates(spark, old, new), "old", "new").first()
    pooled = (statistics.variance(old) + statistics.variance(new)) / 2
    want = (statistics.mean(old) - statistics.mean(new)) / math.sqrt(pooled * 2 / 4)
    assert row.t_stat == pytest.approx(want) and row.df == 6 and row.promote
    assert row.diff_p05 == pytest.approx(np.quantile(np.subtract(new, old), 0.05))
    back = bootstrap.promotion_decision(replicates(spark, new, old), "old", "new").first()
    assert not back.promote and row.p_value + back.p_value == pytest.approx(1.0)
    summary = bootstrap.bootstrap_summary(replicates(spark, old, new))
    assert bootstrap.t_test(summary, "old", "new").first().p_value == pytest.approx(row.p_value)


def test_equal_replicates_are_not_promoted(spark):
    row = bootstrap.promotion_decision(replicates(spark, [0.5, 0.5], [0.5, 0.5]), "old", "new").first()
    assert row.t_stat is None and row.promote is False


def test_r2_of_a_target_far_from_zero(spark):
    rows = [(i, 1e8 + (i * 37 % 100) / 100, 1e8 + (i * 37 % 100) / 100 + (0.1 if i % 2 else -0.1)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, y double, p double")
    y = np.array([r[1] for r in rows])
    true = 1 - 0.01 / y.var()
    found = [r.r2 for r in bootstrap.bootstrap_r2(df, F.col("id"), "y", {"m": "p"}, 50).collect()]
    assert abs(np.mean(found) - true) < 0.005 and max(found) < 1


def test_missing_label_is_an_error(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 1.0, 1.0)], "id long, y double, p double")
    with pytest.raises(ValueError):
        bootstrap.bootstrap_r2(df, F.col("id"), "y", {"m": "p"}, 5)
