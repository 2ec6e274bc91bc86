"""Cross validation from sums by fold, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.plans import exploration


def frame_of(spark, seed=4, n=400):
    rng = np.random.default_rng(seed)
    x = rng.normal(3, [1, 4], size=(n, 2))
    p = 1 / (1 + np.exp(-(1.5 * (x[:, 0] - 3) - 0.4 * (x[:, 1] - 3))))
    y = (rng.random(n) < p).astype(float)
    rows = [(float(a) if i % 4 else None, float(b) if i % 7 else float("nan"), None, 7.0, float(a) if i % 4 else None, float(v))
            for i, ((a, b), v) in enumerate(zip(x, y))]
    names = ["a", "b", "none", "same", "twice"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "y"]))
    return exploration.exploration_frame(df, names, "y"), names


def filled(frame, names, fold):
    """(training design, training labels, held-out design, held-out labels), standardised by the training rows."""
    rows = np.array([tuple(r[c] for c in [*names, "label", "fold"]) for r in frame.collect()], dtype=float)
    x, y, out = rows[:, :-2], rows[:, -2], rows[:, -1] == fold
    fills = np.array([0.0 if np.isnan(c).all() else np.nanmean(c) for c in x[~out].T])
    x = np.where(np.isnan(x), fills, x)
    scale = x[~out].std(axis=0)
    z = (x - x[~out].mean(axis=0)) / np.where(scale > 1e-12, scale, 1)
    z = np.column_stack([np.ones(len(z)), z])
    return z[~out], y[~out], z[out], y[out]


def test_linear_folds_with_missing_constant_and_repeated_features(spark):
    frame, names = frame_of(spark)
    scores = {r.fold: r.score for r in exploration.cross_validate(frame, names, exploration.standardized_linear, exploration.negative_mae).collect()}
    assert sorted(scores) == [0, 1, 2, 3, 4]
    for fold, score in scores.items():
        z, y, held, want = filled(frame, names, fold)
        assert score == pytest.approx(-np.abs(want - held @ np.linalg.lstsq(z, y, rcond=1e-8)[0]).mean(), abs=1e-7)


def test_logistic_fit_ends_where_the_gradient_is_zero(spark):
    frame, names = frame_of(spark)
    moments, w, gradient = exploration.fit_logistic(frame, names)
    assert np.abs(gradient).max() < 1e-6
    for fold in range(5):
        z, y, _, _ = filled(frame, names, fold)
        p = 1 / (1 + np.exp(-z @ w[fold]))
        assert np.abs(z.T @ (p - y) + np.append(0, w[fold][1:])).max() < 1e-5


def test_logistic_scores_and_plan(spark):
    frame, names = frame_of(spark)
    scored = exploration.standardized_logistic(frame, names)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Python" not in plan
    scores = {r.fold: r.score for r in exploration.cross_validate(frame, names, exploration.standardized_logistic, exploration.accuracy).collect()}
    _, w, _ = exploration.fit_logistic(frame, names)
    for fold, score in scores.items():
        _, _, held, want = filled(frame, names, fold)
        assert score == pytest.approx(((held @ w[fold] > 0) == want).mean())
    assert np.mean(list(scores.values())) > 0.7


def test_separable_classes_converge(spark):
    rows = [(float(i), float(i >= 50)) for i in range(100)]
    frame = exploration.exploration_frame(spark.createDataFrame(rows, "a double, y double"), ["a"], "y")
    _, w, gradient = exploration.fit_logistic(frame, ["a"])
    assert np.abs(gradient).max() < 1e-6 and np.isfinite(w).all() and (w[:, 1] > 2).all()


def test_no_rows_and_one_class(spark):
    empty = exploration.exploration_frame(spark.createDataFrame([], "a double, y double"), ["a"], "y")
    for model, metric in ((exploration.standardized_linear, exploration.negative_mae), (exploration.standardized_logistic, exploration.accuracy)):
        assert exploration.cross_validate(empty, ["a"], model, metric).collect() == []
    ones = exploration.exploration_frame(spark.createDataFrame([(float(i), 1.0) for i in range(50)], "a double, y double"), ["a"], "y")
    scores = exploration.cross_validate(ones, ["a"], exploration.standardized_logistic, exploration.accuracy).collect()
    assert {r.score for r in scores} == {1.0}


def test_a_frame_written_by_one_task_is_read_by_many(spark, monkeypatch):
    monkeypatch.setattr(exploration, "FILE_ROWS", 1_000)
    df = spark.range(8_000).coalesce(1).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 2 AS DOUBLE) AS y")
    frame = exploration.exploration_frame(df, ["a"], "y")
    assert frame.count() == 8_000 and len(frame.inputFiles()) == 8
    assert max(r["count"] for r in frame.groupBy(F.input_file_name()).count().collect()) <= 1_000


def test_first_newton_step_needs_no_pass(spark, monkeypatch):
    frame, names = frame_of(spark)
    passes = []
    total = exploration.FoldSums.total
    monkeypatch.setattr(exploration.FoldSums, "total", lambda self, *a: passes.append(1) or total(self, *a))
    monkeypatch.setattr(exploration, "NEWTON_STEPS", 1)
    exploration.fit_logistic(frame, names)
    assert len(passes) == 2  # the moments, and the loss after the step
