"""Boosted trees of all folds at once, against Spark's own boosted models fitted fold by fold."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from aerolake.functions.encoding import surrogates
from aerolake.operators import boosting
from aerolake.plans import exploration

NAMES = ["a", "b", "few", "same", "none", "zeros", "u"]


def frame_of(spark, n, label, key="id"):
    rows = (spark.range(n).withColumn("a", F.when(F.col("id") % 7 > 0, F.rand(1) * 10)).withColumn("b", F.round(F.randn(2) * 40))
            .withColumn("few", (F.col("id") % 3).cast("double")).withColumn("same", F.lit(7.0)).withColumn("none", F.lit(None).cast("double"))
            .withColumn("zeros", F.when(F.col("id") % 5 > 0, F.lit(0.0)).otherwise(F.rand(3))).withColumn("u", F.rand(5)))
    y = F.sin(F.coalesce("a", F.lit(2.0))) * 3 + F.col("b") / 20 * F.col("few") + F.randn(4)
    y = (y > 0).cast("double") if label == "class" else y
    return exploration.exploration_frame(rows.withColumn("y", y), NAMES, "y", key=F.col(key))


def fold_by_fold(frame, estimator, fold):
    train, held_out = frame.where(F.col("fold") != fold), frame.where(F.col("fold") == fold)
    means = surrogates(train, NAMES).first()
    fills = {c: means[c] or 0.0 for c in NAMES}
    model = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), estimator]).fit(train.fillna(fills))
    return np.array([r.prediction for r in model.transform(held_out.fillna(fills)).orderBy("u").select("prediction").collect()])


@pytest.mark.parametrize("n", [3_000, 15_000])  # with more than 10,000 training rows split candidates come from drawn ones
@pytest.mark.parametrize("kind", ["class", "value"])
def test_trees_are_those_of_spark(spark, kind, n, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 1_000)
    monkeypatch.setattr(boosting, "TREES", 4)
    frame = frame_of(spark, n, kind)
    model, estimator = {"class": (exploration.boosted_classifier, GBTClassifier(labelCol="label", seed=42, maxIter=4)),
                        "value": (exploration.boosted_regressor, GBTRegressor(labelCol="label", seed=42, maxIter=4))}[kind]
    predicted = model(frame, NAMES)
    assert predicted.columns == [*frame.columns, "prediction"] and predicted.count() == n
    want = fold_by_fold(frame, estimator, 2)
    got = np.array([r.prediction for r in predicted.where("fold = 2").orderBy("u").select("prediction").collect()])
    assert got == pytest.approx(want, abs=1e-9)


def test_all_folds_take_one_pass_a_level(spark, monkeypatch):
    passes = []
    histograms = boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda *a: passes.append(1) or histograms(*a))
    monkeypatch.setattr(boosting, "TREES", 2)
    exploration.boosted_regressor(frame_of(spark, 2_000, "value"), NAMES)
    assert len(passes) == 2 * boosting.DEPTH


def test_constant_features_and_one_class(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TREES", 3)
    df = spark.createDataFrame([(1.0, None, 1.0)] * 40, "a double, b double, y double")
    frame = exploration.exploration_frame(df.withColumn("id", F.monotonically_increasing_id()), ["a", "b"], "y", key=F.expr("uuid()"))
    assert {r.prediction for r in exploration.boosted_classifier(frame, ["a", "b"]).collect()} == {1.0}
    assert [r.prediction for r in exploration.boosted_regressor(frame, ["a", "b"]).collect()] == pytest.approx([1.0] * 40)


def test_labels_of_the_classifier_are_checked(spark):
    frame = exploration.exploration_frame(spark.createDataFrame([(float(i), float(i % 3)) for i in range(30)], "a double, y double"), ["a"], "y")
    with pytest.raises(ValueError, match="labels"):
        exploration.boosted_classifier(frame, ["a"])
