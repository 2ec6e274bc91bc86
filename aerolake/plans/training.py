"""Train a linear model, compare it with the production one, promote it."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.config import FlightConfig
from aerolake.functions.dates import add_weekday_flags
from aerolake.functions.encoding import mean_imputer
from aerolake.operators.bootstrap import bootstrap_r2, promotion_decision
from aerolake.operators.metrics import METRIC_NAMES, regression_metrics
from aerolake.operators.registry import latest_version, promote_versions
from aerolake.operators.rows import cap_newest, drop_null_target, split_bound, time_split
from aerolake.plans.features import day_counts
from aerolake.sources import sinks, state
from aerolake.sources.tables import read_parquet, row_key

logger = logging.getLogger(__name__)


def model_frame(df: DataFrame, config: FlightConfig) -> DataFrame:
    """The columns a model sees: features, weekday flags, date and target."""
    flagged = add_weekday_flags(df, config.date_dk)
    return drop_null_target(
        flagged.select(*config.model_features, config.date_dk, config.target_column), config.target_column)


def fit_model(train: DataFrame, config: FlightConfig, impute_on: DataFrame | None = None) -> PipelineModel:
    """Imputer, assembler and linear regression, fitted as one pipeline.

    Two passes over the rows: one for the fill values, one for the regression's
    normal equations.  The fill values come from ``impute_on`` (default: the
    training rows, so that validation rows do not leak into them).

    All seven weekday flags are made and filled, but the last one is not given
    to the regression: the seven add up to the intercept's constant, and with
    all of them the normal equations are singular.  Predictions are the same;
    the weights are then unique.
    """
    features = config.model_features
    imputer = mean_imputer(features).fit(train if impute_on is None else impute_on)
    stages = [imputer,
              VectorAssembler(inputCols=[f"{c}_imputed" for c in features[:-1]], outputCol="features"),
              LinearRegression(featuresCol="features", labelCol=config.target_column)]
    return Pipeline(stages=stages).fit(train)


def predict(model: PipelineModel, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Input columns plus the prediction; the vector and any earlier result go."""
    clean = df.drop("features", "prediction")
    kept = [c for c in clean.columns if not c.endswith("_imputed")]
    return model.transform(clean).select(*kept, F.col("prediction").alias(output))


def train_model(spark: SparkSession, config: FlightConfig) -> dict[str, float]:
    """Split by date, fit, measure, register; returns the test metrics.

    All rows before the split are trained on, unless ``max_train_size`` is set: then the newest ones, that many.

    The split is written first and the model is fitted from the written rows:
    every pass then sees the same rows whatever happens to an executor, and the
    feature table is read once for each part.
    """
    started = dt.datetime.now()
    features = model_frame(read_parquet(spark, config.features_path), config)
    bound = split_bound(config.run_date(), config.val_days)
    train, test = time_split(features, config.date_dk, bound)
    if config.max_train_size is not None:
        # Accumulation drops rows without a target, so its counts are those of the model's rows.
        counts = day_counts(spark, config)
        if counts is not None:
            counts, _ = time_split(counts, config.date_dk, bound)
        train = cap_newest(train, config.date_dk, config.max_train_size, config.seed, counts)
    sinks.write_snapshot(train, config.train_path)
    sinks.write_snapshot(test, config.test_path)
    train, test = read_parquet(spark, config.train_path), read_parquet(spark, config.test_path)

    impute_on = {"train": None, "all": features}[config.impute_scope]
    model = fit_model(train, config, impute_on)
    row = regression_metrics(predict(model, test), config.target_column).first()
    metrics = {name: row[name] for name in METRIC_NAMES if row[name] is not None}
    logger.info("Test metrics: %s", metrics)

    registry = state.read_registry(spark, config.registry_path)
    newest = registry.where(F.col("name") == config.model_name).agg(F.max("version")).first()[0] or 0
    version = newest + 1
    path = config.model_path(version)
    model.write().overwrite().save(path)
    state.record_versions(spark, config.registry_path, spark.createDataFrame(
        [(config.model_name, version, "None", path)], "name string, version long, stage string, path string"))
    state.record_run(spark, config.runs_path, config.model_name, uuid.uuid4().hex, started, metrics)
    return metrics


def load_model(spark: SparkSession, config: FlightConfig, stage: str | None = None,
               version: int | None = None) -> PipelineModel | None:
    """The model in ``stage``, or with ``version``, or the newest one."""
    versions = state.read_registry(spark, config.registry_path).where(F.col("name") == config.model_name)
    if stage:
        versions = versions.where(F.col("stage") == stage)
    if version is not None:
        versions = versions.where(F.col("version") == version)
    row = latest_version(versions).first()
    return PipelineModel.load(row.path) if row else None


def compare_models(champion: PipelineModel, challenger: PipelineModel, rows: DataFrame, key: Column,
                   config: FlightConfig) -> DataFrame:
    """One-row promotion decision from the bootstrap of both models on ``rows``."""
    keyed = rows.withColumn("_row_key", key)
    both = predict(challenger, predict(champion, keyed, "champion"), "challenger")
    resamples = bootstrap_r2(both, F.col("_row_key"), config.target_column,
                             {"champion": "champion", "challenger": "challenger"},
                             config.replicates, config.seed)
    return promotion_decision(resamples, "champion", "challenger", config.significance)


def eval_model(spark: SparkSession, config: FlightConfig) -> bool:
    """Promote the newest version when it beats production on the test rows.

    Without a production version there is nothing to beat, so it is promoted.
    """
    registry = state.read_registry(spark, config.registry_path).where(F.col("name") == config.model_name)
    newest = latest_version(registry)
    champion = load_model(spark, config, stage="Production")
    if champion is None:
        better = True
    else:
        challenger = load_model(spark, config)
        test = read_parquet(spark, config.test_path)
        decision = compare_models(champion, challenger, test, row_key(), config).first()
        logger.info("Comparison: %s", decision.asDict())
        better = decision.promote
    if better:
        changed = promote_versions(registry, newest).exceptAll(registry)
        state.record_versions(spark, config.registry_path, changed)
    return better
