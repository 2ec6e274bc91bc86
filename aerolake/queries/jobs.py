"""The jobs as a scheduler runs them, and what they leave in their tables, with reference SQL."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import schema
from aerolake.config import INPUT_FEATURES, FlightConfig
from aerolake.operators import rows
from aerolake.operators.checks import require_columns, require_same_columns
from aerolake.operators.metrics import METRIC_NAMES
from aerolake.operators.registry import metrics_long
from aerolake.plans import features, monitoring, training
from aerolake.queries.fixtures import AS_OF, FLIGHTS_SQL, config_in, flights, rounded
from aerolake.queries.modelling import KEYS, _linear_sql, _validation_rows
from aerolake.queries.monitoring import AT, _moments
from aerolake.queries.preparation import _FRESH, BOUND, DEFAULTS, fresh_slice
from aerolake.sources import sinks, state, tables

#: When the first of two model versions was trained.
EARLY = dt.date(1995, 3, 1)
EARLY_BOUND = rows.split_bound(EARLY, DEFAULTS.val_days)


def _prepared(spark: SparkSession, sf_dir: str, label: str) -> FlightConfig:
    """A fresh prefix whose feature table holds the flights with a target."""
    config = config_in(spark, label)
    sinks.write_snapshot(rows.drop_null_target(flights(spark, sf_dir, staging=True), config.target_column), config.features_path)
    return config


def _two_versions(spark: SparkSession, sf_dir: str) -> FlightConfig:
    """Version 1, trained early, goes into production; version 2, trained on all rows, is compared with it."""
    config = _prepared(spark, sf_dir, "versions")
    early = replace(config, as_of=EARLY)
    for settings in (early, config):
        training.train_model(spark, settings)
        training.eval_model(spark, settings)
    return config


def _long(rows: DataFrame) -> DataFrame:
    return rows.select("metric_name", F.round("value", 3).alias("value"))


def train_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics that training has recorded for its run."""
    config = _prepared(spark, sf_dir, "train")
    training.train_model(spark, config)
    return _long(metrics_long(tables.read_parquet(spark, config.runs_path)))


def eval_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after the second version was compared with the first by 3,000 resamples."""
    config = _two_versions(spark, sf_dir)
    return state.read_registry(spark, config.registry_path).select("name", "version", "stage")


def load_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions by the model in production and by version 1, both looked up in the registry."""
    config = _two_versions(spark, sf_dir)
    validated = training.predict(training.load_model(spark, config, stage="Production"), _validation_rows(spark, sf_dir), "production")
    return training.predict(training.load_model(spark, config, version=1), validated, "first").select(
        *KEYS, F.round("production", 2).alias("production"), F.round("first", 2).alias("first"))


def main_stats_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = config_in(spark, "main-stats")
    sinks.write_snapshot(fresh_slice(spark, sf_dir), config.fresh_path)
    monitoring.create_stats_tables(spark, config)
    monitoring.update_main_stats(spark, config, AT)
    return tables.read_parquet(spark, config.stats_path("main_data_stats")).drop("date")


def feature_stats_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = config_in(spark, "feature-stats")
    sinks.write_snapshot(fresh_slice(spark, sf_dir), config.fresh_path)
    monitoring.create_stats_tables(spark, config)
    monitoring.update_features_stats(spark, config, AT)
    return rounded(tables.read_parquet(spark, config.stats_path("features_stats")).drop("date"))


def metrics_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest run's metrics, of two runs, in the monitoring table."""
    config = _prepared(spark, sf_dir, "metrics")
    for settings in (replace(config, as_of=EARLY), config):
        training.train_model(spark, settings)
    monitoring.create_stats_tables(spark, config)
    monitoring.add_new_metrics(spark, config, AT)
    found = tables.read_parquet(spark, config.stats_path("model_metrics"))
    return found.select("model_name", "dataset_name", "metric_name", F.round("value", 3).alias("value"))


def column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of three frames pass the checks of cleaning and of accumulation, with their rows."""
    good = flights(spark, sf_dir)
    cases = {"whole": good, "reordered": good.select(*reversed(good.columns)), "without target": good.drop("ARR_DELAY")}
    found = None
    for name, frame in cases.items():
        passed = {}
        for check, run in (("required", lambda: require_columns(frame, DEFAULTS.required_columns)), ("same", lambda: require_same_columns(frame, good))):
            try:
                run()
                passed[check] = True
            except ValueError:
                passed[check] = False
        row = frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("frame"), *(F.lit(v).alias(k) for k, v in passed.items()), "row_count")
        found = row if found is None else found.unionByName(row)
    return found


_METRICS = {
    "r2": "1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m))", "rmse": "sqrt(avg((y - p) * (y - p)))",
    "mse": "avg((y - p) * (y - p))", "mae": "avg(abs(y - p))", "var": "avg((p - m) * (p - m))"}
_TEST = f"FL_DATE >= DATE '{BOUND}' AND ARR_DELAY IS NOT NULL"
_LONG_SQL = f"""{_linear_sql()}, e AS (SELECT ARR_DELAY AS y, p, avg(ARR_DELAY) OVER () AS m FROM scored WHERE {_TEST}),
  long AS ({" UNION ALL ".join(f"SELECT '{n}' AS metric_name, round({_METRICS[n]}, 3) AS value FROM e" for n in METRIC_NAMES)})"""
_PAIR_SQL = f"""production AS ({_linear_sql()} SELECT row_number() OVER (ORDER BY {", ".join(KEYS)}, DISTANCE, ARR_DELAY, p) AS i, *
    FROM scored WHERE {_TEST}),
  first AS ({_linear_sql(EARLY_BOUND)} SELECT row_number() OVER (ORDER BY {", ".join(KEYS)}, DISTANCE, ARR_DELAY, p) AS i, p AS p1
    FROM scored WHERE {_TEST})"""

QUERIES = {
    "train_job": (train_job, f"{_LONG_SQL} SELECT * FROM long"),
    "metrics_job": (metrics_job, f"""{_LONG_SQL} SELECT '{DEFAULTS.model_name}' AS model_name,
        '{DEFAULTS.dataset_name}' AS dataset_name, metric_name, value FROM long"""),
    # With 3,000 resamples the test follows the sign of the difference.
    "eval_job": (eval_job, f"""WITH {_PAIR_SQL},
        better AS (SELECT sum((ARR_DELAY - p) * (ARR_DELAY - p)) < sum((ARR_DELAY - p1) * (ARR_DELAY - p1)) AS b
                   FROM production JOIN first USING (i))
        SELECT '{DEFAULTS.model_name}' AS name, CAST(v AS BIGINT) AS version,
          CASE WHEN (v = 2) = b THEN 'Production' WHEN v = 1 THEN 'Archived' ELSE 'None' END AS stage
        FROM better, (VALUES (1), (2)) AS t(v)"""),
    "load_models": (load_models, f"""WITH {_PAIR_SQL},
        better AS (SELECT sum((ARR_DELAY - p) * (ARR_DELAY - p)) < sum((ARR_DELAY - p1) * (ARR_DELAY - p1)) AS b
                   FROM production JOIN first USING (i))
        SELECT {", ".join(KEYS)}, round(CASE WHEN b THEN p ELSE p1 END, 2) AS production, round(p1, 2) AS first
        FROM production JOIN first USING (i), better"""),
    "main_stats_job": (main_stats_job, f"""WITH {FLIGHTS_SQL} SELECT CAST(1 AS BIGINT) AS data_id, '{DEFAULTS.dataset_name}' AS dataset_name,
        CAST(count(*) AS DOUBLE) AS row_count, CAST(21 AS DOUBLE) AS column_count FROM flights WHERE {_FRESH}"""),
    "feature_stats_job": (feature_stats_job, f"""WITH {FLIGHTS_SQL} SELECT CAST(1 AS BIGINT) AS data_id,
        '{DEFAULTS.dataset_name}' AS dataset_name, {", ".join(_moments(c).replace("AS BIGINT", "AS DOUBLE") for c in INPUT_FEATURES)} FROM flights WHERE {_FRESH}"""),
    "column_checks": (column_checks, f"""WITH {FLIGHTS_SQL}, n AS (SELECT count(*) AS row_count FROM flights)
        SELECT * FROM (VALUES ('whole', true, true), ('reordered', true, true), ('without target', false, false)) AS t(frame, required, same), n"""),
}
