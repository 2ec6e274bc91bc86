"""Monitoring tables: dataset size, feature statistics, run metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import schema
from aerolake.config import FlightConfig
from aerolake.operators import profile
from aerolake.operators.registry import latest_run, metrics_long
from aerolake.sources import sinks
from aerolake.sources.tables import read_if_exists, read_parquet


def stats_tables(config: FlightConfig) -> dict:
    return {"main_data_stats": schema.MAIN_STATS, "model_metrics": schema.MODEL_METRICS,
            "features_stats": schema.features_stats(config.input_features)}


def create_stats_tables(spark: SparkSession, config: FlightConfig) -> None:
    for name, columns in stats_tables(config).items():
        sinks.create_if_absent(spark, config.stats_path(name), columns)


def _append(rows: DataFrame, config: FlightConfig, table: str, jdbc: dict | None) -> None:
    """To the parquet table, or to a database given as {"url", "properties"}."""
    columns = stats_tables(config)[table]
    if jdbc:
        sinks.append_jdbc(rows, jdbc["url"], table, columns, jdbc.get("properties"))
    else:
        sinks.append_with_id(rows, config.stats_path(table), columns)


def update_main_stats(spark: SparkSession, config: FlightConfig, at: dt.datetime | None = None,
                      jdbc: dict | None = None) -> None:
    """Row and column count of the fresh slice, before cleaning."""
    stats = profile.main_stats(read_parquet(spark, config.fresh_path), config.dataset_name)
    _append(stats.withColumn("date", F.lit(at or dt.datetime.now())), config, "main_data_stats", jdbc)


def update_features_stats(spark: SparkSession, config: FlightConfig, at: dt.datetime | None = None,
                          jdbc: dict | None = None) -> None:
    """Moments and null rates of the fresh slice, before cleaning."""
    stats = profile.feature_stats(read_parquet(spark, config.fresh_path), config.input_features)
    _append(stats.select(F.lit(config.dataset_name).alias("dataset_name"),
                         F.lit(at or dt.datetime.now()).alias("date"), "*"), config, "features_stats", jdbc)


def add_new_metrics(spark: SparkSession, config: FlightConfig, at: dt.datetime | None = None,
                    jdbc: dict | None = None) -> None:
    """Metrics of the newest training run, one row per metric, in one append."""
    runs = read_if_exists(spark, config.runs_path, schema.RUNS)
    newest = latest_run(runs.where(F.col("experiment") == config.model_name))
    rows = metrics_long(newest).select(
        F.lit(at or dt.datetime.now()).alias("date"), F.lit(config.model_name).alias("model_name"),
        F.lit(config.dataset_name).alias("dataset_name"), "metric_name", "value")
    _append(rows, config, "model_metrics", jdbc)
