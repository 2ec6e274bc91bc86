"""Small state tables: watermark, model registry log, training runs.

Each is an append-only parquet table under the run's own prefix; the current
state is an aggregate over it, so nothing is overwritten while it is read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import schema
from aerolake.operators.registry import current_registry
from aerolake.sources.tables import read_if_exists


def get_watermark(spark: SparkSession, path: str, dataset_name: str) -> dt.date | None:
    marks = read_if_exists(spark, path, schema.WATERMARK)
    return (marks.where(F.col("dataset_name") == dataset_name)
            .agg(F.max("max_available_date")).first()[0])


def set_watermark(spark: SparkSession, path: str, dataset_name: str, mark: dt.date) -> None:
    (spark.createDataFrame([(dataset_name, mark)], schema.WATERMARK)
     .write.mode("append").parquet(path))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return current_registry(read_if_exists(spark, path, schema.REGISTRY))


def record_versions(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Append the given (name, version, stage, path) states to the log."""
    last = read_if_exists(spark, path, schema.REGISTRY).agg(F.max("change_id")).first()[0] or 0
    (rows.select((F.lit(last + 1) + F.monotonically_increasing_id()).alias("change_id"),
                 "name", F.col("version").cast("long").alias("version"), "stage", "path")
     .write.mode("append").parquet(path))


def record_run(spark: SparkSession, path: str, experiment: str, run_id: str, start_time: dt.datetime,
               metrics: dict[str, float]) -> None:
    (spark.createDataFrame([(experiment, run_id, start_time, metrics)], schema.RUNS)
     .write.mode("append").parquet(path))
