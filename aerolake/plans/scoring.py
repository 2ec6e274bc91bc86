"""Batch scoring: CSV in, predictions out, one distributed plan."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from aerolake import schema
from aerolake.config import FlightConfig
from aerolake.functions.dates import weekday_flags, weekday_flags_serving
from aerolake.sources import sinks
from aerolake.sources.tables import read_csv


def scoring_frame(df: DataFrame, config: FlightConfig, weekdays: str = "train") -> DataFrame:
    """The model's input columns.  ``weekdays="train"`` numbers the days as in
    training; ``"serving"`` reproduces old score files."""
    flags = {"train": weekday_flags, "serving": weekday_flags_serving}[weekdays](config.date_dk)
    return df.select("*", *flags).select(*config.model_features)


def score_batch(spark: SparkSession, config: FlightConfig, model: PipelineModel, input_path: str,
                output_path: str, weekdays: str = "train", vectors: str = "json") -> None:
    """Score every row of a headed CSV file or folder and write CSV.

    The output has the model's input, filled and predicted columns.
    """
    rows = read_csv(spark, input_path, schema.scoring_input(config.input_features, config.date_dk))
    sinks.write_csv(model.transform(scoring_frame(rows, config, weekdays)), output_path, vectors)
