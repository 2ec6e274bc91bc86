"""Feature preparation: collect a slice, clean it, add it to the feature table."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from aerolake.config import FlightConfig
from aerolake.functions.dates import first_run_lower_bound
from aerolake.functions.encoding import nan_to_null
from aerolake.operators import profile
from aerolake.operators.checks import require_columns, require_same_columns
from aerolake.operators.rows import date_slice, drop_null_target
from aerolake.sources import sinks, state
from aerolake.sources.tables import read_if_exists, read_parquet

logger = logging.getLogger(__name__)


def collect_raw_data(spark: SparkSession, config: FlightConfig) -> None:
    """Write the rows since the watermark (first run: the last
    ``max_history_days``) as the fresh slice, then move the watermark.

    The mark moves after the data is written.  A run that dies in between is
    repeated over the same days, which accumulation by whole days allows.
    """
    to_date = config.run_date()
    from_date = (state.get_watermark(spark, config.watermark_path, config.dataset_name)
                 or first_run_lower_bound(to_date, config.max_history_days))
    logger.info("Collecting %s to %s", from_date, to_date)
    raw = read_parquet(spark, config.raw_path)
    year = "year" if "year" in raw.columns and "year" not in config.required_columns else None
    fresh = date_slice(raw, config.date_dk, from_date, to_date, year)
    if year:
        fresh = fresh.drop(year)
    # A slice of a long table leaves a few rows in each of many tasks; the
    # rebalance writes them as few well-filled files.
    sinks.write_snapshot(nan_to_null(fresh).hint("rebalance"), config.fresh_path)
    state.set_watermark(spark, config.watermark_path, config.dataset_name, to_date)


def clean_data(spark: SparkSession, config: FlightConfig) -> None:
    """Check the column contract and drop rows without a target.

    The rows before and after are counted by the write itself.
    """
    fresh = require_columns(read_parquet(spark, config.fresh_path), config.required_columns)
    counts = Observation("clean_counts")
    counted = fresh.observe(counts, *profile.clean_counts_columns(config.target_column))
    sinks.write_snapshot(drop_null_target(counted, config.target_column), config.clean_path)
    logger.info("Rows before and after cleaning: %s", counts.get)


def concat_features(spark: SparkSession, config: FlightConfig) -> None:
    """Add the clean slice to the feature table.

    ``accumulate_mode="replace_days"`` replaces whole days, so the day that two
    slices share is kept once.  ``"append_all"`` keeps it twice.  The statistics of the
    slice's days go beside the table in the same way: replaced, or added.
    """
    clean = read_parquet(spark, config.clean_path)
    require_same_columns(clean, read_if_exists(spark, config.features_path, clean.schema))
    stats = profile.day_stats(clean, config.date_dk, config.input_features)
    write = {"replace_days": sinks.replace_days, "append_all": sinks.append_days}[config.accumulate_mode]
    write(clean, config.features_path, config.date_dk)
    write(stats, config.day_stats_path, config.date_dk)


def day_counts(spark: SparkSession, config: FlightConfig) -> DataFrame | None:
    """(date, n) of the feature table's days, or None for a table that was made without them."""
    stats = read_if_exists(spark, config.day_stats_path, StructType([]))
    return profile.merged_days(stats, config.date_dk).select(config.date_dk, "n") if stats.columns else None


def prepare_features(spark: SparkSession, config: FlightConfig) -> None:
    collect_raw_data(spark, config)
    clean_data(spark, config)
    concat_features(spark, config)
