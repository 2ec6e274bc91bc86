"""One-off history preparation: CSV files to year-partitioned raw data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import schema
from aerolake.config import FLIGHT_COLUMNS, HISTORY_SHIFT_DAYS
from aerolake.functions.dates import shift_days
from aerolake.functions.encoding import nan_to_null
from aerolake.operators.profile import modal_year
from aerolake.operators.rows import drop_null_target
from aerolake.sources import files, sinks
from aerolake.sources.tables import read_csv_files


def shifted_rows(rows: DataFrame, date_col: str, target: str, shift: int) -> DataFrame:
    """Rows with a target, their dates moved on by ``shift`` days."""
    return drop_null_target(rows, target).withColumn(date_col, shift_days(date_col, shift))


def modal_rows(rows: DataFrame, file_col: str, date_col: str) -> DataFrame:
    """Of every source file the rows of its most frequent year.

    The per-file years are a small table; adaptive execution broadcasts it if
    its measured size allows, else shuffles and splits skewed files.
    """
    years = modal_year(rows, date_col, [file_col])
    return rows.join(years, file_col).where(F.year(date_col) == F.col("modal_year"))


def prepare_history(rows: DataFrame, file_col: str, date_col: str = "FL_DATE", target: str = "DEP_DELAY",
                    shift: int = HISTORY_SHIFT_DAYS, columns: Sequence[str] = FLIGHT_COLUMNS) -> DataFrame:
    """Shift the dates and keep, for every source file, the rows of its most
    frequent year (the shift pushes a few rows of each file over new year)."""
    return modal_rows(shifted_rows(rows, date_col, target, shift), file_col, date_col).select(*columns)


def load_history(spark: SparkSession, source: str, target_path: str, level: str = "file",
                 target: str = "DEP_DELAY", shift: int = HISTORY_SHIFT_DAYS) -> None:
    """Read all CSV files below ``source`` and write one folder per year; a year
    that was written before is replaced.

    The text is parsed once, into parquet folders by file and year beside the
    target.  The files' years are counted there, which reads no column, and only the
    folders of a file's modal year are read again and published.
    """
    staging, date_col = f"{target_path.rstrip('/')}__staging", "FL_DATE"
    # Files (or folders) of one name in several folders are judged each by itself.
    rows = nan_to_null(read_csv_files(spark, source, schema.FLIGHT, "source_file", f"{level}_path"))
    rows = shifted_rows(rows, date_col, target, shift).withColumn("source_year", F.year(date_col))
    rows.write.mode("overwrite").partitionBy("source_file", "source_year").parquet(staging)
    staged = spark.read.schema(rows.schema).parquet(staging)
    counts = staged.where("source_year IS NOT NULL").groupBy("source_file", "source_year").agg(F.count("*").alias("n"))
    modal = counts.groupBy("source_file").agg(F.max_by("source_year", F.struct("n", -F.col("source_year"))).alias("source_year"))
    # One row a file, and the driver lists the files anyhow: broadcast, so that no row is shuffled.
    kept = staged.join(F.broadcast(modal), ["source_file", "source_year"], "left_semi").select(*FLIGHT_COLUMNS)
    sinks.write_by_year(kept, target_path, date_col)
    files.remove(spark, staging)
