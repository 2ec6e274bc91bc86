"""Counts, moments and profiles.  All are one partial + final aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_counts_columns(target: str) -> list[Column]:
    return [F.count("*").alias("rows_before"), F.count(target).alias("rows_after")]


def clean_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows before and after the target filter, in one pass."""
    return df.agg(*clean_counts_columns(target))


def date_bounds(df: DataFrame, date_col: str) -> DataFrame:
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def feature_stats_columns(features: Sequence[str]) -> list[Column]:
    """Mean, sample deviation, null count and null share of each feature."""
    columns = []
    for c in features:
        missing = F.col(c).isNull().cast("int")
        columns += [F.mean(c).alias(f"mean_{c}"), F.stddev(c).alias(f"std_{c}"),
                    F.sum(missing).alias(f"nan_count_{c}"), F.mean(missing).alias(f"nan_prop_{c}")]
    return columns


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.agg(*feature_stats_columns(features))


def day_stats(df: DataFrame, date_col: str, features: Sequence[str]) -> DataFrame:
    """Per day: rows ``n``, and for each feature its missing values, sum and sum of squares.

    Days in several parts are added up by :func:`merged_days`.
    """
    columns = [F.count("*").alias("n")]
    for c in features:
        x = F.col(c).cast("double")
        columns += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"), F.coalesce(F.sum(x), F.lit(0.0)).alias(f"sum_{c}"),
                    F.coalesce(F.sum(x * x), F.lit(0.0)).alias(f"squares_{c}")]
    return df.groupBy(date_col).agg(*columns)


def merged_days(stats: DataFrame, date_col: str) -> DataFrame:
    """One row a day from day statistics in parts."""
    return stats.groupBy(date_col).agg(*(F.sum(c).alias(c) for c in stats.columns if c != date_col))


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, counted in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return counts.unpivot([], df.columns, "column_name", "null_count")


def main_stats(df: DataFrame, dataset_name: str) -> DataFrame:
    return df.agg(F.count("*").cast("double").alias("row_count")).select(
        F.lit(dataset_name).alias("dataset_name"), "row_count",
        F.lit(float(len(df.columns))).alias("column_count"))


def file_profile(df: DataFrame, label: str) -> DataFrame:
    """Rows and columns of each source file of a tagged scan."""
    return df.groupBy(label).agg(F.count("*").alias("row_count")).select(
        label, "row_count", F.lit(len(df.columns) - 1).alias("column_count"))


def modal_year(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent year, overall or per group; a tie goes to the earliest."""
    year = F.year(date_col)
    counts = (df.where(F.col(date_col).isNotNull()).groupBy(*by, year.alias("_year"))
              .agg(F.count("*").alias("_n")))
    return counts.groupBy(*by).agg(
        F.max_by("_year", F.struct(F.col("_n"), -F.col("_year"))).alias("modal_year"))
