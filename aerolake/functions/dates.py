"""Date columns: weekday indicators, parsing, shifting and run bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEKDAYS = range(1, 8)


def weekday_flags(date_col: str = "FL_DATE") -> list[Column]:
    """Seven 0/1 columns; day 1 is Sunday and day 7 Saturday.

    A null date gives seven nulls.
    """
    return [(F.dayofweek(date_col) == k).cast("int").alias(f"flight_weekday_{k}") for k in WEEKDAYS]


def weekday_flags_serving(date_col: str = "FL_DATE") -> list[Column]:
    """The variant found in old scoring files: Monday is 0, Sunday 6.

    Compared with 1..7, so Monday sets no flag and flag 7 never fires.  Models
    trained on :func:`weekday_flags` must not be fed with it; it is here to
    reproduce old score files.  A null date sets no flag.
    """
    return [F.coalesce((F.weekday(date_col) == k).cast("int"), F.lit(0)).alias(f"flight_weekday_{k}")
            for k in WEEKDAYS]


def add_weekday_flags(df: DataFrame, date_col: str = "FL_DATE") -> DataFrame:
    return df.select("*", *weekday_flags(date_col))


def parse_date(col: str, fmt: str | None = None, strict: bool = True) -> Column:
    """Text to date; ``strict=False`` turns unreadable text into null."""
    if strict:
        return F.to_date(col, fmt) if fmt else F.to_date(col)
    return F.try_to_date(F.col(col), fmt) if fmt else F.try_to_date(F.col(col))


def shift_days(col: str, days: int) -> Column:
    """Calendar-day shift (365 * 5 is 1,825 days and not five calendar years)."""
    return F.date_add(F.col(col), days)


def first_run_lower_bound(as_of: dt.date, max_history_days: int) -> dt.date:
    return as_of - dt.timedelta(days=max_history_days)
