"""Row selection: date slices, target filter, splits, modal year, caps, samples."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.functions.draws import add_draw
from aerolake.operators.profile import modal_year

#: Copies of a row that one task writes out.
COPIES_AT_ONCE = 1 << 16


def date_slice(df: DataFrame, date_col: str, start: dt.date, end: dt.date,
               year_col: str | None = None) -> DataFrame:
    """Rows with ``start <= date <= end``, both ends included.

    The bounds are typed date literals, so the range reaches the parquet scan;
    ``year_col`` adds the matching range on a year partition column.
    """
    keep = F.col(date_col).between(F.lit(start), F.lit(end))
    if year_col:
        keep = keep & F.col(year_col).between(start.year, end.year)
    return df.where(keep)


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """Rows with a target; written as ``IS NOT NULL``, which the scan can use."""
    return df.where(F.col(target).isNotNull())


def split_bound(as_of: dt.date, val_days: int) -> dt.date:
    return as_of - dt.timedelta(days=val_days)


def time_split(df: DataFrame, date_col: str, bound: dt.date) -> tuple[DataFrame, DataFrame]:
    """(rows before ``bound``, rows from ``bound`` on); null dates are in neither."""
    is_validation = F.col(date_col) >= F.lit(bound)
    return df.where(~is_validation), df.where(is_validation)


def modal_year_rows(df: DataFrame, date_col: str) -> DataFrame:
    """Rows whose year is the most frequent one (tie: the earliest).

    The year is a one-value scalar subquery, written as a date range so that
    the scan can skip row groups of other years.
    """
    year = modal_year(df, date_col).select("modal_year")
    first = year.select(F.make_date("modal_year", F.lit(1), F.lit(1))).scalar()
    last = year.select(F.make_date("modal_year", F.lit(12), F.lit(31))).scalar()
    return df.where(F.col(date_col).between(first, last))


def newest_cutoff(counts: DataFrame, date_col: str, cap: int) -> DataFrame:
    """Where a newest-first cap of ``cap`` rows falls, as one row.

    ``counts`` has the number of rows ``n`` of each day; days may be in several
    parts.  ``cut_day`` is the oldest day that is touched, ``rows_after`` the rows of
    the newer days, ``rows_on_day`` how many of ``cut_day`` still fit.  The window
    sees one row per calendar day.
    """
    newest_first = Window.orderBy(F.desc(date_col))
    days = (counts.where(F.col(date_col).isNotNull()).groupBy(date_col).agg(F.sum("n").alias("n"))
            .withColumn("upto", F.sum("n").over(newest_first)))
    touched = days.where(F.col("upto") - F.col("n") < cap)
    return touched.agg(
        F.min(date_col).alias("cut_day"),
        F.coalesce(F.min_by(F.col("upto") - F.col("n"), date_col), F.lit(0)).alias("rows_after"),
        F.coalesce(F.least(F.min_by("n", date_col), F.lit(cap) - F.min_by(F.col("upto") - F.col("n"), date_col)),
                   F.lit(0)).alias("rows_on_day"),
    )


def cap_newest(df: DataFrame, date_col: str, cap: int, seed: int = 42, counts: DataFrame | None = None) -> DataFrame:
    """The newest ``cap`` dated rows; which rows of the cut day stay is set by
    their content, so a second evaluation gives the same rows.

    Whole days are kept by a filter; only the cut day is sampled.  ``counts`` are
    the rows of each day (the date and ``n``), if they are known from the writing of
    the table: then only the days that are kept are read.  Without them one aggregate
    counts the days.
    """
    if counts is None:
        counts = df.groupBy(date_col).agg(F.count("*").alias("n"))
    cut = newest_cutoff(counts, date_col, cap).first()
    newer = df.where(F.col(date_col) > F.lit(cut.cut_day))
    on_day = df.where(F.col(date_col) == F.lit(cut.cut_day))
    return newer.unionByName(sample_exact(on_day, cut.rows_on_day, seed=seed))


def sample_exact(df: DataFrame, n: int, key: str | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows if there are fewer).

    Every row has a 32-bit draw from its key (or, without a key, from its whole
    content), and the ``n`` smallest draws are kept.  Their limit is found from
    two 65,536-bucket counts, so no task ever sorts or holds the sample: below
    the limit it is a plain filter, and only rows that share the very limit
    value are looked at one by one.
    """
    draw = "_draw"
    columns = df.columns
    source = F.col(key) if key else F.xxhash64(*columns)
    drawn = add_draw(df, source, draw, seed)
    high, low = F.shiftright(draw, 16), F.col(draw).bitwiseAND(F.lit(0xFFFF))

    bucket = _limit_bucket(drawn, high, n)
    if bucket is None:
        return df
    inside = drawn.where(high == bucket.bucket)
    value = _limit_bucket(inside, low, n - bucket.before)
    limit = (bucket.bucket << 16) | value.bucket
    if value.upto == n - bucket.before:
        return drawn.where(F.col(draw) <= limit).select(*columns)
    below = drawn.where(F.col(draw) < limit).select(*columns)
    tied = drawn.where(F.col(draw) == limit).select(*columns)
    missing = n - bucket.before - value.before
    if key:
        return below.unionByName(sample_exact(tied, missing, seed=seed + 1))
    return below.unionByName(_take_copies(tied, missing))


def _limit_bucket(df: DataFrame, bucket: Column, n: int):
    """The bucket in which the ``n``-th row falls, with the number of rows before
    its first row and up to its last."""
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    running = counts.withColumn("upto", F.sum("n").over(Window.orderBy("bucket")))
    return (running.where(F.col("upto") >= n)
            .agg(F.min("bucket").alias("bucket"), F.min(F.col("upto") - F.col("n")).alias("before"),
                 F.min("upto").alias("upto"))
            .where("bucket IS NOT NULL").first())


def _take_copies(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows out of rows with one content hash: copies of (almost always)
    one row.  Copies are counted, not moved."""
    order = Window.orderBy(*df.columns)
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(order) - F.col("_n")
    taken = copies.withColumn("_take", F.least(F.col("_n"), F.lit(n) - before)).where("_take > 0")
    # One row may be copied very often: the copies are dealt out in parts before they are written out.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_take") - 1) / COPIES_AT_ONCE)))
    parts = taken.withColumn("_part", part).hint("rebalance")
    size = F.least(F.lit(COPIES_AT_ONCE), F.col("_take") - F.col("_part") * COPIES_AT_ONCE)
    return parts.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size.cast("long")))).select(*df.columns)
