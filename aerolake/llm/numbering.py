"""Gapless numbers in a global order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import stored


def numbered_in_order(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in ``order``.

    Rows are dealt out by ranges, sorted within each, and written with their place;
    a range's numbers begin where the ranges before it end.
    """
    at = F.monotonically_increasing_id()  # the partition above bit 33, the place below
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", at)
    rows = stored(rows, name).withColumn("__part", F.shiftright("__at", 33))
    # One row per partition.
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__start")), f"{name}-starts")
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(starts, "__part").withColumn(name, F.col("__start") + place).drop("__at", "__part", "__start")
