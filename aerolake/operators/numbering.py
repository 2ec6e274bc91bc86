"""Gapless numbers in an order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.sources.workspace import shared_folder


def numbered(df: DataFrame, order: Sequence[Column], out: str, within: str) -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... in ``order`` within each value of ``within``.

    Rows are dealt out by ranges of (within, order) and written with their place; a
    range's numbers begin where those of the same group in the ranges before it end.
    """
    spark, by = df.sparkSession, [F.col(within).asc(), *order]
    at = F.monotonically_increasing_id()  # the partition above bit 33, the place below
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", at)
    folder = shared_folder(spark, "numbered")
    rows.write.parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder).withColumn("_part", F.shiftright("_at", 33))
    # One row per group and range: a range holds one group, or whole ones and the ends of two.
    sizes = rows.groupBy(within, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col(within).alias("_group"), F.col("_part").alias("_of"), "_first", F.coalesce(before, F.lit(0)).alias("_start"))
    joined = rows.join(starts, (F.col(within) == F.col("_group")) & (F.col("_part") == F.col("_of")))
    return joined.withColumn(out, F.col("_start") + F.col("_at") - F.col("_first")).select(*df.columns, out)
