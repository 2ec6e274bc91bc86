"""Sinks: parquet snapshots, day and year partitions, CSV, stats tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.sources.tables import read_parquet


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_days(df: DataFrame, path: str, date_col: str) -> None:
    """Replace every day that occurs in ``df``; other days stay as they are.

    Running it twice gives the same table.  Only the delta is written, never
    the whole table.  The rebalance puts a day's rows together so that a day
    gets few files, and lets adaptive execution split a day that is too big for
    one task.
    """
    (df.hint("rebalance", F.col(date_col)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path))


def append_days(df: DataFrame, path: str, date_col: str) -> None:
    """Plain UNION ALL accumulation: a day that is ingested twice is kept twice."""
    df.hint("rebalance", F.col(date_col)).write.mode("append").partitionBy(date_col).parquet(path)


def write_by_year(df: DataFrame, path: str, date_col: str, year_col: str = "year") -> None:
    """One folder per calendar year; a year that is written again is replaced.

    No shuffle: the rows come from files that hold about one year each, so a
    task opens few output files.
    """
    (df.withColumn(year_col, F.year(date_col)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(year_col).parquet(path))


def write_csv(df: DataFrame, path: str, vectors: str = "json") -> None:
    """Headed CSV.  Vector columns become JSON arrays, or go (``vectors="drop"``)."""
    vector_cols = [f.name for f in df.schema if isinstance(f.dataType, VectorUDT)]
    if vectors == "drop":
        df = df.drop(*vector_cols)
    else:
        for c in vector_cols:
            df = df.withColumn(c, F.to_json(vector_to_array(c)))
    df.write.mode("overwrite").option("header", True).csv(path)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def append_with_id(batch: DataFrame, path: str, schema: T.StructType, id_col: str = "data_id") -> None:
    """Append stats rows, numbering them after the highest stored id.

    Ids are unique and rising but may have gaps, as a database sequence's may;
    that needs no window over the batch.  Columns are matched by name and a
    null in a required column stops the write.
    """
    spark = batch.sparkSession
    create_if_absent(spark, path, schema)
    last = read_parquet(spark, path).agg(F.max(id_col)).first()[0] or 0
    numbered = batch.withColumn(id_col, F.lit(last + 1) + F.monotonically_increasing_id())
    _checked(numbered, schema).write.mode("append").parquet(path)


def append_jdbc(batch: DataFrame, url: str, table: str, schema: T.StructType,
                properties: dict[str, str] | None = None, id_col: str = "data_id") -> None:
    """The same append for a database table whose id is a serial column."""
    columns = T.StructType([f for f in schema if f.name != id_col])
    _checked(batch, columns).write.jdbc(url, table, mode="append", properties=properties)


def _checked(df: DataFrame, schema: T.StructType) -> DataFrame:
    def column(f: T.StructField):
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(f"{f.name} must not be null").cast(f.dataType))
        return value.alias(f.name)

    return df.select(*(column(f) for f in schema))
