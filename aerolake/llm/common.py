"""Small helpers shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.sources import files
from aerolake.sources.workspace import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and survives lost executors."""
    folder = shared_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out.stored_folder = folder
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`stored` returned and that all their readers have finished with."""
    for df in tables:
        files.remove(df.sparkSession, df.stored_folder)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    It does so when the driver collects the plans that used them as garbage, which a
    driver with little to do may put off to the end of a long job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What runs inside hands whole texts to Python ``rows`` at a time at most, instead of 10,000.

    A batch is held by the JVM (in buffers that grow by doubling) and by Python at once.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def as_uri(folder: str) -> str:
    """An absolute path or URI in the form pyarrow's file systems accept."""
    if folder.startswith("file:"):
        return "/" + folder[len("file:"):].lstrip("/")
    return folder


def hex_fraction(text: Column) -> Column:
    """A draw in [0, 1) fixed by ``text``: the first 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
