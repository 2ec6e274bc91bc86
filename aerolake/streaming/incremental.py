"""Incremental ingest of dropped files as a stream that stops when caught up.

The table keeps, beside a row, the identity of the file it came from, and that is
the state which outlives a checkpoint: a batch merges each day it touches with the
stored day, leaving out what the batch's own files have stored before.  So another
source or another checkpoint adds to a day, and a file that comes again adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.config import FlightConfig
from aerolake.functions.encoding import nan_to_null
from aerolake.operators.checks import require_columns
from aerolake.plans import features
from aerolake.schema import FLIGHT
from aerolake.sources import files, sinks, state
from aerolake.sources.tables import read_if_exists, read_parquet

#: The column that holds a row's file in the ingested table.
FILE = "_ingest_file"
IDENTITIES = ("path", "content")


def incremental_ingest(spark: SparkSession, source: str, table: str, checkpoint: str, schema: T.StructType,
                       date_col: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                       max_bytes_per_batch: str | None = None, identity: str = "path",
                       after: Callable[[DataFrame], None] | None = None) -> None:
    """Read every file under ``source`` that the checkpoint does not name, and merge it into ``table``.

    ``identity`` tells when two files are one: by ``"path"`` (a file written anew
    replaces its rows on the days it has), or by ``"content"`` (the same rows in any
    order, for sources that send a file again under another name; two files that
    happen to hold equal rows are then one file too).  Without a ``transform`` a file whose
    content is stored is left out of its batch, and its days are not written again for it.

    A batch is first written as whole merged days beside the table and then moves
    into it by replacing those days.  A run that dies in between is completed by the
    next one from what it had written, whatever its checkpoint.  ``after`` gets the
    merged days of each batch before the batch counts as done, so it may see them twice.
    Rows without a date are kept, under the null day.

    The days a batch touches are rewritten, other days are neither read nor
    written.  One run at a time may write to a table.
    """
    if identity not in IDENTITIES:
        raise ValueError(f"identity must be one of {IDENTITIES}")
    pending = f"{table.rstrip('/')}__pending"

    def publish() -> None:
        days = read_parquet(spark, pending)
        sinks.replace_days(days, table, date_col)
        if after:
            after(days.drop(FILE))
        files.remove(spark, pending)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_identity(batch, identity)
        rows = transform(rows.drop("_source")) if transform else rows.drop("_source")
        stored = read_if_exists(batch.sparkSession, table, rows.schema)
        if identity == "content" and not transform:
            # A stored identity stands for these very rows, and its days were published when they came.
            rows = rows.join(F.broadcast(stored.select(F.col(FILE).alias("_file")).distinct()), F.col(FILE) == F.col("_file"), "left_anti")
        merged = merge_days(rows, stored, date_col)
        if not rows.isEmpty():
            sinks.write_snapshot(merged, pending)
            publish()

    if files.exists(spark, f"{pending}/_SUCCESS"):
        publish()
    reader = spark.readStream.schema(schema)
    if max_bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    (reader.parquet(source).select("*", F.col("_metadata.file_path").alias("_source")).writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def with_identity(batch: DataFrame, identity: str) -> DataFrame:
    """``batch`` with the identity of each row's file (its column ``_source``)."""
    if identity == "path":
        return batch.withColumn(FILE, F.col("_source"))
    row = _row_hash([c for c in batch.columns if c != "_source"])
    prints = batch.groupBy("_source").agg(F.concat_ws(
        ":", F.count(F.lit(1)).cast("string"), F.sum(row.cast("decimal(38,0)")).cast("string"), F.bit_xor(F.xxhash64(row)).cast("string")).alias(FILE))
    return batch.join(F.broadcast(prints), "_source")


def _row_hash(columns: list[str]) -> Column:
    """Of all values, and of which of them are null."""
    return F.xxhash64(*columns, F.concat(*(F.col(c).isNull().cast("int").cast("string") for c in columns)))


def merge_days(rows: DataFrame, stored: DataFrame, date_col: str) -> DataFrame:
    """The days of ``rows`` as they are afterwards: ``rows``, and what other files have stored there.

    Days and files are folders and files that the driver lists anyhow, so they are broadcast and
    no row is shuffled for the joins; the days prune the stored folders.
    """
    days, seen = rows.select(F.col(date_col).alias("_day")).distinct(), rows.select(F.col(FILE).alias("_file")).distinct()
    others = (stored.join(F.broadcast(days), F.col(date_col).eqNullSafe(F.col("_day")), "left_semi")
              .join(F.broadcast(seen), F.col(FILE) == F.col("_file"), "left_anti"))
    return rows.unionByName(others.select(*rows.columns))


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).drop(FILE)


def ingest_features(spark: SparkSession, config: FlightConfig, source: str, checkpoint: str | None = None,
                    max_bytes_per_batch: str | None = None, identity: str = "path") -> None:
    """Collect, clean and accumulate dropped flight files, batch by batch.

    The raw rows are kept by day in ``config.ingested_path``.  Every batch's days
    become the fresh slice whole, are cleaned, and replace those days of the feature
    table; then the watermark moves to the newest day seen.
    """
    def prepare(days: DataFrame) -> None:
        sinks.write_snapshot(nan_to_null(require_columns(days, config.required_columns).select(*config.required_columns)), config.fresh_path)
        features.clean_data(spark, config)
        features.concat_features(spark, config)
        newest = read_parquet(spark, config.fresh_path).agg(F.max(config.date_dk)).first()[0]
        mark = state.get_watermark(spark, config.watermark_path, config.dataset_name)
        if newest and (mark is None or newest > mark):
            state.set_watermark(spark, config.watermark_path, config.dataset_name, newest)

    incremental_ingest(spark, source, config.ingested_path, checkpoint or config.checkpoint_path(source), FLIGHT, config.date_dk,
                       max_bytes_per_batch=max_bytes_per_batch, identity=identity, after=prepare)
