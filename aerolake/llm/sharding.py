"""Sharding by rendezvous hashing over weighted shards.

Every shard draws a score for a key from a hash of key and shard, scaled by the
shard's weight, and the highest score wins.  A new shard can only take keys for
itself, and a removed one gives up only its own.

Defined results: a null key is the key ``null``; rows with equal keys share a
shard; an empty table gives empty shards.  Only the key and the shards decide,
so repeated rows stay together and are numbered one after the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import hex_fraction, stored

#: A shard's rows are numbered in this many independent pieces.
NUMBERING_BUCKETS = 4096


def _key(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to len(weights) - 1, with the highest score -weight / ln(draw)."""
    if not weights or min(weights) <= 0:
        raise ValueError("Every shard needs a weight above 0")

    def score(shard: int) -> Column:
        draw = hex_fraction(F.concat_ws(":", _key(key), F.lit(str(shard)))) + F.lit(2.0 ** -53)
        return F.struct((F.lit(-float(weights[shard])) / F.log(draw)).alias("score"), F.lit(-shard).alias("minus"))

    return -F.array_max(F.array(*[score(i) for i in range(len(weights))]))["minus"]


def numbering_bucket(key: Column) -> Column:
    return F.conv(F.substring(F.md5(_key(key)), 1, 3), 16, 10).cast("int")


def with_slots(assigned: DataFrame, key: str, shard: str = "shard", ties: Sequence[str] = ()) -> DataFrame:
    """``assigned`` with ``slot``: gapless from 0 within each shard, in order of bucket, key and ``ties``.

    Rows are numbered within (shard, bucket), and a bucket starts where the ones
    before it end, so no task holds a shard.
    """
    rows = stored(assigned.drop("slot").withColumn("__bucket", numbering_bucket(F.col(key))), "shards")
    order = Window.partitionBy(shard).orderBy("__bucket")
    starts = (rows.groupBy(shard, "__bucket").agg(F.count(F.lit(1)).alias("__n"))  # NUMBERING_BUCKETS rows a shard
              .withColumn("__start", F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("__n"))
    within = F.row_number().over(Window.partitionBy(shard, "__bucket").orderBy(key, *ties)) - 1
    numbered = rows.withColumn("__within", within).join(starts, [shard, "__bucket"])
    return numbered.withColumn("slot", (F.col("__start") + F.col("__within")).cast("long")).drop("__bucket", "__within", "__start")


def write_shards(docs: DataFrame, path: str, key: str, weights: Sequence[float]) -> None:
    """Write ``docs`` as one folder per shard, each spread over as many files as it needs."""
    assigned = docs.withColumn("shard", shard_of(F.col(key), weights))
    assigned.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
