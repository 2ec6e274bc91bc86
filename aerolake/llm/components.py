"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import discard, release, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the node's least neighbour (or the node)."""
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least"))
    joined = both.join(least, "high").where("low > high")
    return joined.select(F.col("low").alias("high"), F.least("high", "least").alias("low")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are linked to the least of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    joined = links.join(least, "high").where("low > least")
    return (joined.select(F.col("low").alias("high"), F.col("least").alias("low"))
            .unionByName(least.select("high", F.col("least").alias("low"))).distinct())


def _mark(links: DataFrame) -> tuple:
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; the component is its least node.

    Each pass is a few joins and sums over the links and is written; a hub's links
    are one row each, so adaptive execution can split them. What a pass leaves in the
    driver's memory goes before the next one.
    """
    links = stored(links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high > low").distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        read, links = links, stored(_small_star(_large_star(links)), "links")
        discard(read)
        release(links.sparkSession)
        before, mark = mark, _mark(links)
        if before == mark:
            break
    found = stored(links.select(F.col("high").alias("node"), F.col("low").alias("component"))
                   .unionByName(links.select(F.col("low").alias("node"), F.col("low").alias("component"))).distinct(), "components")
    discard(links)
    return found
