"""Model versions and run metrics.

"Newest of a name" is a ``max_by``: it is combined on the map side, so a name
with very many versions is no hot spot, and nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current_registry(log: DataFrame) -> DataFrame:
    """State of every version: its newest entry in the registry log."""
    state = F.max_by(F.struct("stage", "path"), "change_id")
    return (log.groupBy("name", "version").agg(F.max("change_id").alias("change_id"), state.alias("s"))
            .select("change_id", "name", "version", "s.stage", "s.path"))


def latest_version(registry: DataFrame) -> DataFrame:
    """Newest version of each model name, by number and not by list order."""
    return registry.groupBy("name").agg(
        F.max("version").alias("version"), F.max_by("path", "version").alias("path"))


def promote_versions(registry: DataFrame, winners: DataFrame) -> DataFrame:
    """Move each winner (name, version) to Production and archive the version
    that was there.  Names without a winner keep their stages.

    The join strategy is left to adaptive execution, which knows the real size
    of ``winners`` and splits a skewed name.
    """
    winning = winners.select("name", F.col("version").alias("_winner"))
    stage = (F.when(F.col("version") == F.col("_winner"), "Production")
             .when((F.col("stage") == "Production") & F.col("_winner").isNotNull(), "Archived")
             .otherwise(F.col("stage")))
    return registry.join(winning, "name", "left").withColumn("stage", stage).drop("_winner").select(
        *registry.columns)


def latest_run(runs: DataFrame) -> DataFrame:
    """Newest run of each experiment (equal start times: the highest run id)."""
    order = F.struct("start_time", "run_id")
    return runs.groupBy("experiment").agg(F.max_by(F.struct(*runs.columns), order).alias("r")).select("r.*")


def metrics_long(runs: DataFrame) -> DataFrame:
    """One row per run and metric."""
    kept = [c for c in runs.columns if c != "metrics"]
    return runs.select(*kept, F.explode("metrics").alias("metric_name", "value"))
