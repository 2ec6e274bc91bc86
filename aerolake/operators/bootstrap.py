"""Bootstrap comparison of predictions, and the test that decides on it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.draws import block_salt, block_totals, resample_weights

#: Rows of a block, unless that made more than ``MAX_BLOCKS`` blocks; rows x replicates of a task.
BLOCK_ROWS, MAX_BLOCKS, TASK_DRAWS = 1 << 17, 1 << 16, 1 << 27
#: Weights held at a time in a task.
WEIGHTS_AT_ONCE = 1 << 20


def bootstrap_r2(df: DataFrame, key: Column, label: str, predictions: Mapping[str, str],
                 replicates: int = 3000, seed: int = 42, blocks: int | None = None) -> DataFrame:
    """R2 of every prediction column on every resample: (replicate, model, r2).

    A resample draws exactly as many rows as there are, with replacement, and all
    models see the same ones.  The rows fall into blocks by a hash of their key.  How
    many draws fall into a block is settled by a tree of binomial splits that every
    task can follow for itself; within the block, draw after draw picks a row by its
    place in key order.  So no draw is ever sent anywhere, a lost task draws the same
    rows again, and the result does not depend on the layout (a row is picked with
    its share of the block's draws to within block rows / 2**32).

    R2 needs only weighted sums: each task turns its block and its replicates into
    a row of sums per replicate (numpy), and only those are shuffled.  Few rows are
    many draws, so a block is given to several tasks, each with a part of the replicates.
    """
    y = F.col(label).cast("double")
    models = list(predictions)
    complete = reduce(Column.__and__, (F.col(c).isNotNull() for c in [label, *predictions.values()]))
    n, n_complete, mean = df.agg(F.count(F.lit(1)), F.count_if(complete), F.avg(y)).first()
    if n != n_complete:
        raise ValueError(f"{n - n_complete} rows without a label or prediction")
    # Squares of a target far from zero would cancel; R2 does not depend on its mean.
    centred = y - F.lit(mean or 0.0)
    errors = [(y - F.col(predictions[m])) for m in models]
    blocks = blocks or min(MAX_BLOCKS, max(1, -(-n // BLOCK_ROWS)))
    sums = ["n", "sy", "syy", *(f"se{i}" for i in range(len(models)))]
    rows = df.select(key.cast("long").alias("key"), centred.alias("y"), (centred * centred).alias("yy"),
                     *((e * e).alias(f"se{i}") for i, e in enumerate(errors)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
    sizes = [n]
    if blocks > 1:
        sizes = [0] * blocks
        for r in rows.groupBy("block").count().collect():  # MAX_BLOCKS at most
            sizes[r["block"]] = r["count"]
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(replicates, max(1, -(-cores // blocks), -(-max(sizes) * replicates // TASK_DRAWS)))
    # A partition is a block and a part of the replicates.
    spread = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    spread = spread.repartitionById(blocks * parts, F.col("block") * parts + F.col("part"))
    partial = spread.mapInArrow(_weighted_sums(sizes, replicates, parts, seed, sums),
                                "replicate int, " + ", ".join(f"{c} double" for c in sums))
    totals = partial.groupBy("replicate").agg(*(F.sum(c).alias(c) for c in sums))
    spread = F.col("syy") - F.col("sy") * F.col("sy") / F.nullif(F.col("n"), F.lit(0.0))
    return totals.select("replicate", F.explode(F.array(*(
        F.struct(F.lit(m).alias("model"), (1 - F.try_divide(F.col(f"se{i}"), spread)).alias("r2"))
        for i, m in enumerate(models)))).alias("m")).select("replicate", "m.model", "m.r2")


def _weighted_sums(sizes: list[int], replicates: int, parts: int, seed: int, names: list[str]):
    """Task body: sums of weight and weight x column of a block, for its part of the replicates."""

    def fold(batches):
        import numpy as np
        import pyarrow as pa

        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        columns = {name: table.column(name).to_numpy() for name in table.column_names}
        block, part = int(columns.pop("block")[0]), int(columns.pop("part")[0])
        # Places in the order of the key; rows of one key by their values.
        order = np.lexsort([columns[c] for c in reversed(list(columns))])
        values = np.column_stack([np.ones(len(order)), *(columns[c][order] for c in columns if c != "key")])
        mine = range(replicates * part // parts, replicates * (part + 1) // parts)
        totals = block_totals(sizes, block, replicates, seed)
        step = max(1, WEIGHTS_AT_ONCE // len(order))
        for at in range(mine.start, mine.stop, step):
            chosen = range(at, min(at + step, mine.stop))
            weights = resample_weights(len(order), totals[chosen.start:chosen.stop], [block_salt(seed, r, block) for r in chosen])
            found = weights @ values
            yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.int32()), *map(pa.array, found.T.copy())], names=["replicate", *names])

    return fold


def bootstrap_summary(replicate_r2: DataFrame) -> DataFrame:
    """Count, mean and sample variance of the replicate values of each model."""
    return replicate_r2.groupBy("model").agg(
        F.count("r2").alias("n"), F.mean("r2").alias("mean_r2"), F.var_samp("r2").alias("var_r2"))


def t_test(summary: DataFrame, first: str, second: str) -> DataFrame:
    """Pooled two-sample t-test of "mean of ``first`` is below mean of ``second``".

    One row: t_stat, df, p_value.
    """
    row = summary.agg(*(F.max(F.when(F.col("model") == model, F.col(col))).alias(f"{col}_{side}")
                        for side, model in (("a", first), ("b", second))
                        for col in ("n", "mean_r2", "var_r2")))
    return _tested(row).select("t_stat", "df", "p_value")


def _tested(row: DataFrame) -> DataFrame:
    """Add t_stat, df and p_value to a row with n, mean_r2 and var_r2 of a and b."""
    n_a, n_b = F.col("n_a"), F.col("n_b")
    pooled = ((n_a - 1) * F.col("var_r2_a") + (n_b - 1) * F.col("var_r2_b")) / (n_a + n_b - 2)
    t = F.try_divide(F.col("mean_r2_a") - F.col("mean_r2_b"), F.sqrt(pooled * (1 / n_a + 1 / n_b)))
    return (row.withColumn("t_stat", t).withColumn("df", (n_a + n_b - 2).cast("int"))
            .withColumn("p_value", student_t_below(F.col("t_stat"), F.col("df"))))


def student_t_below(t: Column, df: Column) -> Column:
    """P(T <= t) for whole degrees of freedom, by the finite trigonometric series
    (one for even, one for odd degrees of freedom)."""
    angle = F.atan(t / F.sqrt(df.cast("double")))
    cos2 = F.cos(angle) * F.cos(angle)
    odd = df % 2
    # Terms after the leading 1: each is the one before times (2j-1)/(2j) * cos2
    # for even df and (2j)/(2j+1) * cos2 for odd df.
    terms = F.when(odd == 0, df / 2 - 1).otherwise((df - 3) / 2).cast("int")
    steps = F.when(terms > 0, F.sequence(F.lit(1), F.greatest(terms, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    start = F.struct(F.lit(1.0).alias("total"), F.lit(1.0).alias("term"))

    def add(acc: Column, j: Column) -> Column:
        ratio = (2 * j - 1 + odd).cast("double") / (2 * j + odd).cast("double")
        term = acc["term"] * ratio * cos2
        return F.struct((acc["total"] + term).alias("total"), term.alias("term"))

    series = F.aggregate(steps, start, add, lambda acc: acc["total"])
    even = 0.5 + 0.5 * F.sin(angle) * series
    other = 0.5 + (angle + F.when(df > 1, F.sin(angle) * F.cos(angle) * series).otherwise(0.0)) / F.pi()
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(odd == 0, even).otherwise(other)))


def promotion_decision(replicate_r2: DataFrame, champion: str, challenger: str,
                       significance: float = 0.05) -> DataFrame:
    """One row: the test, the decision, and the 5% / 95% points of the paired
    difference challenger minus champion (both saw the same resamples).

    The resamples are computed once and folded in one aggregate.  Without any
    spread in the replicates there is no test, and the decision is no.
    """
    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("r2")))

    paired = replicate_r2.groupBy("replicate").agg(of(champion).alias("a"), of(challenger).alias("b"))
    difference = F.col("b") - F.col("a")
    row = paired.agg(
        *(column for side in "ab" for column in (
            F.count(side).alias(f"n_{side}"), F.mean(side).alias(f"mean_r2_{side}"),
            F.var_samp(side).alias(f"var_r2_{side}"))),
        F.percentile(difference, F.lit(0.05)).alias("diff_p05"),
        F.percentile(difference, F.lit(0.95)).alias("diff_p95"))
    return _tested(row).select(
        "t_stat", "df", "p_value",
        F.coalesce(F.col("p_value") < significance, F.lit(False)).alias("promote"), "diff_p05", "diff_p95")
