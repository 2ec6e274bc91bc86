"""Mixing sources to target weights, in DataFrame operations only.

Sizes are added up per source, a target is set per source, and its rate of
repetition is target / size.  A document is emitted floor(rate) times, plus once
more when its own hash-seeded draw lies below the fraction.

Defined results: documents without a source form one source, the last; a source
of size 0 has target 0 and its documents are not emitted; rows with the same key
share one draw, so repeated rows are taken alike; a null key is one key.
Columns of ``docs`` whose names begin with ``__mix_`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import hex_fraction, stored

#: Sources in order of their names weigh this, repeating.
WEIGHTS = (5, 2, 1)
SHARE, CEILING = 1.5, 2.0

WORDS = r"[^\x20\x09-\x0D]+"


def count_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source: str, size: str, weights=WEIGHTS, share=SHARE, ceiling=CEILING) -> DataFrame:
    """One row per source: its size and target.

    Targets follow the weights but stop at ``ceiling`` times the source's size; the
    excess goes to the others by weight until none is above.  That is one level L
    with target = min(ceiling * size, L * weight): in order of ceiling * size /
    weight, sources are full as long as the level left for the rest reaches them.
    """
    total = sized.groupBy(F.col(source).alias("__mix_source")).agg(F.sum(size).cast("long").alias("__mix_size"))
    # The windows run over one row per source.
    by_name = Window.orderBy(F.col("__mix_source").isNull(), "__mix_source")
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    rows = total.withColumn("w", weight).withColumn("cap", ceiling * F.col("__mix_size"))
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("__mix_source").isNull(), "__mix_source")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(filling.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (share * F.sum("__mix_size").over(everything) - before) / rest)
    rows = rows.withColumn("open", F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("cap") / F.col("w")))
    first_open = F.min_by(F.when(F.col("open").isNotNull(), F.col("level")), "open").over(everything)
    target = F.coalesce(F.least("cap", first_open * F.col("w")), F.col("cap"))
    return rows.select("__mix_source", "__mix_size", target.alias("__mix_target"))


def with_copies(docs: DataFrame, key: str, source: str, size: str, seed: str = "mix", **rule) -> DataFrame:
    """``docs`` with __mix_size, __mix_target (of the source) and __mix_copies (times the document is taken)."""
    docs = docs.drop("__mix_source", "__mix_size", "__mix_target", "__mix_copies")
    # Written, so that Spark knows its size when it picks the join.
    targets = stored(source_targets(docs, source, size, **rule), "mix-targets")
    joined = docs.join(targets, F.col(source).eqNullSafe(F.col("__mix_source")), "left").drop("__mix_source")
    rate = F.when(F.col("__mix_size") > 0, F.col("__mix_target") / F.col("__mix_size")).otherwise(F.lit(0.0))
    draw = hex_fraction(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return joined.withColumn("__mix_copies", F.floor(rate).cast("int") + (draw < rate - F.floor(rate)).cast("int"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mix", **rule) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as it is taken."""
    sized = docs.withColumn("__mix_words", count_words(F.col(text)))
    taken = with_copies(sized, key, source, "__mix_words", seed, **rule).where("__mix_copies > 0")
    return taken.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
