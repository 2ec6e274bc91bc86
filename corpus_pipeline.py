"""The training-data pipeline: five stages over ``documents``, each written and read by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import decontamination, jaccard, language, mixing, token_files
from aerolake.llm.common import discard, release, stored, table
from aerolake.sources.workspace import shared_folder


def _held(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc``, the whole row, beside the columns that an operator works on: so no name of the operator's meets one of the row's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; narrow and letterless ones go.

    The dictionaries are learnt from the documents' own labels, and the text alone decides.
    """
    found = language.identify(_held(docs, "text"), language.learn_dictionaries(docs))
    return found.where(~F.col("rejected")).select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked ones: that with the least doc_id; a text repeated under it stays once.

    Documents without a shingle have no links and stay.
    """
    rows = stored(_held(docs).withColumn("row", F.monotonically_increasing_id()), "numbered-documents", "zstd")
    texts = rows.select("row", F.col("doc.text").alias("text"))
    linked = jaccard.join(texts, key="row", text="text", width=5, percent=80).select("row", F.col("component_id").alias("group"))
    ids = rows.select("row", F.col("doc.doc_id").alias("doc_id")).join(linked, "row")
    # Null ids come last; equal ids are told apart by the row.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = ids.groupBy("group").agg(first).select(F.col("first.row").alias("row"))
    # One bit a row, 64 rows a word: small enough to go to the rows, which then need not move.
    bit = F.expr("shiftleft(1L, CAST(row & 63 AS INT))")
    words = stored(kept.groupBy(F.shiftright("row", 6).alias("word")).agg(F.bit_or(bit).alias("bits")), "kept-rows")
    return rows.join(F.broadcast(words), (F.shiftright("row", 6) == F.col("word")) & (F.col("bits").bitwiseAND(bit) != 0), "left_semi").select("doc.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontamination.find_contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = found.where(F.size("spans") > 0).select(F.col("doc_id").alias("key"), F.col("text_hash").alias("hash")).distinct()
    same = F.col("doc.doc_id").eqNullSafe(F.col("key")) & (F.xxhash64("doc.text") == F.col("hash"))
    return _held(docs).join(hit, same, "left_anti").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the mix takes it."""
    return mixing.mix(_held(docs, "doc_id", "source", "text")).select("doc.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row per copy of a document."""
    folder = shared_folder(spark, "pipeline-tokens")
    encoded = token_files.encode(docs)
    index = token_files.write_files(encoded, folder)
    # The files have all that is in them.
    discard(encoded)
    release(spark)
    return token_files.read_files(index, folder).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: Compression and tokenizing have no SQL form; a test compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; one row per emitted document: doc_id, start, n_tokens, ids_crc32."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
