"""The pipeline's stages, each against plain Python on its own input."""

import binascii
import glob

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from aerolake.llm import mixing
from test_operators import DOCS, brute_hits, near, roots, shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).persist()
        found.append(docs)
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(outputs):
    assert all(df.columns == outputs[0].columns for df in outputs[1:-1])


def test_language_stage_keeps_clean_documents(outputs):
    gone = outputs[0].join(outputs[1].select("doc_id"), "doc_id", "left_anti").collect()
    assert sum(len((r.text or "").split()) > 20 for r in gone) <= outputs[0].count() // 100


def test_one_document_of_every_group_stays(outputs):
    sets = {i: shingles(t, 5) for i, t in texts(outputs[1]).items()}
    group = roots(sets, near(sets, 80))
    assert set(texts(outputs[2])) == set(group.values())


def test_contaminated_documents_go(spark, outputs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(texts(outputs[3])) == {i for i, t in texts(outputs[2]).items() if not brute_hits(t, items)[1]}


def test_mix_and_tokens(outputs):
    sized = outputs[3].withColumn("size", mixing.count_words(F.col("text")))
    want = {r.doc_id: r["__mix_copies"] for r in mixing.with_copies(sized, "doc_id", "source", "size").collect()}
    copies = {}
    for r in outputs[4].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert copies == {i: n for i, n in want.items() if n}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    source = texts(outputs[4])
    found = sorted(outputs[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted(i for i, n in copies.items() for _ in range(n))
    for r in found:
        ids = np.array(tokenizer.encode(source[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), binascii.crc32(ids.tobytes()))
        start += len(ids)


def test_encoded_texts_are_deleted_once_written(spark):
    docs = spark.createDataFrame([(1, "one text", "en", "a", 0), (2, None, "en", "a", 0)], DOCS)
    written = f"{spark.conf.get('spark.checkpoint.dir')}/*/token-ids-*"
    before = set(glob.glob(written))
    found = corpus_pipeline.write_tokens(spark, docs, SF)
    assert set(glob.glob(written)) <= before
    assert [r.doc_id for r in found.orderBy("start").collect()] == [1, 2]


def test_edge_cases(spark):
    words = " ".join(f"term{i}" for i in range(40))
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (3, words, "en", "a", 0), (3, words, "en", "a", 0),
                                  (None, words, "de", None, 0)], DOCS)
    for given in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, given, SF).collect()
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).orderBy("doc_id").collect()] == [1, 2, 3]


#: Names that the stages or the operators use themselves.
CLASH = ["score", "lang_pred", "rejected", "__row", "row", "doc", "__key", "__hash", "__text", "__mix_words", "__mix_copies", "__mix_source",
         "key", "n", "cid", "component_id", "group"]


def test_user_columns_come_through_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASH])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns
        rows = found.collect()
        assert rows and all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in CLASH)
    assert corpus_pipeline.write_tokens(spark, docs, SF).count() == docs.count()
