"""The registered query of every operator, next to its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import collocations, decontamination, embeddings, extraction, hard_negatives, jaccard, language, mixing, quality, sharding, token_counts, token_files, warc
from aerolake.llm.common import stored, table
from aerolake.sources.workspace import shared_folder


def _remainder(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3, F.lit(0))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = _remainder(F.col("doc_id")) == 1
    learnt = language.learn_dictionaries(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), learnt).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = stored(table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.count_words(F.col("text")).alias("size")), "mix-sizes")
    return mixing.with_copies(sized, "doc_id", "source", "size").select(
        "doc_id", "size", F.col("__mix_size").alias("source_size"), F.col("__mix_target").alias("target"),
        (F.col("__mix_copies") * F.col("size")).alias("taken"))


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2.0 * source_size AS cap, [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source IS NULL, source)) - 1) % 3] AS w
  FROM total),
levels AS (
  SELECT *, cap / w AS ratio,
    (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY cap / w, source IS NULL, source)),
targets AS (
  SELECT source, source_size,
    coalesce(least(cap, (SELECT arg_min(level, ratio) FROM levels WHERE ratio > level) * w), cap)::DOUBLE AS target FROM levels),
rates AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rates
"""

def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder, with_payload=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digests AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM payloads),
firsts AS (SELECT hex, min(page_id) AS first_id FROM digests GROUP BY hex)
SELECT page_id, payload_bytes,
  translate(array_to_string([lpad(to_base(('0x' || substr(hex, 1 + 5 * i, 5))::BIGINT, 32), 4, '0') FOR i IN range(8)], ''),
            '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM digests JOIN firsts USING (hex)
"""

SHARDS = 8


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    assigned = docs.select(
        "*", F.lit("key").alias("law"), sharding.shard_of(F.col("doc_id"), [1.0] * SHARDS).alias("shard"),
        sharding.shard_of(F.col("doc_id"), [1.0] * (SHARDS + 1)).alias("grown_shard"))
    return sharding.with_slots(assigned, "doc_id", ties=["text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


#: Without text_crc32, which DuckDB has no function for; a test compares it.
SHARDING_SQL = None

def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    counted = found.withColumn("n_hit", decontamination.covered(F.col("spans")))
    return counted.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                          F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


DECONTAMINATION_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::VARCHAR[]) AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM item_words, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(i) WHERE len(w) > 0),
grams AS (
  SELECT doc_id, s.size, i, array_to_string(w[i:i + s.size - 1], ' ') AS gram
  FROM doc_words, (SELECT DISTINCT size FROM windows) s, unnest(range(1, len(w) - s.size + 2)) AS u(i)),
matches AS (SELECT doc_id, item_id, i, g.size FROM grams g JOIN windows x ON g.size = x.size AND g.gram = x.gram),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM matches, unnest(range(i, i + size)) AS u(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM matches WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS gram FROM words, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(i)
  WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM grams GROUP BY doc_id),
commons AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM commons JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, d.component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) d LEFT JOIN sizes s USING (doc_id)
"""


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.join(table(spark, sf_dir, "embeddings"))


EMBEDDING_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
edges AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, e.y FROM reach r JOIN edges e ON r.other = e.x),
named AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT x, count(*) AS n FROM edges GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN counted ON x = vec_id
"""


def op9_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    index = token_files.write_files(token_files.encode(table(spark, sf_dir, "documents")), folder)
    return token_files.read_files(index, folder).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), rule="majority").select(
        F.col("key").alias("doc_id"), "section", "start_char", "end_char", F.col("tokens").cast("long").alias("n_tokens"), "n_crossing")


QUALITY_THRESHOLD = 0.3


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    def held_out(doc_id):
        return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(1)) == 0

    rows = quality.described(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    model = quality.learn(rows, labels.where("quality = 1"))
    return quality.score(rows, model).select(
        F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
f AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*)::BIGINT AS f
  FROM words, unnest(range(1, 5)) AS s(m), unnest(range(1, len(w) - m + 2)) AS u(i) GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cand c, unnest(range(1, c.m)) AS t(k)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS around
  FROM cand, unnest(range(2, m)) AS t(s), unnest(range(1, m - s + 2)) AS u(i) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.around IS NULL OR 100 * i.around::HUGEINT < 80 * b.a::HUGEINT)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.mine(rows, anchor=F.col("vec_id") % 50 == 0)


HARD_NEGATIVES_SQL = """
WITH points AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM points a JOIN points b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score::HUGEINT <= 100 * score::HUGEINT AND 100 * score::HUGEINT <= 95 * positive_score::HUGEINT
QUALIFY rank <= 3
"""


CATALOG = {
    "op1_language_id": (op1_language_id, None),
    "op2_mixing": (op2_mixing, MIXING_SQL),
    "op3_html_extraction": (op3_html_extraction, None),
    "op4_warc": (op4_warc, WARC_SQL),
    "op5_sharding": (op5_sharding, SHARDING_SQL),
    "op6_decontamination": (op6_decontamination, DECONTAMINATION_SQL),
    "op7_jaccard_join": (op7_jaccard_join, JACCARD_SQL),
    "op8_embedding_dedup": (op8_embedding_dedup, EMBEDDING_SQL),
    "op9_token_binary": (op9_token_binary, None),
    "op10_token_counts": (op10_token_counts, None),
    "op11_quality_classifier": (op11_quality_classifier, None),
    "op12_collocations": (op12_collocations, COLLOCATIONS_SQL),
    "op13_hard_negatives": (op13_hard_negatives, HARD_NEGATIVES_SQL),
}
