"""The training-data operators against plain Python, on the small tables and on edge cases."""

import glob
import os
import binascii
import hashlib
import base64
import math
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerolake.llm import decontamination, embeddings, extraction, jaccard, language, mixing, sharding, token_counts, token_files, warc
from aerolake.llm import queries as Q
from aerolake.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASH = ["key", "row", "n", "cid", "component_id", "score", "block", "rejected", "slot", "shard"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, clash=True):
    rows = [(i, t, "en", ["a", "b", None][i % 3] if i is not None else None, 0) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH]) if clash else df


@pytest.fixture(scope="module")
def edge(spark):
    long_text = " ".join(f"w{i % 7919}" for i in range(120_000))
    words = " ".join(f"term{i}" for i in range(40))
    return documents(spark, [(0, None), (1, ""), (2, "  \n "), (3, words), (4, words), (4, words), (5, words + " more"), (6, long_text),
                             (7, long_text + " end"), (None, words), (8, "one"), (9, "ONE"), (10, "123 456"), (11, "é ü 漢字 　 x")])


def rows(df, key):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} - {()}


def near(sets, percent):
    for a, b in combinations(sorted(i for i in sets if sets[i]), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            yield a, b


# 1: language ID

def test_language_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    found = Q.op1_language_id(spark, sf_dir)
    assert found.count() == truth.count()
    held = found.join(truth, "doc_id").where("held_out AND lang IS NOT NULL AND text IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in held)
    assert sum(r.rejected for r in held) / len(held) <= 0.01


def test_language_edge_cases(spark, edge):
    found = rows(language.identify(edge, language.learn_dictionaries(edge)), "doc_id")
    assert [found[i][0].lang_pred for i in (0, 1, 2, 10)] == ["und"] * 4
    assert all(found[i][0].rejected for i in (0, 1, 2, 10))
    assert sum(map(len, found.values())) == edge.count()
    assert language.learn_dictionaries(edge.limit(0)) == {}
    assert {r.lang_pred for r in language.identify(edge, {}).collect()} == {"und"}


def test_letters_are_those_of_unicode(spark):
    assert [language.letters_only(t) for t in ("½ ²", "Ⅷ", "١٢ 12 _", "", "́")] == [b""] * 5  # numerals, digits, a mark alone
    assert language.letters_only("Cafe\u0301 ½no") .startswith("cafe\u0301 no".encode())
    rows = spark.createDataFrame([(1, "½ ²"), (2, "Ⅷ")], "doc_id long, text string")
    learnt = {"de": b"der die das und ist", "en": b"the and of is that"}
    assert {(r.lang_pred, r.score, r.rejected) for r in language.identify(rows, learnt).collect()} == {("und", 0.0, True)}


def test_long_clean_texts_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    learnt = language.learn_dictionaries(docs)
    texts = {}
    for r in docs.dropDuplicates(["text"]).collect():
        texts.setdefault(r.lang, []).append(r.text)
    joined = {lang: " ".join(found) for lang, found in texts.items()}
    # Several MB in each language; in another order where the texts come to less.
    long_texts = [(lang, (text + " " + " ".join(random.Random(1).sample(text.split(), len(text.split()))) * 4)[:8_000_000])
                  for lang, text in joined.items()]
    assert len(long_texts) == 4 and all(len(text) == 8_000_000 for _, text in long_texts)
    found = language.identify(spark.createDataFrame(long_texts, "lang string, text string"), learnt).collect()
    assert [(r.lang_pred, r.rejected) for r in found] == [(r.lang, False) for r in found]


def test_long_text_of_two_languages_in_equal_parts_is_rejected(spark):
    def words(letters, seed):
        draw = random.Random(seed)
        return ["".join(draw.choice(letters) for _ in range(6)) for _ in range(200)]

    a, b = words("abcdefgh", 1), words("stuvwxyz", 2)
    labelled = spark.createDataFrame([("a", " ".join(a)), ("b", " ".join(b))], "lang string, text string")
    learnt = language.learn_dictionaries(labelled)
    draw = random.Random(3)
    mixed = " ".join(draw.choice(a) + " " + draw.choice(b) for _ in range(200_000))
    clean = " ".join(draw.choice(a) for _ in range(400_000))
    found = language.identify(spark.createDataFrame([(0, mixed), (1, clean)], "id long, text string"), learnt).orderBy("id").collect()
    assert found[0].rejected and (found[1].lang_pred, found[1].rejected) == ("a", False)


def test_more_labels_than_one_block_are_all_learnt(spark):
    draw = random.Random(4)
    names = [f"l{i:03}" for i in range(150)]
    words = {name: ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(60)] for name in names}
    given = [(name, " ".join(draw.choice(words[name]) for _ in range(200))) for name in names for _ in range(1 + (name < "l064"))]
    docs = spark.createDataFrame(given, "lang string, text string")
    learnt = language.learn_dictionaries(docs)
    assert sorted(learnt) == names
    assert sum(map(len, learnt.values())) <= language.LANGUAGES * language.DICTIONARY_BYTES
    fresh = spark.createDataFrame([(name, " ".join(draw.choice(words[name]) for _ in range(100))) for name in names], "lang string, text string")
    found = language.identify(fresh, learnt).collect()
    assert all(r.lang_pred == r.lang and not r.rejected and 0 <= r.score <= 1 for r in found)


# 2: mixing

def test_mixing_takes_whole_copies_near_the_target(spark):
    found = Q.op2_mixing(spark, SF).collect()
    assert all(r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0) for r in found)
    targets = {(r.source_size, r.target) for r in found}
    assert math.isclose(sum(t for _, t in targets), min(1.5, 2) * sum(s for s, _ in targets), rel_tol=1e-9)


def test_mixing_edge_cases(spark, edge):
    mixed = mixing.mix(edge)
    assert mixed.columns == edge.columns
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(edge).collect()))
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in edge.collect()}
    assert mixing.mix(edge.limit(0)).count() == 0


# 3: HTML extraction

def test_extraction_deletes_lines_shared_with_the_nearest_page(spark):
    def page(i, body):
        return (i, f"https://h.example/news/{i}", f"<html><body><div>Home page</div>{body}<div>All rights reserved</div></body></html>", "x")

    pages = spark.createDataFrame(
        [page(1, "<p>The first &amp; only\n story.</p><p>Goes on.</p>"), page(2, "<p>Another story</p>"), page(3, "<p>Third</p>"),
         (4, None, None, "x"), (5, "https://h.example/e", "", "x"), (6, "https://k.example/x", "<article><p>Alone</p><script>x()</script></article>", "x")],
        "page_id long, url string, html string, host string")
    found = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    assert found == {1: "The first & only story.\nGoes on.", 2: "Another story", 3: "Third", 4: "", 5: "", 6: "Alone"}
    assert extraction.extract(pages.limit(0)).count() == 0


def test_extraction_differences_the_unmarked_lines_beside_an_article(spark):
    def page(i, body):
        return (i, f"https://h.example/news/{i}", f"<body><div>Home page</div>{body}<footer>Notice {i}</footer></body>")

    pages = spark.createDataFrame(
        [page(1, "<div>The long story.</div><article>Teaser</article>"), page(2, "<div>Another story.</div><article>Teaser</article>"),
         page(3, "<main>A whole page</main>"), page(4, "<main>A whole page</main><div>Byline</div>")], "page_id long, url string, html string")
    found = {r.page_id: (r.text, r.n_shared) for r in extraction.extract(pages).collect()}
    assert found == {1: ("The long story.\nTeaser", 2), 2: ("Another story.\nTeaser", 2), 3: ("A whole page", 1), 4: ("A whole page\nByline", 2)}


def test_extraction_pairs_every_page(spark):
    found = extraction.extract(spark.read.parquet(f"{SF}/pages.parquet"))
    assert found.where("n_shared > 0").count() > 0


def test_extraction_returns_every_page(spark):
    found = Q.op3_html_extraction(spark, SF).collect()
    assert len(found) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) and "<script" not in r.text for r in found)


# 4: WARC

def test_warc_round_trip(spark, tmp_path):
    given = [(1, "u1", "abc"), (2, "u2", "abc"), (3, None, None), (4, "u\r\n4", ""), (5, "u5", "é漢" * 50_000), (5, "u5", "other"), (None, "u", "abc")]
    pages = spark.createDataFrame([(*g, "x") for g in given], "page_id long, url string, html string, digest string")
    index = warc.write_archives(pages, str(tmp_path / "warc"))
    found = warc.read_records(index, str(tmp_path / "warc")).collect()
    assert len(found) == len(given)

    def digest(text):
        return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()

    want = sorted((str(k), len((t or "").encode()), digest(t)) for k, _, t in given)
    assert sorted((str(r.key), r.payload_bytes, r.payload_digest) for r in found) == want
    kinds = {(r.key, r.payload_digest): (r.record_type, r.refers_to) for r in found}
    assert kinds[1, digest("abc")] == ("response", None) and kinds[2, digest("abc")] == ("revisit", 1)
    assert kinds[None, digest("abc")] == ("revisit", 1) and kinds[4, digest("")] == ("revisit", 3)
    payloads = {r.key: bytes(r.payload) for r in found if r.record_type == "response" and r.key == 1}
    assert payloads == {1: b"abc"}
    one = warc.read_records(index.where("key = 2"), str(tmp_path / "warc")).collect()
    assert [r.key for r in one] == [2]
    empty = str(tmp_path / "none")
    assert warc.read_records(warc.write_archives(pages.limit(0), empty), empty).count() == 0


# 5: sharding

def test_sharding_law(spark):
    found = Q.op5_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    slots = {}
    for r in found:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(data) + 1, binascii.crc32(data))
        assert r.grown_shard in (r.shard, Q.SHARDS)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(found) == len(texts)


def test_sharding_weights_and_edge_cases(spark, edge):
    ids = spark.range(20_000).select(sharding.shard_of(F.col("id"), [1.0, 3.0]).alias("s"))
    share = ids.agg(F.avg("s")).first()[0]
    assert abs(share - 0.75) < 0.02
    placed = sharding.with_slots(edge.withColumn("shard", sharding.shard_of(F.col("doc_id"), [1.0, 1.0])), "doc_id")
    by_shard = rows(placed, "shard")
    assert all(sorted(r.slot for r in found) == list(range(len(found))) for found in by_shard.values())
    assert sharding.with_slots(edge.limit(0).withColumn("shard", F.lit(0)), "doc_id").count() == 0


# 6: decontamination

def brute_hits(text, items, size=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    own, hit, found = words(text), set(), set()
    for item, content in items:
        w = words(content)
        for window in {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else ():
            for at in range(len(own) - len(window) + 1):
                if tuple(own[at:at + len(window)]) == window:
                    hit |= set(range(at, at + len(window)))
                    found.add(item)
    return len(own), len(hit), sorted(found - {None})


def test_decontamination_against_brute_force(spark, edge):
    items = [(1, " ".join(f"Term{i}" for i in range(3, 20))), (2, "one"), (3, None), (4, "..."), (None, "more"), (5, "w7 w8 w9"), (6, "é ü")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, key string")
    found = decontamination.find_contamination(edge, benchmark).withColumn("n_hit", decontamination.covered(F.col("spans")))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in found.collect())
    assert got == sorted((str(r.doc_id), *brute_hits(r.text, items)) for r in edge.collect())
    clean = decontamination.find_contamination(edge, benchmark.limit(0))
    assert clean.count() == edge.count() and clean.where(F.size("spans") > 0).count() == 0
    assert decontamination.find_contamination(edge.limit(0), benchmark).count() == 0


def test_decontamination_blocks_and_proximity(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "a b c d"), (3, "d c b a")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "a b c d"), (2, "c b a")], "item_id long, text string")
    exact = rows(decontamination.find_contamination(docs, benchmark), "doc_id")
    assert [list(exact[i][0]["items"]) for i in (1, 2, 3)] == [[], [1], [2]]
    loose = rows(decontamination.find_contamination(docs, benchmark, slop=1), "doc_id")
    assert 1 in loose[1][0]["items"] and not any(s.exact for s in loose[1][0].spans)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 4)
    several = rows(decontamination.find_contamination(docs, benchmark), "doc_id")
    assert [list(several[i][0]["items"]) for i in (1, 2, 3)] == [[], [1], [2]]


# 7: n-gram Jaccard join

@pytest.mark.parametrize("width, percent, block", [(3, 90, 256), (5, 80, 4)])
def test_jaccard_against_brute_force(spark, width, percent, block):
    draw = random.Random(7)
    base = [[f"v{draw.randrange(400)}" for _ in range(draw.choice([5, 30, 120]))] for _ in range(25)]
    texts = []
    for _ in range(260):  # families of near copies, far and near to the bound
        words = list(draw.choice(base))
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"v{draw.randrange(400)}"
        texts.append(" ".join(words))
    docs = documents(spark, list(enumerate(texts)))
    sets = {i: shingles(t, width) for i, t in enumerate(texts)}
    want = roots(sets, near(sets, percent))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, width=width, percent=percent, block=block).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_jaccard_edge_cases(spark, edge):
    found = rows(jaccard.join(edge), "doc_id")
    assert [found[i][0].component_id for i in (0, 1, 2, 3, 5, 6, 7, 8, 9)] == [0, 1, 2, 3, 3, 6, 6, 8, 8]
    assert [r.component_id for r in found[4]] == [3, 3] and found[None][0].component_id == 3
    assert [found[i][0].n_shingles for i in (0, 1, 2, 3, 8)] == [0, 0, 0, 38, 1]
    assert jaccard.join(edge.limit(0)).count() == 0


def test_regions_without_a_possible_pair_are_dropped(spark):
    # One shared word: sizes 4 and 400 cannot match, equal sizes that share it can.
    docs = spark.createDataFrame([(1, "same b1 c1 d1"), (2, " ".join(["same", *(f"x{i}" for i in range(399))])),
                                  (3, "other e1 f1 g1"), (4, "other e1 f1 g1 h1")], "doc_id long, text string")
    signed = jaccard.signatures(docs, "doc_id", "text", 1, 80)
    classes = jaccard.stored(signed.selectExpr("key AS cid", "n", "row AS first_row"), "test-classes")
    assert {r.cid for r in jaccard.regions(signed, classes, 80).collect()} == {3, 4}


def test_common_shingles_crowd_no_region(spark):
    # A tenth of every set is common to all; the rest is nobody else's.
    common = [f"common{i}" for i in range(100)]
    docs = spark.createDataFrame([(k, " ".join([*common, *(f"own{k}x{i}" for i in range(900))])) for k in range(100)], "doc_id long, text string")
    signed = jaccard.signatures(docs, "doc_id", "text", 1, 80)
    classes = jaccard.stored(signed.selectExpr("key AS cid", "n", "row AS first_row"), "test-classes")
    sizes = [r["count"] for r in jaccard.regions(signed, classes, 80).groupBy("pivot").count().collect()]
    assert max(sizes, default=0) <= 10


def test_jaccard_leaves_only_what_its_result_reads(spark, edge):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{base}/*/*"))
    jaccard.join(edge).collect()
    assert {os.path.basename(p).rsplit("-", 1)[0] for p in set(glob.glob(f"{base}/*/*")) - before} == {"keys", "class-names"}


def test_a_pair_of_many_crowded_regions_is_found_once():
    members = [{"cid": i, "n": 100, "component": i, "near": 0.0, "far": 1.0, "classes": bytes(16), "crowds": [5, 9] if i < 40 else []} for i in range(42)]
    kind = pa.list_(pa.struct([("cid", pa.int64()), ("n", pa.int64()), ("component", pa.int64()), ("near", pa.float64()), ("far", pa.float64()),
                               ("classes", pa.binary()), ("crowds", pa.list_(pa.int64()))]))
    batch = pa.RecordBatch.from_arrays([pa.array([members] * 4, kind), pa.nulls(4, kind), pa.array([True] * 4), pa.array([5, 9, 11, None], pa.int64())],
                                       ["left", "right", "same", "before"])
    found = [p for out in jaccard._windows(90, False)([batch]) for p in zip(out["a"].to_pylist(), out["b"].to_pylist())]
    everywhere = [p for p in combinations(range(42), 2) if p[1] >= 40]  # these know no region in common
    assert sorted(found) == sorted([*combinations(range(40), 2), *everywhere * 4])


def test_classes_differ_in_no_more_than_the_sets():
    draw = np.random.default_rng(3)
    universe = draw.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sets = [np.unique(draw.choice(universe, n)) for n in (1, 5, 60, 70, 400, 700, 2500, 2600)]
    bits = [jaccard.class_bits(x) for x in sets]
    x, y = (a.ravel() for a in np.meshgrid(range(8), range(8)))
    differ = jaccard.differing(bits, bits, x, y)
    assert (differ <= [len(np.setxor1d(sets[i], sets[j])) for i, j in zip(x, y)]).all() and (differ[x == y] == 0).all()
    assert (differ[x != y] > 0).all()


# 8: embeddings

def brute_links(vectors, bound=0.98):
    for (a, v, p), (b, w, q) in combinations(vectors, 2):
        if p == q and p is not None and v and w and len(v) == len(w):
            x, y = np.array(v, float), np.array(w, float)
            if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any():
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= bound:
                    yield a, b


@pytest.mark.parametrize("kind, block", [("float", 2048), ("double", 8)])
def test_embeddings_against_brute_force(spark, kind, block):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 16))
    vectors = []
    for i in range(400):
        v = centres[draw.integers(12)] + draw.choice([0, 0.05, 0.2]) * draw.normal(size=16)
        vectors.append((i, [float(x) for x in np.float32(v)], [0, 0, 0, 1, None][i % 5]))
    vectors += [(400 + i, v, 0) for i, v in enumerate([None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0],
                                                       [2.0, 4.0], [-0.0] + [1.0] * 15, [0.0] + [1.0] * 15])]
    links = list(brute_links(vectors))
    component = roots([v[0] for v in vectors], links)
    counts = {v[0]: sum(v[0] in link for link in links) for v in vectors}
    df = spark.createDataFrame([(*v, "x", "y") for v in vectors], f"vec_id long, embedding array<{kind}>, label int, cid string, block string")
    got = {r.vec_id: tuple(r)[1:] for r in embeddings.join(df, block=block).repartition(3).collect()}
    assert got == {i: (counts[i], component[i], component[i] == i) for i in counts}
    assert embeddings.join(df.limit(0)).count() == 0
    only_bad = embeddings.join(df.where("vec_id between 400 and 404")).collect()
    assert [(r.n_links, r.kept) for r in only_bad] == [(0, True)] * 5


def test_embeddings_null_components_keys_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0, None], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [3.0, 0.0], 1), (None, None, 1)],
                               "vec_id long, embedding array<double>, label int")
    found = sorted(map(tuple, embeddings.join(df).collect()), key=str)
    assert found == sorted([(1, 0, 1, True), (1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=str)


# 9: token files

def test_token_files_round_trip(spark, tmp_path, edge):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    folder = str(tmp_path / "tokens")
    found = token_files.read_files(token_files.write_files(token_files.encode(edge), folder), folder).collect()
    want = sorted((str(r.doc_id), bytes(np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4"))) for r in edge.collect())
    assert sorted((str(r.key), bytes(r.ids)) for r in found) == want
    ordered = sorted(found, key=lambda r: r.start)
    keys = [-1 if r.key is None else r.key for r in ordered]
    assert keys == sorted(keys)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:i]) for i in range(len(ordered))]
    empty = str(tmp_path / "none")
    assert token_files.read_files(token_files.write_files(token_files.encode(edge.limit(0)), empty), empty).count() == 0


def test_tokens_of_white_space_runs_equal_the_library():
    draw = random.Random(5)
    white = [" ", "\u00a0", "\t", "\n", "\r\n", "\u2003", "\u3000", "\x85", "\x1c"]
    texts = ["foo" + " \u00a0" * n + "bar" for n in range(1, 10)] + ["foo \u00a0 \u00a0", " \u00a0 \u00a0", "a\t \t b \n \n", "a\r\n \r\n b", "a ", " a", None, ""]
    texts += ["".join(draw.choice([*white, " ", "a", "foo", "é", "7", ".", "<|endoftext|>"]) for _ in range(draw.randrange(12))) for _ in range(3000)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids, counts = Encoder().encode(pa.array(texts))
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


# 10: token counts

def test_words_are_encoded_once_whatever_stands_beside_them():
    encoder = Encoder()
    encoder.encode(pa.array(["cat cat, cat.\ncat cat's", "cat!\ncat"]))
    assert set(encoder.places) == {"cat", " cat", ",", ".", "\n", "'s", "!"}


def test_cut_texts_equal_the_library():
    encoder, draw = Encoder(), random.Random(9)
    parts = ["a", "Zx", "'s", "'", "don't", "'LL", "é", "ß", "\u0301", "ª", "日", "٠", "1", "23", "²", ".", ",", "_", "-", "’", "(", "\n", "\n", "\r", "\t",
             " ", " ", " ", "\x00", "\x1c", "\x7f", "\x85", "\xa0", "\u3000", "\u200b", "<|endoftext|>"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(16))) for _ in range(4000)] + [f"naïve{i} größer{i}, {i:x}" for i in range(1000)] + ["", None, " ", "\n"]
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    expected = [e.ids for e in encoder.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_add_up(spark, edge, rule):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    some = edge.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(
        edge.limit(1).withColumn("doc_id", F.lit(99).cast("long")).withColumn("text", F.lit("A line\nof text\n\nand é漢字\nend")))
    totals = {r.key: r.n for r in token_counts.count_tokens(some, rule=rule).groupBy("key").agg(F.sum("tokens").alias("n")).collect()}
    for r in some.collect():
        assert math.isclose(totals[r.doc_id], len(tokenizer.encode(r.text or "", add_special_tokens=False).ids), abs_tol=1e-6)
    assert token_counts.count_tokens(edge.limit(0), rule=rule).count() == 0


def test_token_counts_of_given_sections(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "Some longer words that make several tokens, and more of them."
    docs = spark.createDataFrame([(1, text, [("head", 0, 13), ("body", 13, 40)])],
                                 "doc_id long, text string, sections array<struct<name: string, start: long, end: long>>")
    found = {r.section: r for r in token_counts.count_tokens(docs, sections="sections", rule="majority").collect()}
    want = {0: 0, 1: 0, -1: 0}
    for start, end in tokenizer.encode(text, add_special_tokens=False).offsets:
        overlap = [max(0, min(end, 13) - start), max(0, min(end, 40) - max(start, 13))]
        want[overlap.index(max(overlap)) if any(overlap) else -1] += 1
    assert {k: r.tokens for k, r in found.items()} == want
    assert found[0].name == "head"


def test_slices_cover_all_texts_and_hold_few_bytes():
    from aerolake.llm.tokens import slices_by_bytes

    draw = random.Random(6)
    texts = pa.array([None if draw.random() < 0.1 else "é" * draw.choice([0, 1, 40, 700]) for _ in range(500)])
    found = list(slices_by_bytes(texts.slice(7), 1000))
    assert [at for at, _ in found] == [0, *np.cumsum([n for _, n in found])[:-1]] and sum(n for _, n in found) == 493
    sizes = [len((t or "").encode()) for t in texts.slice(7).to_pylist()]
    assert all(n == 1 or sum(sizes[at:at + n]) <= 1000 for at, n in found)
    assert list(slices_by_bytes(pa.array([], pa.string()))) == []
