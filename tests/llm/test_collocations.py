"""Phrase mining against plain Python, with forced collisions and edge cases."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from aerolake.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: A tiny modulus: 121 fingerprints a language for all phrases; the check value tells them apart.
WEAK = {"prime": 11, "bases": ((3, 7), collocations.BASES[1])}


def plain_counts(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    return f, n


def plain(rows, min_count, top, absorbed=80):
    f, n = plain_counts(rows)
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    around = Counter()
    for (lang, w), a in cand.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                around[lang, w[i:i + size]] = max(around[lang, w[i:i + size]], a)
    out = []
    for (lang, w), a in cand.items():
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if Fraction(100 * around[lang, w]) < absorbed * a or not around[lang, w]:
            out.append((lang, score, a, " ".join(w), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    result = []
    for lang in {r[0] for r in out}:
        ranked = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[1], -r[2], r[3].encode()))
        result += [(lang, i + 1, r[3], r[2], r[4], r[5], r[6], r[1]) for i, r in enumerate(ranked[:top])]
    return sorted(result)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string")
    return df.select("*", *[F.lit("x").alias(c) for c in ("print", "count", "phrase", "f", "text_hash", "part", "rank")])


def mined(spark, rows, min_count, top, **options):
    phrases = collocations.frequent_phrases(frame(spark, rows), min_count=min_count, **options)
    return sorted(map(tuple, collocations.collocations(phrases, top).collect()))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    words = ["a", "b", "Cc", "dé", "漢", "e-e", "x" * 300, "ＡＢ", "f g"]
    rows = []
    for _ in range(150):
        parts = []
        for _ in range(draw.randrange(60)):
            parts += [draw.choice(words), draw.choice([" ", " ", " ", "  ", "\t", " \t ", ". ", "\n", ", ", "!"])]
        rows.append(("".join(parts), draw.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", "fr"), (" \t ", "en"), ("...", None)] + [("same words here again", "en")] * 40


def test_equals_plain_python(spark, texts):
    want = plain(texts, 5, 50)
    assert len(want) > 100
    assert mined(spark, texts, 5, 50) == want


def test_colliding_fingerprints_are_told_apart_by_text(spark, texts):
    want = plain(texts, 5, 50)
    rows = collocations._rows(frame(spark, texts), "text", "lang")
    assert collocations.count_phrases(rows, 2, min_count=5, **WEAK).where("clash").count() > 50
    assert mined(spark, texts, 5, 50, **WEAK) == want


def test_a_full_filter_only_lets_more_through(spark, texts):
    assert mined(spark, texts, 5, 50, bits=1 << 7) == plain(texts, 5, 50)


def test_long_texts_are_cut_between_pieces_only(spark, monkeypatch):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    long_text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", ". "]) for _ in range(40_000))
    one_piece = " ".join(draw.choice(words) for _ in range(30_000))
    rows = [(long_text, "en"), (one_piece, "en"), ("w1 w2. " * 10, "de")]
    want = plain(rows, 8, 100)
    assert mined(spark, rows, 8, 100) == want
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 1 << 12)  # sent to the tasks with the code when run in blocks
    import pyarrow as pa
    cut = list(collocations.blocks(pa.array([long_text, one_piece], pa.large_string())))
    assert sum(len(b[0]) for b in cut) == len(long_text) + len(one_piece)
    assert len(cut) > 20 and max(len(b[0]) for b in cut) >= len(one_piece)


def test_ties_are_ranked_by_bytes_and_the_top_is_whole(spark):
    rows = [(f"p{i:03d} q{i:03d}", "en") for i in range(300) for _ in range(3)]
    got = mined(spark, rows, 3, 200)
    assert got == plain(rows, 3, 200) and len(got) == 200 and got[0][2] == "p000 q000"


def test_counts_beyond_64_bits_are_exact(spark):
    big = 2**61
    phrases = spark.createDataFrame([("en", "a b", big), ("en", "a", big + 5), ("en", "b", big + 2), ("en", "", 2**62)], "lang string, phrase string, f long")
    (row,) = collocations.collocations(phrases).collect()
    assert row.score == 2_000_000 * big // (2 * big + 7)


def test_empty_table(spark, texts):
    assert mined(spark, texts, 10**6, 10) == []
    assert collocations.mine(frame(spark, texts).limit(0)).collect() == []
