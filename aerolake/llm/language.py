"""Language identification by compression.

Each language has a raw-content dictionary made of its own texts.  A text is
compressed once per dictionary; the language whose dictionary gives the smallest
frame wins, and a narrow win is marked as rejected.  A long text is compressed in
pieces whose frames are added up: a dictionary saves bytes only near its use, so in
one frame the share that it saves, and with it the margin, would fall with length.

Defined results: a null text or one without a letter is ``und`` with score 0 and
rejected; equal sizes go to the language first in code point order (and are
rejected, their margin being 0).  Whole texts are compressed, whatever their
length.  Without any labelled text every prediction is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bounds of the sample the dictionaries are made of, for up to LANGUAGES labels.  With more labels each gives
#: less, so that together they still bound what reaches the driver.
LANGUAGES, SAMPLE_BUCKETS, SAMPLE_CHARS, DICTIONARY_BYTES = 64, 160, (40, 8000), 256 << 10
LEVEL = 6
#: A frame shorter than its header and tables is stored raw and would tie; so short texts are repeated.
SHORT_BYTES, SHORT_REPEATS = 256, 4
MIN_MARGIN = 0.004
PIECE_BYTES = 64 << 10

#: Letters, and the marks that belong to them, by Unicode category; digits and other numerals are neither.
_LETTER, _NOT_LETTERS = regex.compile(r"\p{L}"), regex.compile(r"[^\p{L}\p{M}]+")


def letters_only(text: str) -> bytes:
    """The text in lower case with every run of other characters than letters turned into one space; nothing without a letter."""
    if not _LETTER.search(text):
        return b""
    plain = _NOT_LETTERS.sub(" ", text).strip().lower().encode("utf-8", "replace")
    return b" ".join([plain] * SHORT_REPEATS) if len(plain) < SHORT_BYTES else plain


def pieces(plain: bytes) -> list[bytes]:
    """The whole text in the least number of pieces of about equal size that hold ``PIECE_BYTES`` at most."""
    n = -(-len(plain) // PIECE_BYTES)
    return [plain[len(plain) * i // n:len(plain) * (i + 1) // n] for i in range(n)]


def learn_dictionaries(labelled: DataFrame, text: str = "text", label: str = "lang") -> dict[str, bytes]:
    """Dictionary content per label, from a bounded sample spread over all labelled texts.

    The texts of a label fall into ``SAMPLE_BUCKETS`` buckets by hash, and the one
    with the smallest hash stands for its bucket; texts outside the usual lengths
    come after all others and give no more than the longest usual length.  Every
    label is learnt; beyond ``LANGUAGES`` labels each has fewer buckets, then shorter
    texts, and a smaller dictionary.
    """
    low, high = SAMPLE_CHARS
    rows = labelled.select(F.col(label).alias("label"), F.col(text).alias("text")).where(
        "label IS NOT NULL AND text IS NOT NULL")
    n = max(LANGUAGES, rows.select("label").distinct().count())
    n_buckets = max(1, SAMPLE_BUCKETS * LANGUAGES // n)
    chars, size = (max(1, most * LANGUAGES // n) for most in (SAMPLE_BUCKETS * high, DICTIONARY_BYTES))
    chars = min(high, chars // n_buckets)
    usual = F.when(F.length("text").between(low, high), F.lit(0)).otherwise(F.lit(1 << 62))
    rows = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 2) + usual)
    buckets = rows.groupBy("label", F.pmod("h", F.lit(n_buckets)).alias("b")).agg(F.min("h").alias("h"))
    wanted = buckets.select("label", "h").collect()  # at most LANGUAGES * SAMPLE_BUCKETS rows, or one a label
    chosen = labelled.sparkSession.createDataFrame(wanted, "label string, h long")
    sample = rows.join(F.broadcast(chosen), ["label", "h"]).select("label", "h", F.substring("text", 1, chars).alias("text"))
    texts: dict[str, list[str]] = {}
    for row in sample.dropDuplicates(["label", "h"]).orderBy("label", "h").collect():
        texts.setdefault(row["label"], []).append(row["text"])
    return {name: b" ".join(map(letters_only, found))[-size:] for name, found in sorted(texts.items())}


def predict(text: Column, dictionaries: dict[str, bytes], df: DataFrame) -> Column:
    """Struct (lang, score, margin) of each text.

    ``margin`` is the gap between the two smallest sizes over the second; ``score``
    is the winner's share when sizes weigh exp(-size / 2), between 0 and 1.
    """
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)  # at most LANGUAGES * DICTIONARY_BYTES, or one byte a label

    @F.pandas_udf("lang string, score double, margin double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import math

        names = list(shared.value)
        blocks = [names[i:i + LANGUAGES] for i in range(0, len(names), LANGUAGES)]

        def coders(block: list[str]) -> list:
            made = []
            for name in block:
                held = zstandard.ZstdCompressionDict(shared.value[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False,
                                                     write_content_size=False, write_dict_id=False))
            return made

        # One block's coders are held at a time, and made once where there is but one block.
        only = coders(names) if len(blocks) == 1 else None
        for batch in batches:
            found = [(UNKNOWN, math.inf, math.inf, 0.0)] * len(batch)  # name and size of the best, second size, weight of all
            for block in blocks:
                held = only or coders(block)
                for at, value in enumerate(batch):
                    plain = letters_only(value) if value is not None else b""
                    if not plain.strip():
                        continue
                    parts = pieces(plain)
                    sizes = [sum(len(coder.compress(part)) for part in parts) for coder in held]
                    name, best, second, weight = found[at]
                    least, second = sorted([best, second, *sizes])[:2]
                    if least < best:  # equal sizes stay with the earlier block
                        name = block[sizes.index(least)]
                    weight = weight * math.exp((least - best) / 2) + sum(math.exp((least - size) / 2) for size in sizes)
                    found[at] = name, least, second, weight
            out = []
            for name, best, second, weight in found:
                if not weight:
                    out.append((UNKNOWN, 0.0, 0.0))
                else:
                    out.append((name, 1 / weight, (second - best) / second if second < math.inf else 1.0))
            yield pd.DataFrame(out, columns=["lang", "score", "margin"])

    return classify(text)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score and rejected; columns of these names are replaced."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    found = docs.withColumn("__found", predict(F.col(text), dictionaries, docs))
    return found.select(*kept, F.col("__found.lang").alias("lang_pred"), F.col("__found.score").alias("score"),
                        ((F.col("__found.lang") == UNKNOWN) | (F.col("__found.margin") < min_margin)).alias("rejected"))
