"""Main text of web pages, by nearest-URL page differencing.

A page is cut into text lines (its blocks).  Within each host the pages are put
in order of their URL path, every page is paired with the neighbour whose path
has the longer common beginning, the two pages' lines are aligned by longest
common subsequence, and shared lines are deleted.

Every page takes part with all its lines.  The marks are a check that follows: a
shared line inside a marked article (article, main) stays, since pages of one host
share passages and whole articles, and a line inside marked boilerplate goes, since
notices and footers differ from page to page.  Differencing decides on the lines
that no mark puts inside or outside of the article, beside a marked article too.

Defined results: null or empty html gives an empty text; pages without a URL form
one host; repeated rows are handled one by one, and two copies of a page share all
their lines, so they are no pair: the next different page is taken, and a page
without any partner keeps its lines.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.blocks import ARTICLE, OPEN, common_lines, text_blocks
from aerolake.llm.common import stored
from aerolake.llm.numbering import numbered_in_order


_LINES = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("region", T.IntegerType())]))
_PLACES = T.ArrayType(T.IntegerType())


@F.pandas_udf(_LINES)
def _lines(html: pd.Series) -> pd.Series:
    return html.map(lambda page: [{"text": t, "region": r} for t, r in text_blocks(page)])


@F.pandas_udf(T.StructType([T.StructField("lefts", _PLACES), T.StructField("rights", _PLACES)]))
def _shared(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([common_lines(list(a), list(b)) for a, b in zip(left, right)], columns=["lefts", "rights"])


def _shared_lines(lines: DataFrame) -> DataFrame:
    """(row, shared): places of the lines a page shares with its nearest page."""
    # A run of equal pages counts once: only its first page takes part.
    place = lines.select("row", "host", "path", F.transform("lines", lambda x: F.xxhash64(x["text"])).alias("hashes"))
    distinct = place.groupBy("host", F.xxhash64("hashes").alias("content")).agg(
        F.min(F.struct("path", "row")).alias("first"))
    firsts = place.join(distinct.select(F.col("first.row").alias("row")), "row", "left_semi").withColumn("content", F.xxhash64("hashes"))
    ranked = numbered_in_order(firsts, ["host", "path", "row"], "rank")
    ahead = ranked.select((F.col("rank") - 1).alias("rank"), *[F.col(c).alias(f"next_{c}") for c in ("host", "path", "hashes", "content")])
    pairs = ranked.join(ahead, "rank").where(F.col("host").eqNullSafe(F.col("next_host")))
    # Length of the paths' common beginning: paths are ordered, so the longer one is the nearer.
    common = F.length(F.regexp_extract(F.concat_ws("\n", "path", "next_path"), r"^([^\n]*)[^\n]*\n\1", 1))
    aligned = pairs.withColumn("both", _shared("hashes", "next_hashes")).withColumn("near", common)
    sides = aligned.select(
        F.explode(F.array(
            F.struct("host", "content", "near", F.lit(1).alias("before"), F.col("both.lefts").alias("shared")),
            F.struct("host", F.col("next_content").alias("content"), "near", F.lit(2).alias("before"), F.col("both.rights").alias("shared")))).alias("side")).select("side.*")
    nearest = sides.groupBy("host", "content").agg(F.max_by("shared", F.struct("near", "before")).alias("shared"))
    return place.withColumn("content", F.xxhash64("hashes")).join(nearest, ["host", "content"]).select("row", "shared")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``key``, url, text, n_lines (all visible lines) and n_shared (those shared with the nearest page)."""
    address = F.coalesce(F.col(url), F.lit(""))
    parsed = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(url).alias("url"),
        F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"),
        _lines(html).alias("lines"))
    lines = stored(parsed, "page-lines", "zstd")
    # Rows with a shared line only, and written, so that Spark sees their size.
    shared = stored(_shared_lines(lines).where(F.size("shared") > 0), "shared-lines")
    joined = lines.join(shared, "row", "left").withColumn("shared", F.coalesce("shared", F.array().cast("array<int>")))
    kept = F.filter("lines", lambda x, i: (x["region"] == ARTICLE) | (
        (x["region"] == OPEN) & ~F.array_contains(F.col("shared"), i)))
    return joined.select(
        F.col("key").alias(key), F.col("url").alias(url), F.concat_ws("\n", F.transform(kept, lambda x: x["text"])).alias("text"),
        F.size("lines").alias("n_lines"), F.size("shared").alias("n_shared"))
