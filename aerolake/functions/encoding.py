"""Feature columns: labels, indicators, imputation and scaling.

Whatever has to be learnt from the data first (a domain, a mean) is learnt by
one aggregate and comes back as a few scalars, which then are literals in a
plain projection: no join, no Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.operators.numbering import numbered

# The numeric kinds kept for exploration; 8-bit integers and
# booleans are left out.
NUMERIC_TYPES = (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Map NaN to null, so that counts, means and imputers agree on "missing"."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*(F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floats else F.col(c)
                       for c in df.columns))


def binary_label(col: str) -> Column:
    """1 when the value is zero or more, 0 otherwise and when it is missing."""
    return F.coalesce((F.col(col) >= 0).cast("int"), F.lit(0))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def category_domains(df: DataFrame, cols: Sequence[str], max_values: int = 1000) -> dict[str, list[str]]:
    """Distinct non-null values of each column, sorted; one pass for all columns.

    A wide indicator table has one column per value, so a column with more than
    ``max_values`` values is an error (use :func:`sparse_one_hot` for it).
    """
    if not cols:
        return {}
    pairs = (df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))
                                           for c in cols))).alias("p"))
             .select("p.c", "p.v").where("v IS NOT NULL").distinct())
    found: dict[str, list[str]] = {c: [] for c in cols}
    rows = pairs.take(max_values * len(cols) + 1)
    for c, v in rows:
        found[c].append(v)
    crowded = [c for c, values in found.items() if len(values) > max_values]
    if crowded or len(rows) > max_values * len(cols):
        raise ValueError(f"More than {max_values} values in {crowded or list(cols)}: "
                         "too many for a wide indicator table")
    return {c: sorted(values) for c, values in found.items()}


def one_hot(df: DataFrame, cols: Sequence[str] | None = None, max_values: int = 1000) -> DataFrame:
    """Replace text columns by ``<column>_<value>`` 0/1 columns (null: all zero)."""
    cols = list(string_columns(df) if cols is None else cols)
    domains = category_domains(df, cols, max_values)
    flags = [F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
             for c in cols for v in domains[c]]
    return df.select(*(c for c in df.columns if c not in cols), *flags)


def dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, count, index): the values of each text column numbered 0, 1, ... by frequency, equal ones in order.

    One aggregate counts the values of all columns (a hot value is combined on the
    map side) and ranges of them are numbered; no task or driver holds a domain.
    """
    pairs = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols))).alias("p"))
    counts = pairs.select("p.column", "p.value").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return numbered(counts, [F.desc("count"), F.asc("value")], "index", within="column")


def sparse_one_hot(df: DataFrame, cols: Sequence[str] | None = None, known: DataFrame | None = None, out: str = "flags") -> DataFrame:
    """Replace text columns by ``out``: the sorted places of the ones in the row of indicators of all values.

    The columns' indicators follow one another, each in the order of its
    :func:`dictionary` (``known``, or that of ``df``).  A null and a value that the dictionary
    does not have give no place.  Any number of values is possible: each column is
    joined with its dictionary, which adaptive execution broadcasts if its measured size
    allows, and else splits the rows of a hot value.
    """
    cols = list(string_columns(df) if cols is None else cols)
    known = dictionary(df, cols) if known is None else known
    sizes = {r["column"]: r["n"] for r in known.groupBy("column").agg((F.max("index") + 1).alias("n")).collect()}  # a row a column
    places, start = [], 0
    for i, c in enumerate(cols):
        own = known.where(F.col("column") == c).select(F.col("value").alias(f"_value_{i}"), (F.col("index") + start).alias(f"_place_{i}"))
        df = df.join(own, F.col(c) == F.col(f"_value_{i}"), "left").drop(f"_value_{i}")
        places.append(F.col(f"_place_{i}"))
        start += sizes.get(c, 0)
    kept = [c for c in df.columns if c not in cols and not c.startswith("_place_")]
    return df.select(*kept, F.array_compact(F.array(*places)).alias(out))


def mean_imputer(cols: Sequence[str]):
    """Spark ML imputer writing ``<column>_imputed``; null and NaN count as missing."""
    from pyspark.ml.feature import Imputer

    return Imputer(inputCols=list(cols), outputCols=[f"{c}_imputed" for c in cols], strategy="mean")


def surrogates(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row with the fill value (mean of the non-missing values) per column."""
    return df.agg(*(F.mean(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in cols))


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and *population* standard deviation per column, in one pass."""
    row = df.agg(*(F.mean(c).alias(f"m_{c}") for c in cols),
                 *(F.stddev_pop(c).alias(f"s_{c}") for c in cols)).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardize(df: DataFrame, moments: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Subtract the mean and divide by the deviation; a constant column becomes 0."""
    def scaled(c: str) -> Column:
        mean, std = moments[c]
        if mean is None:
            return F.lit(None).cast("double").alias(c)
        return ((F.col(c) - F.lit(mean)) / F.lit(std or 1.0)).alias(c)

    return df.select(*(scaled(c) if c in moments else F.col(c) for c in df.columns))
