"""Column contracts, checked on the plan before any row is read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def require_same_columns(new: DataFrame, old: DataFrame) -> None:
    """Same names and, for each name, the same type; order does not matter."""
    if set(new.columns) != set(old.columns):
        raise ValueError(f"Column sets differ: only new {sorted(set(new.columns) - set(old.columns))}, "
                         f"only old {sorted(set(old.columns) - set(new.columns))}")
    old_types, new_types = dict(old.dtypes), dict(new.dtypes)
    differing = {c: (old_types[c], new_types[c]) for c in old_types if old_types[c] != new_types[c]}
    if differing:
        raise ValueError(f"Column types differ (old, new): {differing}")
