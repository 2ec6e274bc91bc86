"""Explicit schemas of every table the jobs read or write."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import types as T

from aerolake.config import FLIGHT_COLUMNS, INPUT_FEATURES

_FLIGHT_TYPES = {
    "FL_DATE": T.DateType(),
    "OP_CARRIER": T.StringType(),
    "OP_CARRIER_FL_NUM": T.LongType(),
    "ORIGIN": T.StringType(),
    "DEST": T.StringType(),
}

FLIGHT = T.StructType(
    [T.StructField(c, _FLIGHT_TYPES.get(c, T.DoubleType())) for c in FLIGHT_COLUMNS]
)

MAIN_STATS = T.StructType([
    T.StructField("data_id", T.LongType(), False),
    T.StructField("date", T.TimestampType()),
    T.StructField("dataset_name", T.StringType(), False),
    T.StructField("row_count", T.DoubleType(), False),
    T.StructField("column_count", T.DoubleType(), False),
])

MODEL_METRICS = T.StructType([
    T.StructField("data_id", T.LongType(), False),
    T.StructField("date", T.TimestampType(), False),
    T.StructField("model_name", T.StringType(), False),
    T.StructField("dataset_name", T.StringType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("value", T.DoubleType(), False),
])

RUNS = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])

# The registry is a log: one row per state a version has been in, newest
# ``change_id`` wins.  Nothing is ever rewritten in place.
REGISTRY = T.StructType([
    T.StructField("change_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("stage", T.StringType()),
    T.StructField("path", T.StringType()),
])

WATERMARK = T.StructType([
    T.StructField("dataset_name", T.StringType()),
    T.StructField("max_available_date", T.DateType()),
])


def features_stats(features: Iterable[str] = INPUT_FEATURES) -> T.StructType:
    """Schema of the feature statistics table, generated from the feature list."""
    features = list(features)
    kinds = [[f"mean_{c}" for c in features], [f"std_{c}" for c in features],
             [f"nan_count_{c}" for c in features], [f"nan_prop_{c}" for c in features]]
    return T.StructType([
        T.StructField("data_id", T.LongType(), False),
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("date", T.TimestampType()),
        *(T.StructField(name, T.DoubleType()) for kind in kinds for name in kind),
    ])


def scoring_input(features: Sequence[str] = INPUT_FEATURES, date_col: str = "FL_DATE") -> T.StructType:
    """Columns a scoring file has to carry; any others are ignored."""
    return T.StructType([T.StructField(date_col, T.DateType()),
                         *(T.StructField(c, T.DoubleType()) for c in features)])
