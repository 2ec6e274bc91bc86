"""Regression metrics in one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reported metrics, in reporting order.
METRIC_NAMES = ("r2", "rmse", "mse", "mae", "var")


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """r2, rmse, mse, mae and explained variance as one row.

    Built on central moments, so a target far from zero loses no digits.
    """
    y, p = F.col(label), F.col(prediction)
    moments = df.agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("vy"), F.avg(y).alias("my"), F.var_pop(p).alias("vp"), F.avg(p).alias("mp"))
    offset = F.col("mp") - F.col("my")
    return moments.select(
        (1 - F.try_divide("mse", "vy")).alias("r2"), F.sqrt("mse").alias("rmse"), "mse", "mae",
        (F.col("vp") + offset * offset).alias("var"))
