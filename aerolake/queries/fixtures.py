"""Flight rows derived from the ``lineitem`` table, for Spark and for SQL.

The test tables hold no flights and no nulls; these expressions, accepted by
both engines, derive a flight row with nulls from every line item.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.config import FlightConfig
from aerolake.sources.workspace import shared_folder

AS_OF = dt.date(2000, 1, 1)
#: About as many rows as a task that stages flights gets, at most.
STAGED_ROWS = 1_000_000

# The derivation of each flight column.
FLIGHT_EXPRESSIONS = {
    "FL_DATE": "CAST(l_shipdate AS DATE)",
    "OP_CARRIER": "concat(l_returnflag, l_linestatus)",
    "OP_CARRIER_FL_NUM": "l_suppkey",
    "ORIGIN": "concat('A', CAST(l_suppkey % 40 AS VARCHAR(10)))",
    "DEST": "concat('A', CAST(l_partkey % 40 AS VARCHAR(10)))",
    "CRS_DEP_TIME": "CAST((l_orderkey % 24) * 100 + l_partkey % 60 AS DOUBLE)",
    "DEP_TIME": "CAST((l_orderkey % 24) * 100 + l_suppkey % 60 AS DOUBLE)",
    "DEP_DELAY": "CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE l_quantity - 25 END",
    "TAXI_OUT": "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE round(l_discount * 100) + 5 END",
    "WHEELS_OFF": "CAST((l_orderkey % 24) * 100 + l_suppkey % 50 AS DOUBLE)",
    "WHEELS_ON": "CAST((l_partkey % 24) * 100 + l_suppkey % 50 AS DOUBLE)",
    "TAXI_IN": "round(l_tax * 100) + 3",
    "CRS_ARR_TIME": "CAST((l_partkey % 24) * 100 + l_partkey % 60 AS DOUBLE)",
    "ARR_TIME": "CAST((l_partkey % 24) * 100 + l_suppkey % 60 AS DOUBLE)",
    "ARR_DELAY": "CASE WHEN l_orderkey % 50 = 0 THEN NULL "
                 "ELSE 0.9 * (l_quantity - 25) + 0.7 * round(l_discount * 100) "
                 "- 0.0002 * l_extendedprice "
                 "+ CAST((l_orderkey * 7 + l_linenumber) % 21 - 10 AS DOUBLE) END",
    "CANCELLED": "CASE WHEN l_orderkey % 50 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "DIVERTED": "CASE WHEN l_orderkey % 97 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "CRS_ELAPSED_TIME": "CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE round(l_extendedprice / 300) END",
    "ACTUAL_ELAPSED_TIME": "CASE WHEN l_orderkey % 50 = 0 THEN NULL "
                           "ELSE round(l_extendedprice / 300) + l_linenumber END",
    "AIR_TIME": "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE round(l_extendedprice / 350) END",
    "DISTANCE": "CAST(100 + (l_partkey * 13) % 2400 AS DOUBLE)",
}

FLIGHTS_SQL = ("flights AS (SELECT "
               + ", ".join(f"{e} AS {c}" for c, e in FLIGHT_EXPRESSIONS.items()) + " FROM lineitem)")

# Training runs and model versions derived from ``orders``.
RUNS_SQL = """runs AS (
  SELECT o_orderpriority AS experiment, CAST(o_orderkey AS VARCHAR(20)) AS run_id,
         CAST(o_orderdate AS DATE) AS start_time,
         o_totalprice / 1000000 AS r2, o_totalprice / 10000 AS rmse, o_totalprice / 20000 AS mae
  FROM orders)"""
REGISTRY_SQL = """registry AS (
  SELECT o_orderkey AS change_id,
         concat('model_', CAST(o_custkey % 50 AS VARCHAR(10))) AS name, o_orderkey AS version,
         CASE o_orderstatus WHEN 'O' THEN 'Production' WHEN 'F' THEN 'Archived' ELSE 'None' END AS stage,
         concat('models/', CAST(o_orderkey AS VARCHAR(20))) AS path
  FROM orders)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str, staging: bool = False) -> DataFrame:
    """The flight rows; ``staging`` is for queries that first write them out.

    The test tables are one row group each, which a single task would read and
    write, so staging spreads a table of fewer files than cores, over more tasks the
    more rows it has: a partitioned write sorts its task's rows in memory.  A table of
    many files is left as it is.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    if staging and len(lineitem.inputFiles()) < cores:
        lineitem = lineitem.repartition(max(cores, -(-lineitem.count() // STAGED_ROWS)), "l_orderkey")
    return lineitem.selectExpr(*(f"{e} AS {c}" for c, e in FLIGHT_EXPRESSIONS.items()))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("experiment"), F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").cast("date").alias("start_time"),
        F.create_map(F.lit("r2"), price / 1000000, F.lit("rmse"), price / 10000,
                     F.lit("mae"), price / 20000).alias("metrics"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("change_id"),
        F.concat(F.lit("model_"), (F.col("o_custkey") % 50).cast("string")).alias("name"),
        F.col("o_orderkey").alias("version"),
        F.when(status == "O", "Production").when(status == "F", "Archived").otherwise("None").alias("stage"),
        F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("path"))


def config_in(spark: SparkSession, label: str, **changes) -> FlightConfig:
    """A configuration that writes into a fresh shared folder."""
    return FlightConfig(output_prefix=shared_folder(spark, label), as_of=AS_OF, **changes)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Fractional columns rounded, so that both engines give equal text."""
    return df.select(*(F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`")
                       for c, t in df.dtypes))


def rounded_sql(columns, digits: int = 6) -> str:
    text = {"FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST"}
    return ", ".join(c if c in text else f"round({c}, {digits}) AS {c}" for c in columns)
