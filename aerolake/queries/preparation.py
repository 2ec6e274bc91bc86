"""Ingest, cleaning, accumulation, splits and history, with reference SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.config import INPUT_FEATURES, FlightConfig
from aerolake.functions.dates import first_run_lower_bound
from aerolake.operators import profile, rows
from aerolake.plans import features, history
from aerolake.queries.fixtures import AS_OF, FLIGHTS_SQL, config_in, flights, rounded, table
from aerolake.queries.scans import ROW, ROW_SQL
from aerolake.sources import sinks, tables
from aerolake.sources.workspace import shared_folder
from aerolake.streaming.incremental import incremental_ingest as run_stream
from aerolake.streaming.incremental import ingest_features, read_ingested

DEFAULTS = FlightConfig(as_of=AS_OF)
START = first_run_lower_bound(AS_OF, DEFAULTS.max_history_days)
BOUND = rows.split_bound(AS_OF, DEFAULTS.val_days)
TRAIN_CAP = 5_000


def fresh_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.date_slice(flights(spark, sf_dir), "FL_DATE", START, AS_OF)


def date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rows.date_slice(flights(spark, sf_dir), "FL_DATE", dt.date(1997, 3, 1),
                                   dt.date(1998, 2, 28)).select(*ROW))


def date_slice_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fresh_slice(spark, sf_dir).select(*ROW))


def ingest_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = config_in(spark, "ingest")
    sinks.write_by_year(flights(spark, sf_dir, staging=True), config.raw_path, "FL_DATE")
    features.collect_raw_data(spark, config)
    return rounded(tables.read_parquet(spark, config.fresh_path).select(*ROW))


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = config_in(spark, "clean")
    sinks.write_snapshot(flights(spark, sf_dir, staging=True), config.fresh_path)
    features.clean_data(spark, config)
    return rounded(tables.read_parquet(spark, config.clean_path).select(*ROW))


def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.clean_counts(flights(spark, sf_dir), "ARR_DELAY")


def accumulate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slices that share five days; the shared days are kept once."""
    config = config_in(spark, "features")
    clean = rows.drop_null_target(flights(spark, sf_dir), config.target_column)
    for start, end in ((START, AS_OF - dt.timedelta(days=40)), (AS_OF - dt.timedelta(days=45), AS_OF)):
        sinks.write_snapshot(rows.date_slice(clean, config.date_dk, start, end), config.clean_path)
        features.concat_features(spark, config)
    return tables.read_parquet(spark, config.features_path).groupBy("FL_DATE").agg(
        F.count("*").alias("row_count"), F.round(F.sum("DEP_DELAY"), 6).alias("sum_dep_delay"),
        F.round(F.sum("ARR_DELAY"), 6).alias("sum_arr_delay"))


def prepare_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files in one folder per half and source year, shifted and trimmed; the second half's years begin in May,
    so that folders of one name in both halves have different modal years."""
    source, target = shared_folder(spark, "history-in"), shared_folder(spark, "history-out")
    half = (F.col("OP_CARRIER_FL_NUM") % 2).alias("half")
    year = F.year(F.when(F.col("half") == 0, F.col("FL_DATE")).otherwise(F.add_months("FL_DATE", 8)))
    (flights(spark, sf_dir, staging=True).select("*", half).withColumn("in_year", year).write
     .option("header", True).partitionBy("half", "in_year").csv(source))
    history.load_history(spark, source, target, level="folder")
    return rounded(tables.read_parquet(spark, target).select("year", *ROW))


def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.date_bounds(flights(spark, sf_dir), "FL_DATE")


def modal_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.modal_year(flights(spark, sf_dir), "FL_DATE")


def modal_year_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rows.modal_year_rows(flights(spark, sf_dir), "FL_DATE").select(*ROW))


def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = rows.time_split(flights(spark, sf_dir), "FL_DATE", BOUND)
    train, test = (part.agg(F.count("*").alias("row_count"), F.min("FL_DATE").alias("min_date"),
                            F.max("FL_DATE").alias("max_date")).select(F.lit(name).alias("part"), "*")
                   for name, part in zip(("train", "test"), parts))
    return train.unionByName(test)


def train_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day that stay in training under a cap of 5,000 rows, by the days' stored counts."""
    clean = rows.drop_null_target(flights(spark, sf_dir), "ARR_DELAY")
    path = shared_folder(spark, "days")
    sinks.write_snapshot(profile.day_stats(clean, "FL_DATE", INPUT_FEATURES), path)
    train, _ = rows.time_split(clean, "FL_DATE", BOUND)
    counts, _ = rows.time_split(tables.read_parquet(spark, path), "FL_DATE", BOUND)
    return rows.cap_newest(train, "FL_DATE", TRAIN_CAP, counts=counts).groupBy("FL_DATE").agg(F.count("*").alias("row_count"))


def day_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.day_stats(flights(spark, sf_dir), "FL_DATE", INPUT_FEATURES))


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` dropped as files in two steps, and a third run that finds none."""
    source, target = shared_folder(spark, "drops"), shared_folder(spark, "ingested")
    checkpoint = shared_folder(spark, "stream-state")
    events = table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    half = F.col("event_date") < F.lit(dt.date(2024, 1, 16))
    for drop in (events.where(half), events.where(~half), None):
        if drop is not None:
            drop.write.mode("append").parquet(source)
        run_stream(spark, source, target, checkpoint, events.schema, "event_date")
    return read_ingested(spark, target).groupBy("event_type").agg(
        F.count("*").alias("row_count"), F.round(F.sum("value"), 2).alias("sum_value"),
        F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"))


def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights of monthly schedules (dated by their month's first day) dropped in three parts at two sources,
    the second part sent to both, all read again by a new checkpoint: the feature table that collecting,
    cleaning and accumulating inside the stream give."""
    config = config_in(spark, "stream")
    one, other = shared_folder(spark, "drops"), shared_folder(spark, "drops")
    rows = flights(spark, sf_dir).withColumn("FL_DATE", F.trunc("FL_DATE", "month"))
    part = F.pmod(F.col("OP_CARRIER_FL_NUM"), F.lit(3))
    for source, sent in ((one, (0, 1)), (other, (1, 2))):
        for n in sent:
            rows.where(part == n).write.mode("append").parquet(source)
        ingest_features(spark, config, source, identity="content")
    ingest_features(spark, config, one, shared_folder(spark, "new-state"), identity="content")
    return tables.read_parquet(spark, config.features_path).groupBy("FL_DATE").agg(
        F.count("*").alias("row_count"), F.round(F.sum("DEP_DELAY"), 6).alias("sum_dep_delay"),
        F.round(F.sum("ARR_DELAY"), 6).alias("sum_arr_delay"))


def _sql(select: str, tail: str = "", table_name: str = "flights") -> str:
    return f"WITH {FLIGHTS_SQL} SELECT {select} FROM {table_name} {tail}"


_FRESH = f"FL_DATE BETWEEN DATE '{START}' AND DATE '{AS_OF}'"
_MODAL = """(SELECT CAST(year(FL_DATE) AS INTEGER) AS modal_year FROM flights
             GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""

QUERIES = {
    "date_slice": (date_slice, _sql(ROW_SQL, "WHERE FL_DATE BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'")),
    "date_slice_default": (date_slice_default, _sql(ROW_SQL, f"WHERE {_FRESH}")),
    "ingest_slice": (ingest_slice, _sql(ROW_SQL, f"WHERE {_FRESH}")),
    "clean_rows": (clean_rows, _sql(ROW_SQL, "WHERE ARR_DELAY IS NOT NULL")),
    "clean_counts": (clean_counts, _sql("count(*) AS rows_before, count(ARR_DELAY) AS rows_after")),
    "accumulate_features": (accumulate_features, _sql(
        "FL_DATE, count(*) AS row_count, round(sum(DEP_DELAY), 6) AS sum_dep_delay, "
        "round(sum(ARR_DELAY), 6) AS sum_arr_delay", f"WHERE {_FRESH} AND ARR_DELAY IS NOT NULL GROUP BY FL_DATE")),
    "prepare_history": (prepare_history, f"""WITH {FLIGHTS_SQL},
        shifted AS (SELECT * REPLACE (CAST(FL_DATE + 1825 AS DATE) AS FL_DATE), OP_CARRIER_FL_NUM % 2 AS half,
                      CASE WHEN OP_CARRIER_FL_NUM % 2 = 0 THEN year(FL_DATE) ELSE year(FL_DATE + INTERVAL 8 MONTH) END AS in_year
                    FROM flights WHERE DEP_DELAY IS NOT NULL),
        counts AS (SELECT half, in_year, year(FL_DATE) AS y, count(*) AS n FROM shifted GROUP BY ALL),
        modes AS (SELECT half, in_year, y FROM counts
                  QUALIFY row_number() OVER (PARTITION BY half, in_year ORDER BY n DESC, y) = 1)
        SELECT CAST(y AS INTEGER) AS year, {ROW_SQL} FROM shifted JOIN modes USING (half, in_year)
        WHERE year(FL_DATE) = y"""),
    "date_bounds": (date_bounds, _sql("min(FL_DATE) AS min_date, max(FL_DATE) AS max_date")),
    "modal_year": (modal_year, _sql("modal_year", table_name=_MODAL)),
    "modal_year_rows": (modal_year_rows, _sql(ROW_SQL, f"WHERE year(FL_DATE) = {_MODAL}")),
    "time_split": (time_split, _sql(
        f"CASE WHEN FL_DATE >= DATE '{BOUND}' THEN 'test' ELSE 'train' END AS part, count(*) AS row_count, "
        "min(FL_DATE) AS min_date, max(FL_DATE) AS max_date", "GROUP BY 1")),
    "day_stats": (day_stats, _sql("FL_DATE, count(*) AS n, " + ", ".join(
        f"count(*) - count({c}) AS nulls_{c}, round(coalesce(sum({c}), 0), 6) AS sum_{c}, "
        f"round(coalesce(sum({c} * {c}), 0), 6) AS squares_{c}" for c in INPUT_FEATURES), "GROUP BY FL_DATE")),
    "train_cap": (train_cap, f"""WITH {FLIGHTS_SQL},
        days AS (SELECT FL_DATE, count(*) AS n FROM flights
                 WHERE ARR_DELAY IS NOT NULL AND FL_DATE < DATE '{BOUND}' GROUP BY 1),
        running AS (SELECT *, sum(n) OVER (ORDER BY FL_DATE DESC) - n AS newer FROM days)
        SELECT FL_DATE, CAST(least(n, {TRAIN_CAP} - newer) AS BIGINT) AS row_count FROM running
        WHERE newer < {TRAIN_CAP}"""),
    "stream_features": (stream_features, _sql(
        "CAST(date_trunc('month', FL_DATE) AS DATE) AS FL_DATE, count(*) AS row_count, round(sum(DEP_DELAY), 6) AS sum_dep_delay, "
        "round(sum(ARR_DELAY), 6) AS sum_arr_delay", "WHERE ARR_DELAY IS NOT NULL GROUP BY 1")),
    "incremental_ingest": (incremental_ingest, """SELECT event_type, count(*) AS row_count,
        round(sum(value), 2) AS sum_value, min(CAST(ts AS DATE)) AS min_date, max(CAST(ts AS DATE)) AS max_date
        FROM events GROUP BY 1"""),
}
