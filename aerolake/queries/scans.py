"""Sources, sinks and projections over the test tables, with reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import schema
from aerolake.config import FLIGHT_COLUMNS, INPUT_FEATURES
from aerolake.functions import dates, encoding
from aerolake.operators import profile
from aerolake.queries.fixtures import FLIGHTS_SQL, flights, rounded, rounded_sql
from aerolake.sources import sinks, tables
from aerolake.sources.workspace import shared_folder

ROW = ("FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "DEP_DELAY", "TAXI_OUT",
       "ARR_DELAY", "CRS_ELAPSED_TIME", "DISTANCE")
ROW_SQL = rounded_sql(ROW)
ALL_SQL = rounded_sql(FLIGHT_COLUMNS)


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_parquet(spark, f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("l_shipdate"))


def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(flights(spark, sf_dir).select("FL_DATE", *INPUT_FEATURES, "ARR_DELAY"))


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir)
    return rounded(rows.drop("prediction").drop(rows["AIR_TIME"]))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    sinks.write_csv(flights(spark, sf_dir, staging=True), path)
    return rounded(tables.read_csv(spark, path, schema.FLIGHT))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "parquet")
    sinks.write_snapshot(flights(spark, sf_dir, staging=True), path)
    return rounded(tables.read_parquet(spark, path))


def _carrier_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV folders by carrier, of the same names below two folders; a row's label is its folder's path below them."""
    path = shared_folder(spark, "carriers")
    (flights(spark, sf_dir, staging=True).select(
        F.when(F.col("OP_CARRIER_FL_NUM") % 2 == 0, "even").otherwise("odd").alias("part"), F.col("OP_CARRIER").alias("carrier"), "*").write
     .option("header", True).partitionBy("part", "carrier").csv(path))
    return tables.read_csv_files(spark, path, schema.FLIGHT, level="folder_path")


def _below(label):
    return F.substring_index(label, "/", -2)


def scan_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_carrier_files(spark, sf_dir).select(_below("source_file").alias("source_file"), *ROW))


def file_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.file_profile(_carrier_files(spark, sf_dir), "source_file").withColumn("source_file", _below("source_file"))


def scan_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = tables.read_if_exists(spark, shared_folder(spark, "absent"), schema.FLIGHT)
    return rounded(nothing.unionByName(flights(spark, sf_dir)).select(*ROW))


def partition_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "years")
    sinks.write_by_year(flights(spark, sf_dir, staging=True), path, "FL_DATE")
    return tables.read_parquet(spark, path).groupBy("year").agg(
        F.count("*").alias("row_count"), F.min("FL_DATE").alias("min_date"),
        F.max("FL_DATE").alias("max_date"))


def date_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir).select(
        "FL_DATE", dates.shift_days("FL_DATE", 365 * 5).alias("shifted"), "OP_CARRIER_FL_NUM")


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = flights(spark, sf_dir).select(
        F.when(F.col("TAXI_IN") == 3, F.lit("no date")).otherwise(F.col("FL_DATE").cast("string")).alias("raw"),
        F.date_format("FL_DATE", "dd/MM/yyyy").alias("raw_dmy"))
    return text.select("raw", "raw_dmy", dates.parse_date("raw", strict=False).alias("parsed"),
                       dates.parse_date("raw_dmy", "dd/MM/yyyy").alias("parsed_dmy"))


def weekday_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.add_weekday_flags(flights(spark, sf_dir).select("FL_DATE", "OP_CARRIER_FL_NUM"))


def weekday_onehot_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir).select("FL_DATE", "OP_CARRIER_FL_NUM", *dates.weekday_flags_serving())


def binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir).select("FL_DATE", "OP_CARRIER_FL_NUM", "DEP_DELAY",
                                         encoding.binary_label("DEP_DELAY").alias("label"))


def numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir)
    return rounded(rows.select(*encoding.numeric_columns(rows)))


def onehot_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.one_hot(flights(spark, sf_dir).select("FL_DATE", "OP_CARRIER_FL_NUM", "OP_CARRIER"))


def onehot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the ones of a flight's carrier, airports and number among all values."""
    rows = flights(spark, sf_dir).select("FL_DATE", "OP_CARRIER_FL_NUM", "OP_CARRIER", "ORIGIN", "DEST",
                                         F.concat("OP_CARRIER", F.col("OP_CARRIER_FL_NUM").cast("string")).alias("FLIGHT"))
    return encoding.sparse_one_hot(rows).withColumn("flags", F.concat_ws(",", F.col("flags").cast("array<string>")))


def impute_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(encoding.surrogates(flights(spark, sf_dir), INPUT_FEATURES))


def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir).select("FL_DATE", *INPUT_FEATURES)
    return rounded(encoding.mean_imputer(INPUT_FEATURES).fit(rows).transform(rows))


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir).select("FL_DATE", *INPUT_FEATURES)
    return rounded(encoding.standardize(rows, encoding.fit_scaler(rows, INPUT_FEATURES)))


def _sql(select: str, tail: str = "") -> str:
    return f"WITH {FLIGHTS_SQL} SELECT {select} FROM flights {tail}"


_WEEKDAYS = ", ".join(f"CAST(dayofweek(FL_DATE) + 1 = {k} AS INTEGER) AS flight_weekday_{k}" for k in range(1, 8))
_SERVING = ", ".join(f"CAST(isodow(FL_DATE) - 1 = {k} AS INTEGER) AS flight_weekday_{k}" for k in range(1, 8))
_CARRIERS = ", ".join(f"CAST(OP_CARRIER = '{v}' AS INTEGER) AS OP_CARRIER_{v}"
                      for v in ("AF", "AO", "NF", "NO", "RF", "RO"))

_FOLDER = "concat(CASE WHEN OP_CARRIER_FL_NUM % 2 = 0 THEN 'part=even' ELSE 'part=odd' END, '/carrier=', OP_CARRIER)"

QUERIES = {
    "scan_parquet": (scan_parquet, "SELECT l_orderkey, l_linenumber, l_quantity, "
                     "CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem"),
    "project_columns": (project_columns, _sql(rounded_sql(["FL_DATE", *INPUT_FEATURES, "ARR_DELAY"]))),
    "drop_columns": (drop_columns, _sql(rounded_sql([c for c in FLIGHT_COLUMNS if c != "AIR_TIME"]))),
    "csv_roundtrip": (csv_roundtrip, _sql(ALL_SQL)),
    "parquet_roundtrip": (parquet_roundtrip, _sql(ALL_SQL)),
    "scan_multi_file": (scan_multi_file, _sql(f"{_FOLDER} AS source_file, {ROW_SQL}")),
    "file_profile": (file_profile, _sql(f"{_FOLDER} AS source_file, count(*) AS row_count, "
                                        "21 AS column_count", "GROUP BY 1")),
    "scan_if_exists": (scan_if_exists, _sql(ROW_SQL)),
    "partition_by_year": (partition_by_year, _sql(
        "CAST(year(FL_DATE) AS INTEGER) AS year, count(*) AS row_count, min(FL_DATE) AS min_date, "
        "max(FL_DATE) AS max_date", "GROUP BY 1")),
    "date_shift": (date_shift, _sql("FL_DATE, CAST(FL_DATE + 1825 AS DATE) AS shifted, OP_CARRIER_FL_NUM")),
    "parse_dates": (parse_dates, f"""WITH {FLIGHTS_SQL},
        t AS (SELECT CASE WHEN TAXI_IN = 3 THEN 'no date' ELSE strftime(FL_DATE, '%Y-%m-%d') END AS raw,
                     strftime(FL_DATE, '%d/%m/%Y') AS raw_dmy FROM flights)
        SELECT raw, raw_dmy, TRY_CAST(raw AS DATE) AS parsed,
               CAST(strptime(raw_dmy, '%d/%m/%Y') AS DATE) AS parsed_dmy FROM t"""),
    "weekday_onehot": (weekday_onehot, _sql(f"FL_DATE, OP_CARRIER_FL_NUM, {_WEEKDAYS}")),
    "weekday_onehot_serving": (weekday_onehot_serving, _sql(f"FL_DATE, OP_CARRIER_FL_NUM, {_SERVING}")),
    "binary_label": (binary_label, _sql(
        "FL_DATE, OP_CARRIER_FL_NUM, DEP_DELAY, CASE WHEN DEP_DELAY >= 0 THEN 1 ELSE 0 END AS label")),
    "numeric_columns": (numeric_columns, _sql(rounded_sql(
        [c for c in FLIGHT_COLUMNS if c not in ("FL_DATE", "OP_CARRIER", "ORIGIN", "DEST")]))),
    "onehot_categorical": (onehot_categorical, _sql(f"FL_DATE, OP_CARRIER_FL_NUM, {_CARRIERS}")),
    "onehot_sparse": (onehot_sparse, f"""WITH {FLIGHTS_SQL},
        f AS (SELECT row_number() OVER () AS row, FL_DATE, OP_CARRIER_FL_NUM, [OP_CARRIER, ORIGIN, DEST,
                concat(OP_CARRIER, CAST(OP_CARRIER_FL_NUM AS VARCHAR(20)))] AS v FROM flights),
        long AS (SELECT row, unnest(v) AS value, unnest(range(4)) AS c FROM f),
        known AS (SELECT c, value, row_number() OVER (ORDER BY c, count(*) DESC, value) - 1 AS place
                  FROM long WHERE value IS NOT NULL GROUP BY c, value),
        placed AS (SELECT row, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS flags
                   FROM long JOIN known USING (c, value) GROUP BY row)
        SELECT FL_DATE, OP_CARRIER_FL_NUM, coalesce(flags, '') AS flags FROM f LEFT JOIN placed USING (row)"""),
    "impute_surrogates": (impute_surrogates, _sql(", ".join(f"round(avg({c}), 6) AS {c}" for c in INPUT_FEATURES))),
    "impute_mean": (impute_mean, f"""WITH {FLIGHTS_SQL},
        m AS (SELECT {", ".join(f"avg({c}) AS m_{c}" for c in INPUT_FEATURES)} FROM flights)
        SELECT FL_DATE, {", ".join(f"round({c}, 6) AS {c}, round(coalesce({c}, m_{c}), 6) AS {c}_imputed"
                                   for c in INPUT_FEATURES)} FROM flights, m"""),
    "standardize": (standardize, f"""WITH {FLIGHTS_SQL},
        m AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in INPUT_FEATURES)} FROM flights)
        SELECT FL_DATE, {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in INPUT_FEATURES)}
        FROM flights, m"""),
}
