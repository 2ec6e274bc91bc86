"""Monitoring tables, run metrics and the model registry, with reference SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import schema
from aerolake.config import FLIGHT_COLUMNS, INPUT_FEATURES
from aerolake.operators import profile, registry
from aerolake.plans import monitoring
from aerolake.queries import fixtures
from aerolake.queries.fixtures import AS_OF, FLIGHTS_SQL, REGISTRY_SQL, RUNS_SQL, config_in, flights, rounded
from aerolake.queries.preparation import _FRESH, fresh_slice
from aerolake.sources import sinks, tables

AT = dt.datetime.combine(AS_OF, dt.time())


def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.feature_stats(fresh_slice(spark, sf_dir), INPUT_FEATURES))


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(flights(spark, sf_dir))


def main_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.main_stats(fresh_slice(spark, sf_dir), "prod_ds")


def append_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table's size and the fresh slice's size, appended one by one."""
    path = config_in(spark, "stats").stats_path("main_data_stats")
    for name, rows in (("all", flights(spark, sf_dir)), ("fresh", fresh_slice(spark, sf_dir))):
        stats = profile.main_stats(rows, name).withColumn("date", F.lit(AT))
        sinks.append_with_id(stats, path, schema.MAIN_STATS)
    return tables.read_parquet(spark, path).select("data_id", "dataset_name", "row_count", "column_count")


def stats_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the three stats tables after creating them twice and appending
    the flights' size and moments and every run's metrics."""
    config = config_in(spark, "schema")
    for _ in range(2):
        monitoring.create_stats_tables(spark, config)
    rows = flights(spark, sf_dir)
    batches = {
        "main_data_stats": profile.main_stats(rows, "all"),
        "features_stats": profile.feature_stats(rows, INPUT_FEATURES).withColumn("dataset_name", F.lit("all")),
        "model_metrics": registry.metrics_long(fixtures.runs(spark, sf_dir)).select(
            F.col("experiment").alias("model_name"), F.lit("all").alias("dataset_name"), "metric_name", "value"),
    }
    described = None
    for name, columns in monitoring.stats_tables(config).items():
        path = config.stats_path(name)
        sinks.append_with_id(batches[name].withColumn("date", F.lit(AT)), path, columns)
        stored = tables.read_parquet(spark, path)
        types = F.create_map(*(F.lit(x) for pair in stored.dtypes for x in pair))
        part = (stored.agg(*(F.count(c).alias(c) for c in stored.columns))
                .unpivot([], stored.columns, "column_name", "filled")
                .select(F.lit(name).alias("table_name"), "column_name",
                        types[F.col("column_name")].alias("data_type"), "filled"))
        described = part if described is None else described.unionByName(part)
    return described


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = registry.latest_run(fixtures.runs(spark, sf_dir))
    return newest.select("experiment", "run_id", "start_time", F.round(F.col("metrics")["r2"], 8).alias("r2"))


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(registry.metrics_long(fixtures.runs(spark, sf_dir)), 8)


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latest_version(fixtures.registry(spark, sf_dir))


def promote_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = fixtures.registry(spark, sf_dir)
    return registry.promote_versions(versions, registry.latest_version(versions))


def _moments(c: str) -> str:
    return (f"round(avg({c}), 6) AS mean_{c}, round(stddev_samp({c}), 6) AS std_{c}, "
            f"CAST(sum(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS nan_count_{c}, "
            f"round(avg(CAST({c} IS NULL AS INTEGER)), 6) AS nan_prop_{c}")


def _listing() -> str:
    """(table, column, type, filled) rows; run metrics: three per order."""
    from aerolake.config import FlightConfig

    names = {"bigint": "bigint", "double": "double", "string": "string", "timestamp": "timestamp"}
    parts = []
    for table, columns in monitoring.stats_tables(FlightConfig()).items():
        filled = "3 * (SELECT count(*) FROM orders)" if table == "model_metrics" else "1"
        parts += [f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, "
                  f"'{names[f.dataType.simpleString()]}' AS data_type, CAST({filled} AS BIGINT) AS filled"
                  for f in columns]
    return " UNION ALL ".join(parts)


QUERIES = {
    "feature_stats": (feature_stats, f"WITH {FLIGHTS_SQL} SELECT {', '.join(map(_moments, INPUT_FEATURES))} "
                                     f"FROM flights WHERE {_FRESH}"),
    "null_profile": (null_profile, f"WITH {FLIGHTS_SQL} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM flights" for c in FLIGHT_COLUMNS)),
    "main_stats": (main_stats, f"""WITH {FLIGHTS_SQL} SELECT 'prod_ds' AS dataset_name,
        CAST(count(*) AS DOUBLE) AS row_count, CAST(21 AS DOUBLE) AS column_count FROM flights WHERE {_FRESH}"""),
    "append_stats": (append_stats, f"""WITH {FLIGHTS_SQL}
        SELECT CAST(1 AS BIGINT) AS data_id, 'all' AS dataset_name, CAST(count(*) AS DOUBLE) AS row_count,
               CAST(21 AS DOUBLE) AS column_count FROM flights
        UNION ALL
        SELECT CAST(2 AS BIGINT), 'fresh', CAST(count(*) AS DOUBLE), CAST(21 AS DOUBLE)
        FROM flights WHERE {_FRESH}"""),
    "stats_schema": (stats_schema, _listing()),
    "latest_run": (latest_run, f"""WITH {RUNS_SQL} SELECT experiment, run_id, start_time, round(r2, 8) AS r2 FROM runs
        QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) = 1"""),
    "metrics_long": (metrics_long, f"WITH {RUNS_SQL} " + " UNION ALL ".join(
        f"SELECT experiment, run_id, start_time, '{m}' AS metric_name, round({m}, 8) AS value FROM runs"
        for m in ("r2", "rmse", "mae"))),
    "latest_version": (latest_version, f"""WITH {REGISTRY_SQL} SELECT name, version, path FROM registry
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1"""),
    "promote_version": (promote_version, f"""WITH {REGISTRY_SQL},
        newest AS (SELECT name, max(version) AS winner FROM registry GROUP BY name)
        SELECT change_id, name, version, CASE WHEN version = winner THEN 'Production'
               WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage, path
        FROM registry JOIN newest USING (name)"""),
}
