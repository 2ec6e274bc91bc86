"""Scans, sinks and state tables."""

import datetime as dt
import json
import os

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake import schema
from aerolake.operators import registry
from aerolake.queries import fixtures
from aerolake.sources import sinks, state, tables
from aerolake.sources.workspace import shared_folder
from helpers import DAY, days, flight, flights_frame


def test_missing_table_is_empty_but_a_broken_one_raises(spark, tmp_path):
    assert tables.read_if_exists(spark, str(tmp_path / "none"), schema.FLIGHT).count() == 0
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        tables.read_if_exists(spark, str(broken), schema.FLIGHT)


def test_csv_is_read_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("extra,DISTANCE,FL_DATE,DEP_DELAY,TAXI_OUT,CRS_ELAPSED_TIME\nx,1,2000-01-01,2,,NaN\n")
    row = tables.read_csv(spark, str(folder), schema.scoring_input()).first()
    assert row.asDict()["FL_DATE"] == DAY and (row.DISTANCE, row.DEP_DELAY, row.TAXI_OUT) == (1.0, 2.0, None)
    with pytest.raises(ValueError, match="ARR_DELAY"):
        tables.read_csv(spark, str(folder), T.StructType([T.StructField("ARR_DELAY", T.DoubleType())]))


def test_csv_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("y,x\n1,2\n")
    columns = T.StructType([T.StructField(c, T.DoubleType()) for c in "xy"])
    with pytest.raises(Exception, match="CSV header"):
        tables.read_csv(spark, str(folder), columns).collect()


def test_files_are_tagged_with_their_name(spark, tmp_path):
    for year in ("2001", "2002"):
        (tmp_path / "in" / year).mkdir(parents=True)
        (tmp_path / "in" / year / f"f{year}.csv").write_text(f"x\n{year}\n{year}\n")
    columns = T.StructType([T.StructField("x", T.IntegerType())])
    for level, names in (("file", ["f2001.csv", "f2002.csv"]), ("folder", ["2001", "2002"])):
        rows = tables.read_csv_files(spark, str(tmp_path / "in"), columns, level=level)
        assert sorted({(r.source_file, r.x) for r in rows.collect()}) == [(names[0], 2001), (names[1], 2002)]


def test_row_key_is_unique_and_stable(spark, tmp_path):
    spark.range(1000).repartition(4).write.parquet(str(tmp_path / "t"))
    keys = [{(r.id, r.k) for r in spark.read.parquet(str(tmp_path / "t"))
             .select("id", tables.row_key().alias("k")).collect()} for _ in range(2)]
    assert keys[0] == keys[1] and len({k for _, k in keys[0]}) == 1000


def test_replacing_days_twice_is_replacing_them_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first = flights_frame(spark, [flight(d, number=i) for i, d in enumerate(days(4))])
    second = flights_frame(spark, [flight(d, number=10 + i) for i, d in enumerate(days(3, DAY + dt.timedelta(3)))])
    sinks.replace_days(first, path, "FL_DATE")
    for _ in range(2):
        sinks.replace_days(second, path, "FL_DATE")
    numbers = sorted(r.OP_CARRIER_FL_NUM for r in spark.read.parquet(path).collect())
    assert numbers == [0, 1, 2, 10, 11, 12]


def test_writing_a_year_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "t")
    for carrier in ("AA", "BB"):
        sinks.write_by_year(flights_frame(spark, [flight(carrier=carrier)]), path, "FL_DATE")
    sinks.write_by_year(flights_frame(spark, [flight(dt.date(2001, 1, 1))]), path, "FL_DATE")
    assert sorted((r.year, r.OP_CARRIER) for r in spark.read.parquet(path).collect()) == [(2000, "BB"), (2001, "AA")]


def test_vectors_in_csv(spark, tmp_path):
    frame = spark.createDataFrame([(1, Vectors.dense(1.0, 2.5)), (2, Vectors.sparse(2, {1: 3.0}))], ["id", "v"])
    sinks.write_csv(frame, str(tmp_path / "json"))
    back = spark.read.option("header", True).csv(str(tmp_path / "json")).orderBy("id").collect()
    assert [json.loads(r.v) for r in back] == [[1.0, 2.5], [0.0, 3.0]]
    sinks.write_csv(frame, str(tmp_path / "drop"), vectors="drop")
    assert spark.read.option("header", True).csv(str(tmp_path / "drop")).columns == ["id"]


def test_appended_ids_rise_and_nulls_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "dataset_name string, row_count double, "
                                  "column_count double").withColumn("date", F.current_timestamp())
    seen = []
    for _ in range(2):
        sinks.append_with_id(batch, path, schema.MAIN_STATS)
        ids = {r.data_id for r in spark.read.parquet(path).collect()}
        assert len(ids) == len(seen) + 2
        assert min(ids - set(seen)) > max(seen, default=0)
        seen = sorted(ids)
    with pytest.raises(Exception, match="dataset_name must not be null"):
        sinks.append_with_id(batch.withColumn("dataset_name", F.lit(None).cast("string")), path, schema.MAIN_STATS)


def test_creating_a_table_keeps_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    columns = T.StructType([T.StructField("x", T.IntegerType())])
    sinks.create_if_absent(spark, path, columns)
    assert spark.read.parquet(path).schema == columns and spark.read.parquet(path).count() == 0
    spark.createDataFrame([(1,)], columns).write.mode("append").parquet(path)
    sinks.create_if_absent(spark, path, columns)
    assert spark.read.parquet(path).count() == 1


def test_watermark_is_kept_per_dataset(spark, tmp_path):
    path = str(tmp_path / "w")
    assert state.get_watermark(spark, path, "a") is None
    state.set_watermark(spark, path, "a", DAY)
    state.set_watermark(spark, path, "a", DAY + dt.timedelta(2))
    assert state.get_watermark(spark, path, "a") == DAY + dt.timedelta(2)
    assert state.get_watermark(spark, path, "b") is None


def test_registry_keeps_the_newest_state(spark, tmp_path):
    path = str(tmp_path / "r")
    columns = "name string, version int, stage string, path string"
    state.record_versions(spark, path, spark.createDataFrame(
        [("m", 1, "Production", "p1"), ("m", 10, "None", "p10"), ("m", 9, "None", "p9")], columns))
    versions = state.read_registry(spark, path)
    newest = registry.latest_version(versions)
    assert tuple(newest.first()) == ("m", 10, "p10")
    state.record_versions(spark, path, registry.promote_versions(versions, newest))
    now = {r.version: r.stage for r in state.read_registry(spark, path).collect()}
    assert now == {1: "Archived", 9: "None", 10: "Production"}


def test_promotion_leaves_other_names_alone(spark):
    versions = spark.createDataFrame([(1, "m", 1, "Production", ""), (2, "m", 2, "None", ""),
                                      (3, "n", 1, "Production", "")],
                                     "change_id long, name string, version long, stage string, path string")
    winners = spark.createDataFrame([("m", 2)], "name string, version long")
    got = {(r.name, r.version): r.stage for r in registry.promote_versions(versions, winners).collect()}
    assert got == {("m", 1): "Archived", ("m", 2): "Production", ("n", 1): "Production"}


def test_shared_folder_is_under_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(base) and shared_folder(spark, "x") != shared_folder(spark, "x")
    assert not os.path.exists(shared_folder(spark, "x"))


def test_staging_spreads_more_rows_over_more_tasks(spark, tmp_path, monkeypatch):
    lines = spark.range(600).coalesce(1).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "1D AS l_quantity", "1D AS l_extendedprice",
        "0D AS l_discount", "0D AS l_tax", "'A' AS l_returnflag", "'F' AS l_linestatus", "TIMESTAMP '2000-01-01' AS l_shipdate")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(fixtures, "STAGED_ROWS", 20)
    staged = fixtures.flights(spark, str(tmp_path), staging=True)
    assert staged.rdd.getNumPartitions() == 30
    assert staged.exceptAll(fixtures.flights(spark, str(tmp_path))).isEmpty() and staged.count() == 600
