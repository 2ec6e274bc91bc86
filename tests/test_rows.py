"""Slices, splits, caps and samples."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolake.operators import checks, profile, rows
from helpers import DAY, days, flight, flights_frame


def test_slice_is_closed_and_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(d, i) for i, d in enumerate(days(5))], "d date, i int").write.parquet(path)
    kept = rows.date_slice(spark.read.parquet(path), "d", DAY + dt.timedelta(1), DAY + dt.timedelta(3))
    assert sorted(r.i for r in kept.collect()) == [1, 2, 3]
    plan = kept._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(d,2000-01-02)" in plan and "LessThanOrEqual(d,2000-01-04)" in plan


def test_slice_prunes_year_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    dated = spark.createDataFrame([(dt.date(y, 6, 1), y) for y in range(1995, 2001)], "d date, year int")
    dated.write.partitionBy("year").parquet(path)
    kept = rows.date_slice(spark.read.parquet(path), "d", dt.date(1998, 1, 1), dt.date(1999, 12, 31), "year")
    assert kept.count() == 2
    assert "PartitionFilters: [isnotnull(year" in kept._jdf.queryExecution().toString()


def test_target_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0,), (None,)], "y double").write.parquet(path)
    kept = rows.drop_null_target(spark.read.parquet(path), "y")
    assert kept.count() == 1 and "PushedFilters: [IsNotNull(y)]" in kept._jdf.queryExecution().toString()


def test_split_parts_and_null_dates_make_up_all_rows(spark):
    some = [flight(d) for d in days(10)] + [flight(None)]
    frame = flights_frame(spark, some)
    bound = rows.split_bound(DAY + dt.timedelta(days=10), 7)
    train, test = rows.time_split(frame, "FL_DATE", bound)
    assert (train.count(), test.count()) == (3, 7)
    assert train.count() + test.count() + frame.where("FL_DATE IS NULL").count() == len(some)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=0, max_size=40), st.integers(1, 45))
def test_cap_keeps_the_newest_days(spark, offsets, cap):
    frame = spark.createDataFrame([(DAY + dt.timedelta(days=o), i) for i, o in enumerate(offsets)], "d date, i int")
    kept = rows.cap_newest(frame, "d", cap).collect()
    assert len(kept) == min(cap, len(offsets))
    if offsets:
        counts = profile.day_stats(frame, "d", ["i"])
        halves = counts.withColumn("n", F.lit(1).cast("long")).unionByName(counts.withColumn("n", F.col("n") - 1))
        assert sorted(rows.cap_newest(frame, "d", cap, counts=halves).collect()) == sorted(kept)
    assert len({r.i for r in kept}) == len(kept)
    newest_first = sorted((DAY + dt.timedelta(days=o) for o in offsets), reverse=True)[:cap]
    assert Counter(r.d for r in kept) == Counter(newest_first)


def test_cap_of_copies_is_exact(spark):
    """A third of the day is one row, copied."""
    same = [(DAY, 7)] * 300 + [(DAY, i) for i in range(1000, 1600)]
    kept = rows.cap_newest(spark.createDataFrame(same, "d date, i int"), "d", 450)
    assert kept.count() == 450
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, kept.collect()))


def test_very_many_copies_are_dealt_out_in_parts(spark, monkeypatch):
    monkeypatch.setattr(rows, "COPIES_AT_ONCE", 7)
    copies = spark.createDataFrame([(1, "a")] * 100 + [(2, "b")] * 5, "i int, s string")
    for n, want in ((50, 50), (103, 100), (105, 100)):
        taken = rows._take_copies(copies, n).collect()
        assert len(taken) == n and sum(r.i == 1 for r in taken) == want


def test_day_stats_merge_to_those_of_all_rows(spark):
    frame = flights_frame(spark, [flight(d, dep=float(i) if i % 3 else None) for i, d in enumerate(days(6) * 4)])
    whole = profile.day_stats(frame, "FL_DATE", ["DEP_DELAY"])
    parts = [profile.day_stats(frame.where(F.col("DEP_DELAY").isNull() == missing), "FL_DATE", ["DEP_DELAY"]) for missing in (True, False)]
    merged = profile.merged_days(parts[0].unionByName(parts[1]), "FL_DATE")
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    one = whole.where(F.col("FL_DATE") == F.lit(DAY)).first()
    assert (one.n, one.nulls_DEP_DELAY) == (4, 4) or one.squares_DEP_DELAY > 0


@pytest.mark.parametrize("n", [0, 1, 99, 100, 101, 1999, 2000, 2001])
def test_sample_is_exact_and_equals_a_sort(spark, n):
    frame = spark.range(2000).withColumn("v", F.col("id") * 2)
    kept = [r.id for r in rows.sample_exact(frame, n, "id", seed=3).collect()]
    assert len(kept) == len(set(kept)) == min(n, 2000)
    ordered = frame.orderBy(rows_draw("id", 3), "id").limit(n)
    assert sorted(kept) == sorted(r.id for r in ordered.collect())


def rows_draw(key, seed):
    from aerolake.functions.draws import uniform32

    return uniform32(F.col(key), seed)


def test_sample_with_a_repeated_key_is_still_exact(spark):
    frame = spark.range(900).select((F.col("id") % 2).alias("k"), "id")
    assert rows.sample_exact(frame, 500, "k").distinct().count() == 500


def test_modal_year_tie_goes_to_the_earliest(spark):
    frame = spark.createDataFrame([(dt.date(y, 1, 1),) for y in (2001, 1999, 2001, 1999, 2000)] + [(None,)], "d date")
    assert profile.modal_year(frame, "d").first()[0] == 1999
    assert {r.d.year for r in rows.modal_year_rows(frame, "d").collect()} == {1999}


def test_modal_year_of_nothing(spark):
    frame = spark.createDataFrame([], "d date")
    assert profile.modal_year(frame, "d").first()[0] is None
    assert rows.modal_year_rows(frame, "d").count() == 0


def test_stats_of_no_rows(spark):
    frame = flights_frame(spark, [])
    row = profile.feature_stats(frame, ["DEP_DELAY"]).first()
    assert tuple(row) == (None, None, None, None)
    assert profile.main_stats(frame, "x").first().row_count == 0.0
    assert profile.clean_counts(frame, "ARR_DELAY").first() == (0, 0)


def test_stats_are_one_aggregate(spark):
    plan = profile.feature_stats(flights_frame(spark, [flight()]), ["DEP_DELAY", "TAXI_OUT"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_column_checks(spark):
    frame = spark.createDataFrame([], "a int, b string")
    assert checks.require_columns(frame, ["a"]) is frame
    with pytest.raises(ValueError, match="'c'"):
        checks.require_columns(frame, ["a", "c"])
    checks.require_same_columns(frame, frame.select("b", "a"))
    with pytest.raises(ValueError, match="only new"):
        checks.require_same_columns(frame, frame.select("a"))
    with pytest.raises(ValueError, match="types"):
        checks.require_same_columns(frame, frame.select(F.col("a").cast("long"), "b"))
