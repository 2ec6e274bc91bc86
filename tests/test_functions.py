"""Dates, encodings and draws, with the edge cases a whole-table query misses."""

import datetime as dt
import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolake.functions import dates, draws, encoding


def test_weekday_conventions(spark):
    # 2000-01-02 is a Sunday and 2000-01-03 a Monday.
    rows = spark.createDataFrame([(dt.date(2000, 1, 2),), (dt.date(2000, 1, 3),), (None,)], "FL_DATE date")
    train = [[r[f"flight_weekday_{k}"] for k in range(1, 8)] for r in dates.add_weekday_flags(rows).collect()]
    serve = [list(r) for r in rows.select(*dates.weekday_flags_serving()).collect()]
    assert train == [[1, 0, 0, 0, 0, 0, 0], [0, 1, 0, 0, 0, 0, 0], [None] * 7]
    assert serve == [[0, 0, 0, 0, 0, 1, 0], [0] * 7, [0] * 7]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=30))
def test_one_weekday_per_date(spark, some_days):
    rows = dates.add_weekday_flags(spark.createDataFrame([(d,) for d in some_days], "FL_DATE date"))
    total = sum(F.col(f"flight_weekday_{k}") for k in range(1, 8))
    assert rows.where(total != 1).count() == 0


def test_shift_is_in_days_not_years(spark):
    row = spark.createDataFrame([(dt.date(2012, 1, 1),)], "d date").select(dates.shift_days("d", 365 * 5)).first()
    assert row[0] == dt.date(2016, 12, 30)


def test_unreadable_date_is_null_only_on_request(spark):
    rows = spark.createDataFrame([("2000-01-01",), ("never",)], "t string")
    assert [r[0] for r in rows.select(dates.parse_date("t", strict=False)).collect()] == [dt.date(2000, 1, 1), None]
    with pytest.raises(Exception, match="never"):
        rows.select(dates.parse_date("t")).collect()


def test_binary_label_of_missing_is_zero(spark):
    rows = spark.createDataFrame([(0.0,), (-1.0,), (None,), (2.0,)], "x double")
    assert [r[0] for r in rows.select(encoding.binary_label("x")).collect()] == [1, 0, 0, 1]


def test_nan_and_null_agree_after_ingest(spark):
    rows = encoding.nan_to_null(spark.createDataFrame([(float("nan"), 1), (None, 2), (3.0, 3)], "x double, i int"))
    assert rows.agg(F.count_if(F.col("x").isNull()), F.mean("x")).first() == (2, 3.0)


def test_imputer_agrees_with_surrogates(spark):
    rows = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 6), (5.0, None)], "x double, i int")
    fills = encoding.surrogates(rows, ["x", "i"]).first()
    assert (fills.x, fills.i) == (3.0, 3.0)
    filled = encoding.mean_imputer(["x", "i"]).fit(rows).transform(rows).collect()
    assert [r.x_imputed for r in filled] == [1.0, 3.0, 3.0, 5.0]
    assert [r.i_imputed for r in filled] == [1, 2, 6, 3]


def test_imputing_an_all_null_column_is_an_error(spark):
    with pytest.raises(Exception, match="surrogate cannot be computed"):
        encoding.mean_imputer(["x"]).fit(spark.createDataFrame([(None,)], "x double"))


def test_one_hot_of_every_text_column(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "a", "y")], "id int, s string, t string")
    got = encoding.one_hot(rows).orderBy("id")
    assert got.columns == ["id", "s_a", "s_b", "t_x", "t_y"]
    assert [tuple(r)[1:] for r in got.collect()] == [(1, 0, 1, 0), (0, 1, 0, 0), (1, 0, 0, 1)]


def test_one_hot_refuses_a_crowded_column(spark):
    rows = spark.range(20).select(F.col("id").cast("string").alias("s"))
    with pytest.raises(ValueError, match="Too many|too many"):
        encoding.one_hot(rows, max_values=10)


def test_sparse_one_hot_takes_any_domain(spark):
    values = [f"v{i:05d}" for i in range(3000)] + ["hot"] * 4000 + [None, "Hot", ""]
    rows = spark.createDataFrame([(i, v, "x" if i % 2 else None) for i, v in enumerate(values)], "id int, s string, t string")
    known = {(r["column"], r["value"]): r["index"] for r in encoding.dictionary(rows, ["s", "t"]).collect()}
    order = sorted({v for v in values if v is not None}, key=lambda v: (-values.count(v), v))
    assert known == {**{("s", v): i for i, v in enumerate(order)}, ("t", "x"): 0}
    got = {r.id: r.flags for r in encoding.sparse_one_hot(rows).collect()}
    assert got == {i: ([] if v is None else [known["s", v]]) + [len(order)] * (i % 2) for i, v in enumerate(values)}


def test_sparse_one_hot_by_a_known_dictionary(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "s string")
    later = spark.createDataFrame([(1, "b"), (2, "new"), (3, None)], "id int, s string")
    got = encoding.sparse_one_hot(later, ["s"], encoding.dictionary(train, ["s"]))
    assert {r.id: r.flags for r in got.collect()} == {1: [1], 2: [], 3: []}
    assert encoding.sparse_one_hot(train.limit(0)).collect() == []


def test_numbers_in_an_order_within_groups(spark):
    from aerolake.operators.numbering import numbered

    rows = [("one" if i % 3 else "other", (i * 7919) % 1000) for i in range(1000)]
    got = numbered(spark.createDataFrame(rows, "g string, v int").repartition(9), [F.desc("v")], "n", "g").collect()
    for g in ("one", "other"):
        want = sorted((v for k, v in rows if k == g), reverse=True)
        assert [r.v for r in sorted((r for r in got if r.g == g), key=lambda r: r.n)] == want
        assert sorted(r.n for r in got if r.g == g) == list(range(len(want)))


def test_standardize_uses_population_deviation_and_keeps_constants(spark):
    rows = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, c double")
    scaled = encoding.standardize(rows, encoding.fit_scaler(rows, ["x", "c"])).collect()
    assert [tuple(r) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]


def test_numeric_columns_leave_out_small_integers_and_booleans(spark):
    rows = spark.createDataFrame([], "a byte, b short, c int, d long, e float, f double, g boolean, h string, i date")
    assert encoding.numeric_columns(rows) == ["b", "c", "d", "e", "f"]


def test_draw_matches_the_digest(spark):
    keys = [0, 1, 2**40, -5]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r[0] for r in rows.select(draws.uniform32(F.col("k"), 7)).collect()]
    assert got == [int(hashlib.md5(f"{k}:7".encode()).hexdigest()[:8], 16) for k in keys]


def test_block_totals_of_all_blocks_add_up_and_are_multinomial():
    sizes, replicates = [500, 0, 1200, 300, 2000], 4000
    totals = np.array([draws.block_totals(sizes, b, replicates, 42) for b in range(len(sizes))])
    assert (totals.sum(axis=0) == sum(sizes)).all() and (totals >= 0).all()
    exact = np.random.default_rng(1).multinomial(sum(sizes), np.array(sizes) / sum(sizes), replicates).T
    assert np.allclose(totals.mean(axis=1), exact.mean(axis=1), atol=3)
    assert np.allclose(np.cov(totals), np.cov(exact), rtol=0.12, atol=40)
    assert (totals != [draws.block_totals(sizes, b, replicates, 43) for b in range(len(sizes))]).any()


def test_resample_weights_are_exact_and_independent():
    totals = [1000, 990, 0, 1010]
    weights = draws.resample_weights(1000, totals, [draws.block_salt(42, r, 3) for r in range(4)])
    assert weights.sum(axis=1).tolist() == totals
    shape = np.bincount(draws.resample_weights(100_000, [100_000], [draws.block_salt(7, 0, 0)])[0].astype(int)) / 100_000
    assert np.allclose(shape[:4], [0.3679, 0.3679, 0.1839, 0.0613], atol=0.006)
    many = draws.resample_weights(500, [500] * 300, [draws.block_salt(42, r, 0) for r in range(300)])
    between = np.corrcoef(many)[np.triu_indices(300, 1)]
    assert abs(between.mean()) < 0.002 and np.abs(between).max() < 0.25
    assert draws.resample_weights(0, [0], [1]).shape == (1, 0)


