"""Whole jobs, run the way a user runs them."""

import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake import FlightConfig, schema
from aerolake.functions import encoding
from aerolake.plans import exploration, features, history, monitoring, scoring, training
from aerolake.queries import modelling
from aerolake.sources import sinks, state, tables
from aerolake.streaming.incremental import incremental_ingest, ingest_features, read_ingested
from helpers import DAY, days, flight, flights_frame

TODAY = dt.date(2000, 3, 31)


@pytest.fixture
def config(tmp_path):
    return FlightConfig(output_prefix=str(tmp_path / "lake"), as_of=TODAY, replicates=40)


def raw_rows(n=2000, slope=0.9, seed=0):
    """Flights over the last 100 days whose arrival follows the departure."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        day = TODAY - dt.timedelta(days=int(i % 100))
        dep = float(rng.normal(10, 20))
        late = slope * dep + 3.0 * (day.isoweekday() % 7 == 0) + float(rng.normal(0, 5))
        rows.append(flight(day, number=i, dep=None if i % 50 == 0 else dep, taxi=float(rng.integers(5, 30)),
                           arr=None if i % 40 == 0 else late, elapsed=float(rng.integers(60, 300)),
                           distance=float(rng.integers(100, 2000))))
    return rows


def numbers(spark, path):
    return sorted(r.OP_CARRIER_FL_NUM for r in tables.read_parquet(spark, path).collect())


def test_ingest_moves_the_watermark_and_never_doubles_a_day(spark, config):
    sinks.write_by_year(flights_frame(spark, [flight(d, number=i) for i, d in enumerate(days(30))]),
                        config.raw_path, config.date_dk)
    first = replace(config, as_of=DAY + dt.timedelta(days=9))
    features.prepare_features(spark, first)
    assert numbers(spark, config.features_path) == list(range(10))
    second = replace(config, as_of=DAY + dt.timedelta(days=19))
    features.prepare_features(spark, second)
    assert numbers(spark, config.fresh_path) == list(range(9, 20))
    features.prepare_features(spark, second)
    assert numbers(spark, config.features_path) == list(range(20))
    mark = state.get_watermark(spark, config.watermark_path, config.dataset_name)
    assert mark == second.as_of


def test_accumulation_keeps_the_days_counts(spark, config):
    frame = flights_frame(spark, raw_rows(300))
    sinks.write_by_year(frame, config.raw_path, config.date_dk)
    for _ in range(2):
        features.prepare_features(spark, config)
    want = tables.read_parquet(spark, config.features_path).groupBy("FL_DATE").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, features.day_counts(spark, config).collect())) == sorted(map(tuple, want.collect()))
    added = replace(config, accumulate_mode="append_all")
    features.concat_features(spark, added)
    assert features.day_counts(spark, config).agg(F.sum("n")).first()[0] == tables.read_parquet(spark, config.features_path).count()
    # A table made without them is counted.
    assert features.day_counts(spark, replace(config, output_prefix=config.output_prefix + "-other")) is None


def test_append_all_keeps_the_shared_day_twice(spark, config):
    config = replace(config, accumulate_mode="append_all")
    frame = flights_frame(spark, [flight(d, number=i) for i, d in enumerate(days(3))])
    for start in (0, 2):
        sinks.write_snapshot(frame.where(F.col("OP_CARRIER_FL_NUM") >= start), config.clean_path)
        features.concat_features(spark, config)
    assert numbers(spark, config.features_path) == [0, 1, 2, 2]


def test_reordered_columns_are_matched_by_name(spark, config):
    frame = flights_frame(spark, [flight(DAY, dep=1.0, arr=9.0)])
    sinks.write_snapshot(frame, config.clean_path)
    features.concat_features(spark, config)
    later = flights_frame(spark, [flight(DAY + dt.timedelta(1), dep=1.0, arr=9.0)])
    sinks.write_snapshot(later.select(*reversed(later.columns)), config.clean_path)
    features.concat_features(spark, config)
    rows = tables.read_parquet(spark, config.features_path).collect()
    assert [(r.DEP_DELAY, r.ARR_DELAY) for r in rows] == [(1.0, 9.0)] * 2
    sinks.write_snapshot(later.drop("DISTANCE"), config.clean_path)
    with pytest.raises(ValueError, match="DISTANCE"):
        features.concat_features(spark, config)


def test_clean_needs_the_whole_contract(spark, config):
    sinks.write_snapshot(flights_frame(spark, [flight()]).drop("ORIGIN"), config.fresh_path)
    with pytest.raises(ValueError, match="ORIGIN"):
        features.clean_data(spark, config)


def test_train_compare_promote_monitor_and_score(spark, config, tmp_path):
    sinks.write_by_year(flights_frame(spark, raw_rows()), config.raw_path, config.date_dk)
    features.prepare_features(spark, config)

    metrics = training.train_model(spark, config)
    assert 0.85 < metrics["r2"] < 1 and set(metrics) == {"r2", "rmse", "mse", "mae", "var"}
    train, test = (tables.read_parquet(spark, p) for p in (config.train_path, config.test_path))
    bound = TODAY - dt.timedelta(days=7)
    assert train.agg(F.max("FL_DATE")).first()[0] < bound == test.agg(F.min("FL_DATE")).first()[0]
    assert "features" not in test.columns and not any(c.endswith("_imputed") for c in test.columns)

    # Nothing is in production yet, so the first version is promoted.
    assert training.load_model(spark, config, stage="Production") is None
    assert training.eval_model(spark, config) is True

    # A second version trained on bad data loses, a third on good data wins over it.
    bad = replace(config, max_train_size=12)
    training.train_model(spark, bad)
    assert training.eval_model(spark, config) is False
    stages = {r.version: r.stage for r in state.read_registry(spark, config.registry_path).collect()}
    assert stages == {1: "Production", 2: "None"}
    versions = spark.createDataFrame([(config.model_name, 2, "Production", config.model_path(2)),
                                      (config.model_name, 1, "Archived", config.model_path(1))],
                                     "name string, version int, stage string, path string")
    state.record_versions(spark, config.registry_path, versions)
    training.train_model(spark, config)
    assert training.eval_model(spark, config) is True
    stages = {r.version: r.stage for r in state.read_registry(spark, config.registry_path).collect()}
    assert stages == {1: "Archived", 2: "Archived", 3: "Production"}

    # Monitoring tables.
    at = dt.datetime(2000, 3, 31, 12)
    for _ in range(2):
        monitoring.create_stats_tables(spark, config)
        monitoring.update_main_stats(spark, config, at)
        monitoring.update_features_stats(spark, config, at)
        monitoring.add_new_metrics(spark, config, at)
    sizes = tables.read_parquet(spark, config.stats_path("main_data_stats")).collect()
    assert [(r.row_count, r.column_count) for r in sizes] == [(2000.0, 21.0)] * 2
    stats = tables.read_parquet(spark, config.stats_path("features_stats"))
    assert stats.columns == schema.features_stats().names
    assert [r.nan_count_DEP_DELAY for r in stats.collect()] == [40.0, 40.0]
    logged = tables.read_parquet(spark, config.stats_path("model_metrics")).collect()
    assert len(logged) == 10 and len({r.data_id for r in logged}) == 10
    assert {r.value for r in logged if r.metric_name == "r2"} == {metrics["r2"]}

    # Scoring from CSV with columns in another order and one to ignore.
    fresh = flights_frame(spark, raw_rows(50, seed=1))
    sinks.write_csv(fresh.select("DISTANCE", "ORIGIN", "FL_DATE", *FlightConfig().input_features[:3]),
                    str(tmp_path / "in"))
    model = training.load_model(spark, config, stage="Production")
    scoring.score_batch(spark, config, model, str(tmp_path / "in"), str(tmp_path / "out"))
    scores = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert scores.count() == 50 and {"prediction", "features", "DISTANCE_imputed"} <= set(scores.columns)
    want = sorted(r.prediction for r in model.transform(scoring.scoring_frame(fresh, config)).collect())
    assert sorted(float(r.prediction) for r in scores.collect()) == pytest.approx(want)

    # The old weekday numbering gives other scores; only asked for by name.
    other = model.transform(scoring.scoring_frame(fresh, config, "serving")).collect()
    assert sorted(r.prediction for r in other) != pytest.approx(want)


def test_training_takes_all_rows_of_a_large_table(spark, config):
    n = 5_000_400
    features_table = spark.range(n).selectExpr(
        "date_sub(DATE '2000-03-20', CAST(id % 2 AS INT)) AS FL_DATE", "CAST(id % 50 AS DOUBLE) AS DEP_DELAY",
        "CAST(id % 11 AS DOUBLE) AS TAXI_OUT", "CAST(id % 61 AS DOUBLE) AS CRS_ELAPSED_TIME", "CAST(id % 701 AS DOUBLE) AS DISTANCE",
        "CAST(id % 50 + id % 3 AS DOUBLE) AS ARR_DELAY")
    held_out = features_table.limit(50).withColumn("FL_DATE", F.lit(TODAY))
    sinks.write_snapshot(features_table.unionByName(held_out), config.features_path)
    training.train_model(spark, config)
    assert tables.read_parquet(spark, config.train_path).count() == n


def test_model_equals_least_squares(spark, config):
    """Against numpy on the same rows, with one indicator per weekday."""
    frame = training.model_frame(flights_frame(spark, raw_rows(600)), config)
    model = training.fit_model(frame, config)
    got = training.predict(model, frame).collect()
    table = np.array([[np.nan if r[c] is None else r[c] for c in config.model_features] for r in got], dtype=float)
    fills = np.nanmean(table, axis=0)
    table = np.where(np.isnan(table), fills, table)
    y = np.array([r.ARR_DELAY for r in got])
    weights = np.linalg.lstsq(table, y, rcond=None)[0]
    assert np.allclose([r.prediction for r in got], table @ weights, atol=1e-6)


def test_impute_scope(spark, config):
    train = training.model_frame(flights_frame(spark, [flight(d, dep=1.0, number=i) for i, d in enumerate(days(9))]),
                                 config)
    everything = train.unionByName(
        training.model_frame(flights_frame(spark, [flight(DAY, dep=11.0)] * 9), config))
    fills = [training.fit_model(train, config, on).stages[0].surrogateDF.first().DEP_DELAY
             for on in (None, everything)]
    assert fills == [1.0, 6.0]


def test_predict_replaces_old_results(spark, config):
    frame = training.model_frame(flights_frame(spark, raw_rows(300)), config)
    model = training.fit_model(frame, config)
    once = training.predict(model, frame)
    old = once.withColumn("features", F.lit(1)).withColumn("DISTANCE_imputed", F.lit(0.0))
    again = training.predict(model, old)
    assert again.columns == once.columns
    assert again.agg(F.sum("prediction")).first()[0] == pytest.approx(once.agg(F.sum("prediction")).first()[0])


def test_history_is_shifted_trimmed_and_written_by_year(spark, tmp_path):
    year = flights_frame(spark, [flight(dt.date(2011, 12, 31), number=1), flight(dt.date(2011, 6, 1), number=2),
                                 flight(dt.date(2011, 1, 1), number=3), flight(dt.date(2011, 2, 1), number=4, dep=None)])
    sinks.write_csv(year, str(tmp_path / "in" / "2011"))
    history.load_history(spark, str(tmp_path / "in"), str(tmp_path / "out"), level="folder")
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("FL_DATE").collect()
    # 1,825 days on, 2011-01-01 is 2015-12-31 and is trimmed.
    assert [(r.year, r.OP_CARRIER_FL_NUM) for r in rows] == [(2016, 2), (2016, 1)]


def test_cross_validation_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(0, 0.5, 300)
    frame = exploration.exploration_frame(
        spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, y double"),
        ["a", "b"], "y")
    scores = {r.fold: r.score for r in exploration.cross_validate(
        frame, ["a", "b"], exploration.standardized_linear, exploration.negative_mae).collect()}
    rows = np.array([(r.a, r.b, 1.0, r.label, r.fold) for r in frame.collect()])
    assert len(rows) == 300 and sorted(scores) == [0, 1, 2, 3, 4]
    for fold, score in scores.items():
        out = rows[:, 4] == fold
        weights = np.linalg.lstsq(rows[~out, :3], rows[~out, 3], rcond=None)[0]
        assert score == pytest.approx(-np.abs(rows[out, 3] - rows[out, :3] @ weights).mean(), abs=1e-6)


def test_cross_validation_fills_missing_features_in_each_fold(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(3, 1, size=(300, 2))
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(0, 0.5, 300)
    given = [(float(a) if i % 4 else None, float(b) if i % 7 else float("nan"), None, float(v) if i % 10 else None)
             for i, ((a, b), v) in enumerate(zip(x, y))]
    frame = exploration.exploration_frame(
        spark.createDataFrame(given, "a double, b double, none double, y double"), ["a", "b", "none"], "y")
    scores = {r.fold: r.score for r in exploration.cross_validate(
        frame, ["a", "b", "none"], exploration.standardized_linear, exploration.negative_mae).collect()}
    rows = np.array([(r.a, r.b, 1.0, r.label, r.fold) for r in frame.collect()], dtype=float)
    assert len(rows) == 270
    for fold, score in scores.items():
        out = rows[:, 4] == fold
        filled = np.where(np.isnan(rows[:, :3]), np.nanmean(rows[~out, :3], axis=0), rows[:, :3])
        weights = np.linalg.lstsq(filled[~out], rows[~out, 3], rcond=None)[0]
        assert score == pytest.approx(-np.abs(rows[out, 3] - filled[out] @ weights).mean(), abs=1e-6)


def test_exploration_queries_use_all_labelled_rows(spark):
    sf_dir = "/root/testdata/sf0.001"
    flown = modelling.flights(spark, sf_dir)
    classes = modelling._exploration(spark, sf_dir, encoding.binary_label("DEP_DELAY"))[0]
    values = modelling._exploration(spark, sf_dir, F.col("DEP_DELAY"))[0]
    assert classes.count() == flown.count()
    assert values.count() == flown.where("DEP_DELAY IS NOT NULL").count() < flown.count()


def test_stream_reads_each_file_once_and_keeps_late_rows(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    frame = flights_frame(spark, [flight(d, number=i) for i, d in enumerate(days(6))] + [flight(arr=None, number=99)])

    def run():
        incremental_ingest(spark, source, table, checkpoint, schema.FLIGHT, "FL_DATE",
                           lambda rows: rows.where(F.col("ARR_DELAY").isNotNull()))
        return sorted(r.OP_CARRIER_FL_NUM for r in read_ingested(spark, table).collect())

    frame.where("OP_CARRIER_FL_NUM >= 2").write.mode("append").parquet(source)
    assert run() == [2, 3, 4, 5]
    # The second drop is late: its days are older than what is stored, or shared.
    frame.where("OP_CARRIER_FL_NUM <= 2").write.mode("append").parquet(source)
    assert run() == [0, 1, 2, 2, 3, 4, 5]
    assert run() == [0, 1, 2, 2, 3, 4, 5]


def test_a_second_source_and_a_new_checkpoint_lose_nothing(spark, tmp_path):
    one, two, table = (str(tmp_path / n) for n in ("one", "two", "out"))
    frame = flights_frame(spark, [flight(number=i) for i in range(6)])

    def run(source, checkpoint):
        incremental_ingest(spark, source, table, str(tmp_path / checkpoint), schema.FLIGHT, "FL_DATE")
        return sorted(r.OP_CARRIER_FL_NUM for r in read_ingested(spark, table).collect())

    frame.where("OP_CARRIER_FL_NUM < 4").coalesce(1).write.parquet(one)
    assert run(one, "a") == [0, 1, 2, 3]
    frame.where("OP_CARRIER_FL_NUM >= 4").coalesce(1).write.parquet(two)
    assert run(two, "b") == [0, 1, 2, 3, 4, 5]
    # A new checkpoint reads old files again, which adds nothing.
    assert run(one, "c") == [0, 1, 2, 3, 4, 5]
    # One folder a day, however many batches.
    assert len(list((tmp_path / "out").glob("FL_DATE=*"))) == 1


@pytest.mark.parametrize("identity, want", [("path", [0, 0, 1, 1]), ("content", [0, 1])])
def test_a_file_sent_again_under_another_name(spark, tmp_path, identity, want):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        flights_frame(spark, [flight(number=i, dep=None) for i in range(2)]).coalesce(1).write.mode("append").parquet(source)
        incremental_ingest(spark, source, table, str(tmp_path / "state"), schema.FLIGHT, "FL_DATE", identity=identity)
    assert sorted(r.OP_CARRIER_FL_NUM for r in read_ingested(spark, table).collect()) == want


def test_a_batch_that_died_while_publishing_is_completed(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    flights_frame(spark, [flight(number=i) for i in range(2)]).coalesce(1).write.parquet(source)

    def run(after=None):
        incremental_ingest(spark, source, table, checkpoint, schema.FLIGHT, "FL_DATE", after=after)

    def dies(days):
        raise RuntimeError("killed")

    run()
    flights_frame(spark, [flight(number=2), flight(None, number=3)]).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="killed"):
        run(dies)
    # The day had been replaced half-way: its folder is gone.
    for old in (tmp_path / "out").glob("FL_DATE=2000-01-01/*.parquet"):
        old.unlink()
    seen = []
    run(lambda days: seen.append(sorted(r.OP_CARRIER_FL_NUM for r in days.collect())))
    assert sorted(r.OP_CARRIER_FL_NUM for r in read_ingested(spark, table).collect()) == [0, 1, 2, 3]
    assert seen[0] == [0, 1, 2, 3] and not (tmp_path / "out__pending").exists()


def test_features_are_prepared_inside_the_stream(spark, config, tmp_path):
    source = str(tmp_path / "drops")
    frame = flights_frame(spark, raw_rows(500))
    for part in (frame.where("OP_CARRIER_FL_NUM % 2 = 0"), frame.where("OP_CARRIER_FL_NUM % 2 = 1")):
        part.write.mode("append").parquet(source)
        ingest_features(spark, config, source)
    sinks.write_by_year(frame, config.raw_path, config.date_dk)
    batch = replace(config, output_prefix=str(tmp_path / "batch"))
    sinks.write_by_year(frame, batch.raw_path, config.date_dk)
    features.prepare_features(spark, batch)
    got, want = (tables.read_parquet(spark, c.features_path) for c in (config, batch))
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == want.count()
    assert state.get_watermark(spark, config.watermark_path, config.dataset_name) == TODAY


def test_history_files_of_one_name_are_judged_each_by_itself(spark, tmp_path):
    for year, n in ((2010, 3), (2011, 2)):
        rows = flights_frame(spark, [flight(dt.date(year, 6, 1), number=i) for i in range(n)])
        (tmp_path / "in" / str(year)).mkdir(parents=True)
        rows.toPandas().to_csv(tmp_path / "in" / str(year) / "flights.csv", index=False)
    history.load_history(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out")).groupBy("year").count().collect()
    assert sorted(r["count"] for r in found) == [2, 3]


def test_a_file_whose_content_is_stored_rewrites_nothing(spark, tmp_path):
    source, table = str(tmp_path / "in"), tmp_path / "out"
    flights_frame(spark, [flight(number=i) for i in range(2)]).coalesce(1).write.parquet(source)
    kept = []
    for state_of in ("a", "b"):
        incremental_ingest(spark, source, str(table), str(tmp_path / state_of), schema.FLIGHT, "FL_DATE", identity="content")
        kept.append(sorted(p.name for p in table.rglob("*.parquet")))
    assert kept[0] == kept[1]
    flights_frame(spark, [flight(number=2)]).coalesce(1).write.mode("append").parquet(source)
    incremental_ingest(spark, source, str(table), str(tmp_path / "c"), schema.FLIGHT, "FL_DATE", identity="content")
    assert sorted(r.OP_CARRIER_FL_NUM for r in read_ingested(spark, str(table)).collect()) == [0, 1, 2]


def test_history_rows_are_not_shuffled_for_their_years(spark, tmp_path, monkeypatch):
    flights_frame(spark, [flight(number=i) for i in range(3)]).write.option("header", True).csv(str(tmp_path / "in"))
    plans, write = [], sinks.write_by_year

    def written(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, *args)

    monkeypatch.setattr(sinks, "write_by_year", written)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history.load_history(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
