"""The command line drives the same jobs."""

import datetime as dt

from aerolake import jobs
from aerolake.config import FlightConfig
from aerolake.sources import sinks
from test_pipelines import TODAY, raw_rows
from helpers import flights_frame


def test_history_to_scores(spark, tmp_path):
    prefix = str(tmp_path / "lake")
    config = FlightConfig(output_prefix=prefix, as_of=TODAY)
    old = flights_frame(spark, [(r[0] - dt.timedelta(days=1825), *r[1:]) for r in raw_rows(1500)])
    sinks.write_csv(old.coalesce(1), str(tmp_path / "history"))

    def run(job, *more):
        jobs.main([job, "--output-prefix", prefix, "--as-of", TODAY.isoformat(), "--replicates", "20", *more])

    run("load_history", "--input", str(tmp_path / "history"))
    for job in ("prepare_features", "train_model", "eval_model", "create_stats_tables", "update_main_stats",
                "update_features_stats", "add_new_metrics"):
        run(job)
    run("score", "--input", str(tmp_path / "history"), "--output", str(tmp_path / "scores"))
    assert spark.read.option("header", True).csv(str(tmp_path / "scores")).count() == 1500
    # The shift puts all days into 1999 and 2000; the fuller year stays.
    assert spark.read.parquet(config.raw_path).select("year").distinct().count() == 1
