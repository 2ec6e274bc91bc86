"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the
data and the cores.  Every query's whole result is computed (noop sink).
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from aerolake.queries import CATALOG  # noqa: E402
from aerolake.queries.modelling import _resamples  # noqa: E402

HEADLINE = [
    "feature_stats", "date_slice", "clean_rows", "accumulate_features", "null_profile", "clean_counts",
    "weekday_onehot", "impute_mean", "standardize", "time_split", "modal_year_rows", "train_cap", "sample_n",
    "cv_folds", "metrics_long", "latest_run", "promote_version", "csv_roundtrip", "prepare_history",
    "linreg_predict", "regression_metrics", "score_batch", "promotion_decision", "incremental_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: CATALOG[name][0] for name in HEADLINE}
    # The full-size comparison: 3,000 resamples of two models.
    runs["bootstrap_3000"] = lambda s, d: _resamples(s, d, 3000)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()

    seconds = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
