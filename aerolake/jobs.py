"""Command line: one sub-command per job, for a scheduler or ``spark-submit``.

    spark-submit jobs.py prepare_features --output-prefix s3a://lake/flights
    spark-submit jobs.py score --input s3a://in/data.csv --output s3a://out/preds
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from dataclasses import fields

from pyspark.sql import SparkSession

from aerolake.config import FlightConfig
from aerolake.plans import features, history, monitoring, scoring, training
from aerolake.streaming import incremental

STEPS = {
    "collect_raw_data": features.collect_raw_data,
    "clean_data": features.clean_data,
    "concat_features": features.concat_features,
    "prepare_features": features.prepare_features,
    "train_model": training.train_model,
    "eval_model": training.eval_model,
    "create_stats_tables": monitoring.create_stats_tables,
    "update_main_stats": monitoring.update_main_stats,
    "update_features_stats": monitoring.update_features_stats,
    "add_new_metrics": monitoring.add_new_metrics,
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="aerolake")
    parser.add_argument("job", choices=[*STEPS, "score", "load_history", "ingest_features"])
    parser.add_argument("--input", help="files to score, history files, or the folder of dropped files")
    parser.add_argument("--output", help="folder for predictions (score)")
    for field in fields(FlightConfig):
        convert = {"int": int, "int | None": int, "float": float, "str": str}.get(str(field.type))
        if field.name == "as_of":
            convert = dt.date.fromisoformat
        if convert:
            parser.add_argument(f"--{field.name.replace('_', '-')}", type=convert, default=field.default)
    return parser


def main(arguments: list[str] | None = None) -> None:
    options = vars(_parser().parse_args(arguments))
    job, source, target = (options.pop(name) for name in ("job", "input", "output"))
    config = FlightConfig(**options)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName(f"{config.dataset_name}/{job}").getOrCreate()
    if job == "score":
        model = training.load_model(spark, config, stage="Production")
        if model is None:
            raise SystemExit(f"No production version of {config.model_name}")
        scoring.score_batch(spark, config, model, source, target)
    elif job == "load_history":
        history.load_history(spark, source, config.raw_path)
    elif job == "ingest_features":
        incremental.ingest_features(spark, config, source)
    else:
        STEPS[job](spark, config)


if __name__ == "__main__":
    main()
