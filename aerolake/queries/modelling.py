"""Training, scoring, comparison and exploration, with reference SQL.

Linear predictions have a closed form that SQL can follow: the weekday
indicators and the intercept amount to taking weekday means, and the four
numeric features are then handled one after the other, each on what the
earlier ones left over.
"""

from __future__ import annotations

import datetime as dt
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.config import INPUT_FEATURES
from aerolake.functions import draws, encoding
from aerolake.operators import bootstrap, metrics, rows
from aerolake.plans import exploration, scoring, training
from aerolake.queries.fixtures import FLIGHTS_SQL, flights, table
from aerolake.queries.preparation import BOUND, DEFAULTS
from aerolake.sources import sinks
from aerolake.sources.workspace import shared_folder

KEYS = ("FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST")
REPLICATES = 3000
SAMPLE_ROWS = 10_000


def _training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.time_split(training.model_frame(flights(spark, sf_dir), DEFAULTS), "FL_DATE", BOUND)[0]


def _validation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = rows.drop_null_target(flights(spark, sf_dir), "ARR_DELAY")
    return training.add_weekday_flags(rows.time_split(labelled, "FL_DATE", BOUND)[1])


def _validated(spark: SparkSession, sf_dir: str, model: PipelineModel) -> DataFrame:
    return training.predict(model, _validation_rows(spark, sf_dir))


def _fit(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return training.fit_model(_training_rows(spark, sf_dir), DEFAULTS)


def linreg_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir, _fit(spark, sf_dir)).select(
        *KEYS, F.round("prediction", 2).alias("prediction"))


def label_vs_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir, _fit(spark, sf_dir)).select(
        F.round("ARR_DELAY", 6).alias("label"), F.round("prediction", 2).alias("prediction"))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "model")
    _fit(spark, sf_dir).write().overwrite().save(path)
    return _validated(spark, sf_dir, PipelineModel.load(path)).select(
        *KEYS, F.round("prediction", 2).alias("prediction"))


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _validated(spark, sf_dir, _fit(spark, sf_dir))
    row = metrics.regression_metrics(scored, "ARR_DELAY")
    return row.select(*(F.round(c, 3).alias(c) for c in metrics.METRIC_NAMES))


def _score_csv(spark: SparkSession, sf_dir: str, vectors: str) -> str:
    source, target = shared_folder(spark, "to-score"), shared_folder(spark, "scores")
    sinks.write_csv(flights(spark, sf_dir, staging=True), source)
    scoring.score_batch(spark, DEFAULTS, _fit(spark, sf_dir), source, target, vectors=vectors)
    return target


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flight as CSV, scored, read back: inputs, filled inputs, prediction."""
    scores = spark.read.option("header", True).csv(_score_csv(spark, sf_dir, "drop"))
    return scores.select(
        *(F.col(c).cast("double").alias(c) for c in INPUT_FEATURES),
        *(F.col(f"flight_weekday_{k}").cast("int").alias(f"flight_weekday_{k}") for k in range(1, 8)),
        F.round(F.col("prediction").cast("double"), 2).alias("prediction"))


def score_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file written with the feature vector as JSON text, whose values
    are the filled inputs."""
    scores = spark.read.option("header", True).csv(_score_csv(spark, sf_dir, "json"))
    vector = F.from_json("features", "array<double>")
    return scores.select(
        *(F.round(vector[i], 6).alias(f"{c}_imputed") for i, c in enumerate(INPUT_FEATURES)),
        F.round(F.col("prediction").cast("double"), 2).alias("prediction"))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two predictors of an event's value, the second a little better."""
    value, noise = F.col("value"), ((F.col("event_id") * 37) % 41 - 20).cast("double")
    return table(spark, sf_dir, "events").select(
        "event_id", "value", (value * 0.8 + 10 + noise).alias("champion"),
        (value * 0.8 + 10 + noise * 0.98).alias("challenger"))


def _resamples(spark: SparkSession, sf_dir: str, replicates: int = REPLICATES) -> DataFrame:
    return bootstrap.bootstrap_r2(_predictions(spark, sf_dir), F.col("event_id"), "value",
                                  {"champion": "champion", "challenger": "challenger"}, replicates)


def bootstrap_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resamples(spark, sf_dir).select("replicate", "model", F.round("r2", 6).alias("r2"))


def bootstrap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrap.bootstrap_summary(_resamples(spark, sf_dir)).select(
        "model", "n", F.round("mean_r2", 6).alias("mean_r2"), F.round("var_r2", 10).alias("var_r2"))


def t_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = bootstrap.bootstrap_summary(_resamples(spark, sf_dir))
    return bootstrap.t_test(summary, "champion", "challenger").select(
        F.round("t_stat", 4).alias("t_stat"), "df", F.round("p_value", 6).alias("p_value"))


def promotion_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = bootstrap.promotion_decision(_resamples(spark, sf_dir), "champion", "challenger")
    return decision.select(F.round("t_stat", 4).alias("t_stat"), F.round("p_value", 6).alias("p_value"), "promote",
                           F.round("diff_p05", 6).alias("diff_p05"), F.round("diff_p95", 6).alias("diff_p95"))


def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.sample_exact(orders, SAMPLE_ROWS, "o_orderkey")


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = exploration.add_fold(table(spark, sf_dir, "orders"), F.col("o_orderkey"))
    return folded.groupBy("fold").agg(F.count("*").alias("row_count"),
                                      F.round(F.sum("o_totalprice"), 2).alias("sum_price"))


#: What a flight's fold is drawn from.
FOLD_KEY = ("CAST(FL_DATE AS STRING)", "OP_CARRIER", "CAST(OP_CARRIER_FL_NUM AS STRING)", "ORIGIN", "DEST",
            "CAST(CAST(CRS_DEP_TIME AS BIGINT) AS STRING)", "CAST(CAST(CRS_ARR_TIME AS BIGINT) AS STRING)")


def _exploration(spark: SparkSession, sf_dir: str, label) -> tuple[DataFrame, list[str]]:
    # A missing delay is a missing value for the regressor, which drops it, and a 0 of the classifier's label.
    flown = flights(spark, sf_dir)
    features = [c for c in encoding.numeric_columns(flown) if c != "DEP_DELAY"]
    key = F.concat_ws("|", *map(F.expr, FOLD_KEY))
    return exploration.exploration_frame(flown.withColumn("label", label), features, "label", key=key), features


def cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = exploration.cross_validate(*_exploration(spark, sf_dir, F.col("DEP_DELAY")), exploration.standardized_linear, exploration.negative_mae)
    return scores.select("fold", F.round("score", 6).alias("score"))


def logreg_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = exploration.cross_validate(*_exploration(spark, sf_dir, encoding.binary_label("DEP_DELAY")),
                                        exploration.standardized_logistic, exploration.accuracy)
    return scores.select("fold", F.round("score", 6).alias("score"))


def gbt_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = exploration.cross_validate(*_exploration(spark, sf_dir, encoding.binary_label("DEP_DELAY")),
                                         exploration.boosted_classifier, exploration.accuracy)
    values = exploration.cross_validate(*_exploration(spark, sf_dir, F.col("DEP_DELAY")), exploration.boosted_regressor, exploration.negative_mae)
    return classes.withColumn("model", F.lit("classifier")).unionByName(
        values.withColumn("model", F.lit("regressor")))


# The numeric columns of a flight but the delay that is predicted.
EXPLORED = ("OP_CARRIER_FL_NUM", "CRS_DEP_TIME", "DEP_TIME", "TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN", "CRS_ARR_TIME", "ARR_TIME",
            "ARR_DELAY", "CANCELLED", "DIVERTED", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME", "AIR_TIME", "DISTANCE")


def _folded_sql(label: str, where: str) -> str:
    """CTE ``train``: (fold, row, y, j, z) of every fold's training rows and ``test`` of its own: features
    j = 1.. filled and standardised by the training rows, and j = 0 the constant 1."""
    key = ", '|', ".join(e.replace("AS STRING", "AS VARCHAR") for e in FOLD_KEY)
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in EXPLORED)
    return f"""WITH {FLIGHTS_SQL},
      labelled AS MATERIALIZED (
        SELECT row_number() OVER () AS row, CAST({label} AS DOUBLE) AS y, [{values}] AS x,
               CAST(('0x' || substr(md5(concat(concat({key}), ':42')), 1, 8))::BIGINT % 5 AS INTEGER) AS own FROM flights {where}),
      long AS (SELECT row, own, y, unnest(range(1, {len(EXPLORED) + 1})) AS j, unnest(x) AS x FROM labelled),
      folds AS (SELECT unnest(range(5)) AS fold),
      fills AS MATERIALIZED (SELECT fold, j, avg(x) AS m FROM long JOIN folds ON own <> fold GROUP BY ALL),
      scales AS MATERIALIZED (SELECT fold, j, m, stddev_pop(coalesce(x, m)) AS s FROM long JOIN fills USING (j) WHERE own <> fold GROUP BY ALL),
      packed AS MATERIALIZED (
        SELECT fold, list(m ORDER BY j) AS m, list(CASE WHEN s > 0 THEN s ELSE 1 END ORDER BY j) AS s FROM scales GROUP BY fold),
      wide AS MATERIALIZED (
        SELECT fold, own = fold AS test, y, list_prepend(1.0::DOUBLE, list_transform(range(1, {len(EXPLORED) + 1}),
          lambda j: (coalesce(x[j], m[j]) - m[j]) / s[j])) AS z FROM labelled, packed)"""


def _solved_sql(name: str, cells: str, size: int) -> str:
    """CTEs that solve the system ``cells`` (fold, i, j, v; i from 0 to size - 1, j = size the right side)
    by elimination; ``name`` has (fold, w), the solution as a list."""
    ctes, last = [f"{name}_0 AS MATERIALIZED ({cells})"], f"{name}_0"
    for k in range(size):
        ctes.append(f"""{name}_{k + 1} AS MATERIALIZED (
          SELECT a.fold, a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v FROM {last} a
          JOIN {last} p ON p.fold = a.fold AND p.i = {k} AND p.j = {k}
          JOIN {last} c ON c.fold = a.fold AND c.i = a.i AND c.j = {k}
          JOIN {last} r ON r.fold = a.fold AND r.i = {k} AND r.j = a.j)""")
        last = f"{name}_{k + 1}"
    ctes.append(f"{name} AS MATERIALIZED (SELECT fold, list(v ORDER BY i) AS w FROM {last} WHERE j = {size} GROUP BY fold)")
    return ",\n".join(ctes)


@cache
def _cross_validate_sql() -> str:
    size = len(EXPLORED) + 1
    cells = f"""SELECT fold, i, j, sum(z[i + 1] * CASE WHEN j = {size} THEN y ELSE z[j + 1] END) AS v
        FROM wide, range({size}) AS a(i), range({size + 1}) AS b(j) WHERE NOT test GROUP BY ALL"""
    return f"""{_folded_sql("DEP_DELAY", "WHERE DEP_DELAY IS NOT NULL")},
      {_solved_sql("solved", cells, size)}
      SELECT fold, round(-avg(abs(y - list_inner_product(z, w))), 6) AS score FROM wide JOIN solved USING (fold) WHERE test GROUP BY fold"""


@cache
def _logreg_sql(steps: int = 7) -> str:
    """Newton steps, each solving for its coefficients: (Z'SZ + I) w = Z'(S Z w0 + y - p)."""
    size = len(EXPLORED) + 1
    ctes = [_folded_sql("CASE WHEN DEP_DELAY >= 0 THEN 1 ELSE 0 END", ""),
            f"w0 AS (SELECT fold, list_transform(range({size}), lambda i: 0.0::DOUBLE) AS w FROM folds)"]
    for t in range(1, steps + 1):
        ctes.append(f"""m{t} AS MATERIALIZED (SELECT fold, z, y, list_inner_product(z, w) AS a FROM wide JOIN w{t - 1} USING (fold) WHERE NOT test)""")
        ctes.append(f"""s{t} AS MATERIALIZED (SELECT fold, z, s, s * a + y - p AS r FROM (
          SELECT fold, z, y, a, 1 / (1 + exp(-a)) AS p, 1 / (1 + exp(-a)) * (1 - 1 / (1 + exp(-a))) AS s FROM m{t}))""")
        cells = f"""SELECT fold, i, j, sum(z[i + 1] * CASE WHEN j = {size} THEN r ELSE s * z[j + 1] END) + CASE WHEN i = j AND i > 0 THEN 1 ELSE 0 END AS v
          FROM s{t}, range({size}) AS a(i), range({size + 1}) AS b(j) GROUP BY fold, i, j"""
        ctes.append(_solved_sql(f"w{t}", cells, size))
    return ",\n".join(ctes) + f"""
      SELECT fold, round(avg(CAST(CAST(list_inner_product(z, w) > 0 AS DOUBLE) = y AS INTEGER)), 6) AS score
      FROM wide JOIN w{steps} USING (fold) WHERE test GROUP BY fold"""


@cache
def _linear_sql(bound: dt.date = BOUND) -> str:
    """CTE ``scored``: every flight with its filled features and prediction ``p`` by the fit on the rows before ``bound``."""
    xs = range(1, 5)
    ctes = [FLIGHTS_SQL,
            f"""base AS (SELECT *, dayofweek(FL_DATE) AS wd,
                FL_DATE < DATE '{bound}' AND ARR_DELAY IS NOT NULL AS fit FROM flights)""",
            "fill AS (SELECT " + ", ".join(f"avg({c}) AS f{i}" for i, c in enumerate(INPUT_FEATURES, 1))
            + " FROM base WHERE fit)",
            "filled AS (SELECT base.*, " + ", ".join(f"coalesce({c}, f{i}) AS x{i}"
                                                     for i, c in enumerate(INPUT_FEATURES, 1)) + " FROM base, fill)",
            "means AS (SELECT wd, avg(ARR_DELAY) AS my, " + ", ".join(f"avg(x{i}) AS m{i}" for i in xs)
            + " FROM filled WHERE fit GROUP BY wd)",
            "step0 AS (SELECT filled.*, my AS p, ARR_DELAY - my AS r, "
            + ", ".join(f"x{i} - m{i} AS z{i}" for i in xs) + " FROM filled JOIN means USING (wd))"]
    for i in xs:
        later = [j for j in xs if j > i]
        ctes.append(f"slope{i} AS (SELECT sum(z{i} * r) / sum(z{i} * z{i}) AS b"
                    + "".join(f", sum(z{i} * z{j}) / sum(z{i} * z{i}) AS g{j}" for j in later)
                    + f" FROM step{i - 1} WHERE fit)")
        replaced = [f"p + b * z{i} AS p", f"r - b * z{i} AS r", *(f"z{j} - g{j} * z{i} AS z{j}" for j in later)]
        gone = ", ".join(["b", *(f"g{j}" for j in later)])
        ctes.append(f"step{i} AS (SELECT * EXCLUDE ({gone}) REPLACE ({', '.join(replaced)}) "
                    f"FROM step{i - 1}, slope{i})")
    ctes.append("scored AS (SELECT * FROM step4)")
    return "WITH " + ",\n".join(ctes)


_VALIDATION = f"FROM scored WHERE FL_DATE >= DATE '{BOUND}' AND ARR_DELAY IS NOT NULL"
_PREDICTION_SQL = f"{_linear_sql()} SELECT {', '.join(KEYS)}, round(p, 2) AS prediction {_VALIDATION}"


def _mix_sql(x: str, source: str, keep: str) -> str:
    """Nested selects that scramble the 32-bit column ``x`` of ``source``."""
    first, second = draws.MULTIPLIERS
    return (f"(SELECT {keep}, xor({x}, {x} >> 16) AS {x} FROM "
            f"(SELECT {keep}, (xor({x}, {x} >> 15) * {second}) & {draws.MASK} AS {x} FROM "
            f"(SELECT {keep}, (xor({x}, {x} >> 16) * {first}) & {draws.MASK} AS {x} FROM {source})))")


@cache
def _resample_sql() -> str:
    """The draws of a table of one block: draw j of a replicate picks the row at place floor(u * n / 2**32)."""
    salts = ", ".join(f"({r}, CAST({draws.block_salt(42, r, 0)} AS BIGINT))" for r in range(REPLICATES))
    places = _mix_sql("u", "(SELECT CAST(range AS BIGINT) AS u FROM range((SELECT count(*) FROM events)))", "0 AS zero")
    drawn = _mix_sql("u", f"(SELECT replicate, xor(u, s) AS u FROM {places}, (VALUES {salts}) AS t(replicate, s))", "replicate")
    r2 = "1 - sum((y - {0}) * (y - {0})) / (sum(y * y) - sum(y) * sum(y) / count(*))"
    return f"""WITH noisy AS (SELECT event_id, value AS y, CAST((event_id * 37) % 41 - 20 AS DOUBLE) AS e FROM events),
      placed AS (SELECT row_number() OVER (ORDER BY event_id, y) - 1 AS place, y, y * 0.8 + 10 + e AS c, y * 0.8 + 10 + e * 0.98 AS d
                 FROM noisy),
      weighted AS (SELECT replicate, y, c, d FROM (
                     SELECT replicate, (u * (SELECT count(*) FROM events)) >> 32 AS place FROM {drawn}) JOIN placed USING (place)),
      resamples AS (
        SELECT replicate, 'champion' AS model, {r2.format('c')} AS r2 FROM weighted GROUP BY replicate
        UNION ALL
        SELECT replicate, 'challenger', {r2.format('d')} FROM weighted GROUP BY replicate),
      summary AS (SELECT model, count(*) AS n, avg(r2) AS m, var_samp(r2) AS v FROM resamples GROUP BY model),
      t AS (SELECT (a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n))
                   AS t_stat, CAST(a.n + b.n - 2 AS INTEGER) AS df
            FROM summary a, summary b WHERE a.model = 'champion' AND b.model = 'challenger'),
      -- one-sided p-value: Simpson's rule over the density between 0 and t
      grid AS (SELECT t_stat, df, t_stat * i / 4000 AS x, t_stat / 4000 AS h,
                      CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
               FROM t, range(4001) AS g(i)),
      tested AS (SELECT t_stat, df, 0.5 + sum(w * h / 3 * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0))
                        / sqrt(df * pi()) * pow(1 + x * x / df, -(df + 1) / 2.0)) AS p FROM grid GROUP BY t_stat, df)"""


_ORDER_DRAW = "CAST(concat('0x', substr(md5(concat(CAST(o_orderkey AS VARCHAR), ':42')), 1, 8)) AS BIGINT)"


QUERIES = {
    "linreg_predict": (linreg_predict, _PREDICTION_SQL),
    "label_vs_prediction": (label_vs_prediction, f"""{_linear_sql()}
        SELECT round(ARR_DELAY, 6) AS label, round(p, 2) AS prediction {_VALIDATION}"""),
    "model_roundtrip": (model_roundtrip, _PREDICTION_SQL),
    "regression_metrics": (regression_metrics, f"""{_linear_sql()},
        e AS (SELECT ARR_DELAY AS y, p {_VALIDATION}),
        my AS (SELECT avg(y) AS m FROM e)
        SELECT round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 3) AS r2,
               round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg((y - p) * (y - p)), 3) AS mse,
               round(avg(abs(y - p)), 3) AS mae, round(avg((p - m) * (p - m)), 3) AS var FROM e, my"""),
    "score_batch": (score_batch, f"""{_linear_sql()} SELECT {', '.join(INPUT_FEATURES)},
        {', '.join(f"CAST(wd + 1 = {k} AS INTEGER) AS flight_weekday_{k}" for k in range(1, 8))},
        round(p, 2) AS prediction FROM scored"""),
    "score_to_csv": (score_to_csv, f"""{_linear_sql()}
        SELECT {', '.join(f'round(x{i}, 6) AS {c}_imputed' for i, c in enumerate(INPUT_FEATURES, 1))},
               round(p, 2) AS prediction FROM scored"""),
    "bootstrap_r2": (bootstrap_r2, f"{_resample_sql()} SELECT replicate, model, round(r2, 6) AS r2 FROM resamples"),
    "bootstrap_summary": (bootstrap_summary, f"""{_resample_sql()} SELECT model, n, round(m, 6) AS mean_r2,
        round(v, 10) AS var_r2 FROM summary"""),
    "t_statistic": (t_statistic, f"""{_resample_sql()} SELECT round(t_stat, 4) AS t_stat, df,
        round(p, 6) AS p_value FROM tested"""),
    "promotion_decision": (promotion_decision, f"""{_resample_sql()},
        d AS (SELECT b.r2 - a.r2 AS d FROM resamples a JOIN resamples b USING (replicate)
              WHERE a.model = 'champion' AND b.model = 'challenger')
        SELECT round(t_stat, 4) AS t_stat, round(p, 6) AS p_value, p < 0.05 AS promote,
               (SELECT round(quantile_cont(d, 0.05), 6) FROM d) AS diff_p05,
               (SELECT round(quantile_cont(d, 0.95), 6) FROM d) AS diff_p95 FROM tested"""),
    "sample_n": (sample_n, f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY {_ORDER_DRAW}, o_orderkey LIMIT {SAMPLE_ROWS}"""),
    "cv_folds": (cv_folds, f"""SELECT CAST({_ORDER_DRAW} % 5 AS INTEGER) AS fold, count(*) AS row_count,
        round(sum(o_totalprice), 2) AS sum_price FROM orders GROUP BY 1"""),
    "cross_validate": (cross_validate, _cross_validate_sql()),
    "logreg_score": (logreg_score, _logreg_sql()),
    "gbt_score": (gbt_score, None),
}
