"""Quality scores by positive-unlabelled learning.

Only trusted positives are learnt from; all documents together are the unlabelled
mixture.  A document is a vector of style bytes (:mod:`style`), and the model is
linear, g(x) = w x, with the squared loss (1 - y g)^2 / 4.

* Class prior: a first model tells half of the positives from the unlabelled rows.
  Where the share of unlabelled rows above a threshold, over that of the positives
  of the other half, is least (with a confidence margin), the rows above hold next
  to no negatives, and the ratio is the share of positives among all.
* Non-negative risk: with prior p the risk is p R_pos(+) + max(0, R_unl(-) - p R_pos(-));
  the negatives' part, estimated as a difference, may not fall below 0.  Each R is a
  quadratic form of w given by the sums of x and x x' over its rows.  These sums are
  exact whole numbers and of fixed size, one aggregate over all rows takes them, and
  the risk over all rows is minimised on the driver without a sample of any kind.
* The score is P(positive | g): by bins of g the prior times the positives' density over that
  of all rows, made rising by pooling, and followed by a logistic curve.  The positives' g
  come from models that have not seen them, each learnt from the other half.

Defined results: a null text is empty and scored by its length alone; positives that
name no row, and null keys, are not learnt from; repeated rows weigh as often as
they stand; without positives every score is 0.5, without rows there are none.
Labels, language, source and key are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm import style
from aerolake.llm.common import stored

#: Ridge on the weights, descent steps at most, and the relative gain that ends the descent.
RIDGE, STEPS, GAIN = 1e-4, 500, 1e-9
#: g is counted in so many bins from -2 to 2; the bins at the ends have what lies beyond.
BINS, REACH = 2000, 2.0
#: Ridge on the slope of the logistic curve.
SLOPE_RIDGE = 1e-4
#: Confidence of the class prior's margin, and the weight of the margin.
DELTA, MARGIN = 0.1, 1.01
_TRIANGLE = np.triu_indices(style.WIDTH + 1)


@dataclass
class Model:
    weights: np.ndarray | None  # of the style bytes / 255 and a constant
    prior: float | None = None
    curve: tuple[float, float] = (1.0, 0.0)

    def margins(self, described: np.ndarray) -> np.ndarray:
        """g of each row of style bytes."""
        return described @ (self.weights[:-1] / 255) + self.weights[-1]

    def scores(self, described: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(described), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * self.margins(described) + self.curve[1], -500, 500)))


@dataclass
class Sums:
    """Number of rows, mean of x and mean of x x' (x: style bytes / 255 and a constant 1)."""

    n: int
    mean: np.ndarray
    gram: np.ndarray

    def risk(self, w: np.ndarray, y: int) -> float:
        """Mean of (1 - y g)^2 / 4."""
        return (1 - 2 * y * self.mean @ w + w @ self.gram @ w) / 4

    def slope(self, w: np.ndarray, y: int) -> np.ndarray:
        return (self.gram @ w - y * self.mean) / 2


def _bytes(batch: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(batch.to_pylist()), np.uint8).reshape(-1, style.WIDTH)


def described(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Written rows (key, style) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = style.describe(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in found], pa.binary())], ["key", "style"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return stored(rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, style binary"), "style", "zstd")


def sums(rows: DataFrame, kinds: int = 1) -> list[Sums]:
    """Sums over the rows (style, kind), by kind; one aggregate of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kinds, len(_TRIANGLE[0])))
        for batch in batches:
            of = batch.column(1).to_numpy(zero_copy_only=False)
            x = np.hstack([_bytes(batch.column(0)).astype(np.float64), np.ones((batch.num_rows, 1))])
            for kind in range(kinds):
                part = x[of == kind]
                total[kind] += (part.T @ part)[_TRIANGLE]  # below 2^53, so exact
        for kind in range(kinds):
            if total[kind, -1]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(total.shape[1], kind, np.int32)), pa.array(np.arange(total.shape[1], dtype=np.int32)), pa.array(total[kind].astype(np.int64))],
                    ["kind", "cell", "value"])

    cells = rows.select("style", "kind").mapInArrow(run, "kind int, cell int, value long").groupBy("kind", "cell").agg(
        F.sum(F.col("value").cast("decimal(30,0)")).alias("value")).collect()  # WIDTH^2 / 2 cells a kind
    found = np.zeros((kinds, len(_TRIANGLE[0])), object)
    for r in cells:
        found[r["kind"], r["cell"]] = int(r["value"])
    scale = np.append(np.full(style.WIDTH, 255.0), 1.0)
    out = []
    for values in found:
        n = int(values[-1])
        gram = np.zeros((style.WIDTH + 1,) * 2)
        gram[_TRIANGLE] = [v / max(n, 1) for v in values]
        gram = (gram + np.triu(gram, 1).T) / np.outer(scale, scale)
        out.append(Sums(n, gram[-1], gram))
    return out


def pooled(a: Sums, b: Sums) -> Sums:
    n = max(a.n + b.n, 1)
    return Sums(a.n + b.n, (a.n * a.mean + b.n * b.mean) / n, (a.n * a.gram + b.n * b.gram) / n)


def telling_apart(positive: Sums, unlabelled: Sums) -> np.ndarray:
    """Weights that tell positives (1) from unlabelled rows (-1), both of equal weight."""
    size = len(positive.mean)
    return np.linalg.solve(positive.gram + unlabelled.gram + RIDGE * np.eye(size), positive.mean - unlabelled.mean)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from both counts by bin of a rising score."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    above_p, above_u = (np.cumsum(x[::-1])[::-1] / max(n, 1) for x, n in ((positive, n_p), (unlabelled, n_u)))
    margin = np.sqrt(np.log(4 / DELTA) / 2) * (1 / np.sqrt(max(n_u, 1)) + 1 / np.sqrt(max(n_p, 1)))
    some = above_p > 0
    at = int(np.argmin((above_u[some] + MARGIN * margin) / above_p[some]))
    return float(np.clip(above_u[some][at] / above_p[some][at], 0.01, 0.99))


def minimise(positive: Sums, unlabelled: Sums, prior: float) -> np.ndarray:
    """Weights of least non-negative risk plus ridge, by descent from those of least unbiased risk."""
    size = len(positive.mean)
    curve = unlabelled.gram / 2 + 2 * RIDGE * np.eye(size)

    def risk(w: np.ndarray) -> float:
        return nonnegative_risk(positive, unlabelled, prior, w) + RIDGE * w @ w

    w = np.linalg.solve(curve, prior * positive.mean - unlabelled.mean / 2)
    least, step = risk(w), 1.0
    for _ in range(STEPS):
        slope = prior * positive.slope(w, 1) + 2 * RIDGE * w
        if unlabelled.risk(w, -1) > prior * positive.risk(w, -1):
            slope = slope + unlabelled.slope(w, -1) - prior * positive.slope(w, -1)
        towards = np.linalg.solve(curve, slope)
        while step > 1e-6 and risk(w - step * towards) > least - 1e-4 * step * (slope @ towards):
            step /= 2
        moved = risk(w - step * towards)
        if moved >= least - GAIN * abs(least):
            break
        w, least, step = w - step * towards, moved, min(1.0, 2 * step)
    return w


def nonnegative_risk(positive: Sums, unlabelled: Sums, prior: float, w: np.ndarray) -> float:
    return prior * positive.risk(w, 1) + max(0.0, unlabelled.risk(w, -1) - prior * positive.risk(w, -1))


def _binned(rows: DataFrame, model: Model) -> np.ndarray:
    """Number of rows by bin of g."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.int64)
        for batch in batches:
            at = np.clip((model.margins(_bytes(batch.column(0))) / REACH + 1) / 2 * BINS, 0, BINS - 1).astype(np.int64)
            counts += np.bincount(at, minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS, dtype=np.int32)), pa.array(counts)], ["bin", "n"])

    out = np.zeros(BINS, np.int64)
    for r in rows.select("style").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r["bin"]] = r["n"]
    return out


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``values`` by weighted squares: neighbours that fall are pooled."""
    pools: list[list[float]] = []  # mean, weight, length
    for value, weight in zip(values, weights):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            total = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / total, total, a[2] + b[2]])
    return np.repeat([p[0] for p in pools], [p[2] for p in pools])


def logistic_curve(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """(slope, offset) of the share of positives by g, from both counts by bin."""
    used = unlabelled > 0
    g = ((np.arange(BINS) + 0.5) / BINS * 2 - 1)[used] * REACH
    weight = unlabelled[used] / unlabelled.sum()
    share = np.clip(rising(prior * positive[used] / max(positive.sum(), 1) / weight, weight), 0, 1)
    design, w = np.column_stack([g, np.ones(len(g))]), np.array([1.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return weight @ (np.logaddexp(0, z) - share * z) + SLOPE_RIDGE * w[0] ** 2 / 2

    for _ in range(STEPS):  # Newton, halved while it does not descend
        p = 1 / (1 + np.exp(-design @ w))
        slope = design.T @ (weight * (p - share)) + [SLOPE_RIDGE * w[0], 0]
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([SLOPE_RIDGE, 1e-9])
        move, least = np.linalg.solve(curve, slope), loss(w)
        step = 1.0
        while step > 1e-9 and loss(w - step * move) > least:
            step /= 2
        w = w - step * move
        if least - loss(w) <= GAIN * least:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def learn(rows: DataFrame, positives: DataFrame, key: str = "doc_id") -> Model:
    """The model of least risk; ``rows`` is what :func:`described` gives, ``positives`` names trusted rows by ``key``."""
    named = positives.select(F.col(key).alias("key")).where("key IS NOT NULL").distinct()
    half = F.pmod(F.xxhash64("key"), F.lit(2)).cast("int")
    trusted = stored(rows.join(named, "key", "left_semi").select("style", half.alias("kind")), "trusted", "zstd")
    first, second = sums(trusted, 2)
    (unlabelled,) = sums(rows.withColumn("kind", F.lit(0)))
    positive = pooled(first, second)
    if not positive.n:
        return Model(None)
    if not (first.n and second.n):  # a single positive, say: nothing to hold out
        return Model(minimise(positive, unlabelled, 0.5), 0.5, (2.0, 0.0))
    apart = Model(telling_apart(first, unlabelled))
    prior = class_prior(_binned(trusted.where("kind = 1"), apart), _binned(rows, apart))
    model = Model(minimise(positive, unlabelled, prior), prior)
    unseen = sum(_binned(trusted.where(F.col("kind") == kind), Model(minimise(other, unlabelled, prior))) for kind, other in ((1, first), (0, second)))
    model.curve = logistic_curve(unseen, _binned(rows, model), prior)
    return model


def score(rows: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """(key, ``out``) of all described rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_bytes(batch.column(1))))], ["key", out])

    return rows.select("key", "style").mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, {out} double")
