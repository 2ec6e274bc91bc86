"""Exploratory models: k-fold scores of linear, logistic and boosted models.

No fold is fitted on its own.  A pass over the rows adds up, per fold, what the models
need (products of features, gradients, Hessians, histograms of the boosted trees), and all
folds are solved from such sums at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from aerolake.functions.draws import add_draw
from aerolake.functions.encoding import nan_to_null, surrogates
from aerolake.operators.boosting import boosted
from aerolake.operators.folds import FoldSums, fold_sums
from aerolake.sources.workspace import shared_folder

FOLDS = 5
#: Most rows in a file of a frame.  A scan gives a file of this size to one task whole, so files are what passes are shared out by.
FILE_ROWS = 100_000
#: Rows of a batch that a pass works on at once, few enough for a core's cache.
CACHED = 2_000
#: The logistic fit ends when no entry of the gradient of the summed loss is above this (or 1e-12 a row).
TOLERANCE, NEWTON_STEPS = 1e-6, 50
#: Singular values below this share of the largest count as 0: features that add up to others get no weight of their own.
RANK = 1e-10


def add_fold(df: DataFrame, key: Column, k: int = FOLDS, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from a row key: the same row always gets the same fold."""
    return add_draw(df, key, "_draw", seed).withColumn(out, (F.col("_draw") % k).cast("int")).drop("_draw")


def exploration_frame(df: DataFrame, features: Sequence[str], label: str, k: int = FOLDS,
                      seed: int = 42, key: Column | None = None) -> DataFrame:
    """Labelled rows with a fold number, drawn from ``key`` or else the row's content; missing features stay missing.

    The rows are written, so that every pass reads the same ones and none computes them anew, in
    files small enough that every core gets its share of each pass however few tasks write them.
    """
    kept = [F.col(c).cast("double").alias(c) for c in features]
    rows = df.select(*kept, F.col(label).cast("double").alias("label"), *([] if key is None else [key.alias("_key")]))
    rows = nan_to_null(rows).where("label IS NOT NULL")
    rows = add_fold(rows, F.xxhash64(*rows.columns) if key is None else F.col("_key"), k, seed).drop("_key")
    path = shared_folder(df.sparkSession, "exploration")
    rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def negative_mae(scored: GroupedData | DataFrame) -> DataFrame:
    return scored.agg((-F.avg(F.abs(F.col("label") - F.col("prediction")))).alias("score"))


def accuracy(scored: GroupedData | DataFrame) -> DataFrame:
    return scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("score"))


def cross_validate(frame: DataFrame, features: Sequence[str], model: Callable[[DataFrame, Sequence[str], int], DataFrame],
                   metric: Callable[[GroupedData], DataFrame], k: int = FOLDS) -> DataFrame:
    """(fold, score) of every fold that has rows: each is predicted by the model of the other folds.

    ``model`` gives ``frame`` with the column ``prediction``; the scores are one aggregate.
    """
    return metric(model(frame, features, k).groupBy("fold"))


def _by_fold(values: Sequence[float]) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), F.col("fold") + 1)


def _linear_term(features: Sequence[str], intercepts, weights, fills) -> Column:
    """Intercept plus weights times features, missing ones filled, with the numbers of the row's fold."""
    term = _by_fold(intercepts)
    for i, c in enumerate(features):
        term = term + _by_fold(weights[:, i]) * F.coalesce(F.col(c), _by_fold(fills[:, i]))
    return term


class Moments:
    """Of each fold's training rows: fill values, deviations after filling, and products of the filled, centred features.

    Let v be a feature less a fixed shift, or 0 where it is missing, and p tell whether
    it is there.  Filled with its mean d over the training rows and centred, it is
    v - d p; so the products of all v, p, the label and 1 hold those of every fold's fill.
    """

    def __init__(self, frame: DataFrame, features: Sequence[str], k: int):
        d = len(features)
        means = surrogates(frame, features).first()
        shift = np.array([0.0 if means[c] is None else means[c] for c in features])

        def products(fold, label, x):
            there = ~np.isnan(x)
            a = np.column_stack([np.ones(len(label)), label, np.where(there, x - shift, 0.0), there])
            return fold_sums(fold, k, lambda rows: (a[rows].T @ a[rows]).ravel())

        found = FoldSums(frame, features, k).total(products, (2 + 2 * d) ** 2).reshape(k, 2 + 2 * d, 2 + 2 * d)
        gram = found.sum(axis=0) - found
        v, p = slice(2, 2 + d), slice(2 + d, 2 + 2 * d)
        self.n = gram[:, 0, 0]
        self.label_mean = gram[:, 0, 1] / np.maximum(self.n, 1)
        there = gram[:, 0, p]
        delta = gram[:, 0, v] / np.maximum(there, 1)
        self.shift, self.delta, self.fills = shift, delta, shift + delta
        self.partly = np.flatnonzero(found[:, 0, p].sum(axis=0) < found[:, 0, 0].sum())
        vp = gram[:, v, p]
        self.products = (gram[:, v, v] - vp * delta[:, None, :] - np.swapaxes(vp, 1, 2) * delta[:, :, None]
                         + gram[:, p, p] * delta[:, :, None] * delta[:, None, :])
        self.with_label = gram[:, v, 1] - delta * gram[:, p, 1]
        deviation = np.sqrt(np.maximum(np.diagonal(self.products, axis1=1, axis2=2), 0) / np.maximum(self.n, 1)[:, None])
        self.deviations = np.where(deviation > 0, deviation, 1.0)


def standardized_linear(frame: DataFrame, features: Sequence[str], k: int = FOLDS) -> DataFrame:
    """Least squares on features filled by their means, from one pass of products by fold."""
    m = Moments(frame, features, k)
    weights = np.zeros((k, len(features)))
    for fold in range(k):
        scale = m.deviations[fold]
        solved = np.linalg.pinv(m.products[fold] / np.outer(scale, scale), rcond=RANK, hermitian=True) @ (m.with_label[fold] / scale)
        weights[fold] = solved / scale
    intercepts = m.label_mean - (weights * m.fills).sum(axis=1)
    return frame.withColumn("prediction", _linear_term(features, intercepts, weights, m.fills))


def fit_logistic(frame: DataFrame, features: Sequence[str], k: int = FOLDS) -> tuple[Moments, np.ndarray, np.ndarray]:
    """(moments, coefficients, gradients) of the ridge logistic fits of all folds, by Newton steps.

    The objective is the *sum* of the training rows' losses plus half the square of
    the coefficients of the standardised features; the intercept (first) is free.
    A pass gives every fold's loss, gradient and Hessian at its coefficients (at 0 the moments
    do); a step that does not lower the loss is halved and tried again.
    """
    m, d = Moments(frame, features, k), len(features)
    sums = FoldSums(frame, features, k)
    penalty = np.append(0.0, np.ones(d))
    shift, partly, spread = m.shift, m.partly, m.deviations.max(axis=0)
    cells = 1 + d + len(partly)

    # A batch is laid out once for all folds: 1, the shifted features, and whether those that are missing
    # somewhere are there.  ``basis[f]`` makes fold f's filled and standardised features of that.
    place = np.zeros(d, int)
    place[partly] = 1 + d + np.arange(len(partly))
    basis = np.zeros((k, cells, d + 1))
    basis[:, 0, 0] = 1
    for i in range(d):
        basis[:, 1 + i, 1 + i] = spread[i] / m.deviations[:, i]
        basis[:, place[i], 1 + i] -= m.delta[:, i] / m.deviations[:, i]

    def evaluated(w: np.ndarray):
        weights = np.einsum("fcj,fj->cf", basis, w)

        def terms(fold, label, x):
            out = np.zeros((k, 1 + cells + cells ** 2))
            for start in range(0, len(label), CACHED):
                part = slice(start, start + CACHED)
                y, xt = label[part], np.ascontiguousarray(x[part].T)
                there = ~np.isnan(xt)
                b = np.concatenate([np.ones((1, len(y))), np.where(there, (xt - shift[:, None]) / spread[:, None], 0.0), there[partly]])
                at, trains = weights.T @ b, fold[part] != np.arange(k)[:, None]
                e = np.exp(-np.abs(at))
                p, curve = np.where(at >= 0, 1.0, e) / (1 + e), np.sqrt(np.where(trains, e, 0.0)) / (1 + e)
                out[:, 0] += np.where(trains, np.maximum(at, 0) + np.log(1 + e) - y * at, 0.0).sum(axis=1)
                out[:, 1:1 + cells] += np.where(trains, p - y, 0.0) @ b.T
                for model in range(k):
                    scaled = b * curve[model]
                    out[model, 1 + cells:] += (scaled @ scaled.T).ravel()
            return out

        found = sums.total(terms, 1 + cells + cells ** 2)
        turned = np.swapaxes(basis, 1, 2)
        return (found[:, 0] + (penalty * w * w).sum(axis=1) / 2,
                (turned @ found[:, 1:1 + cells, None])[:, :, 0] + penalty * w,
                turned @ found[:, 1 + cells:].reshape(k, cells, cells) @ basis + np.diag(penalty))

    # With all coefficients 0 every row's probability is a half, and the moments hold the sums.
    w, ends = np.zeros((k, d + 1)), np.maximum(TOLERANCE, 1e-12 * m.n)
    loss = m.n * np.log(2)
    gradient = np.column_stack([m.n * (0.5 - m.label_mean), -m.with_label / m.deviations])
    hessian = np.zeros((k, d + 1, d + 1))
    hessian[:, 0, 0] = m.n / 4
    hessian[:, 1:, 1:] = m.products / (4 * m.deviations[:, :, None] * m.deviations[:, None, :])
    hessian += np.diag(penalty)
    for _ in range(NEWTON_STEPS):
        if (np.abs(gradient).max(axis=1) <= ends).all():
            break
        move = np.array([np.linalg.pinv(h, rcond=1e-14, hermitian=True) @ g for h, g in zip(hessian, gradient)])
        step = np.ones(k)
        for _ in range(30):
            moved = w - step[:, None] * move
            found = evaluated(moved)
            worse = found[0] > loss + 1e-9 * np.abs(loss)
            if not worse.any():
                break
            step = np.where(worse, step / 2, step)
        w, (loss, gradient, hessian) = moved, found
    return m, w, gradient


def standardized_logistic(frame: DataFrame, features: Sequence[str], k: int = FOLDS) -> DataFrame:
    """Ridge logistic regression with a penalty of weight 1 on the sum of losses; predicts 0 or 1."""
    m, w, _ = fit_logistic(frame, features, k)
    weights = w[:, 1:] / m.deviations
    margin = _linear_term(features, w[:, 0] - (weights * m.fills).sum(axis=1), weights, m.fills)
    return frame.withColumn("prediction", (margin > 0).cast("double"))


def boosted_classifier(frame: DataFrame, features: Sequence[str], k: int = FOLDS) -> DataFrame:
    """The trees of Spark's ``GBTClassifier``, for labels 0 and 1; predicts 0 or 1."""
    return boosted(frame, features, k, classes=True)


def boosted_regressor(frame: DataFrame, features: Sequence[str], k: int = FOLDS) -> DataFrame:
    """The trees of Spark's ``GBTRegressor``."""
    return boosted(frame, features, k, classes=False)
