"""Sums by fold over a frame of features, taken in numpy on Arrow batches and added up by Spark."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_sums(fold: np.ndarray, k: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``of`` the places of each fold's rows, stacked."""
    return np.array([of(np.flatnonzero(fold == f)) for f in range(k)])


class FoldSums:
    """Passes over (fold, label, features); missing features are NaN."""

    def __init__(self, frame: DataFrame, features: Sequence[str], k: int, extra: Sequence[str] = ()):
        self.rows = frame.select("fold", "label", *features, *extra)
        self.features, self.k, self.extra = list(features), k, list(extra)

    def total(self, terms: Callable[..., np.ndarray], cells: int) -> np.ndarray:
        """The sum over all batches of ``terms(fold, label, x, *extra)``, a (k x cells) array; k x cells numbers reach the driver."""
        k, features, extra = self.k, self.features, self.extra

        def run(batches):
            found = np.zeros((k, cells))
            for batch in batches:
                if batch.num_rows:
                    found += terms(*arrays(batch, features, extra))
            fold, cell = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(fold.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(found[fold, cell])],
                                             ["fold", "cell", "value"])

        out = np.zeros((k, cells))
        found = self.rows.mapInArrow(run, "fold int, cell int, value double").groupBy("fold", "cell").agg(F.sum("value").alias("value")).toArrow()
        out[found.column("fold").to_numpy(), found.column("cell").to_numpy()] = found.column("value").to_numpy()
        return out


def arrays(batch: pa.RecordBatch, features: list[str], extra: list[str]) -> list[np.ndarray]:
    """(fold, label, feature matrix, extra columns) of a batch."""
    column = lambda c: np.asarray(batch.column(c).to_numpy(zero_copy_only=False))
    x = np.column_stack([column(c).astype(np.float64) for c in features]) if features else np.zeros((batch.num_rows, 0))
    return [column("fold"), column("label"), x, *(column(c) for c in extra)]
