"""A bit filter over 64-bit hashes: of fixed size, it may let through too much, never too little."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def bit_filter(hashes: DataFrame, bits: int = BITS):
    """The broadcast filter of the hashes in the first column: ``bits`` bits, made by an aggregate over its 64-bit words."""
    mask, value = F.lit(bits - 1), F.col(hashes.columns[0])
    places = F.explode(F.array(value.bitwiseAND(mask), F.shiftrightunsigned(value, 32).bitwiseAND(mask))).alias("place")
    words = hashes.select(places).groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("held")).toArrow()  # bits / 64 rows at most
    held = np.zeros(-(-bits // 64), np.uint64)
    held[words.column("word").to_numpy()] = words.column("held").to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(held)


def passes(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned ``hashes`` may be among the filter's: those whose two places are both set."""
    mask, six, low = np.uint64(len(held) * 64 - 1), np.uint64(6), np.uint64(63)
    one, two = hashes & mask, (hashes >> np.uint64(32)) & mask
    return ((held[one >> six] >> (one & low)) & (held[two >> six] >> (two & low)) & np.uint64(1)).astype(bool)
