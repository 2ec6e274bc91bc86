"""Reproducible pseudo-random draws from a row key.

A draw is a pure function of (row key, salt): a task that is run again gives
the same draws, they do not depend on how rows are partitioned, and no state
is shared between tasks.

:func:`uniform32` is one draw per row as a column.  :func:`resample_weights` and
:func:`block_totals` are the many-draws-per-row form for a numpy task, with a
cheaper hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF
# Odd multipliers below 2**31.
MULTIPLIERS = (0x7FEB352D, 0x31848BAB)


def mix_int(x: int) -> int:
    """Scramble a 32-bit integer: xor-shift and multiply, twice."""
    x ^= x >> 16
    x = (x * MULTIPLIERS[0]) & MASK
    x ^= x >> 15
    x = (x * MULTIPLIERS[1]) & MASK
    return x ^ (x >> 16)


def salt(seed: int, replicate: int = 0) -> int:
    """A 32-bit salt for one replicate of one seeded experiment."""
    return mix_int(mix_int(seed & MASK) ^ (replicate & MASK))


def uniform32(key: Column, seed: int = 42) -> Column:
    """A whole number in 0 .. 2**32 - 1 from a row key."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def add_draw(df: DataFrame, key: Column, out: str, seed: int = 42) -> DataFrame:
    """Add :func:`uniform32` as a column that filters can be put on.

    Exploding a one-element array keeps the draw a column of its own.  As a
    plain projection the optimizer would inline it into every later filter, and
    a hash of many renamed columns makes its constraint inference exponential.
    """
    return df.select("*", F.explode(F.array(uniform32(key, seed))).alias(out))


def block_salt(seed: int, replicate: int, block: int) -> int:
    """The salt of one replicate's draws in one block of rows."""
    return mix_int(salt(seed, replicate) ^ mix_int(block))


def block_totals(sizes: Sequence[int], block: int, replicates: int, seed: int):
    """How many of n = sum(sizes) draws with replacement fall into ``block``, for every replicate.

    The blocks are the leaves of a binary tree.  From the root down, a node's draws
    are split between its halves by exact binomials, whose generator is keyed by the
    seed and the node: whoever walks to another leaf makes the same splits, so the
    totals of all blocks add up to n without any exchange.
    """
    import numpy as np

    before = np.concatenate([[0], np.cumsum(np.asarray(sizes, dtype=np.int64))])
    low, high = 0, len(sizes)
    totals = np.full(replicates, before[-1], dtype=np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        rows = before[high] - before[low]
        share = (before[middle] - before[low]) / rows if rows else 0.0
        generator = np.random.Generator(np.random.Philox(key=[seed & MASK, low << 32 | high]))
        left = generator.binomial(totals, share)
        if block < middle:
            totals, high = left, middle
        else:
            totals, low = totals - left, middle
    return totals


def resample_weights(rows: int, totals, salts):
    """How often each of ``rows`` rows is drawn, as a (salts x rows) numpy block of doubles.

    Draw j of a salt picks row floor(u * rows / 2**32), where u is a hash of j and the salt;
    each salt has its own number of draws.
    """
    import numpy as np

    totals = np.asarray(totals, dtype=np.int64)
    weights = np.zeros((len(salts), rows))
    if not rows or not len(totals):
        return weights
    most = int(totals.max())
    places = np.arange(most, dtype=np.uint32)
    spare = np.empty_like(places)
    _mix_block(places, spare)
    draws = np.empty_like(places)
    for i, (total, start) in enumerate(zip(totals.tolist(), salts)):
        drawn, rest = draws[:total], spare[:total]
        np.bitwise_xor(places[:total], np.uint32(start), out=drawn)
        _mix_block(drawn, rest)
        weights[i] = np.bincount((drawn.astype(np.uint64) * np.uint64(rows) >> np.uint64(32)).view(np.int64), minlength=rows)
    return weights


def _mix_block(x, spare) -> None:
    """:func:`mix_int` on an array of 32-bit integers, in place."""
    import numpy as np

    for shift, multiplier in ((16, MULTIPLIERS[0]), (15, MULTIPLIERS[1]), (16, None)):
        np.right_shift(x, shift, out=spare)
        x ^= spare
        if multiplier:
            x *= np.uint32(multiplier)
