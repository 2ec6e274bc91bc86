"""Hashed word shingles of whole texts, a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# A-Z become lower case; blank, tab, line feed, vertical tab, form feed and return part words.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_SLICE_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of each text's shingles of ``width`` words.

    A text of fewer words has its whole word sequence as one shingle, and one
    without words has none.
    """

    def __init__(self, width: int = 3):
        self.width = width
        self.letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n >= len(self.powers):
            steps = np.full(2 * n, 1, np.uint64)
            steps[1:] = np.uint64(_BASE)
            self.powers = np.cumprod(steps)
            steps[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
            self.inverses = np.cumprod(steps)

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
        out: list[np.ndarray] = []
        if not len(texts):
            return out
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):  # slices of whole texts
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE_BYTES, "right")) - 1)
            out += self._slice(data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at])
            at = end
        return out

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        n_texts = len(offsets) - 1
        if not len(data):
            return [np.zeros(0, np.uint64)] * n_texts
        self._grow(len(data) + 1)
        solid = ~_SPACE[data]
        before = np.concatenate([[False], solid[:-1]])
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after = np.concatenate([solid[1:], [False]])
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        first, last = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.letters[_LOWER[data]] * self.powers[:len(data)])])
        words = mixed((sums[last] - sums[first]) * self.inverses[first])
        bounds = np.searchsorted(first, offsets)
        n = self.width
        grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for i in range(n):
            grams = mixed(grams * np.uint64(3) + words[i:i + len(grams)] + np.uint64(i + 1))
        out = []
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if end - start >= n:
                found = np.sort(grams[start:end - n + 1])
                keep = np.ones(len(found), bool)
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                out.append(found[keep])
            elif end > start:
                whole = np.full(1, end - start, np.uint64)
                for word in words[start:end]:
                    whole = mixed(whole * np.uint64(5) + word)
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
        return out
