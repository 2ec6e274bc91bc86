"""Canonical length-limited Huffman codes: lengths from counts, bit packing, table-driven decoding."""

from __future__ import annotations

import numpy as np

#: Longest code, unless the alphabet needs more.
MAX_LENGTH = 16
#: The bit offset of every so many ids is kept with a block.
CHECKPOINT = 64


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Code length of every id (0: it does not occur), by package-merge."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    limit = max(MAX_LENGTH, (n - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    level, is_leaf = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weights, pairs])
        order = np.argsort(merged, kind="stable")
        level = merged[order]
        is_leaf.append(order < n)
    taken, found = 2 * n - 2, np.zeros(n, np.int64)
    for leaves in reversed(is_leaf):
        single = int(leaves[:taken].sum())
        found[:single] += 1
        taken = 2 * (taken - single)
    lengths[used] = found
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of every id: codes count up in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    used = np.flatnonzero(lengths)
    for i in used[np.argsort(lengths[used], kind="stable")]:
        length = int(lengths[i])
        code <<= length - last
        codes[i], last, code = code, length, code + 1
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' codes as bits, first bit highest, and the bit offset of every CHECKPOINT-th id."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    bits = int(end[-1]) if len(end) else 0
    words = np.zeros(bits // 64 + 2, np.uint64)
    if len(ids):
        code, word, over = codes[ids], at >> 6, (at & 63) + size - 64
        crosses = over > 0
        high = np.where(crosses, code >> np.maximum(over, 0).astype(np.uint64), code << np.maximum(-over, 0).astype(np.uint64))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.add.reduceat(high, first)
        words[word[crosses] + 1] += code[crosses] << (64 - over[crosses]).astype(np.uint64)
    return words.byteswap().tobytes()[:(bits + 7) // 8], at[::CHECKPOINT]


class Decoder:
    """Looks up the next ``width`` bits in one table that gives id and code length."""

    def __init__(self, lengths: np.ndarray):
        self.width = max(1, int(lengths.max(initial=1)))
        if self.width > 25:
            raise ValueError("Codes of more than 25 bits do not fit the look-up")
        self.ids, self.sizes = np.zeros(1 << self.width, np.uint32), np.zeros(1 << self.width, np.int64)
        codes = canonical_codes(lengths)
        used = np.flatnonzero(lengths)
        order = used[np.argsort(lengths[used], kind="stable")]
        spans = np.int64(1) << (self.width - lengths[order].astype(np.int64))
        filled = int(spans.sum())
        assert not len(order) or int(codes[order[0]]) == 0
        self.ids[:filled] = np.repeat(order, spans)
        self.sizes[:filled] = np.repeat(lengths[order], spans)

    def unpack(self, data: bytes, checkpoints: np.ndarray, count: int) -> np.ndarray:
        """``count`` ids; the stretches between checkpoints are decoded side by side."""
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at, last = checkpoints.astype(np.int64), len(window) - 1
        out = np.empty((len(at), CHECKPOINT), np.uint32)
        mask = np.int64((1 << self.width) - 1)
        for step in range(CHECKPOINT):  # the last stretch may run on into the padding
            byte = np.minimum(at >> 3, last)
            found = (window[byte].astype(np.int64) >> (32 - self.width - (at & 7))) & mask
            out[:, step] = self.ids[found]
            at = at + self.sizes[found]
        return out.reshape(-1)[:count]
