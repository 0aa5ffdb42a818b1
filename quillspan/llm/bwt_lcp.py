"""Equal strings of a given length within a text, by threshold-bounded interval expansion on its Burrows-Wheeler transform.

Suffixes are sorted by their first 128 bytes, which fixes the interval of every string of up to 128 bytes. Starting from the
empty string, all intervals of one length are extended backwards at once through a wavelet matrix; an extension that
ends at a row whose common prefix with the row before is not known yet has that length as its value. Values so come out in
increasing order, and the expansion stops at the minimum length: rows without a value share at least that many bytes.
"""

from __future__ import annotations

import numpy as np

#: No UTF-8 text holds this byte; it is the largest, and strings are never extended with it.
GAP = 0xFF
DEPTH = 128


def sort_bounded(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Start positions in the order of the first ``depth`` bytes behind them (a power of two, 8 at least), ties by position."""
    n = len(text)
    padded = np.r_[text, np.full(8, GAP, np.uint8)].astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : n + i]
    width = 8
    while True:
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        fresh = np.empty(n, np.int64)
        fresh[0] = 0
        np.cumsum(sorted_[1:] != sorted_[:-1], out=fresh[1:])
        if width >= depth or fresh[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        key = rank * (n + 1)
        if width < n:
            key[: n - width] += rank[width:] + 1
        width *= 2


class Expander:
    """Backward extension of many intervals at once over a byte sequence."""

    def __init__(self, bwt: np.ndarray):
        n, now = len(bwt), bwt
        self.before, self.zeros = [], []
        starts = np.zeros(256, np.int64)
        symbols = np.arange(256)
        for bit in range(7, -1, -1):
            zero = (now >> bit) & 1 == 0
            before = np.zeros(n + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            zeros = int(before[-1])
            one = (symbols >> bit) & 1 == 1
            starts = np.where(one, zeros + starts - before[starts], before[starts])
            self.before.append(before)
            self.zeros.append(zeros)
            now = np.concatenate([now[zero], now[~zero]])
        first = np.r_[0, np.cumsum(np.bincount(bwt, minlength=256))[:-1]]
        self.shift = first - starts  # from places in the last level to rows

    def extend(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all one-byte extensions (gaps excepted) of the given intervals."""
        symbol = np.zeros(len(low), np.int32)
        for before, zeros in zip(self.before, self.zeros, strict=True):
            low0, high0 = before[low], before[high]
            low1, high1 = zeros + low - low0, zeros + high - high0
            z, o = high0 > low0, high1 > low1
            low, high = np.concatenate([low0[z], low1[o]]), np.concatenate([high0[z], high1[o]])
            symbol = np.concatenate([symbol[z] << 1, symbol[o] << 1 | 1])
        keep = symbol != GAP
        shift = self.shift[symbol[keep]]
        return low[keep] + shift, high[keep] + shift


def long_prefix_rows(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, boundary): suffixes in order, and whether each row shares fewer than ``least`` bytes with the row before."""
    if not 1 <= least <= DEPTH:
        raise ValueError(f"the minimum length must lie between 1 and {DEPTH}")
    n = len(text)
    order = sort_bounded(text)
    expander = Expander(text[order - 1])
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        low, high = expander.extend(low, high)
        fresh = ~known[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        known[high] = True
    return order, known[:n]
