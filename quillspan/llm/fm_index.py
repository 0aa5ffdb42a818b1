"""FM-index over a sequence of word numbers: Burrows-Wheeler transform, wavelet matrix, sampled suffix positions.

All searches are vectorised over many patterns at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffix array of a sequence whose symbols may be any integers, by prefix doubling."""
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        fresh = np.r_[0, np.cumsum(sorted_[1:] != sorted_[:-1])]
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2
        if width >= n:
            return order


class WaveletMatrix:
    """rank(c, i): how often c stands among the first i symbols."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.zeros, self.before = [], []
        now = symbols
        for b in range(self.bits - 1, -1, -1):
            zero = (now >> b) & 1 == 0
            self.before.append(np.r_[0, np.cumsum(zero)].astype(np.int32))
            self.zeros.append(int(self.before[-1][-1]))
            now = np.concatenate([now[zero], now[~zero]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(upto), upto
        for level, (zeros, before) in enumerate(zip(self.zeros, self.before, strict=True)):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            low = np.where(one, zeros + low - before[low], before[low])
            high = np.where(one, zeros + high - before[high], before[high])
        return high - low


class FMIndex:
    """Index of a sequence of words >= 1, with 0 as separator; matches never cross a separator."""

    def __init__(self, words: np.ndarray, sample: int = SAMPLE):
        words = np.r_[words.astype(np.int64), 0]  # ends with a separator
        n, gap = len(words), words == 0
        unique = words.copy()
        unique[gap] = np.arange(-int(gap.sum()), 0)  # separators differ, so no two suffixes are alike beyond them
        order = suffix_order(unique)
        self.bwt = words[order - 1]
        self.wavelet = WaveletMatrix(self.bwt)
        self.top = int(words.max(initial=0))
        self.first = np.r_[0, np.cumsum(np.bincount(words, minlength=self.top + 1))]
        sampled = np.arange(n) % sample == 0
        sampled |= np.r_[True, gap[:-1]]  # walks back end at the latest behind a separator
        self.known = np.where(sampled[order], order, -1)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of every pattern; patterns are rows, filled with -1 on the left."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.bwt), np.int64)
        for column in patterns.T[::-1]:
            alive = np.flatnonzero((column > 0) & (column <= self.top) & (low < high))
            gone = (column > self.top) | (column == 0)
            high[gone] = low[gone]
            c = column[alive]
            low[alive], high[alive] = self.first[c] + self.wavelet.rank(c, low[alive]), self.first[c] + self.wavelet.rank(c, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to sampled positions."""
        at, steps = np.empty(len(rows), np.int64), 0
        live, now = np.arange(len(rows)), rows
        while len(live):
            found = self.known[now] >= 0
            at[live[found]] = self.known[now[found]] + steps
            live, now = live[~found], now[~found]
            c = self.bwt[now]
            now = self.first[c] + self.wavelet.rank(c, now)
            steps += 1
        return at
