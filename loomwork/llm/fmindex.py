"""FM-index over a sequence of small numbers: suffix order, Burrows-Wheeler
transform with wavelet-matrix ranks, and sampled suffix positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(t: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the compared prefix."""
    rank = np.unique(t, return_inverse=True)[1].astype(np.int64)
    n, k = len(t), 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - k if k < n else 0] = rank[k:] + 1
        key = rank * (n + 2) + nxt
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        k *= 2


class WaveletMatrix:
    """rank(c, i): how often c stands before i, for arrays of c and i."""

    def __init__(self, t: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (t >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(len(t) - int(self.ones[-1][-1]))
            t = np.concatenate([t[bit == 0], t[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        a = np.zeros_like(i)
        for level in range(self.bits):
            one = ((c >> (self.bits - 1 - level)) & 1).astype(bool)
            r, ra = self.ones[level][i], self.ones[level][a]
            i, a = np.where(one, self.zeros[level] + r, i - r), np.where(one, self.zeros[level] + ra, a - ra)
        return i - a


class FMIndex:
    """t: numbers >= 0; patterns may hold numbers from 1 to top."""

    def __init__(self, t: np.ndarray, top: int):
        t = np.concatenate([t.astype(np.int64) + 1, [0]])  # 0 ends the text, 1 separates
        order = suffix_order(t)
        self.bwt = t[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=top + 3))])
        self.ranks = WaveletMatrix(self.bwt, top + 2)
        self.sampled = order % SAMPLE == 0
        self.sample_no = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of equally long patterns, from their last symbol backwards; start equals end for none."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.bwt), np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, j] + 1
            lo, hi = self.first[c] + self.ranks.rank(c, lo), self.first[c] + self.ranks.rank(c, hi)
            hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back to a sampled one."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            r = rows[open_]
            done = self.sampled[r]
            out[open_[done]] = self.samples[self.sample_no[r[done]]] + steps[open_[done]]
            open_, r = open_[~done], r[~done]
            c = self.bwt[r]
            rows[open_] = self.first[c] + self.ranks.rank(c, r)
            steps[open_] += 1
        return out
