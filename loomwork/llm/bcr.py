"""Column-wise construction of a collection's suffix order with common prefixes.

All strings are read from their last byte to their first, one byte of every
string per round.  The transform is kept as the row that each row leads to
when its first byte is dropped, under the byte itself: within the rows that
begin with one byte these are ascending, exactly as that byte's places in the
Burrows-Wheeler transform.  A round finds where the new rows go by rank,
inserts them in one sequential pass over each array, and repairs the common
prefixes of new rows and of those right after them from range minima over the
round before.  Common prefixes are counted up to CAP bytes.

The arrays of one call live in memory: callers bound what they hand in, since
scratch files on an executor's own disk are not to be relied on.
"""

from __future__ import annotations

import numpy as np

CAP = 200
SPAN = 32
NEAR = 8


class RangeMin:
    """Minima of a byte array over closed ranges, all at once."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        pad = np.full(-(-n // SPAN) * SPAN + SPAN, 255, np.uint8)
        pad[:n] = x
        self.pad, self.rows = pad, pad.reshape(-1, SPAN)
        level = pad
        while len(level) * SPAN > len(pad):
            level = np.minimum(level[::2], level[1::2])
        self.levels = [level]
        while len(level) > 1:
            step = 1 << (len(self.levels) - 1)
            if step >= len(level):
                break
            level = np.minimum(level[:-step], level[step:])
            self.levels.append(level)

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        size = hi - lo
        out = self.pad[np.minimum(lo[:, None] + np.arange(NEAR), hi[:, None])].min(1)  # most ranges are short
        far = np.flatnonzero(size >= NEAR)
        if len(far):
            a, b = lo[far], hi[far]
            col = np.arange(SPAN)
            ra, rb = a // SPAN, b // SPAN
            left, right = self.rows[ra], self.rows[rb]
            same = (ra == rb)[:, None]
            left = np.where((col >= (a % SPAN)[:, None]) & (~same | (col <= (b % SPAN)[:, None])), left, 255).min(1)
            right = np.where((col <= (b % SPAN)[:, None]) & ~same, right, 255).min(1)
            best = np.minimum(left, right)
            mid = np.flatnonzero(rb - ra > 1)
            if len(mid):
                f, t = ra[mid] + 1, rb[mid]
                k = np.frexp((t - f).astype(np.float64))[1] - 1
                for level in np.unique(k):
                    own = k == level
                    m = self.levels[level]
                    best[mid[own]] = np.minimum(best[mid[own]], np.minimum(m[f[own]], m[t[own] - (1 << level)]))
            out[far] = best
        return out


def build(strings: list[bytes], cap: int = CAP) -> tuple[np.ndarray, np.ndarray]:
    """(flat start of the suffix in every row, common prefix with the row before).

    Flat starts count through the joined strings; the rows of the empty
    suffixes are left out.  cap is at most 254.
    """
    size = np.array([len(s) for s in strings], np.int64)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    end = np.cumsum(size)
    m = len(strings)
    rows = np.arange(m)  # by row: the row without the first byte
    first = np.zeros(258, np.int64)  # by byte + 1: where its rows begin; the empty suffixes come before all
    first[1:] = m
    lcp = np.zeros(m, np.uint8)
    row = np.arange(m, dtype=np.int64)
    by_size = np.argsort(-size, kind="stable")
    longest = -size[by_size]
    for j in range(1, int(size.max(initial=0)) + 1):
        active = by_size[: np.searchsorted(longest, -j, side="right")]
        c = flat[end[active] - j]
        order = np.argsort((c.astype(np.int64) << 32) | row[active])
        active, c = active[order], c[order]
        r = row[active]
        n = len(rows)
        at = np.empty(len(r), np.int64)
        edge = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1], [True]]))
        for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):  # rank of each, byte by byte
            lo, hi = first[int(c[x]) + 1], first[int(c[x]) + 2]
            at[x:y] = lo + np.searchsorted(rows[lo:hi], r[x:y])
        place = at + np.arange(len(at))
        kept = np.ones(n + len(at), bool)
        kept[place] = False
        old_to = np.flatnonzero(kept)
        # neighbours within the byte, still naming rows of the round before
        added = np.bincount(c, minlength=256)
        head = first[1:-1] + np.concatenate([[0], np.cumsum(added)[:-1]])
        tail = head + np.diff(first[1:]) + added
        both = np.empty(n + len(at), np.int64)
        both[kept], both[place] = rows, r
        fresh = np.zeros(n + len(at), np.uint8)
        fresh[kept] = lcp
        minima = RangeMin(lcp)
        left, right = np.flatnonzero(place > head[c]), np.flatnonzero(place + 1 < tail[c])
        lo = np.concatenate([both[place[left] - 1] + 1, r[right] + 1])
        hi = np.concatenate([r[left], both[place[right] + 1]])
        # of two new rows side by side both give the same value for the second
        fresh[np.concatenate([place[left], place[right] + 1])] = np.minimum(minima(lo, hi), cap - 1) + 1
        # name rows of this round from here on
        rows, lcp = np.take(old_to, both), fresh
        rows[:m] = np.arange(m)
        first[1:] += np.concatenate([[0], np.cumsum(added)])
        row = old_to[row]
        row[active] = place
    start = np.empty(len(rows), np.int64)
    at, live = end - size, np.flatnonzero(size > 0)
    while len(live):  # down every string, byte by byte
        start[row[live]] = at[live]
        row[live] = rows[row[live]]
        at[live] += 1
        live = live[at[live] < end[live]]
    return start[m:], lcp[m:]


def repeated_starts(strings: list[bytes], cap: int = CAP) -> np.ndarray:
    """Flags over the joined strings: a cap-byte piece that starts here, within
    its string, also starts at another place of the collection."""
    start, lcp = build(strings, cap)
    out = np.zeros(sum(map(len, strings)), bool)
    hit = lcp >= cap
    out[start[hit]] = True
    out[start[np.flatnonzero(hit) - 1]] = True
    return out
