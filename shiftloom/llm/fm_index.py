"""An FM-index over a shard of word symbols: wavelet-matrix ranks, backward search, sampled positions.

Symbols are integers; 0 is a separator that no pattern holds. Queries are batches: all patterns of
one length take each backward step together in numpy.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix positions in order by prefix doubling; each separator is a symbol of its own, and suffixes told apart are not sorted again."""
    n = len(symbols)
    gaps = np.flatnonzero(symbols == 0)
    rank = symbols.astype(np.int64) + len(gaps)
    rank[gaps] = np.arange(len(gaps))
    order = np.argsort(rank, kind="stable")
    new = np.concatenate([[True], np.diff(rank[order]) != 0])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # a suffix's rank: where its group begins
    rank[order] = head
    size = np.diff(np.concatenate([np.flatnonzero(new), [n]]))
    live = np.flatnonzero(np.repeat(size > 1, size))
    step = 1
    while len(live):
        at = order[live]
        behind = at + step
        key = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        sort = np.lexsort((key, head[live]))
        at, key, group = at[sort], key[sort], head[live]
        order[live] = at
        new = np.ones(len(live), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        head[live] = np.maximum.accumulate(np.where(new, live, 0))
        rank[at] = head[live]
        size = np.diff(np.concatenate([np.flatnonzero(new), [len(live)]]))
        live = live[np.repeat(size > 1, size)]
        step *= 2
    return order


class WaveletMatrix:
    """rank(c, i): how many of the first i symbols are c, for arrays of c and i."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        now = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(now) - int(self.ones[-1][-1]))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        low = np.zeros_like(i)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            one = ((c >> level) & 1).astype(bool)
            ones = self.ones[k]
            i = np.where(one, self.zeros[k] + ones[i], i - ones[i])
            low = np.where(one, self.zeros[k] + ones[low], low - ones[low])
        return i - low


class FMIndex:
    """Index of one shard; ``sample``: every so many positions, and each position after a separator, is stored."""

    def __init__(self, symbols: np.ndarray, top: int, sample: int = 8):
        order = suffix_order(symbols)
        self.size = len(symbols)
        self.bwt = symbols[order - 1].astype(np.int64)  # the first suffix wraps to the last symbol, a separator
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))]).astype(np.int64)
        self.ranks = WaveletMatrix(self.bwt, top)
        after_gap = np.zeros(self.size, bool)
        after_gap[0] = True
        after_gap[1:] = symbols[:-1] == 0
        self.position = np.where((order % sample == 0) | after_gap[order], order, -1)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of each pattern (one a row); empty where it does not occur."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        live = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, k].astype(np.int64)
            low[live] = self.first[c] + self.ranks.rank(c, low[live])
            high[live] = self.first[c] + self.ranks.rank(c, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows: walk back until a sampled position."""
        out, row, walked = np.full(len(rows), -1, np.int64), rows.copy(), 0
        live = np.arange(len(rows))
        while len(live):
            at = self.position[row[live]]
            found = at >= 0
            out[live[found]] = at[found] + walked
            live = live[~found]
            c = self.bwt[row[live]]
            row[live] = self.first[c] + self.ranks.rank(c, row[live])
            walked += 1
        return out
