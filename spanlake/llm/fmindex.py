"""A compressed full-text index of word sequences: depth-bounded suffix order, BWT and a wavelet matrix."""

from __future__ import annotations

import numpy as np


def _dense(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ranks of pairs, equal for equal pairs."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def _later(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[: len(x) - by] = x[by:]
    return out


class WaveletMatrix:
    """Rank of symbols in a sequence from bits alone: a packed bit vector and its block counts a level."""

    def __init__(self, values: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        n = len(values)
        for level in range(self.levels - 1, -1, -1):
            on = ((values >> level) & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, bool)
            padded[:n] = on
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1])
            self.zeros.append(n - int(on.sum()))
            values = np.concatenate((values[~on], values[on]))
        self.first = self._walk(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for depth in range(self.levels):
            block, bit = at >> 6, (at & 63).astype(np.uint64)
            ones = self.before[depth][block] + np.bitwise_count(self.bits[depth][block] & ((np.uint64(1) << bit) - np.uint64(1)))
            on = (symbol >> (self.levels - 1 - depth)) & 1
            at = np.where(on == 1, self.zeros[depth] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._walk(symbol, at) - self.first[symbol]


class FMIndex:
    """Texts of words that answer which text holds a pattern of up to `depth` words.

    Texts are arrays of positive symbols, laid end to end with a 0 after each. Suffixes are sorted by their
    first `depth` words, enough for patterns of that length; doubling gives the order.
    """

    def __init__(self, texts: np.ndarray, owner: np.ndarray, n_symbols: int, depth: int):
        """texts: all symbols with the zeros; owner: a number for each place, of which a search returns the least."""
        if depth < 2:
            raise ValueError("depth is 2 at least")
        self.depth, self.n = depth, len(texts)
        short, have = texts, 1
        ranks = {1: texts}
        while have * 2 <= depth - 1:
            short = _dense(short, _later(short, have))
            have *= 2
            ranks[have] = short
        less = short if have == depth - 1 else _dense(short, _later(short, depth - 1 - have))
        full = _dense(less, _later(texts, depth - 1))
        order = np.argsort(full, kind="stable")
        self.wavelet = WaveletMatrix(texts[order - 1], n_symbols)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(texts, minlength=n_symbols))))
        self.low, self.high = self._groups(less[order])
        low, _ = self._groups(full[order])
        edges = np.unique(low)
        self.least = np.minimum.reduceat(owner[order], edges) if self.n else owner
        self.group = np.searchsorted(edges, low)

    @staticmethod
    def _groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of a sorted array, where the run of equal values around it starts and ends."""
        new = np.concatenate(([True], x[1:] != x[:-1]))
        edges = np.append(np.flatnonzero(new), len(x))
        run = np.cumsum(new) - 1
        return edges[run], edges[run + 1]

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the suffixes that start with the symbol and go on as before."""
        both = self.wavelet.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        return self.starts[symbol] + both[: len(symbol)], self.starts[symbol] + both[len(symbol) :]

    def least_owner(self, query: np.ndarray, first: np.ndarray, none: int) -> np.ndarray:
        """For each place of each query the least owner of the `depth` words from it on, or `none` where no text holds them.

        query: symbols of all queries end to end; first: where each starts, with the end. Queries are read
        backwards in step. A match as long as `depth` is reported and cut back by its last word, so each further
        place costs one step. A query with a word sequence the index lacks is searched again place by place.
        """
        out = np.full(len(query), none, np.int64)
        sizes = np.diff(first)
        low, high, matched = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.n, np.int64), np.zeros(len(sizes), np.int64)
        broken = np.zeros(len(sizes), bool)
        for back in range(int(sizes.max(initial=0))):
            live = np.flatnonzero((sizes > back) & ~broken)
            at = first[1:][live] - 1 - back
            a, b = self.step(query[at], low[live], high[live])
            found = a < b
            broken[live[~found]] = True
            live, at, a, b = live[found], at[found], a[found], b[found]
            matched[live] += 1
            full = matched[live] >= self.depth
            out[at[full]] = self.least[self.group[a[full]]]
            b[full] = self.high[a[full]]
            a[full] = self.low[a[full]]
            matched[live[full]] = self.depth - 1
            low[live], high[live] = a, b
        for q in np.flatnonzero(broken):
            out[first[q] : first[q + 1]] = none
            places = np.arange(first[q], first[q + 1] - self.depth + 1)
            a, b = np.zeros(len(places), np.int64), np.full(len(places), self.n, np.int64)
            for k in range(self.depth - 1, -1, -1):
                a, b = self.step(query[places + k], a, np.maximum(a, b))
            hit = a < b
            out[places[hit]] = self.least[self.group[a[hit]]]
        return out
