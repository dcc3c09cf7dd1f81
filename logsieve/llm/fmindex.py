"""An FM-index over a sequence of symbols, in numpy: suffix array by prefix doubling, wavelet
matrix for ranks, suffix positions sampled in text order."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order; a suffix that is a prefix of another comes first. Only suffixes whose
    order is still open are sorted again, by twice as many symbols each time."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    key = text[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    rank[order] = np.repeat(start, np.diff(np.r_[start, n]))  # a group's rank: its first place
    step = 1
    while True:
        sizes = np.diff(np.r_[start, n])
        tied = np.repeat(sizes > 1, sizes)
        places = np.flatnonzero(tied)
        if not len(places):
            return order
        suffix = order[places]
        after = suffix + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        by = np.lexsort((second, rank[suffix]))
        suffix, second = suffix[by], second[by]
        first = rank[suffix]
        order[places] = suffix
        fresh = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        rank[suffix] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))]
        heads = np.ones(n, dtype=bool)
        heads[places] = fresh
        start = np.flatnonzero(heads)
        step *= 2


class WaveletMatrix:
    """rank(symbols, i): how often each symbol stands before place i."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.bits)):
            bit = (values >> level) & 1
            ones = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        low = np.zeros_like(at)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbols >> (self.bits - 1 - level)) & 1 == 1
            a, b = ones[low], ones[at]
            low = np.where(bit, zeros + a, low - a)
            at = np.where(bit, zeros + b, at - b)
        return at - low


class FMIndex:
    """Symbols are 1 and up in ``text``; 0 is the end."""

    def __init__(self, text: np.ndarray, sigma: int):
        whole = np.append(text, 0).astype(np.int64)
        self.n = len(whole)
        suffixes = suffix_array(whole)
        self.bwt = whole[suffixes - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(whole, minlength=sigma))])
        self.ranks = WaveletMatrix(self.bwt, sigma)
        self.sampled = suffixes % SAMPLE == 0
        self.sample_at = np.cumsum(self.sampled) - 1
        self.samples = suffixes[self.sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of suffixes that begin with each pattern (a row of ``patterns``,
        of which the first ``lengths`` count), from the last symbol to the first."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for back in range(patterns.shape[1]):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - back]
            low[live] = self.before[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.ranks.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows begin: step back until a sampled one is met."""
        rows = rows.copy()
        place = np.zeros(len(rows), dtype=np.int64)
        steps, open_ = 0, np.arange(len(rows))
        while len(open_):
            here = rows[open_]
            found = self.sampled[here]
            done = open_[found]
            place[done] = self.samples[self.sample_at[here[found]]] + steps
            open_, here = open_[~found], here[~found]
            symbol = self.bwt[here]
            rows[open_] = self.before[symbol] + self.ranks.rank(symbol, here)
            steps += 1
        return place
