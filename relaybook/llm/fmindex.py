"""An FM-index over a sequence of symbols: suffix order, wavelet matrix and sampled positions."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The starts of all suffixes, sorted, by doubling the length that is compared.

    The last symbol must be smaller than all others and occur once.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        if step < n:
            ahead[:-step] = rank[step:] + 1
        pair = rank * (n + 1) + ahead
        order = np.argsort(pair, kind="stable")
        in_order = pair[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])])
        rank, step = new, step * 2
        if rank[order[-1]] == n - 1:
            return order


class Bits:
    """A bit vector with rank: 64-bit words and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & _ONE

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)


class FMIndex:
    """Counts and finds phrases in a text of symbols from 1 up; 0 is added as its end."""

    def __init__(self, text: np.ndarray, every: int = 8):
        symbols = np.concatenate([np.asarray(text, np.int64), [0]])
        order = suffix_order(symbols)
        last = symbols[order - 1]
        self.size, top = len(symbols), int(symbols.max())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        self.levels: list[tuple[int, Bits, int]] = []
        rest = last
        for shift in reversed(range(max(1, top.bit_length()))):
            bits = ((rest >> shift) & 1).astype(np.uint8)
            zeros = int(len(bits) - bits.sum())
            self.levels.append((shift, Bits(bits), zeros))
            rest = np.concatenate([rest[bits == 0], rest[bits == 1]])
        # Where the walk of a symbol's rank begins, so that differences count the symbol.
        self.base = self._walk(np.arange(top + 1), np.zeros(top + 1, np.int64))
        sampled = order % every == 0
        self.sampled, self.positions = Bits(sampled), order[sampled]

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def _before(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The row of the first suffix that begins with the symbol and goes on as row ``at`` does."""
        return self.first[symbol] + self._walk(symbol, at) - self.base[symbol]

    def _back(self, at: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one symbol earlier."""
        symbol, place = np.zeros(len(at), np.int64), at
        for shift, bits, zeros in self.levels:
            one = bits.get(place).astype(np.int64)
            ones = bits.rank(place)
            symbol |= one << shift
            place = np.where(one == 1, zeros + ones, place - ones)
        return self.first[symbol] + place - self.base[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows from, to of each phrase. Phrases are padded at their end to one width.

        A phrase may hold symbols that the text lacks; it then has no rows.
        """
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        known = len(self.first) - 1
        for step in range(phrases.shape[1] if len(phrases) else 0):
            alive = np.flatnonzero((step < lengths) & (low < high))
            symbol = phrases[alive, lengths[alive] - 1 - step]
            lost = symbol >= known
            high[alive[lost]] = low[alive[lost]]
            alive, symbol = alive[~lost], symbol[~lost]
            low[alive] = self._before(symbol, low[alive])
            high[alive] = self._before(symbol, high[alive])
        return low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place in the text) of every occurrence of the row ranges."""
        counts = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(low)), counts)
        offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        rows = np.repeat(low, counts) + offsets
        place, open_, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(open_):
            here = self.sampled.get(rows).astype(bool)
            place[open_[here]] = self.positions[self.sampled.rank(rows[here])] + steps
            open_, rows, steps = open_[~here], self._back(rows[~here]), steps + 1
        return phrase, place
