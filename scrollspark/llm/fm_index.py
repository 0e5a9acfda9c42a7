"""An FM-index of a sequence of symbols: suffix array, wavelet matrix, backward search, sampled positions.

All operations take whole arrays: many patterns are searched, and many rows located, at once.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Starts of all suffixes in their order.  A 0 ends a suffix, and zeros order by their place; the last symbol is a 0.

    Prefix doubling: the first sort packs as many symbols as fit into 62 bits, every
    further one compares twice as many, of the suffixes that are still tied.
    """
    n, width = len(symbols), max(1, 62 // bits)
    padded = np.zeros(n + width, np.int64)
    padded[:n] = symbols
    key, open_ = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(width):
        here = padded[j : j + n]
        open_ &= here != 0
        key = key << bits | np.where(open_, here, 0)
    order = np.argsort(key, kind="stable")
    # Suffixes that end within the packed symbols are in place: the stable sort has left them in the order of their zeros.
    first = np.ones(n, bool)
    first[1:] = (np.diff(key[order]) != 0) | ~open_[order[1:]]
    slots, starts, depth = np.arange(n), first, width
    rank = np.empty(n, np.int64)
    while True:
        at = np.flatnonzero(starts)
        size = np.diff(np.append(at, len(slots)))
        rank[order[slots]] = np.repeat(slots[at], size)
        tied = np.repeat(size > 1, size)
        slots = slots[tied]
        if not len(slots):
            return order
        rows = order[slots]
        pair = rank[rows] * n + rank[rows + depth]
        by = np.argsort(pair, kind="stable")
        order[slots], pair = rows[by], pair[by]
        starts = np.ones(len(slots), bool)
        starts[1:] = np.diff(pair) != 0
        depth *= 2


class Bits:
    """A bit vector with ranks: counts up to every 64th bit, and the rest by population count."""

    def __init__(self, flags: np.ndarray):
        size = len(flags) // 64 + 1
        packed = np.zeros(size * 8, np.uint8)
        body = np.packbits(flags, bitorder="little")
        packed[: len(body)] = body
        self.words = packed.view("<u8")
        self.counts = np.zeros(size + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.counts[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, low = at >> 6, (at & 63).astype(np.uint64)
        return self.counts[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << low) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class FMIndex:
    """Symbols 0 .. highest; zeros separate texts and are never searched for.  Every step-th place, and each place after a zero, is sampled."""

    def __init__(self, symbols: np.ndarray, highest: int, step: int = 8):
        n, self.bits = len(symbols), max(1, int(highest).bit_length())
        order = suffix_order(symbols, self.bits)
        before = symbols[order - 1].astype(np.int64)  # the Burrows-Wheeler transform; the symbol before place 0 is the last 0
        sampled = (order % step == 0) | (before == 0)
        self.sampled, self.samples = Bits(sampled), order[sampled]
        self.smaller = np.zeros(highest + 2, np.int64)
        np.cumsum(np.bincount(symbols, minlength=highest + 1), out=self.smaller[1:])
        self.levels: list[Bits] = []
        self.zeros: list[int] = []
        for level in range(self.bits):
            one = before >> (self.bits - 1 - level) & 1 == 1
            self.levels.append(Bits(one))
            self.zeros.append(n - int(one.sum()))
            before = np.concatenate([before[~one], before[one]])
        every = np.arange(highest + 1)
        self.base = self._descend(every, np.zeros(highest + 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where a place of the transform goes through the wavelet matrix on the way of a symbol."""
        for level, (flags, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = flags.rank(at)
            at = np.where(symbol >> (self.bits - 1 - level) & 1, zeros + ones, at - ones)
        return at

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The first row of a symbol plus the symbol's rank before a place."""
        return self.smaller[symbol] + self._descend(symbol, at) - self.base[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row of a matrix of symbols the first row of the suffixes that begin with it, and the row after the last one."""
        last = patterns[:, -1]
        low, high = self.smaller[last], self.smaller[last + 1]
        for j in range(patterns.shape[1] - 2, -1, -1):
            alive = np.flatnonzero(high > low)
            symbol = patterns[alive, j]
            low[alive], high[alive] = self._step(symbol, low[alive]), self._step(symbol, high[alive])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the sequence of the suffix of each row: steps back to a sampled one."""
        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            known = self.sampled.get(rows)
            out[todo[known]] = self.samples[self.sampled.rank(rows[known])] + steps
            todo, rows, steps = todo[~known], rows[~known], steps + 1
            at, symbol = rows, np.zeros(len(rows), np.int64)
            for flags, zeros in zip(self.levels, self.zeros, strict=True):
                one, ones = flags.get(at), flags.rank(at)
                symbol = symbol << 1 | one
                at = np.where(one, zeros + ones, at - ones)
            rows = self.smaller[symbol] + at - self.base[symbol]
        return out
