"""FM-index of a shard of text: backward search and location through wavelet-tree ranks.

The text is a sequence of symbols from 1 up; a 0 ends every run, and no pattern crosses it. Only sampled suffix positions are
kept; the others are found by walking back to the next sampled one. Everything is done for many patterns at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


class Bits:
    """Bits with rank: ones before a place, from one count per 64 bits and the rest of the word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]])

    def rank(self, at: np.ndarray) -> np.ndarray:
        rest = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & rest)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Sequence of symbols below ``1 << levels``; level by level, a node's symbols stand together from ``smaller`` on."""

    def __init__(self, symbols: np.ndarray, smaller: np.ndarray):
        self.smaller = smaller  # how many symbols are less than each
        self.levels = max(1, int(len(smaller) - 2).bit_length())
        self.padded = np.concatenate([smaller, np.full((1 << self.levels) + 1, smaller[-1])])
        self.bits, order = [], symbols
        for level in range(self.levels):
            shift = self.levels - 1 - level
            self.bits.append(Bits(order >> shift & 1))
            key = order >> shift
            order = order[np.argsort(key.astype(np.uint16) if shift + 16 > self.levels - 1 and self.levels <= 16 else key, kind="stable")]

    def _start(self, symbol: np.ndarray, shift: int) -> np.ndarray:
        return self.padded[symbol >> shift << shift]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        at = at.copy()
        for level, bits in enumerate(self.bits):
            shift = self.levels - 1 - level
            start = self._start(symbol, shift + 1)
            ones = bits.rank(start + at) - bits.rank(start)
            at = np.where(symbol >> shift & 1, ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each place, and how often it stands before."""
        symbol, at = np.zeros(len(at), np.int64), at.copy()
        for level, bits in enumerate(self.bits):
            shift = self.levels - 1 - level
            start = self._start(symbol, shift + 1)
            ones = bits.rank(start + at) - bits.rank(start)
            one = bits.get(start + at)
            at = np.where(one, ones, at - ones)
            symbol |= one.astype(np.int64) << shift
        return symbol, at


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; each 0 is less than the 0s behind it, so every order is settled within a run.

    Symbols are packed into the first keys; after that only suffixes that are still equal to a neighbour are sorted again.
    """
    n = len(text)
    ends = np.flatnonzero(text == 0)
    first = text.astype(np.int64) + len(ends)
    first[ends] = np.arange(len(ends))
    base = int(first.max()) + 1
    width = max(1, 62 // max(base.bit_length(), 1))
    padded = np.concatenate([first, np.zeros(width, np.int64)])
    keys = np.zeros(n, np.int64)
    for i in range(width):
        keys = keys * base + padded[i : i + n]
    order = np.argsort(keys, kind="stable")
    rank = np.zeros(n + 1, np.int64)

    def settle(places: np.ndarray, sorted_keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Give the sorted suffixes their ranks; which of them still equal a neighbour."""
        new = np.ones(len(places), bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        rank[places] = offsets[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        return ~new | np.append(~new[1:], False)

    tied = settle(order, keys[order], np.arange(n))
    where, places = np.flatnonzero(tied), order[tied]
    step = width
    while len(places):
        ahead = rank[np.minimum(places + step, n)]
        by = np.lexsort((ahead, rank[places]))
        keys = rank[places] * (n + 1) + ahead
        places = places[by]
        order[where] = places
        tied = settle(places, keys[by], where)
        where, places = where[tied], places[tied]
        step *= 2
    return order


class FmIndex:
    """Index of one text; the last symbol of the text must be 0."""

    def __init__(self, text: np.ndarray, symbols: int, every: int = SAMPLE_EVERY):
        order = suffix_order(text)
        counts = np.bincount(text, minlength=symbols)
        self.smaller = np.concatenate([[0], np.cumsum(counts)])
        before = np.where(order > 0, text[order - 1], 0)
        self.tree = WaveletTree(before.astype(np.int64), self.smaller)
        kept = (order % every == 0) | (before == 0)  # a run's first place too, so that no walk crosses a 0
        self.kept = Bits(kept)
        self.places = order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row (exclusive) of each pattern, all of one length; equal where it does not occur."""
        low, high = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
        alive = np.arange(len(patterns))
        a, b = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.smaller[-1])
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, column].astype(np.int64)
            a = self.smaller[symbol] + self.tree.rank(symbol, a)
            b = self.smaller[symbol] + self.tree.rank(symbol, b)
            there = b > a
            alive, a, b = alive[there], a[there], b[there]
        low[alive], high[alive] = a, b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text place of each row."""
        found, steps, open_, rows = np.zeros(len(rows), np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(open_):
            done = self.kept.get(rows)
            found[open_[done]] = self.places[self.kept.rank(rows[done])] + steps
            open_, rows = open_[~done], rows[~done]
            symbol, before = self.tree.access(rows)
            rows = self.smaller[symbol] + before
            steps += 1
        return found
