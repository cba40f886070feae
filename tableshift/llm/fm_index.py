"""A compressed FM-index over integer symbols: a wavelet matrix of packed bits over the Burrows-Wheeler transform.

Suffixes are sorted to a depth of 16 or more symbols, enough for patterns of up to that length: the interval of a shorter
pattern does not depend on how suffixes that agree further are ordered. The intervals of the runs of two to four symbols that the
first sort tells apart are kept as a table, and a search starts from there.
"""

from __future__ import annotations

import numpy as np

MOST_START = 4  # symbols of the runs in the table
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)  # the bits below each


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """Places of the suffixes, sorted by their first ``depth`` symbols or more: each sort takes as many ranks ahead as fit 64 bits.

    And of the first sort: how many symbols it compares, the class of each place by them, and the first row of each class (and the end).
    """
    rank, span, start = text.astype(np.uint64), 1, None
    while True:
        base = int(rank.max(initial=0)) + 2  # 0 is behind the text
        count = min(64 // base.bit_length(), -(-depth // span))
        if start is None:
            count = min(count, MOST_START)
        key = rank + np.uint64(1)
        for i in range(1, max(2, count)):
            key *= np.uint64(base)
            key[:max(0, len(key) - i * span)] += rank[i * span:] + np.uint64(1)
        span *= max(2, count)
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank = np.empty(len(key), np.uint64)
        rank[order] = np.cumsum(new) - 1
        if start is None:
            start = span, rank.astype(np.int64), np.append(np.flatnonzero(new), len(new))
        if span >= depth or new.all():
            return order, *start


def places_type(length: int) -> type:
    """The type of places in a text of this length."""
    return np.int32 if length < 1 << 31 else np.int64


class Bits:
    """A bit vector with constant-time rank: 64-bit words and a running count per word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        counts = np.bitwise_count(self.words)
        self.total = int(counts.sum(dtype=np.int64))
        self.before = np.cumsum(counts, dtype=places_type(len(bits))) - counts

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & _BELOW[at & 63])


class FmIndex:
    """Backward search over ``text``, whose symbols are 0 to ``symbols - 1``."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        kind = places_type(len(text))
        self.order, self.run, self.run_at, runs = suffix_order(text, depth)
        self.run_at, self.runs = self.run_at.astype(kind), runs.astype(kind)
        self.levels: list[tuple[int, int, Bits]] = []
        column = text[self.order - 1]  # the symbol before each suffix; the whole text follows its last symbol
        column = column.astype(np.int32 if symbols < 1 << 31 else np.int64)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols)))).astype(kind)
        self.start = np.zeros(symbols, kind)
        every = np.arange(symbols, dtype=column.dtype)
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (column >> shift) & 1 == 1
            bits = Bits(ones)
            zeros = len(column) - bits.total
            self.levels.append((shift, zeros, bits))
            column = np.concatenate((column[~ones], column[ones]))
            self.start = self._step(self.start, every, shift, zeros, bits)

    @staticmethod
    def _step(at: np.ndarray, symbol: np.ndarray, shift: int, zeros: int, bits: Bits) -> np.ndarray:
        ones = bits.rank(at)
        return np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one more symbol in front."""
        both, twice = np.concatenate((low, high)), np.concatenate((symbol, symbol))
        for shift, zeros, bits in self.levels:
            both = self._step(both, twice, shift, zeros, bits)
        both += self.first[twice] - self.start[twice]
        return both[:len(low)], both[len(low):]

    def intervals(self, text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the text's own places, up to ``length``: for the ``length`` symbols that end before each of
        ``ends``, the matched length and the interval of that match. A match that is met only once goes no further."""
        if length < self.run:
            known, symbol = 1, text[ends - 1]
            low, high = self.first[symbol].copy(), self.first[symbol + 1].copy()
        else:
            known, run = self.run, self.run_at[ends - self.run]
            low, high = self.runs[run], self.runs[run + 1]
        matched = np.full(len(ends), known, np.int64)
        live = np.arange(len(ends))
        for step in range(known + 1, length + 1):
            live = live[high[live] - low[live] > 1]
            if not len(live):
                break
            low[live], high[live] = self.extend(low[live], high[live], text[ends[live] - step])
            matched[live] = step
        return matched, low, high
