"""An FM-index over sequences of words, searched for many patterns at once.

The suffixes are sorted by their first ``depth`` words, then by position: enough to search for
patterns of up to ``depth`` words, and the first suffix of an interval is the leftmost occurrence.
The transformed text is kept as a wavelet matrix: a bit per word and level, with a running count
for each 64 bits.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks of symbols in a sequence of numbers below ``symbols``."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self._levels = max(1, int(symbols - 1).bit_length())
        self._bits, self._before, self._zeros = [], [], []
        for level in range(self._levels - 1, -1, -1):
            bit = (sequence >> level & 1).astype(np.uint8)
            room = -len(bit) % 64 + 64
            packed = np.packbits(np.pad(bit, (0, room)), bitorder="little").view(np.uint64)
            ones = np.bitwise_count(packed).astype(np.int32)
            self._bits.append(packed)
            self._before.append(np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32))
            self._zeros.append(len(bit) - int(ones.sum()))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        # Where the symbols' blocks begin below the last level.
        self._block = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self._levels - 1, -1, -1)):
            word = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = self._before[k][word] + np.bitwise_count(self._bits[k][word] & below)
            place = np.where(symbol >> level & 1, self._zeros[k] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._descend(symbol, place) - self._block[symbol]


class FMIndex:
    """The index of a text of symbols below ``symbols``; 0 separates, ends it, and is not searched."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.depth = depth
        order = _prefix_ranks(text, depth)
        self.suffixes = np.argsort(order, kind="stable")
        self._matrix = WaveletMatrix(text[self.suffixes - 1], symbols)
        self._first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes that begin with the patterns (rows), by backward search.

        An interval is given up, as of width 1, once it is: what is left is one occurrence.
        """
        last = patterns[:, -1]
        low, high = self._first[last], self._first[last + 1]
        active = np.flatnonzero(high - low > 1)
        for k in range(patterns.shape[1] - 2, -1, -1):
            symbol = patterns[active, k]
            low[active] = self._first[symbol] + self._matrix.rank(symbol, low[active])
            high[active] = self._first[symbol] + self._matrix.rank(symbol, high[active])
            active = active[high[active] - low[active] > 1]
        return low, high


def _prefix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes by their first ``depth`` symbols, by doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < depth:
        # The second half may overlap the first: what they share is equal where it matters.
        step = min(length, depth - length)
        behind = np.zeros_like(rank)
        behind[: len(rank) - step] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 2) + behind, return_inverse=True)[1].astype(np.int64)
        length += step
    return rank
