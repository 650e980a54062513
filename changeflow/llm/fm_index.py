"""A compressed FM-index over sequences of words, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Symbols stored as one packed bit vector per binary digit; counts symbols up to a position."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.digits = max(1, int(sigma - 1).bit_length())
        self.words, self.ranks, self.zeros = [], [], []
        for digit in reversed(range(self.digits)):
            bits = (symbols >> digit) & 1 == 1
            packed = np.packbits(bits, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.words.append(packed)
            self.ranks.append(ranks.astype(np.int32))
            self.zeros.append(len(bits) - int(bits.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where positions end up in the order of the last level, each on its symbol's way."""
        for level, digit in enumerate(reversed(range(self.digits))):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.ranks[level][word] + np.bitwise_count(self.words[level][word] & below)
            at = np.where((symbols >> digit) & 1 == 1, self.zeros[level] + ones, at - ones)
        return at


class FMIndex:
    """Index of a sequence of words (numbers from 1 up); finds where patterns of up to ``depth`` words occur.

    Suffixes are sorted by their first ``depth`` words, which is all that such searches need. Kept are the wavelet matrix and
    the counts of words; the suffixes themselves aren't.
    """

    def __init__(self, words: np.ndarray, depth: int):
        text = np.concatenate([words.astype(np.int64), [0]])
        sigma = int(text.max()) + 1
        before = text[np.argsort(self._order(text, depth), kind="stable") - 1]
        self.size = len(text)
        self.wavelets = WaveletMatrix(before, sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        every = np.arange(sigma)
        self.shift = self.first[:-1] - self.wavelets.descend(every, np.zeros(sigma, np.int64))

    @staticmethod
    def _order(text: np.ndarray, depth: int) -> np.ndarray:
        """Keys that sort as the first ``depth`` words of all suffixes do: ranks of longer and longer beginnings, as many
        of which are joined at a time as a number can hold."""

        def joined(ranks: np.ndarray, offsets: list[int], bits: int) -> np.ndarray:
            key = np.zeros(len(ranks), np.int64)
            for offset in offsets:
                key = (key << bits) | np.concatenate([ranks[offset:], np.zeros(offset, np.int64)])[:len(ranks)]
            return key

        rank, length = text, 1
        while True:
            bits = max(1, int(rank.max()).bit_length())
            fit = max(2, 63 // bits)
            if length * fit >= depth:
                offsets = [min(i * length, depth - length) for i in range(-(-depth // length))]
                return joined(rank, offsets, bits)
            rank = np.unique(joined(rank, [i * length for i in range(fit)], bits), return_inverse=True)[1]
            length *= fit

    def search(self, patterns: np.ndarray, stop_at: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of each row of ``patterns``: the interval [low, high) of suffixes that start with the longest
        suffix of the row that occurs, and its length (the matching statistic of the row's end). A row whose interval has
        shrunk to ``stop_at`` suffixes isn't searched further."""
        n = len(patterns)
        low, high = np.zeros(n, np.int64), np.full(n, self.size, np.int64)
        length, live = np.zeros(n, np.int64), np.arange(n)
        for column in reversed(range(patterns.shape[1])):
            symbols = patterns[live, column]
            bounds = self.wavelets.descend(np.concatenate([symbols, symbols]), np.concatenate([low[live], high[live]]))
            bounds += np.concatenate([self.shift[symbols], self.shift[symbols]])
            lo, hi = bounds[:len(live)], bounds[len(live):]
            found = lo < hi
            live, lo, hi = live[found], lo[found], hi[found]
            low[live], high[live] = lo, hi
            length[live] += 1
            live = live[hi - lo > stop_at]
        return low, high, length
