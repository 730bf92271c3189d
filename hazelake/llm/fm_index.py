"""A compressed FM-index over sequences of word numbers: a wavelet matrix of the Burrows-Wheeler transform."""

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``text``, by doubling the length that is sorted by."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    size, width = len(text), 1
    while True:
        after = np.zeros(size, np.int64)
        after[: size - width] = rank[width:] + 1
        joint = rank * (size + 1) + after
        order = np.argsort(joint, kind="stable")
        ordered = joint[order]
        rank = np.empty(size, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        width *= 2
        if rank[order[-1]] == size - 1 or width >= size:
            return order


class WaveletMatrix:
    """Rank queries on a sequence: one packed bit vector per bit of the alphabet, with a count every 64 bits."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            ones = values >> level & 1
            packed = np.packbits(np.append(ones, np.zeros(128 - len(ones) % 64, ones.dtype)).astype(bool), bitorder="little")
            words = packed.view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            zeros = len(values) - int(ones.sum())
            self.levels.append((level, words, before, zeros))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end; both are arrays."""
        starts, ends = np.zeros(len(ends), np.int64), ends.astype(np.int64)
        for level, words, before, zeros in self.levels:
            one = (symbols >> level & 1).astype(bool)
            ends, starts = (
                np.where(one, zeros + ones, at - ones) for at, ones in ((x, self._ones(words, before, x)) for x in (ends, starts))
            )
        return ends - starts

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & mask)


class FMIndex:
    """Finds the interval of suffixes that begin with a pattern, for many patterns at once."""

    def __init__(self, text: np.ndarray):
        self.size = len(text)
        before = text[suffix_array(text) - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.wavelet = WaveletMatrix(before, max(1, int(text.max()).bit_length()))

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with a symbol put before each: one step of backward search."""
        base = self.first[symbols]
        return base + self.wavelet.rank(symbols, low), base + self.wavelet.rank(symbols, high)

    def intervals(self, text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Interval of each ``text[start : start + length]``; empty ones have ``low >= high``."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.size, np.int64)
        for back in range(length - 1, -1, -1):
            low, high = self.extend(text[starts + back], low, high)
        return low, high
