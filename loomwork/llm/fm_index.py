"""A compressed full-text index over words: Burrows-Wheeler transform in a wavelet matrix, searched backwards in batches.

All steps are vector operations over many patterns at once. The bits of the wavelet matrix are packed, with one count
per 64 bits: about 1.5 x log2(alphabet) bits a word.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
        padded[:self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletMatrix:
    """Ranks of any symbol in a sequence of small integers, one bit vector per binary digit."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        current = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = (current >> level) & 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        # Where each symbol begins once all digits are sorted.
        self.starts = self._descend(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = bits.rank(at)
            at = np.where((symbols >> (self.depth - 1 - k)) & 1, zeros + one, at - one)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._descend(symbols, at) - self.starts[symbols]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; ``text`` holds integers whose last is unique and smallest at its place."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        second = np.zeros(len(rank), np.int64)
        second[:-width] = rank[width:] + 1
        pair = rank * (len(rank) + 1) + second
        order = np.argsort(pair, kind="stable")
        step = np.concatenate([[0], np.diff(pair[order]) != 0]).cumsum()
        rank = np.empty(len(rank), np.int64)
        rank[order] = step
        if step[-1] == len(rank) - 1 or width >= len(rank):
            return order
        width *= 2


class FMIndex:
    """Index of several texts of 64-bit words."""

    def __init__(self, texts: list[np.ndarray]):
        self.words = np.unique(np.concatenate(texts))
        lengths = np.array([len(t) for t in texts])
        # Every text ends in a separator. For sorting each is its own symbol, below all words; in the transform they are one, 0.
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        total = int(lengths.sum() + len(texts))
        ends = self.begins + lengths
        text = np.zeros(total, np.int64)
        inside = np.ones(total, bool)
        inside[ends] = False
        text[inside] = np.searchsorted(self.words, np.concatenate(texts)) + 1
        ordered = text + len(texts)
        ordered[ends] = np.arange(len(texts))
        self.order = suffix_array(ordered)
        transformed = text[self.order - 1]
        n_symbols = len(self.words) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])[:-1]
        self.matrix = WaveletMatrix(transformed, n_symbols)
        self.total = total

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words, 0 for a word that the index does not hold."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1, 0)

    def search(self, codes: np.ndarray, ends: np.ndarray, longest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics, read backwards: for each end in ``codes`` the length of the longest match that ends there (``longest`` at
        most) and the interval of suffixes that begin with it."""
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.total, np.int64)
        going = np.flatnonzero(longest > 0)
        while len(going):
            symbol = codes[ends[going] - 1 - length[going]]
            at = self.first[symbol]
            both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low[going], high[going]]))
            new_low, new_high = at + both[:len(going)], at + both[len(going):]
            found = (symbol > 0) & (new_low < new_high)
            going, new_low, new_high = going[found], new_low[found], new_high[found]
            low[going], high[going] = new_low, new_high
            length[going] += 1
            going = going[length[going] < longest[going]]
        return length, low, high
