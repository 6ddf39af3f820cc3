"""A compressed full-text index over word ids, searched for many words at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit array with rank: packed words and one count per word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits are set."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Rank of any symbol, with the levels of the tree stored one bit per symbol.

    Each level holds one bit of every symbol, from the highest down, and sorts
    the sequence stably by that bit for the next.
    """

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for level in reversed(range(max(1, int(alphabet - 1).bit_length()))):
            bit = (symbols >> level) & 1
            self.levels.append((level, Bits(bit.astype(np.uint8)), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.first = self._descend(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first ``at``."""
        return self._descend(symbol, at) - self.first[symbol]


def _dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return np.unique(high * (int(low.max()) + 1) + low, return_inverse=True)[1].astype(np.int64)


def _ahead(ranks: np.ndarray, by: int) -> np.ndarray:
    """Ranks ``by`` places on; past the end lies the smallest rank of all."""
    out = np.zeros_like(ranks)
    out[: len(ranks) - by] = ranks[by:] + 1
    return out


class FMIndex:
    """Index of a text of word ids, exact for patterns of up to ``depth`` words.

    Suffixes are sorted by their first ``depth`` words, by doubling; that is all
    that backward search of such patterns looks at.  ``wide`` marks the rows
    where the first ``depth - 1`` words change: the interval of a pattern
    without its last word is read off there, so sliding a window by one word
    costs one backward step.
    """

    def __init__(self, text: np.ndarray, alphabet: int, depth: int):
        self.depth, size = depth, len(text)
        ranks, span, held = text.astype(np.int64), 1, {1: text.astype(np.int64)}
        while span * 2 <= depth:
            ranks = _dense(ranks, _ahead(ranks, span))
            span *= 2
            held[span] = ranks
        full = _dense(ranks, _ahead(ranks, depth - span)) if depth > span else ranks
        short = _dense(ranks, _ahead(ranks, depth - 1 - span)) if depth - 1 > span else ranks
        if depth - 1 < span:
            half = held[span // 2]
            short = _dense(half, _ahead(half, depth - 1 - span // 2))
        self.suffixes = np.argsort(full, kind="stable")
        before = np.where(self.suffixes > 0, text[self.suffixes - 1], 0)
        self.tree = WaveletTree(before, alphabet)
        # The symbol before the whole text counts as the separator, 0, like the one that ends it.
        counts = np.bincount(text, minlength=alphabet)
        self.below = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.wide_start, self.wide_end = self._runs(short[self.suffixes])
        self.size = size

    @staticmethod
    def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every row, where the run of equal values around it starts and ends."""
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        sizes = np.diff(np.concatenate([edge, [len(ordered)]]))
        return np.repeat(edge, sizes), np.repeat(edge + sizes, sizes)

    def extend(self, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of word + pattern, from the intervals of patterns."""
        base = self.below[word]
        return base + self.tree.rank(word, start), base + self.tree.rank(word, end)

    def shorten(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of patterns of ``depth`` words without their last word."""
        return self.wide_start[start], self.wide_end[start]

    def earliest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Smallest text position in each interval.

        Rows that agree in ``depth`` words are in text order, so it stands first.
        """
        return self.suffixes[start]
