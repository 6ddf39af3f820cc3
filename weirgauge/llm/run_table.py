"""A hash table from short byte strings to token ids, in flat arrays.

Millions of words are looked up at once: their bytes are read as three 64-bit
numbers, so that equal numbers and lengths mean equal words, and all look-ups
probe the table together.  An entry takes about 60 bytes.
"""

from __future__ import annotations

import numpy as np

#: Longest word a table holds, in bytes.
LONGEST = 24
FIRST_BITS = 12
#: Entries at which the older half is dropped.
ENTRIES = 2_500_000

_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def words_of(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to LONGEST bytes from each start as rows of three numbers; ``padded`` has as many bytes to spare."""
    every = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    return np.stack([every[starts + 8 * k] & _MASKS[np.clip(lengths - 8 * k, 0, 8)] for k in range(3)], axis=1)


def mixed(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = words[:, 0] * _FACTORS[0]
    for k in (1, 2):
        out = (out ^ (out >> np.uint64(32)) ^ words[:, k]) * _FACTORS[k]
    out = (out ^ (out >> np.uint64(29)) ^ lengths.astype(np.uint64)) * _FACTORS[3]
    return out ^ (out >> np.uint64(32))


class RunTable:
    def __init__(self, kind: np.dtype):
        self.kind = kind
        self._empty(FIRST_BITS, 1024)

    def _empty(self, bits: int, room: int) -> None:
        self.bits, self.entries, self.used = bits, 0, 0
        self.words = np.zeros((1 << bits, 3), np.uint64)
        self.lengths = np.zeros(1 << bits, np.uint8)
        self.firsts, self.counts = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint16)
        self.ids = np.zeros(room, self.kind)

    def find(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Slots of the words; -1 for those that are not there."""
        slots = (mixed(words, lengths) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = np.full(len(words), -1, np.int64)
        rest = np.arange(len(words))
        while len(rest):
            at, held = slots[rest], self.lengths[slots[rest]]
            same = held == lengths[rest]
            own, theirs = words[rest[same]], self.words[at[same]]
            same[same] = (own == theirs).all(axis=1)
            found[rest[same]] = at[same]
            rest = rest[~same & (held != 0)]
            slots[rest] = (slots[rest] + 1) & ((1 << self.bits) - 1)
        return found

    def add(self, words: np.ndarray, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Words that are not there and differ from each other; ``ids`` of all, in turn."""
        if self.entries + len(words) > ENTRIES:
            self._rebuild(older=True)
        while 3 * (self.entries + len(words)) > 2 << self.bits:
            self._rebuild(bits=self.bits + 1)
        firsts = self.used + np.cumsum(counts) - counts
        if self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(len(self.ids) + len(ids), self.kind))
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self._place(words, lengths, firsts, counts)

    def _place(self, words, lengths, firsts, counts) -> None:
        slots = (mixed(words, lengths) >> np.uint64(64 - self.bits)).astype(np.int64)
        rest = np.arange(len(words))
        while len(rest):
            free = rest[self.lengths[slots[rest]] == 0]
            at, chosen = np.unique(slots[free], return_index=True)
            who = free[chosen]
            self.words[at], self.lengths[at] = words[who], lengths[who]
            self.firsts[at], self.counts[at] = firsts[who], counts[who]
            rest = np.setdiff1d(rest, who, assume_unique=True)
            slots[rest] = np.where(self.lengths[slots[rest]] != 0, slots[rest] + 1, slots[rest]) & ((1 << self.bits) - 1)
        self.entries += len(words)

    def _rebuild(self, bits: int | None = None, older: bool = False) -> None:
        """The same entries, or their newer half, in a new table."""
        held = np.flatnonzero(self.lengths)
        held = held[np.argsort(self.firsts[held], kind="stable")][len(held) // 2 if older else 0 :]
        words, lengths, counts, old = self.words[held], self.lengths[held], self.counts[held], self.ids
        start = int(self.firsts[held[0]]) if len(held) else self.used
        kept, firsts = old[start : self.used], self.firsts[held] - start
        self._empty(bits or self.bits, max(1024, 2 * len(kept)))
        self.ids[: len(kept)], self.used = kept, len(kept)
        self._place(words, lengths, firsts, counts)

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all slots in turn, how many each has)."""
        counts = self.counts[slots].astype(np.int64)
        through = np.cumsum(counts)
        at = np.arange(through[-1] if len(through) else 0) + np.repeat(self.firsts[slots].astype(np.int64) - through + counts, counts)
        return self.ids[at], counts

    def encode(self, padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, learn) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs in turn, how many each has).

        ``learn`` gives the same for an array of run numbers; it is asked once
        for every short run that is not in the table, and for each long one.
        """
        short, long = np.flatnonzero(lengths <= LONGEST), np.flatnonzero(lengths > LONGEST)
        words, sizes = words_of(padded, starts[short], lengths[short]), lengths[short]
        slots = self.find(words, sizes)
        while len(missing := np.flatnonzero(slots < 0)):
            _, first = np.unique(mixed(words[missing], sizes[missing]), return_index=True)
            pick = missing[first]
            self.add(words[pick], sizes[pick], *learn(short[pick]))
            slots = self.find(words, sizes)  # new entries may have moved the old ones
        ids, counts = self.gather(slots)
        if not len(long):
            return ids, counts
        others, their = learn(long)
        every = np.zeros(len(lengths), np.int64)
        every[short], every[long] = counts, their
        through = np.append(0, np.cumsum(counts))
        return np.insert(ids, np.repeat(through[np.searchsorted(short, long)], their), others), every


def reorder(ids: np.ndarray, counts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of runs, given in turn, for the runs in another order."""
    before = np.cumsum(counts) - counts
    taken = counts[order]
    through = np.cumsum(taken)
    return ids[np.arange(len(ids)) + np.repeat(before[order] - through + taken, taken)], taken
