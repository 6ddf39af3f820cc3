"""A minimal perfect hash of a fixed set of keys, with fingerprints.

Keys are known by two 64-bit hashes.  On every level each key left picks a bit
of an array twice as long as there are keys; a key alone on its bit stays there
and the others go on.  A key's slot is the number of set bits before its own,
so n keys fill slots 0 to n-1 and a look-up costs a few steps whatever n is.
Keys that never come to be alone (both hashes equal) are kept in full.
"""

from __future__ import annotations

import io

import numpy as np

LEVELS = 40


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = h1 + h2 * np.uint64(2 * level + 1)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def fingerprints(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return ((h1 * np.uint64(0xC2B2AE3D27D4EB4F) ^ h2) >> np.uint64(32)).astype(np.uint32)


class Levels:
    """The bit arrays, and the number of set bits before each word of 64."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.first = np.concatenate([[0], np.cumsum(sizes // 64)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.slots = int(ones.sum())

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> Levels:
        sizes, words, rest = [], [], np.arange(len(h1))
        while len(rest) and len(sizes) < LEVELS:
            size = -(-2 * len(rest) // 64) * 64
            at = _place(h1[rest], h2[rest], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = rest[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, "<u8"), *words]))

    def slot(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 where every level's bit is clear."""
        found = np.full(len(h1), -1, np.int64)
        rest = np.arange(len(h1))
        for level, size in enumerate(self.sizes.tolist()):
            at = _place(h1[rest], h2[rest], level, size)
            word = self.first[level] + (at >> 6)
            bit = (at & 63).astype(np.uint64)
            held = self.words[word]
            is_set = (held >> bit) & np.uint64(1) == 1
            lower = held & ((np.uint64(1) << bit) - np.uint64(1))
            here = self.before[word] + np.bitwise_count(lower).astype(np.int64)
            found[rest[is_set]] = here[is_set]
            rest = rest[~is_set]
        return found


class HashIndex:
    """Positions of keys: rows of ``values``, one or more for each key."""

    def __init__(self, levels: Levels, prints: np.ndarray, starts: np.ndarray, values: np.ndarray, kept: list[bytes | None]):
        self.levels, self.prints, self.starts, self.values = levels, prints, starts, values
        self.kept = {key: levels.slots + k for k, key in enumerate(kept)}

    @classmethod
    def build(cls, keys: list, h1: np.ndarray, h2: np.ndarray, values: np.ndarray) -> HashIndex:
        """``values`` has one row per entry of ``keys``; equal keys stand together."""
        new = np.array([k == 0 or keys[k] != keys[k - 1] for k in range(len(keys))], bool)
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(keys)))
        levels = Levels.of(h1[first], h2[first])
        slots = levels.slot(h1[first], h2[first])
        # a key that was never alone finds a clear bit everywhere or another key's slot
        prints = np.zeros(levels.slots, np.uint32)
        own = np.full(levels.slots, -1, np.int64)
        pairs: dict[tuple[int, int], int] = {}
        for k, pair in enumerate(zip(h1[first].tolist(), h2[first].tolist())):
            pairs[pair] = pairs.get(pair, 0) + 1
        twin = np.array([pairs[p] > 1 for p in zip(h1[first].tolist(), h2[first].tolist())], bool)
        single = ~twin & (slots >= 0)
        own[slots[single]] = np.flatnonzero(single)
        left = np.flatnonzero(~single)
        order = np.concatenate([own, left])
        prints[:] = fingerprints(h1[first], h2[first])[own]
        starts = np.concatenate([[0], np.cumsum(counts[order])]).astype(np.int64)
        rows = np.concatenate([np.arange(first[k], first[k] + counts[k]) for k in order]) if len(order) else np.zeros(0, np.int64)
        return cls(levels, prints, starts, values[rows], [keys[first[k]] for k in left])

    def look_up(self, keys: list, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which key, its position) for every position of the keys that are there.

        A key that is not there is found by mistake once in 2**32 look-ups.
        """
        slots = self.levels.slot(h1, h2)
        there = slots >= 0
        there[there] = self.prints[slots[there]] == fingerprints(h1[there], h2[there])
        slots = np.where(there, slots, -1)
        if self.kept:
            for k, key in enumerate(keys):
                slots[k] = self.kept.get(key, slots[k])
        who = np.flatnonzero(slots >= 0)
        counts = self.starts[slots[who] + 1] - self.starts[slots[who]]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(who, counts), self.values[np.repeat(self.starts[slots[who]], counts) + within]

    def to_bytes(self) -> bytes:
        lengths = np.array([-1 if k is None else len(k) for k in self.kept], np.int64)
        text = np.frombuffer(b"".join(k or b"" for k in self.kept), np.uint8)
        out = io.BytesIO()
        np.savez(
            out, sizes=self.levels.sizes, words=self.levels.words, prints=self.prints, starts=self.starts,
            values=self.values, lengths=lengths, text=text,
        )
        return out.getvalue()

    @classmethod
    def from_bytes(cls, packed: bytes) -> HashIndex:
        held = np.load(io.BytesIO(packed), allow_pickle=False)
        kept, text, at = [], held["text"].tobytes(), 0
        for length in held["lengths"].tolist():
            kept.append(None if length < 0 else text[at : at + length])
            at += max(length, 0)
        levels = Levels(held["sizes"], held["words"])
        return cls(levels, held["prints"], held["starts"], held["values"], kept)
