"""Token ids of whole texts by a byte-level tokenizer, each word encoded once.

Such a tokenizer never joins a word to the white space or the mark after it, so
a text falls apart there and its ids are those of its runs in turn.  A worker
remembers the ids of short runs in a table that is searched for all runs at
once; new ones are encoded many at a time, parted by line breaks.  Texts with
white space beyond ASCII, and with special tokens where these are recognised,
are encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .run_table import LONGEST, RunTable, reorder

TOGETHER = 256

# Bytes that are white space (1), letters and digits (2), and marks that end a word (3);
# white space beyond ASCII.
BLANK = 0x20
KINDS = np.zeros(256, np.uint8)
KINDS[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, BLANK]] = 1
KINDS[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = 2
KINDS[list(b"!),.:;?")] = 3
FAR_WHITE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class ByteWords:
    """``specials`` says whether special tokens within a text are recognised."""

    def __init__(self, file: str, specials: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = not specials
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.marks = [t.content for t in added] if specials else []
        self.runs = RunTable(self.kind)
        (self.line,) = self._encode(["\n"])[0]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _learn(self, runs: list[str], white: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs in turn, how many each has); the last ``white`` runs hold white space and are encoded one by one."""
        joined = runs[: len(runs) - white]
        groups = [joined[i : i + TOGETHER] for i in range(0, len(joined), TOGETHER)]
        found, counts = [np.zeros(0, self.kind)], [np.zeros(0, np.int64)]
        for group, ids in zip(groups, self._encode(["\n".join(g) for g in groups])):
            parting = ids == self.line
            ends = np.append(np.flatnonzero(parting), len(ids))
            if len(ends) != len(group):
                raise ValueError("the tokenizer joins words over a line break")
            found.append(ids[~parting])
            counts.append(np.diff(ends, prepend=-1) - 1)
        alone = self._encode(runs[len(joined) :])
        return np.concatenate(found + alone), np.concatenate([*counts, np.array([len(i) for i in alone], np.int64)])

    def _by_runs(self, texts: list[bytes]) -> list[np.ndarray]:
        data = b"".join(texts)
        padded = np.frombuffer(data + bytes(LONGEST + 8), np.uint8)
        begins = np.cumsum([0, *map(len, texts)])
        kinds = KINDS[padded[: len(data)]]
        white, before = kinds == 1, np.append(np.uint8(0), kinds[:-1])
        parting = np.append(white & (before != 1) | (kinds == 3) & (before == 2), False)
        parting[begins] = True
        starts = np.flatnonzero(parting[: len(data)])
        lengths = np.diff(np.append(starts, len(data)))
        inner = white.copy()
        inner[starts] &= padded[starts] != BLANK
        inside = np.add.reduceat(inner, starts, dtype=np.int64) > 0 if len(starts) else np.zeros(0, bool)

        def learn(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.argsort(inside[which], kind="stable")
            which = which[order]
            spans = zip(starts[which].tolist(), (starts[which] + lengths[which]).tolist())
            return reorder(*self._learn([data[a:b].decode() for a, b in spans], int(inside[which].sum())), np.argsort(order))

        ids, counts = self.runs.encode(padded, starts, lengths, learn)
        through = np.append(0, np.cumsum(counts))
        edges = through[np.searchsorted(starts, begins)].tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:])]

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text; bytes that are no UTF-8 count as replacement characters."""
        plain = [t.decode("utf-8", "replace") for t in texts]
        whole = [k for k, t in enumerate(plain) if self._whole(t)]
        out: list = [None] * len(plain)
        for k, ids in zip(whole, self._encode([plain[k] for k in whole])):
            out[k] = ids
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, self._by_runs([plain[k].encode() for k in rest])):
            out[k] = ids
        return out

    def _whole(self, text: str) -> bool:
        return any(m in text for m in self.marks) or not text.isascii() and FAR_WHITE.search(text) is not None


_encoders: dict[tuple[str, bool], ByteWords] = {}


def byte_words(file: str, specials: bool = True) -> ByteWords:
    """The encoder of this worker."""
    if (file, specials) not in _encoders:
        _encoders[file, specials] = ByteWords(file, specials)
    return _encoders[file, specials]
