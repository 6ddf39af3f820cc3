"""Packing documents into token sequences along a space-filling curve.

Every document's tokens are hashed into a count vector, the vector is projected
to ``AXES`` fixed random directions, and the projections, cut to ``AXIS_BITS``
bits, give the document's place on a Hilbert curve.  Documents are range-sorted
by that place and laid end to end; the line is cut every ``LENGTH`` tokens, so
neighbours on the curve share sequences and only the end of the line is short.
The end is cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import bisect
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import discard, raw, slices, store, stored
from .registry import query, table
from .run_table import LONGEST, RunTable

LENGTH = 2048
END_ID = 1
VECTOR_DIMS = 512
AXES = 4
AXIS_BITS = 8
TOGETHER = 256

# Bytes that are white space (1), letters and digits (2), and marks that end a word (3).
KINDS = np.zeros(256, np.uint8)
KINDS[list(b" \t\n\v\f\r")] = 1
KINDS[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = 2
KINDS[list(b"!),.:;?")] = 3
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)

TOKENS = pa.schema([("doc", pa.binary()), ("n", pa.int64()), ("place", pa.int64()), ("ids", pa.binary())])
PIECES = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def hilbert_place(points: np.ndarray, bits: int = AXIS_BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points below 2**bits.

    Works from the highest bit down.  At each level the curve's sub-cube is a
    Gray code of the point's bits; what lies below is reflected and its axes
    are exchanged so that the curve stays connected.
    """
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for axis in range(axes):
            upper = (x[axis] & level) != 0
            swap = np.where(upper, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(upper, below, swap)
            x[axis] ^= swap
        level >>= 1
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flips = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flips ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flips
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(axes):
            place = (place << 1) | ((x[axis] >> bit) & 1)
    return place


def _directions() -> np.ndarray:
    """Fixed projection: signs from a multiplicative hash, alike in every run."""
    cells = np.arange(VECTOR_DIMS * AXES, dtype=np.uint64) + np.uint64(1)
    mixed = cells * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.where((mixed >> np.uint64(63)).astype(bool), 1.0, -1.0).reshape(VECTOR_DIMS, AXES)


DIRECTIONS = _directions()


def curve_place(documents: list[np.ndarray]) -> np.ndarray:
    sizes = [len(d) for d in documents]
    owner = np.repeat(np.arange(len(documents), dtype=np.int64), sizes)
    ids = np.concatenate(documents).astype(np.int64) if documents else np.zeros(0, np.int64)
    cell = owner * VECTOR_DIMS + (ids * 40503 >> 4) % VECTOR_DIMS
    counts = np.bincount(cell, minlength=len(documents) * VECTOR_DIMS).reshape(-1, VECTOR_DIMS)
    vectors = np.log1p(counts)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    spread = np.clip((vectors @ DIRECTIONS + 3.0) / 6.0, 0.0, 1.0 - 1e-9)
    return hilbert_place((spread * (1 << AXIS_BITS)).astype(np.int64))


class WordIds:
    """Token ids of texts by way of their words, each encoded once and kept.

    The tokenizer drops white space and never joins what it parts, so a text's
    ids are those of its runs between white space and marks in turn.  New runs
    are encoded many at a time, parted by a special token.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        special = [
            (i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special
        ]
        self.parting = max(special) if special else None
        self.marks = [content.encode() for _, content in special]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closing = None
        if suffix:
            self.closing = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.closing[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.runs = RunTable(np.dtype(self.kind))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    @staticmethod
    def _cut(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        packed, size = ids.tobytes(), ids.itemsize
        for start, end in zip((starts * size).tolist(), (ends * size).tolist()):
            yield packed[start:end]

    def _parted(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words that hold no special token, encoded with one between them."""
        mark, text = self.parting
        ids = self._encode([text.join(words)])[0]
        marks = np.flatnonzero(ids == mark)
        yield from self._cut(ids, np.concatenate([[0], marks + 1]), np.concatenate([marks, [len(ids)]]))

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of new words.

        A word of letters alone is one unit of the tokenizer and ends with a
        token that closes words, so such words are encoded with blanks between
        them, which is cheapest; a group where that does not hold, and all other
        words, are parted by a special token, or encoded one by one.
        """
        found: dict[bytes, bytes] = {}
        blob = b"\n".join(words)
        special = any(m in blob for m in self.marks)
        letters, plain, alone = [], [], []
        for word in words:
            text = word.decode("utf-8", "replace")
            if self.parting is None or special and any(m in word for m in self.marks):
                alone.append((word, text))
            elif self.closing is not None and text.isalpha():
                letters.append((word, text))
            else:
                plain.append((word, text))
        groups = [letters[i : i + TOGETHER] for i in range(0, len(letters), TOGETHER)]
        for group, ids in zip(groups, self._encode([" ".join(t for _, t in g) for g in groups])):
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(group) and (not len(ids) or ends[-1] == len(ids)):
                found.update(zip((w for w, _ in group), self._cut(ids, np.concatenate([[0], ends[:-1]]), ends)))
            else:
                plain += group
        for at in range(0, len(plain), TOGETHER):
            group = plain[at : at + TOGETHER]
            found.update(zip((w for w, _ in group), self._parted([t for _, t in group])))
        found.update(zip((w for w, _ in alone), (i.tobytes() for i in self._encode([t for _, t in alone]))))
        return found

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text and the end id, by way of its runs between white space and marks.

        Letters are made lower before runs are looked up, as the tokenizer makes
        them, unless that could turn a text into a special token.
        """
        data = b" ".join(texts) + b" "
        padded = np.frombuffer(data + bytes(LONGEST + 8), np.uint8)
        if not any(m[:2] in data for m in self.marks):
            padded = LOWER[padded]
        kinds = KINDS[padded[: len(data)]]
        before = np.append(np.uint8(1), kinds[:-1])
        begins = (kinds != 1) & ((before == 1) | (kinds == 3) & (before == 2))
        edges = np.flatnonzero(begins | (kinds == 1) & (before != 1))
        is_start = begins[edges]
        starts = edges[is_start]
        lengths = np.append(edges[1:], len(data))[is_start] - starts
        whole = padded.tobytes()

        def learn(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            spans = zip(starts[which].tolist(), (starts[which] + lengths[which]).tolist())
            runs = [whole[a:b] for a, b in spans]
            found = self.learn(set(runs))
            parts = [found[r] for r in runs]
            counts = np.array([len(x) for x in parts], np.int64) // np.dtype(self.kind).itemsize
            return np.frombuffer(b"".join(parts), self.kind), counts

        ids, counts = self.runs.encode(padded, starts, lengths, learn)
        through = np.append(0, np.cumsum(counts))
        stops = through[np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))]
        closed = np.insert(ids, stops, END_ID)
        edges = [0, *(stops + np.arange(1, len(texts) + 1)).tolist()]
        return [closed[a:b] for a, b in zip(edges, edges[1:])]


_encoders: dict[str, WordIds] = {}


def encoder(file: str) -> WordIds:
    if file not in _encoders:
        _encoders[file] = WordIds(file)
    return _encoders[file]


def _tokenizing(file: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        words = encoder(file)
        for batch in batches:
            for first, texts in slices(batch["text"]):
                arrays = words.ids(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc"].slice(first, len(texts)),
                        pa.array([len(a) for a in arrays], pa.int64()),
                        pa.array(curve_place(arrays), pa.int64()),
                        pa.array([a.tobytes() for a in arrays], pa.binary()),
                    ],
                    ["doc", "n", "place", "ids"],
                )

    return run


def line_starts(tokens: DataFrame) -> DataFrame:
    """(row, at): where each document starts on the line of all documents.

    Rows are range-partitioned by place on the curve; each part sums its own
    rows, and only one total per part is ordered globally.
    """
    order = ["place", "row"]
    ranged = stored(
        tokens.select("row", "place", "n").repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
        "curve",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy("part")
        .agg(F.sum("n").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("carried"))
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("within", F.sum("n").over(inside) - F.col("n"))
    return summed.join(carried, "part").select("row", (F.col("carried") + F.col("within")).alias("at"))


def line_end(total: int, length: int) -> list[int]:
    """Edges after the last full sequence: descending powers of two."""
    edges, at = [], total - total % length
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        edges.append(at)
    return edges


def cut(at: int, count: int, total: int, length: int, tail: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of a document."""
    full, begin = total // length, at
    while at < begin + count:
        if at < full * length:
            number, first, edge = at // length, at // length * length, (at // length + 1) * length
        else:
            k = bisect.bisect_right(tail, at)
            number, first, edge = full + k, tail[k - 1] if k else full * length, tail[k]
        stop = min(edge, begin + count)
        yield at - begin, stop - at, number, at - first
        at = stop


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """Pieces of all documents: key, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.

    A document is its ids and the end id; a NULL or empty text is the end id
    alone.  Repeated rows, and rows with equal or NULL keys, are packed each on
    its own; an empty table has no pieces; other columns are not returned.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(f"`{key}`").cast("string").cast("binary").alias("doc"), raw(text).alias("text"))
    tokens = named.mapInArrow(_tokenizing(tokenizer), "doc binary, n bigint, place bigint, ids binary")
    tokens = stored(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    tail = line_end(total, length)

    def pieces(batches) -> Iterator[pa.RecordBatch]:
        size = np.dtype(encoder(tokenizer).kind).itemsize
        for batch in batches:
            rows = {k: [] for k in ("doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for doc, at, n, ids in zip(*(batch[c].to_pylist() for c in ("doc", "at", "n", "ids"))):
                wide = np.frombuffer(ids, f"<u{size}").astype("<u4")
                for start, count, number, offset in cut(at, n, total, length, tail):
                    values = (doc, start, count, wide[start : start + count].tobytes(), n, number, offset)
                    for column, value in zip(rows.values(), values):
                        column.append(value)
            types = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows)
            )

    joined = tokens.select("row", "doc", "n", "ids").join(line_starts(tokens), "row")
    found = joined.select("doc", "at", "n", "ids").mapInArrow(pieces, f"doc binary, {PIECES}")
    return found.withColumn("doc", F.col("doc").cast("string").cast(kind)).withColumnRenamed("doc", key)


@query("op3_pack")
def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
