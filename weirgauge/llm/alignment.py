"""Alignment of two tokenizers' tokens of the same text by pointer jumping.

Tokens of both sides cover the same bytes.  Every token points to the token of
the other side that overlaps it and reaches farthest right, or to itself (the
first side's) where both end together.  Doubling the pointers until nothing
changes brings every token to the last token of its component, which labels
the group; a chain of n tokens takes log2(n) rounds, over all texts at once.

Tasks turn documents into blocks: one row with the groups of some thousand
documents, the id pairs they link, and in how many documents each pair is.
Only a block's distinct pairs travel to be counted over the corpus, and their
counts travel back to the block.  Nothing is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import raw, slices, store
from .byte_words import byte_words
from .registry import query, table

#: A block is closed at so many bytes of text, or so many distinct pairs summed over documents.
BLOCK_BYTES = 16 << 20
BLOCK_PAIRS = 4_000_000
ENCODE_BYTES = 1 << 20


def jump(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every token, those of A before those of B, the A token that ends its component.

    Tokens are given by the bytes at which they end; both sides end alike.
    """
    n = len(ends_a)
    if not n:
        return np.zeros(0, np.int64)
    starts_a, starts_b = np.append(0, ends_a[:-1]), np.append(0, ends_b[:-1])
    to_b = np.searchsorted(starts_b, ends_a, "left") - 1
    to_a = np.searchsorted(starts_a, ends_b, "left") - 1
    points = np.concatenate([np.where(ends_b[to_b] == ends_a, np.arange(n), n + to_b), to_a])
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            return points
        points = farther


class Sides:
    """Both tokenizers of a worker, with the bytes and the decimal forms of their ids."""

    def __init__(self, file_a: str, file_b: str):
        import sentencepiece

        self.a = byte_words(file_a, specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        vocabulary = {i: t for t, i in self.a.tokenizer.get_vocab().items()}
        coded = _byte_letters()
        self.bytes_a = [_decoded(vocabulary.get(i, ""), coded) for i in range(max(vocabulary) + 1)]
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in s], np.int64) for s in (self.bytes_a, self.bytes_b))
        self.size_b = len(self.bytes_b)
        longest = max(len(self.bytes_a), self.size_b)
        self.inner = np.array([b"%d," % k for k in range(longest)], object)
        self.last_a = np.array([b"%d|" % k for k in range(len(self.bytes_a))], object)
        self.last_b = np.array([b"%d;" % k for k in range(self.size_b)], object)

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where a side does not give back the blank and the text."""
        given = [b" " + t for t in texts]
        of_b = self.b.encode([t.decode("utf-8", "replace") for t in texts], num_threads=1)
        none = np.zeros(0, np.int64)
        found = []
        for text, whole, a, b in zip(texts, given, self.a.ids(given), of_b):
            same = text and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole
            same = same and b"".join(map(self.bytes_b.__getitem__, b)) == whole
            found.append((a.astype(np.int64), np.array(b, np.int64)) if same else (none, none))
        return found

    def align(self, texts: list[bytes]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links, groups), and its distinct pairs:
        which text, pair, links of this pair."""
        found = self.encode(texts)
        a, b = (np.concatenate([f[side] for f in found]) for side in (0, 1))
        to_a, to_b = (np.cumsum([len(f[side]) for f in found]) for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        label = jump(ends_a, ends_b)
        ends_group = np.zeros(len(a), np.int64)
        ends_group[label] = 1
        number = (np.cumsum(ends_group) - ends_group)[label]
        of_a, of_b = number[: len(a)], number[len(a) :]
        groups = int(ends_group.sum())
        a_in, b_in = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        b_before, a_through = np.cumsum(b_in) - b_in, np.cumsum(a_in)
        written = np.empty(len(a) + len(b), object)
        for ids, of, shift, last in ((a, of_a, b_before, self.last_a), (b, of_b, a_through, self.last_b)):
            closing = np.append(of[1:] != of[:-1], True) if len(of) else np.zeros(0, bool)
            written[np.arange(len(ids)) + shift[of]] = np.where(closing, last[ids], self.inner[ids])
        first = np.searchsorted(ends_b, ends_a - self.length_a[a], "right")
        links = np.searchsorted(ends_b - self.length_b[b], ends_a, "left") - first
        through = np.cumsum(links)
        at = np.arange(links.sum()) - np.repeat(through - links - first, links)
        pair = np.repeat(a, links) * self.size_b + b[at]
        text = np.repeat(np.searchsorted(to_a, np.arange(len(a)), "right"), links)
        room = len(self.bytes_a) * self.size_b
        own, times = np.unique(text * room + pair, return_counts=True)
        rows, begin_a, begin_b = [], 0, 0
        linked, grouped = np.append(0, through), np.append(0, np.cumsum(ends_group))
        for end_a, end_b in zip(to_a.tolist(), to_b.tolist()):
            body = b"".join(written[begin_a + begin_b : end_a + end_b].tolist())[:-1]
            rows.append((end_a - begin_a, end_b - begin_b, int(grouped[end_a] - grouped[begin_a]), int(linked[end_a] - linked[begin_a]), body))
            begin_a, begin_b = end_a, end_b
        return rows, own // room, own % room, times


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [k for k in range(256) if k not in set(plain)]
    return {chr(k): k for k in plain} | {chr(0x100 + k): byte for k, byte in enumerate(others)}


def _decoded(token: str, coded: dict[str, int]) -> bytes:
    """Bytes of an entry; one that is not byte-level (a special token) stands for its text."""
    return bytes(coded[c] for c in token) if all(c in coded for c in token) else token.encode()


@lru_cache(maxsize=4)
def sides(file_a: str, file_b: str) -> Sides:
    return Sides(file_a, file_b)


DOC_COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_pairs"]
BLOCKS = pa.schema(
    [("block", pa.int64()), ("keys", pa.list_(pa.binary())), ("groups", pa.list_(pa.string()))]
    + [(c, pa.list_(pa.int64())) for c in DOC_COLUMNS]
    + [(c, pa.binary()) for c in ("pairs", "documents", "linked", "times")]
)
BLOCK_DDL = (
    "block bigint, keys array<binary>, groups array<string>, "
    + ", ".join(f"{c} array<bigint>" for c in DOC_COLUMNS)
    + ", pairs binary, documents binary, linked binary, times binary"
)


def _blocks(file_a: str, file_b: str, as_text: bool):
    def run(batches) -> Iterator[pa.RecordBatch]:
        both = sides(file_a, file_b)
        number = TaskContext.get().partitionId() << 32
        keys, rows, parts, size, held = [], [], [], 0, 0

        def block() -> pa.RecordBatch:
            pairs, linked = np.unique(np.concatenate([p for p, _, _ in parts]), return_inverse=True)
            documents = np.bincount(linked, minlength=len(pairs))
            counts = np.concatenate([n for _, _, n in parts])
            times = np.concatenate([t for _, t, _ in parts])
            columns = [pa.array([[r[k] for r in rows]], pa.list_(pa.int64())) for k in range(4)]
            columns.append(pa.array([counts.tolist()], pa.list_(pa.int64())))
            arrays = [pairs.astype("<u8"), documents.astype("<u4"), linked.astype("<u4"), times.astype("<u4")]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([keys], pa.list_(pa.binary())),
                    pa.array([[r[4] for r in rows]], pa.list_(pa.string())),
                    *columns,
                    *(pa.array([x.tobytes()], pa.binary()) for x in arrays),
                ],
                schema=BLOCKS,
            )

        for batch in batches:
            for first, texts in slices(batch["text"], ENCODE_BYTES):
                keys += batch["key"].slice(first, len(texts)).to_pylist()
                found, owner, pairs, times = both.align(texts)
                for *counts, body in found:
                    rows.append((*counts, body.decode() if as_text else hashlib.sha256(body).hexdigest() if body else ""))
                parts.append((pairs, times, np.bincount(owner, minlength=len(texts))))
                size, held = size + sum(map(len, texts)), held + len(pairs)
                if size >= BLOCK_BYTES or held >= BLOCK_PAIRS:
                    yield block()
                    number += 1
                    keys, rows, parts, size, held = [], [], [], 0, 0
        if keys:
            yield block()

    return run


def _each_pair(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, documents in zip(*(batch[c].to_pylist() for c in ("block", "pairs", "documents"))):
            pair, count = np.frombuffer(pairs, "<u8").astype(np.int64), np.frombuffer(documents, "<u4").astype(np.int64)
            for at in range(0, len(pair), 100_000):
                part = pair[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), block)), pa.array(part), pa.array(count[at : at + 100_000])],
                    ["block", "pair", "documents"],
                )


def pair_counts(each: DataFrame, size_b: int) -> DataFrame:
    """Of the blocks' pairs: pair (A id times the size of B's vocabulary, plus B id), documents that
    hold it linked, and whether no pair of its A id is in more."""
    counted = each.groupBy("pair").agg(F.sum("documents").alias("documents"))
    of_a = Window.partitionBy(F.expr(f"pair div {size_b}"))  # at most one row per id of B
    return counted.withColumn("best", F.col("documents") == F.max("documents").over(of_a))


def _rows(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of one block, with the corpus counts of its pairs."""
    block = left.to_pylist()[0]
    counts = right.sort_by("pair")
    documents, best = counts["documents"].to_numpy(), counts["best"].to_numpy()
    linked, times = np.frombuffer(block["linked"], "<u4"), np.frombuffer(block["times"], "<u4").astype(np.int64)
    edges = np.append(0, np.cumsum(np.array(block["n_pairs"], np.int64)))
    total = lambda x: np.diff(np.append(0, np.cumsum(x))[edges])
    columns = {"key": pa.array(block["keys"], pa.binary())}
    columns |= {c: pa.array(block[c], pa.int64()) for c in DOC_COLUMNS[:4]}
    columns["n_best"] = pa.array(total(times * best[linked]))
    columns["count_sum"] = pa.array(total(times * documents[linked]))
    columns["groups"] = pa.array(block["groups"], pa.string())
    return pa.table(columns)


LONGS = [*DOC_COLUMNS[:4], "n_best", "count_sum"]


def align(
    docs: DataFrame, file_a: str, file_b: str, *, key: str = "doc_id", text: str = "text", as_text: bool = True
) -> DataFrame:
    """One row per document: key, n_a and n_b tokens, n_groups, n_links (pairs of
    tokens that overlap), n_best (links whose id pair is in as many documents as
    any pair of its A id), count_sum (documents of the pair, summed over links)
    and groups: ``a1,a2|b1;a3|b2,b3`` or, without ``as_text``, its SHA-256.

    NULL and empty texts, and texts that a tokenizer does not give back byte by
    byte, have no tokens: zeros and ''.  Rows with equal or NULL keys are each a
    document; an empty table gives no rows; other columns are not returned.  A
    document, however long, is aligned as a whole.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(f"`{key}`").cast("string").cast("binary").alias("key"), raw(text).alias("text"))
    found = named.mapInArrow(_blocks(file_a, file_b, as_text), BLOCK_DDL)
    blocks = spark.read.schema(found.schema).parquet(store(found, "aligned"))
    each = blocks.select("block", "pairs", "documents").mapInArrow(_each_pair, "block bigint, pair bigint, documents bigint")
    counts = pair_counts(each, sides(file_a, file_b).size_b)
    known = each.select("block", "pair").join(counts, "pair")
    columns = ", ".join(["key binary", *(f"{c} bigint" for c in LONGS), "groups string"])
    rows = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_rows, columns)
    return rows.select(F.col("key").cast("string").cast(kind).alias(key), *LONGS, "groups")


@query("op11_align")
def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens between common ends, and how usual their links are."""
    import public_tokenizers

    files = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    rows = align(table(spark, sf_dir, "documents").select("doc_id", "text"), *files, as_text=False)
    return rows.withColumnRenamed("groups", "groups_sha256")
