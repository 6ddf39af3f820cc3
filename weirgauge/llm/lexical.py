"""Ranked lexical search of many items at once by two trees.

Items are kept in a tree, and so are the documents of every block.  A node
holds, term by term, the largest value of anything below it: for items the
weight of the term times its repeats, for documents the share that its count
earns.  The product of two nodes bounds every score between their members.
Both trees are descended together; a pair of nodes whose bound is below the
weakest kth score of the node's items is dropped with all documents and items
below it, and the scores of the leaves that remain are exact.

Items are searched in portions of bounded size, each in one pass over the
documents.  Every task keeps the best of its own documents; kth scores found
in a few blocks first are lower bounds of the final ones and start every task.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import raw, slices, stored
from .registry import query, table

TOP = 20
#: Items of one pass: bytes of text, each item counting ITEM_COST besides.
PORTION_BYTES = 512 << 10
ITEM_COST = 256
BLOCK_DOCS = 2048
BLOCK_ENTRIES = 1_000_000
ITEM_LEAF, DOC_LEAF = 4, 16
#: Blocks whose kth scores start the search.
FIRST_BLOCKS = 4
#: Sums of floating-point numbers may fall short of the true bound by less than this share.
SLACK = 1e-9

# Bytes that are part of a term, upper case made lower.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


class Sparse:
    """Rows of (column, value), column-wise sorted within each row."""

    def __init__(self, edges: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.edges, self.columns, self.values, self.width = edges, columns, values, width
        self.rows = np.repeat(np.arange(len(edges) - 1), np.diff(edges))

    def __len__(self) -> int:
        return len(self.edges) - 1

    def take(self, order: np.ndarray) -> Sparse:
        sizes = np.diff(self.edges)[order]
        edges = np.append(0, np.cumsum(sizes))
        at = np.arange(edges[-1]) + np.repeat(self.edges[order] - edges[:-1], sizes)
        return Sparse(edges, self.columns[at], self.values[at], self.width)

    def dot(self, vector: np.ndarray, rows: np.ndarray) -> np.ndarray:
        part = self.take(rows)
        return np.bincount(part.rows, part.values * vector[part.columns], minlength=len(rows))

    def maxima(self, group: np.ndarray, groups: int) -> np.ndarray:
        """Largest value of every column in every group of rows (values are positive)."""
        cell = group[self.rows] * self.width + self.columns
        order = np.argsort(cell, kind="stable")
        out = np.zeros(groups * self.width)
        if len(order):
            first = np.flatnonzero(np.append(True, np.diff(cell[order]) != 0))
            out[cell[order][first]] = np.maximum.reduceat(self.values[order].astype(float), first)
        return out.reshape(groups, self.width)


class Tree:
    """A binary tree over rows; level k has 2**k nodes, the last its leaves.

    A node's rows are dealt in halves by which of two of them, far apart, they
    are nearer to.  ``order`` lists the rows leaf by leaf; ``leaf`` has the
    leaf of each, and ``levels`` the coordinate maxima of every level's nodes.
    """

    def __init__(self, rows: Sparse, leaf: int):
        self.depth = max(0, math.ceil(math.log2(max(len(rows), 1) / leaf)))
        parts = [np.arange(len(rows))]
        for _ in range(self.depth):
            parts = [half for part in parts for half in self._halves(rows, part)]
        self.order = np.concatenate(parts)
        self.edges = np.append(0, np.cumsum([len(p) for p in parts]))
        self.rows = rows.take(self.order)
        self.leaf = np.repeat(np.arange(len(parts)), np.diff(self.edges))
        self.levels = [self.rows.maxima(self.leaf, len(parts))]
        while len(self.levels[0]) > 1:
            below = self.levels[0]
            self.levels.insert(0, np.maximum(below[0::2], below[1::2]))

    @staticmethod
    def _halves(rows: Sparse, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(part) < 2:
            return part, part[:0]

        def vector(row: int) -> np.ndarray:
            out = np.zeros(rows.width)
            span = slice(rows.edges[row], rows.edges[row + 1])
            out[rows.columns[span]] = rows.values[span]
            return out / max(np.linalg.norm(out), 1e-12)

        one = vector(part[0])
        other = vector(part[np.argmin(rows.dot(one, part))])
        nearer = rows.dot(one, part) - rows.dot(other, part)
        ordered = part[np.argsort(nearer, kind="stable")]
        return ordered[: len(part) // 2], ordered[len(part) // 2 :]


class Best:
    """The k best (score, key) found so far for every item; a NULL key comes first."""

    def __init__(self, items: int, k: int, floor: np.ndarray):
        self.k, self.found = k, [[] for _ in range(items)]
        self.weakest = np.maximum(floor, 1)

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray, keys: list) -> None:
        good = np.flatnonzero(scores >= self.weakest[item])
        if len(good) > self.k:
            good = good[scores[good] >= np.partition(scores[good], -self.k)[-self.k]]
        if len(good):
            found = ((s, keys[d]) for s, d in zip(scores[good].tolist(), docs[good].tolist()))
            new = [(-s, key is not None, 0 if key is None else key) for s, key in found]
            self.found[item] = sorted(self.found[item] + new)[: self.k]
            if len(self.found[item]) == self.k:
                self.weakest[item] = max(self.weakest[item], -self.found[item][-1][0])


def search_block(items: Tree, docs: Tree, keys: list, best: Best) -> int:
    """Add a block's documents to the best of the items; the number of leaf pairs scored."""
    alive = np.ones((1, 1), bool)
    for step in range(max(items.depth, docs.depth) + 1):
        above, below = items.levels[min(step, items.depth)], docs.levels[min(step, docs.depth)]
        if step and step <= items.depth:
            alive = np.repeat(alive, 2, axis=0)
        if step and step <= docs.depth:
            alive = np.repeat(alive, 2, axis=1)
        some, any_doc = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(some):
            return 0
        bounds = np.zeros(alive.shape)
        bounds[np.ix_(some, any_doc)] = above[some] @ below[any_doc].T * (1 + SLACK)
        weakest = np.full(1 << items.depth, np.iinfo(np.int64).max)
        np.minimum.at(weakest, items.leaf, best.weakest[items.order])
        weakest = weakest.reshape(len(above), -1).min(axis=1)
        alive &= bounds >= weakest[:, None]
    scored = 0
    for leaf in np.flatnonzero(alive.any(axis=1)).tolist():
        members = range(items.edges[leaf], items.edges[leaf + 1])
        columns = np.flatnonzero(items.levels[-1][leaf])
        place = np.full(docs.rows.width, -1)
        place[columns] = np.arange(len(columns))
        weights = np.zeros((len(columns), len(members)), np.int64)
        for k, row in enumerate(members):
            span = slice(items.rows.edges[row], items.rows.edges[row + 1])
            weights[place[items.rows.columns[span]], k] = items.rows.values[span]
        own = items.order[members.start : members.stop]
        leaves = np.flatnonzero(alive[leaf])
        leaves = leaves[np.argsort(-bounds[leaf, leaves], kind="stable")]
        for at in range(0, len(leaves), 8):
            wave = leaves[at : at + 8]
            wave = wave[bounds[leaf, wave] >= best.weakest[own].min()]
            if not len(wave):
                break
            scored += len(wave)
            rows = np.concatenate([np.arange(docs.edges[w], docs.edges[w + 1]) for w in wave.tolist()])
            part = docs.rows.take(rows)
            inside = place[part.columns] >= 0
            shares = np.zeros((len(rows), len(columns)), np.int64)
            shares[part.rows[inside], place[part.columns[inside]]] = part.values[inside]
            scores = shares @ weights
            for k, item in enumerate(own.tolist()):
                best.add(item, scores[:, k], docs.order[rows], keys)
    return scored


# --- documents -----------------------------------------------------------------------

VECTORS = "keys array<binary>, lengths array<bigint>, edges binary, columns binary, counts binary, documents bigint, terms bigint"


def _vectors(vocabulary: dict[bytes, int]):
    """Blocks of documents: how often each holds the items' terms, and its length."""
    schema = pa.schema(
        [("keys", pa.list_(pa.binary())), ("lengths", pa.list_(pa.int64()))]
        + [(c, pa.binary()) for c in ("edges", "columns", "counts")]
        + [(c, pa.int64()) for c in ("documents", "terms")]
    )

    def run(batches) -> Iterator[pa.RecordBatch]:
        width = max(len(vocabulary), 1)
        keys, lengths, parts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            sizes, columns, counts = (np.concatenate([p[k] for p in parts]) for k in range(3))
            packed = [np.append(0, np.cumsum(sizes)).astype("<i8"), columns.astype("<u4"), counts.astype("<i8")]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([keys], pa.list_(pa.binary())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    *(pa.array([x.tobytes()], pa.binary()) for x in packed),
                    pa.array([sum(n > 0 for n in lengths)], pa.int64()),
                    pa.array([sum(lengths)], pa.int64()),
                ],
                schema=schema,
            )

        for batch in batches:
            for first, texts in slices(batch["text"]):
                words = [terms(t) for t in texts]
                sizes = [len(w) for w in words]
                flat = itertools.chain.from_iterable(words)
                ids = np.fromiter(map(vocabulary.get, flat, itertools.repeat(-1)), np.int64, sum(sizes))
                cells = np.repeat(np.arange(len(texts)), sizes)[ids >= 0] * width + ids[ids >= 0]
                cells, counts = np.unique(cells, return_counts=True)
                parts.append((np.bincount(cells // width, minlength=len(texts)), cells % width, counts))
                keys += batch["key"].slice(first, len(texts)).to_pylist()
                lengths += sizes
                held += len(cells)
                if len(keys) >= BLOCK_DOCS or held >= BLOCK_ENTRIES:
                    yield block()
                    keys, lengths, parts, held = [], [], [], 0
        if keys:
            yield block()

    return run


def _each_term(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for columns in batch["columns"]:
            term, documents = np.unique(np.frombuffer(columns.as_py(), "<u4"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int64)), pa.array(documents)], ["term", "documents"])


def _searching(items: Tree, k: int, floor: np.ndarray, total_docs: int, total_terms: int, whole: bool):
    def run(batches) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.order), k, floor)
        for batch in batches:
            for row in range(batch.num_rows):
                keys, lengths, *packed = (batch[c][row].as_py() for c in ("keys", "lengths", "edges", "columns", "counts"))
                edges, columns, counts = (np.frombuffer(x, t).astype(np.int64) for x, t in zip(packed, ("<i8", "<u4", "<i8")))
                norm = 100 - 25 + (25 * np.array(lengths, np.int64) * total_docs) // max(total_terms, 1)
                share = (1_000_000_000 * counts) // (1000 * counts + 12 * np.repeat(norm, np.diff(edges)))
                tree = Tree(Sparse(edges, columns, share, items.rows.width), DOC_LEAF)
                if whole:
                    keys = [None if x is None else int(x) for x in keys]
                search_block(items, tree, keys, best)
        rows = [(i, key if known else None, -score) for i, found in enumerate(best.found) for score, known, key in found]
        keys = pa.array([None if r[1] is None else str(r[1]).encode() if whole else r[1] for r in rows], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), keys, pa.array([r[2] for r in rows], pa.int64())],
            ["item", "key", "score"],
        )

    return run


# --- items ---------------------------------------------------------------------------


def portions(items: DataFrame, key: str, text: str) -> DataFrame:
    """Items with their number and portion; a portion has PORTION_BYTES and what its last item has beyond."""
    rows = stored(
        items.select(
            F.col(f"`{key}`").alias("key"), raw(text).alias("text"), F.monotonically_increasing_id().alias("number")
        ).select("*", (F.coalesce(F.octet_length("text"), F.lit(0)) + ITEM_COST).cast("bigint").alias("cost")),
        "items",
    ).withColumn("part", F.expr("number >> 33"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("part").agg(F.sum("cost").alias("cost")).select(
        "part", F.coalesce(F.sum("cost").over(before), F.lit(0)).alias("carried")
    )
    within = F.sum("cost").over(Window.partitionBy("part").orderBy("number")) - F.col("cost")
    placed = rows.withColumn("within", within).join(carried, "part")
    return placed.select("key", "text", "number", F.expr(f"(carried + within) div {PORTION_BYTES}").alias("portion"))


def _portion(docs: DataFrame, texts: list[bytes], k: int, whole: bool) -> DataFrame:
    """(item, key, score) of the k best documents in every task."""
    spark, counts, vocabulary = docs.sparkSession, [], {}
    for text in texts:
        own: dict[int, int] = {}
        for term in terms(text):
            number = vocabulary.setdefault(term, len(vocabulary))
            own[number] = own.get(number, 0) + 1
        counts.append(own)
    blocks = stored(docs.mapInArrow(_vectors(vocabulary), VECTORS), "vectors")
    totals = blocks.agg(F.sum("documents"), F.sum("terms")).first()
    total_docs, total_terms = totals[0] or 0, totals[1] or 0
    held = blocks.select("columns").mapInArrow(_each_term, "term bigint, documents bigint").groupBy("term").agg(F.sum("documents"))
    weight = np.zeros(max(len(vocabulary), 1), np.int64)
    for term, documents in held.toLocalIterator():  # a row per term of the portion
        weight[term] = math.floor(1000 * math.log((2 * total_docs + 2) / (2 * documents + 1)))
    rows = [sorted((t, n * int(weight[t])) for t, n in own.items() if weight[t] > 0) for own in counts]
    flat = np.array([x for row in rows for x in row], np.int64).reshape(-1, 2)
    edges = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int64)
    tree = Tree(Sparse(edges, flat[:, 0], flat[:, 1], len(weight)), ITEM_LEAF)
    shape = "item bigint, key binary, score bigint"
    search = lambda part, floor: part.mapInArrow(_searching(tree, k, floor, total_docs, total_terms, whole), shape)
    floor = np.zeros(len(texts), np.int64)
    first = search(blocks.limit(FIRST_BLOCKS), floor).groupBy("item").agg(
        F.element_at(F.sort_array(F.collect_list("score"), asc=False), k).alias("kth")
    )  # a few tasks at most, each with k rows an item
    for item, kth in first.where("kth IS NOT NULL").collect():
        floor[item] = kth
    return search(blocks, floor)


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    k: int = TOP,
) -> DataFrame:
    """The ``k`` best documents of every item with a score above 0: item key, rank
    (from 1), document key, score; equal scores by ascending document key.

    Terms are maximal runs of digits, letters a-z (A-Z made lower) and bytes beyond
    ASCII.  NULL and empty texts have no terms, and an item without terms, or whose
    terms no document holds, no rows.  Rows with equal keys are each a document or
    an item; NULL document keys come before others.  Keys are whole numbers or
    strings, strings in order of their bytes.  Empty tables give no rows; other
    columns are not returned.
    """
    spark, kind, item_kind = docs.sparkSession, docs.schema[key].dataType, items.schema[item_key].dataType
    whole = kind.simpleString() in ("tinyint", "smallint", "int", "bigint")
    if not whole and kind.simpleString() != "string":
        raise TypeError(f"document keys are whole numbers or strings, not {kind.simpleString()}")
    named = docs.select(F.col(f"`{key}`").cast("string").cast("binary").alias("key"), raw(text).alias("text"))
    numbered = stored(portions(items, item_key, item_text), "portions")
    found = None
    for (portion,) in numbered.select("portion").distinct().orderBy("portion").collect():
        part = numbered.where(F.col("portion") == portion).select("number", "text").orderBy("number").collect()
        numbers = spark.createDataFrame([(n, r.number) for n, r in enumerate(part)], "item bigint, number bigint")
        best = _portion(named, [bytes(r.text or b"") for r in part], k, whole).join(F.broadcast(numbers), "item").drop("item")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "key binary, score bigint, number bigint")
    found = found.withColumn("key", F.col("key").cast("string").cast(kind))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = numbered.select("number", F.col("key").cast(item_kind).alias(item_key))
    return ranked.join(names, "number").select(item_key, "rank", F.col("key").alias(key), "score")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM d WHERE len(words) > 0),
tf AS (
  SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT doc_id, CAST(len(words) AS BIGINT) AS n, unnest(words) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY doc_id, n, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * s.n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * tf.n * s.n) // s.l)))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""


@query("op12_lexical", ORACLE)
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that answer each benchmark item best."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
