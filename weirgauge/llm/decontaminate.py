"""Benchmark decontamination: multi-string search by skipping, words as symbols.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window.  All windows of one length share a shift
table over blocks of ``BLOCK`` words.  The table tells how far the search may
jump when a block is met: the full distance if no window holds the block.  A
block that ends some window has shift zero; its bucket holds the windows that
end so, and each is compared word by word with the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .batches import fresh, raw, stored
from .registry import query, table

WINDOW = 10
BLOCK = 3
#: Windows whose tables are broadcast at once, about 1.5 kB each in a worker.
CHUNK_WINDOWS = 50_000

#: Word characters: digits, letters and all of non-ASCII; A-Z become a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
FOUND = "struct<n_words:bigint,hits:array<int>,items:array<string>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SkipTables:
    """Shift table and buckets for windows of one length."""

    def __init__(self, length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, set]] = {}

    def add(self, window: tuple, item) -> None:
        for end in range(self.block, self.length + 1):
            block = window[end - self.block : end]
            jump = self.length - end
            if jump < self.shift.get(block, self.default):
                self.shift[block] = jump
        ending = self.buckets.setdefault(window[-self.block :], {})
        ending.setdefault(window, set()).add(item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, items) of every occurrence of a window."""
        length, width, default = self.length, self.block, self.default
        shift, end, stop = self.shift, self.length, len(words)
        while end <= stop:
            block = tuple(words[end - width : end])
            jump = shift.get(block, default)
            if jump:
                end += jump
                continue
            items = self.buckets[block].get(tuple(words[end - length : end]))
            if items is not None:
                yield end - length, items
            end += 1


def build(items: list[tuple]) -> list[SkipTables]:
    """Tables for (item, words) pairs, one per window length."""
    by_length: dict[int, SkipTables] = {}
    for item, words in items:
        length = min(WINDOW, len(words))
        tables = by_length.setdefault(length, SkipTables(length))
        for start in range(len(words) - length + 1):
            tables.add(tuple(words[start : start + length]), item)
    return list(by_length.values())


def scan(tables: list[SkipTables], words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
    """Disjoint hit ranges in order, and the items behind them."""
    ranges, items = [], set()
    for group in tables:
        for start, owners in group.search(words):
            items |= owners
            ranges.append((start, start + group.length))
    return merge(ranges), items


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def chunks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """Items with words, cut into lists of at most ``limit`` windows.

    Only one list is held at a time.  A long item is cut into pieces that
    overlap by a window less one word, so no window is lost.
    """
    rows = benchmark.select(F.col(f"`{item}`").cast("string"), raw(text))
    held, size = [], 0
    for key, value in rows.toLocalIterator():
        words = words_of(bytes(value or b""))
        windows = max(1, len(words) - WINDOW + 1)
        for start in range(0, windows, limit):
            piece = words[start : start + limit + WINDOW - 1]
            count = min(limit, windows - start)
            if not piece:
                continue
            if held and size + count > limit:
                yield held
                held, size = [], 0
            held.append((key, piece))
            size += count
    yield held


_built: dict[str, list[SkipTables]] = {}


def _searcher(spark: SparkSession, items: list[tuple]):
    shared, token = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    @arrow_udf(FOUND)
    def search(texts: pa.Array, hits: pa.Array, found: pa.Array) -> pa.Array:
        if token not in _built:  # a worker keeps the tables of the chunk it works on
            _built.clear()
            _built[token] = build(shared.value)
        tables = _built[token]
        counts, ranges, owners = [], [], []
        for text, hit, had in zip(texts, hits, found):
            words = words_of(text.as_py() or b"")
            spots, names = scan(tables, words)
            known = hit.as_py() or []
            if known:
                spots = merge([*spots, *zip(known[::2], known[1::2])])
            counts.append(len(words))
            ranges.append([edge for spot in spots for edge in spot])
            owners.append(sorted({n for n in names if n is not None} | set(had.as_py() or [])))
        return pa.StructArray.from_arrays(
            [
                pa.array(counts, pa.int64()),
                pa.array(ranges, pa.list_(pa.int32())),
                pa.array(owners, pa.list_(pa.string())),
            ],
            ["n_words", "hits", "items"],
        )

    return search


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    out: str = "found",
    chunk_windows: int = CHUNK_WINDOWS,
) -> DataFrame:
    """Add ``out``, with underscores if there is such a column: struct of n_words, hits (flat [start, end) pairs), items.

    Every document keeps its row and its other columns; nothing is shuffled.
    The benchmark is broadcast in chunks of bounded size; with more than one
    chunk the texts are passed over once per chunk, through a stored table.

    NULL and empty texts have no words and no hits.  Repeated documents are
    judged alike; repeated items count once.  An item with a NULL id marks
    words but is not listed.  An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    name = fresh(docs, out)
    flat = docs.withColumn(name, F.lit(None).cast(FOUND))
    held = None
    for part in chunks(benchmark, item, item_text, chunk_windows):
        if held is not None:
            flat = stored(_pass(flat, held, text, name), "hits")
        held = part
    return _pass(flat, held, text, name)


def _pass(df: DataFrame, items: list[tuple], text: str, name: str) -> DataFrame:
    known: Column = F.col(name)
    search = _searcher(df.sparkSession, items)
    return df.withColumn(name, search(raw(text), known["hits"], known["items"]))


def hit_words(found: Column) -> Column:
    """How many words lie in hit ranges."""
    total = F.aggregate(
        F.transform(found["hits"], lambda edge, at: F.when(at % 2 == 0, -edge).otherwise(edge)),
        F.lit(0).cast("bigint"),
        lambda total, edge: total + edge,
    )
    return total


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS pat
  FROM (SELECT item_id, w, least(10, len(w)) AS m,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
g AS (
  SELECT doc_id, s, m, array_to_string(w[s:s + m - 1], ' ') AS pat
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s
        FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
o AS (SELECT doc_id, s, g.m, item_id FROM g JOIN p USING (m, pat)),
h AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + m)) AS spot FROM o) GROUP BY doc_id),
i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query("op7_decontaminate", ORACLE)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_hits(docs, table(spark, sf_dir, "benchmark"))
    hit, items = hit_words(F.col("found")), F.col("found.items")
    return found.select("doc_id", "found").select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
