"""Removal of repeated passages, found with a compressed index per shard.

A window is ``WINDOW`` consecutive words.  It is repeated if the same words
start a window earlier: in a document with a smaller key, or further up in the
same document.  Words of repeated windows are removed.

* Every document is cut into segments: runs of windows with the same anchor,
  the smallest hash of ``ANCHOR`` words within the window.  Equal windows have
  equal anchors, so all their occurrences meet in one shard.  Anchors that occur
  once cannot belong to a repeated window.
* Equal segments are collapsed.  All but the earliest are repeated as a whole.
* Where an anchor has several different segments, or one that may repeat within
  itself, the segments of a shard are indexed, and each is streamed through
  backward search, which gives for every window the interval of its occurrences
  and so the earliest of them.
* An anchor with very many distinct segments (a common line among ever new
  text) is split: its segments become single windows, which are collapsed by
  content in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import discard, fresh, raw, slices, store, stored
from .fm_index import FMIndex
from .registry import query, table

WINDOW = 20
ANCHOR = 6
#: Words an index should hold, and distinct segments after which an anchor is split.
SHARD_WORDS = 400_000
CROWD = 2000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class _Hashes(dict):
    """Hash of a word; a worker remembers those of its text so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 11)
        return value


_hashes = _Hashes()


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashed:
    """Hashes of any run of a document's words."""

    def __init__(self, words: list[bytes]):
        get = _hashes.__getitem__
        values = np.fromiter((get(w) for w in words), np.uint64, len(words))
        self.sums = np.concatenate(
            [np.zeros(1, np.uint64), np.cumsum(mix(values) * powers(_BASE, len(words)), dtype=np.uint64)]
        )
        self.back = powers(_UNBASE, len(words) + 1)

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def every(self, length: int) -> np.ndarray:
        start = np.arange(len(self.sums) - length)
        return self.runs(start, start + length)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(words: list[bytes]) -> tuple[np.ndarray, ...]:
    """(anchor, content, start, windows, times) of the runs of windows with one anchor.

    ``times`` is 2 if the anchor's words stand at several places of the
    document, where a run may repeat itself, and 1 otherwise.
    """
    if len(words) < WINDOW:
        return (np.zeros(0, np.int64),) * 5
    hashed = Hashed(words)
    grams = hashed.every(ANCHOR)
    anchors = smallest(grams, WINDOW - ANCHOR + 1)
    start = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    end = np.concatenate([start[1:], [len(anchors)]])
    content = hashed.runs(start, end + WINDOW - 1)
    ordered = np.sort(grams)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    times = 1 + np.isin(anchors[start], again).astype(np.int64)
    return anchors[start].view(np.int64), content.view(np.int64), start, end - start, times


SEGMENT = "anchor bigint, content bigint, pos bigint, start int, n int, times int"


def _segmented(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch["pos"].to_numpy(zero_copy_only=False)
        for first, texts in slices(batch["text"]):
            found = [segments(t.split()) for t in texts]
            sizes = [len(f[0]) for f in found]
            anchor, content, start, n, times = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor), pa.array(content),
                    pa.array(np.repeat(keys[first : first + len(texts)], sizes).astype(np.int64)),
                    pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                    pa.array(times.astype(np.int32)),
                ],
                ["anchor", "content", "pos", "start", "n", "times"],
            )


CUT = "anchor bigint, content bigint, pos bigint, start int, n int, words binary"


def _cut(batches) -> Iterator[pa.RecordBatch]:
    """The words of wanted segments; of a crowded anchor, its windows by hash alone."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["anchor", "content", "pos", "start", "n", "words"]

    def flush(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        rows, size = [], 0
        for pos, text, wanted in zip(batch["pos"].to_pylist(), batch["text"], batch["wanted"]):
            words, hashed = (text.as_py() or b"").split(), None
            for one in wanted.as_py():
                at, n = one["start"], one["n"]
                if not one["crowded"]:
                    piece = b" ".join(words[at : at + n + WINDOW - 1])
                    rows.append((one["anchor"], one["content"], pos, at, n, piece))
                    size += len(piece) + 60
                else:
                    hashed = hashed or Hashed(words)
                    start = np.arange(at, at + n)
                    whole = hashed.runs(start, start + WINDOW).view(np.int64).tolist()
                    part = hashed.runs(start + 1, start + WINDOW).view(np.int64).tolist()
                    rows += [(a, b, pos, s, 1, None) for a, b, s in zip(whole, part, start.tolist())]
                    size += 60 * n
                if size > 8 << 20:
                    yield flush(rows)
                    rows, size = [], 0
        if rows:
            yield flush(rows)


REPEAT = "pos bigint, start int, n int"


def repeated_windows(pos: np.ndarray, start: np.ndarray, n: np.ndarray, words: list[bytes]):
    """(pos, start, n) of runs of windows that occur earlier among these segments."""
    order = np.lexsort((start, pos))
    ids: dict[bytes, int] = {}
    parts, sizes = [], []
    for k in order:
        part = [ids.setdefault(w, len(ids) + 1) for w in words[k].split(b" ")]
        parts += part
        parts.append(0)
        sizes.append(len(part) + 1)
    text = np.array(parts, np.int64)
    index = FMIndex(text, len(ids) + 1, WINDOW)
    first = np.cumsum([0, *sizes[:-1]])
    count = n[order].astype(np.int64)
    out = []
    # All segments are streamed side by side, each from its last window back to its first.
    here = first + count - 1
    low, high = np.zeros(len(here), np.int64), np.full(len(here), index.size)
    for back in range(WINDOW - 1, -1, -1):
        low, high = index.extend(text[here + back], low, high)
    live = np.arange(len(here))
    while len(live):
        out.append((live, here[live], index.earliest(low, high) < here[live]))
        more = here[live] > first[live]
        live, low = live[more], low[more]
        here[live] -= 1
        wide = index.shorten(low)
        low, high = index.extend(text[here[live]], *wide)
    owner = np.concatenate([o for o, _, _ in out])
    place = np.concatenate([p for _, p, _ in out])
    early = np.concatenate([e for _, _, e in out])
    owner, place = owner[early], np.sort(place[early])
    owner = np.searchsorted(first, place, side="right") - 1
    if not len(place):
        return (np.zeros(0, np.int64),) * 3
    edge = np.concatenate([[True], (place[1:] != place[:-1] + 1) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(edge)
    runs = np.diff(np.concatenate([at, [len(place)]]))
    who = order[owner[at]]
    return pos[who], start[who] + (place[at] - first[owner[at]]), runs


def _indexed(group: pa.Table) -> pa.Table:
    found = repeated_windows(
        group["pos"].to_numpy(), group["start"].to_numpy(), group["n"].to_numpy(), group["words"].to_pylist()
    )
    kinds = (np.int64, np.int32, np.int32)
    return pa.table(dict(zip(("pos", "start", "n"), (pa.array(f.astype(k)) for f, k in zip(found, kinds)))))


def merged(starts, counts) -> list[tuple[int, int]]:
    """Disjoint [start, end) word ranges of runs of windows."""
    out: list[list[int]] = []
    for start, n in sorted(zip(starts, counts)):
        end = start + n + WINDOW - 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


KEPT = "pos bigint, n_words bigint, n_removed bigint, kept binary"


def _kept(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[], [], [], []]
        for pos, text, runs in zip(batch["pos"].to_pylist(), batch["text"], batch["runs"]):
            words = (text.as_py() or b"").split()
            spots = merged(*zip(*((r["start"], r["n"]) for r in runs.as_py())))
            left, at = [], 0
            for start, end in spots:
                left += words[at:start]
                at = end
            left += words[at:]
            for column, value in zip(rows, (pos, len(words), len(words) - len(left), b" ".join(left))):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
            ["pos", "n_words", "n_removed", "kept"],
        )


def in_order(docs: DataFrame, key: str, text: str = "text", out: str = "pos") -> DataFrame:
    """Add bigint ``out``, unique and ordered by key.

    Unique keys are their own positions.  Otherwise rows are numbered along a
    range sort: equal keys by length and hash of ``text``, NULL keys last.
    """
    name = F.col(f"`{key}`")
    whole = docs.schema[key].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    if whole:
        # A key that is NULL or repeated shows in exact counts of the key column alone.
        repeated = docs.groupBy(name.alias("k")).count().where("k IS NULL OR count > 1")
        if repeated.isEmpty():
            return docs.withColumn(out, name.cast("bigint"))
    row = fresh(docs, out + "_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    order = [F.asc_nulls_last("key"), F.asc("size"), F.asc("mark"), F.asc(row)]
    own = [name.alias("key"), F.octet_length(F.col(f"`{text}`")).alias("size"), F.xxhash64(raw(text)).alias("mark")]
    ranged = stored(
        rows.select(*own, row).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("base")
    return rows.join(ranged.join(sizes, "part").select(row, place.cast("bigint").alias(out)), row).drop(row)


def release(spark: SparkSession) -> None:
    """Let the driver forget plans nobody holds, so that Spark removes their shuffle files."""
    spark.sparkContext._jvm.System.gc()


def changes(flat: DataFrame, digest: bool = False) -> DataFrame:
    """(pos, n_words, n_removed, kept) of the documents that lose words, as a stored table.

    ``flat``: unique bigint ``pos`` in the order that decides which occurrence
    is the first, and binary ``text``; NULL has no words.  ``kept`` is the text
    that is left or, with ``digest``, its SHA-256.
    """
    spark = flat.sparkSession
    cut = flat.mapInArrow(_segmented, SEGMENT)
    # Counted from the anchors alone, and joined to a second pass: only what is repeated is stored.
    twice = cut.groupBy("anchor").agg(F.sum("times").alias("times")).where("times > 1").select("anchor")
    place = F.shiftleft(F.col("start").cast("bigint"), 32) + F.shiftleft(F.col("n").cast("bigint"), 2) + F.col("times")
    narrow = cut.select("anchor", "content", "pos", place.alias("place"))
    held = [store(narrow.join(twice, "anchor", "left_semi"), "segments")]
    release(spark)

    found = spark.read.schema("anchor bigint, content bigint, pos bigint, place bigint").parquet(held[0])
    same = found.groupBy("anchor", "content").agg(
        F.min(F.struct("pos", "place")).alias("first"), F.max(F.col("place").bitwiseAND(3)).alias("times")
    )
    kinds = same.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("times").alias("times"))
    # A single kind of segment that does not repeat itself holds nothing more to find.
    several = kinds.where("kinds > 1 OR times > 1").select("anchor", "kinds")
    marks = (
        found.join(same.drop("times"), ["anchor", "content"])
        .join(several, "anchor", "left")
        .select(
            "anchor", "content", "pos",
            F.shiftright("place", 32).cast("int").alias("start"),
            F.shiftright(F.col("place").bitwiseAND(0xFFFFFFFF), 2).cast("int").alias("n"),
            F.coalesce(F.col("kinds") > CROWD, F.lit(False)).alias("crowded"),
            F.col("kinds").isNotNull().alias("several"),
            (F.struct("pos", "place") == F.col("first")).alias("is_first"),
        )
        .where("several OR NOT is_first")
    )
    held.append(store(marks, "marked"))
    marked = spark.read.schema(marks.schema).parquet(held[-1])
    discard(spark, held[0])
    # The texts that may change, and nothing else, are kept for the steps below.
    held.append(store(flat.join(marked.select("pos").distinct(), "pos", "left_semi"), "texts"))
    texts = spark.read.schema("pos bigint, text binary").parquet(held[-1])
    release(spark)

    wanted = marked.where("is_first").groupBy("pos").agg(
        F.collect_list(F.struct("anchor", "content", "start", "n", "crowded")).alias("wanted")
    )
    held.append(store(texts.join(wanted, "pos").select("pos", "text", "wanted").mapInArrow(_cut, CUT), "pieces"))
    pieces = spark.read.schema(CUT).parquet(held[-1])
    release(spark)
    total = pieces.where("words IS NOT NULL").agg(F.sum(F.col("n") + WINDOW)).first()[0] or 0
    shards = -(-total // SHARD_WORDS) or 1
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    by_index = (
        pieces.where("words IS NOT NULL")
        .select(shard.alias("shard"), "pos", "start", "n", "words")
        .groupBy("shard")
        .applyInArrow(_indexed, REPEAT)
    )
    single = pieces.where("words IS NULL")
    earliest = single.groupBy("anchor", "content").agg(F.min(F.struct("pos", "start")).alias("first"))
    later = (
        single.join(earliest, ["anchor", "content"])
        .where(F.struct("pos", "start") != F.col("first"))
        .select("pos", "start", "n")
    )
    copies = marked.where("NOT is_first").select("pos", "start", "n")
    runs = (
        by_index.unionByName(later)
        .unionByName(copies)
        .groupBy("pos")
        .agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    )
    result = texts.join(runs, "pos").select("pos", "text", "runs").mapInArrow(_kept, KEPT)
    if digest:
        result = result.select("pos", "n_words", "n_removed", F.sha2("kept", 256).alias("kept"))
    result = stored(result, "changes")
    for path in held[1:]:
        discard(spark, path)
    release(spark)
    return result


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with repeated passages removed, and ``n_removed``.

    A document that loses words becomes its other words joined by blanks; any
    other keeps its text as it is.  All columns are kept.  NULL and empty texts
    have no words.  Rows with one key are ordered by length and hash of their
    text; rows with NULL keys come last.  A document that has a column
    ``n_removed`` keeps it, and the count gets underscores.
    """
    count = fresh(docs, "n_removed")
    name = lambda c: F.col(f"`{c}`")
    packed = docs.select(
        F.struct(*[name(c) for c in docs.columns]).alias("doc"), name(key).alias("key"), raw(text).alias("text")
    )
    rows = in_order(packed, "key")
    changed = changes(rows.select("pos", "text")).select(
        "pos", "n_removed", F.col("kept").cast("string").alias("kept")
    )
    whole = rows.drop("key", "text").join(changed, "pos", "left")
    own = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != text]
    left = F.coalesce("kept", F.col(f"doc.`{text}`")).alias(text)
    removed = F.coalesce("n_removed", F.lit(0)).cast("bigint").alias(count)
    return whole.select(*own, left, removed).select(*[name(c) for c in docs.columns], count)


def _digested(batches) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        words = [(t.as_py() or b"").split() for t in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [
                batch["pos"], batch["key"],
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string()),
            ],
            ["pos", "key", "n_words", "whole"],
        )


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, s FROM (
        SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM g) WHERE n > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM r),
v AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
      FROM v ANTI JOIN x USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query("op2_substrings", ORACLE)
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat earlier windows, and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = in_order(docs, "doc_id")
    flat = rows.select("pos", raw("text").alias("text"))
    changed = changes(flat, digest=True).select("pos", "n_removed", F.col("kept").alias("left"))
    whole = rows.select("pos", F.col("doc_id").alias("key"), raw("text").alias("text")).mapInArrow(
        _digested, "pos bigint, key bigint, n_words bigint, whole string"
    )
    return whole.join(changed, "pos", "left").select(
        F.col("key").alias("doc_id"),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("left", "whole").alias("kept_sha256"),
    )
