"""Token ids of documents in binary shards, with keyed access.

A shard file holds, one after the other: the ids of its documents without gaps
(little-endian, two bytes each if the vocabulary allows, else four), the number
of ids of each document, the keys' lengths and bytes, and a footer.  Documents
stand in ascending order of their keys over all shards.

Beside the shards lies an index: keys are dealt into buckets by hash, and each
bucket holds a minimal perfect hash from its keys to (shard, place, copies),
checked by a fingerprint.  ``locate`` reads one bucket and one slot per key.

Files are written by Spark's text writer, one row (a whole shard) a file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch
from .batches import discard, raw, slices, store
from .byte_words import byte_words
from .hash_index import HashIndex
from .registry import query, table

#: A shard is closed when it holds so many bytes of ids, or so many documents.
SHARD_BYTES = 32 << 20
SHARD_DOCS = 500_000
#: Bytes of text for each range of keys; a range makes one shard or a few.
RANGE_BYTES = 32 << 20
BUCKET_KEYS = 100_000
BATCH_BYTES = 8 << 20

# Fixed values of the format.
MAGIC = b"TKNS"
FOOTER = struct.Struct("<4sHHqqqq")  # magic, version, bytes of an id, shard, documents, ids, bytes of keys
VERSION = 1
CLOSING = b"\n"

ENTRY = "key binary, shard bigint, place bigint, copies bigint"


def pack_shard(number: int, keys: list[bytes | None], ids: list[np.ndarray], kind: np.dtype) -> bytes:
    counts = np.array([len(i) for i in ids], "<i8")
    sizes = np.array([-1 if k is None else len(k) for k in keys], "<i4")
    text = b"".join(k or b"" for k in keys)
    footer = FOOTER.pack(MAGIC, VERSION, kind.itemsize, number, len(keys), int(counts.sum()), len(text))
    return b"".join([*(i.tobytes() for i in ids), counts.tobytes(), sizes.tobytes(), text, footer])


def open_shard(content: memoryview) -> tuple[int, list[bytes | None], np.ndarray, np.ndarray]:
    """(number, keys, ids of all documents, number of ids of each)."""
    end = len(content) - len(CLOSING)
    if end < FOOTER.size or bytes(content[end:]) != CLOSING:
        raise ValueError("a token file ends early")
    magic, version, width, number, docs, total, text = FOOTER.unpack(content[end - FOOTER.size : end])
    if magic != MAGIC or version != VERSION or end != FOOTER.size + text + 12 * docs + width * total:
        raise ValueError("this is no token file, or it is damaged")
    at = width * total
    ids = np.frombuffer(content[:at], f"<u{width}")
    counts = np.frombuffer(content[at : at + 8 * docs], "<i8")
    sizes = np.frombuffer(content[at + 8 * docs : at + 12 * docs], "<i4").tolist()
    at += 12 * docs
    keys = []
    for size in sizes:
        keys.append(None if size < 0 else bytes(content[at : at + size]))
        at += max(size, 0)
    return number, keys, ids, counts


def _packing(file: str, end_id: int, shard_bytes: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        words = byte_words(file)
        end = np.array([end_id], words.kind)
        number = TaskContext.get().partitionId() << 20
        keys, ids, size = [], [], 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_shard(number, keys, ids, words.kind)], pa.binary())], ["value"])

        for batch in batches:
            for first, texts in slices(batch["text"]):
                names = batch["key"].slice(first, len(texts)).to_pylist()
                for key, found in zip(names, words.ids(texts)):
                    keys.append(key)
                    ids.append(np.concatenate([found, end]))
                    size += ids[-1].nbytes
                    if size >= shard_bytes or len(keys) >= SHARD_DOCS:
                        yield shard()
                        number += 1
                        keys, ids, size = [], [], 0
        if keys:
            yield shard()

    return run


def _shards(path: str) -> str:
    return f"{path}/shards"


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Write every document's ids and the end id, in ascending order of ``key``, and the index.

    A NULL or empty text is the end id alone.  NULL keys come first; rows with
    equal keys follow each other by length and hash of their text, and equal
    rows are each written.  A file holds ``shard_bytes`` of ids and what its
    last document has beyond.  An empty table has no shards and an empty index.
    Other columns are not written.
    """
    bytes_in = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bytes_in // RANGE_BYTES))
    named = docs.select(F.col(f"`{key}`").alias("order"), raw(text).alias("text")).select(
        "order",
        F.coalesce(F.octet_length("text"), F.lit(-1)).alias("size"),
        F.xxhash64("text").alias("mark"),
        F.monotonically_increasing_id().alias("row"),  # parts equal rows, so that they need not share a range
        "text",
    )
    places = ["order", "size", "mark", "row"]
    sorted_rows = named.repartitionByRange(ranges, *places).sortWithinPartitions(*places)
    keyed = sorted_rows.select(F.col("order").cast("string").cast("binary").alias("key"), "text")
    packed = keyed.mapInArrow(_packing(tokenizer, end_id, shard_bytes), "value binary")
    writer = packed.select(F.col("value").cast("string").alias("value")).write
    writer.option("lineSep", CLOSING.decode()).option("maxRecordsPerFile", 1).text(_shards(path))
    _write_index(docs.sparkSession, path)


ROWS = "key binary, shard bigint, place bigint, at bigint, n bigint, ids_crc32 bigint"


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per document of the files: key (as text in bytes), shard, place in
    the shard, ids before it in the shard (at), number of ids (n), their CRC-32 as
    little-endian unsigned 32-bit numbers and, if asked for, these bytes (ids)."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        names = ["key", "shard", "place", "at", "n", "ids_crc32", *(["ids"] if payloads else [])]
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def batch_of(held: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

        for batch in batches:
            for content in batch["content"]:
                number, keys, ids, counts = open_shard(memoryview(content.as_buffer()))
                at, held, size = 0, [], 0
                for place, (key, n) in enumerate(zip(keys, counts.tolist())):
                    wide = ids[at : at + n].astype("<u4").tobytes()
                    held.append((key, number, place, at, n, zlib.crc32(wide), *([wide] if payloads else [])))
                    at, size = at + n, size + 200 + (len(wide) if payloads else 0)
                    if size > BATCH_BYTES:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(_shards(path))
    return files.select("content").mapInArrow(rows, ROWS + (", ids binary" if payloads else ""))


def _hashed(df: DataFrame, key: Column) -> DataFrame:
    """With two hashes of a key; a NULL key is a key like any other."""
    return df.withColumn("h1", F.xxhash64(key.isNull(), key)).withColumn("h2", F.xxhash64(key, F.lit(13), key.isNull()))


def _write_index(spark: SparkSession, path: str) -> None:
    rows_at = store(read(spark, path), "token-rows")
    rows = spark.read.schema(ROWS).parquet(rows_at)
    shards = rows.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.select("*", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start")).write.parquet(f"{path}/starts")
    entries = rows.groupBy("key", "shard").agg(F.min("place").alias("place"), F.count("*").alias("copies"))
    entries_at = store(entries, "token-entries")
    entries = spark.read.schema(ENTRY).parquet(entries_at)
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))

    def build(batch: pa.Table) -> pa.Table:
        ordered = batch.sort_by([("key", "ascending"), ("shard", "ascending")])
        h1, h2 = (ordered[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
        values = np.stack([ordered[c].to_numpy() for c in ("shard", "place", "copies")], axis=1).astype(np.int64)
        found = HashIndex.build(ordered["key"].to_pylist(), h1, h2, values)
        return pa.table({"bucket": ordered["bucket"].slice(0, 1), "index": pa.array([found.to_bytes()], pa.binary())})

    dealt = _hashed(entries, F.col("key")).withColumn("bucket", F.pmod("h1", F.lit(buckets)))
    grouped = dealt.groupBy("bucket").applyInArrow(build, "bucket bigint, index binary")
    grouped.withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/index")
    for place in (rows_at, entries_at):
        discard(spark, place)


def locate(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Where the documents of the distinct keys stand: key (as text in bytes), shard,
    place of the first, copies; a key has a row for each shard it is in.

    Keys meet their bucket of the index in one task, in which they stream past it.
    A key that is not in the index has no row, but for one in 2**32.
    """
    index = spark.read.parquet(f"{path}/index")
    buckets = index.agg(F.max("buckets")).first()[0] or 1
    named = keys.select(F.col(f"`{key}`").cast("string").cast("binary").alias("key")).distinct()
    asked = _hashed(named, F.col("key")).withColumn("bucket", F.pmod("h1", F.lit(buckets)))
    both = index.select("bucket", F.lit(0).alias("turn"), "index").unionByName(
        asked.select("bucket", F.lit(1).alias("turn"), "key", "h1", "h2"), allowMissingColumns=True
    )

    def look_up(batches) -> Iterator[pa.RecordBatch]:
        bucket, index = None, None
        for batch in batches:
            turns, numbers = batch["turn"].to_numpy(), batch["bucket"].to_numpy()
            edges = np.flatnonzero((np.diff(numbers) != 0) | (turns[1:] == 0)) + 1
            for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if start < stop and turns[start] == 0:
                    bucket, index = numbers[start], HashIndex.from_bytes(batch["index"][start].as_py())
                    start += 1
                if start == stop or index is None or numbers[start] != bucket:
                    continue
                part = batch.slice(start, stop - start)
                names = part["key"].to_pylist()
                h1, h2 = (part[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
                who, values = index.look_up(names, h1, h2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[k] for k in who.tolist()], pa.binary()), *(pa.array(values[:, k]) for k in range(3))],
                    ["key", "shard", "place", "copies"],
                )

    order = both.repartition("bucket").sortWithinPartitions("bucket", "turn")
    return order.mapInArrow(look_up, ENTRY)


def fetch(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id", payloads: bool = True) -> DataFrame:
    """Documents of the distinct keys, through the index: key, start (ids of all
    documents before), n_tokens, ids_crc32 and, if asked for, ids (little-endian
    unsigned 32-bit).  Equal keys come back once for each document that has them.
    """
    kind = keys.schema[key].dataType.simpleString()
    found = locate(spark, path, keys, key).withColumnRenamed("place", "first")
    places = found.select("key", "shard", F.explode(F.sequence("first", F.expr("first + copies - 1"))).alias("place"))
    rows = read(spark, path, payloads).withColumnRenamed("key", "held")
    starts = spark.read.parquet(f"{path}/starts").select("shard", "start")
    joined = places.join(rows, ["shard", "place"]).where(F.col("key").eqNullSafe(F.col("held"))).join(starts, "shard")
    columns = [(F.col("start") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32"]
    return joined.select(F.col("key").cast("string").cast(kind).alias(key), *columns, *(["ids"] if payloads else []))


@query("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to shards and found again through the index."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch(spark, "token-files")
    write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return fetch(spark, path, docs.select("doc_id"), payloads=False)
