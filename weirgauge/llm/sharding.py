"""Sharding by extendible hashing, with DataFrame functions only.

Rows are placed by the leading bits of a hash.  A directory of ``2**depth``
entries points to buckets; a bucket at local depth d owns all entries that
begin with its d bits.  Only a bucket above the byte limit is split on another
bit.  Bits are looked at in rounds: a round knows the bytes below every prefix
of its depth range, and takes the shortest prefix that fits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import fresh, stored
from .registry import query, table

BITS = 60
#: Bits looked at beyond those an even spread would need.
SPARE_BITS = 3
SHARD_BYTES = 1 << 20


def key_hash(key: Column) -> Column:
    """60 bits of the MD5 of a key's text; NULL is hashed as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint")


def _shift(value: Column, bits: Column) -> Column:
    """value without its last ``bits`` bits."""
    return F.call_function("shiftright", value, bits.cast("int"))


def _round(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Buckets found by looking at ``low`` to ``high`` leading bits.

    Rows: (grp, h, bytes).  A bucket is the shortest prefix that fits, or whose
    rows share one hash.  Prefixes that stay too large at ``high`` come back
    with ``fits`` false.
    """
    cells = rows.groupBy("grp", _shift(F.col("h"), F.lit(BITS - high)).alias("cell")).agg(
        F.sum("bytes").alias("bytes"),
        F.count("*").alias("rows"),
        F.min("h").alias("first"),
        F.max("h").alias("last"),
    )
    lengths = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    prefixes = (
        cells.select("*", lengths)
        .groupBy("grp", "depth", _shift(F.col("cell"), F.lit(high) - F.col("depth")).alias("prefix"))
        .agg(
            F.sum("bytes").alias("bytes"),
            F.sum("rows").alias("rows"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .withColumn("fits", (F.col("bytes") <= limit) | (F.col("first") == F.col("last")))
    )
    above = prefixes.select(
        "grp",
        (F.col("depth") + 1).alias("depth"),
        F.col("prefix").alias("parent"),
        F.col("fits").alias("parent_fits"),
    )
    below = prefixes.withColumn("parent", _shift(F.col("prefix"), F.lit(1)))
    joined = below.join(above, ["grp", "depth", "parent"], "left")
    open_above = (F.col("depth") == low) | ~F.coalesce(F.col("parent_fits"), F.lit(True))
    leaf = open_above & (F.col("fits") | (F.col("depth") == high))
    return joined.where(leaf).select(
        "grp", "depth", "prefix", "bytes", "rows", "fits", (F.col("first") == F.col("last")).alias("one_hash")
    )


def _entries(buckets: DataFrame, high: int) -> DataFrame:
    """The directory: every ``high``-bit entry with the bucket that owns it."""
    spare = F.lit(high) - F.col("depth")
    first = F.call_function("shiftleft", F.col("prefix"), spare.cast("int"))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), spare.cast("int"))
    cell = F.explode(F.sequence(first, first + size - 1)).alias("cell")
    return buckets.select("grp", cell, "depth", "prefix", "bytes", "rows", "fits", "one_hash")


def buckets_of(rows: DataFrame, limit: int, total: int) -> list[tuple[int, DataFrame]]:
    """(depth, directory entries at that depth) of as many rounds as are needed.

    The entries of one round that do not fit name the rows of the next.
    """
    wanted = math.ceil(math.log2(max(1.0, total / limit))) + SPARE_BITS
    low, high, out = 0, min(BITS, wanted), []
    while True:
        found = stored(_round(rows, low, high, limit), "buckets")
        out.append((high, _entries(found, high)))
        too_large = found.where(~F.col("fits"))
        if high == BITS or too_large.isEmpty():
            return out
        cell = _shift(F.col("h"), F.lit(BITS - high))
        owners = too_large.select("grp", F.col("prefix").alias("cell"))
        rows = rows.withColumn("cell", cell).join(owners, ["grp", "cell"], "left_semi").drop("cell")
        low, high = high + 1, min(BITS, high + 1 + SPARE_BITS)


def _lookup(rows: DataFrame, rounds: list[tuple[int, DataFrame]]) -> DataFrame:
    """Rows with the bucket of the first round that has one for them."""
    settled = F.lit(None).cast(
        "struct<depth:int,prefix:bigint,bytes:bigint,rows:bigint,one_hash:boolean>"
    )
    rows = rows.withColumn("bucket", settled)
    for high, entries in rounds:
        one = entries.where("fits").select(
            "grp", "cell", F.struct("depth", "prefix", "bytes", "rows", "one_hash").alias("here")
        )
        rows = (
            rows.withColumn("cell", _shift(F.col("h"), F.lit(BITS - high)))
            .join(one, ["grp", "cell"], "left")
            .withColumn("bucket", F.coalesce("bucket", "here"))
            .drop("cell", "here")
        )
    return rows


def _name(bucket: Column) -> Column:
    digits = F.lpad(F.bin(bucket["prefix"]), bucket["depth"], "0")
    return F.when(bucket["depth"] == 0, F.lit("")).otherwise(digits)


def assign(df: DataFrame, key: Column, size: Column, limit: int = SHARD_BYTES, out: str = "shard") -> DataFrame:
    """Add ``out``, with underscores if there is such a column: struct of name, depth, bytes and rows of each row's shard.

    ``name`` is the bits of the bucket, "" if one shard holds everything.  No
    shard exceeds ``limit`` bytes unless a single row does.  Rows that share a
    key share all bits; if they exceed the limit together, they are split again
    on the bits of a row number, and the name goes on after a dash.  NULL keys
    count as one key, NULL sizes as 0; an empty table stays empty; repeated
    rows are placed like any others; other columns are kept.
    """
    own = df.columns
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), key_hash(key).alias("h"),
                       F.coalesce(size.cast("bigint"), F.lit(0)).alias("bytes"),
                       F.lit(0).cast("bigint").alias("grp"))
    rows = stored(packed.withColumn("number", F.monotonically_increasing_id()), "shard-rows")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    thin = rows.select("grp", "h", "bytes")
    placed = _lookup(rows, buckets_of(thin, limit, total))
    crowded = F.col("bucket.one_hash") & (F.col("bucket.bytes") > limit) & (F.col("bucket.rows") > 1)
    base = placed.withColumn("name", _name(F.col("bucket"))).withColumn("crowded", crowded)
    again = base.where("crowded").select(
        "row", "bytes", "name", F.col("h").alias("grp"), key_hash(F.col("number")).alias("h"),
        F.col("bucket.depth").alias("before"),
    )
    parts = [base.where("NOT crowded").select("row", "name", "bucket", F.lit(0).alias("before"))]
    if not again.isEmpty():
        again = stored(again, "shard-again")
        largest = again.groupBy("grp").agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0]
        second = _lookup(again, buckets_of(again.select("grp", "h", "bytes"), limit, largest))
        name = F.concat("name", F.lit("-"), _name(F.col("bucket")))
        parts.append(second.select("row", name.alias("name"), "bucket", "before"))
    joined = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    shard = F.struct(
        "name",
        (F.col("bucket.depth") + F.col("before")).alias("depth"),
        F.col("bucket.bytes").alias("bytes"),
        F.col("bucket.rows").alias("rows"),
    )
    name = fresh(df, out)
    return joined.select(*[F.col(f"row.`{c}`") for c in own], shard.alias(name))


ORACLE = f"""
WITH r AS (
  SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h,
         CAST(coalesce(strlen(text), 0) AS BIGINT) AS n FROM documents),
x AS (SELECT doc_id, h, n, d, h >> ({BITS} - d) AS p FROM r, (SELECT unnest(range(0, 41))::INTEGER AS d)),
t AS (SELECT d, p, sum(n) AS n, count(*) AS k, min(h) = max(h) AS one FROM x GROUP BY d, p),
l AS (SELECT doc_id, min(x.d) AS d FROM x JOIN t USING (d, p)
      WHERE t.n <= {SHARD_BYTES} OR one GROUP BY doc_id)
SELECT doc_id, CASE WHEN d = 0 THEN '' ELSE right(repeat('0', 64) || bin(p), d) END AS shard,
       CAST(d AS INTEGER) AS depth, x.n AS n_bytes, CAST(t.n AS BIGINT) AS shard_bytes,
       t.k AS shard_rows
FROM l JOIN x USING (doc_id, d) JOIN t USING (d, p)
"""


@query("op10_shard", ORACLE)
def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, at most a mebibyte of text each."""
    docs = table(spark, sf_dir, "documents")
    small = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    placed = assign(small, F.col("doc_id"), F.col("n_bytes"))
    return placed.select(
        "doc_id",
        F.col("shard.name").alias("shard"),
        F.col("shard.depth").alias("depth"),
        "n_bytes",
        F.col("shard.bytes").alias("shard_bytes"),
        F.col("shard.rows").alias("shard_rows"),
    )
