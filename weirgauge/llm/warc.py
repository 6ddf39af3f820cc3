"""WARC archives: writing captures, reading records, assembling transactions.

A capture is a request, a response (or a revisit of an equal payload) and a
metadata record.  Request and metadata name the response they were concurrent
to; reading joins the three through these identifiers.

Archives are written by Spark's text writer: a row is the bytes of one capture,
and the line separator is the blank line that ends its last record.  They are
read as whole files, so a file holds about FILE_BYTES of payload, by the
measured sizes, and at most CAPTURES_PER_FILE captures.
"""

from __future__ import annotations

import datetime
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from .batches import discard, store, stored
from .registry import query, table

CAPTURES_PER_FILE = 4000
#: Payload of a file, if its captures are of mean size, and if they are all as large as the largest.
FILE_BYTES, MOST_BYTES = 256 << 20, 1 << 30
#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
BATCH_BYTES = 8 << 20

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE = "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _id(kind: str, *parts: Column) -> Column:
    """A record id that depends on nothing but the capture."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws("\n", F.lit(kind), *texts).cast("binary"))
    cuts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """Bytes of a record without the blank line at its end; NULL headers are left out."""
    lines = [
        F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit(LINE))
        for name, value in headers
    ]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    return F.concat(F.lit(VERSION + LINE), F.concat_ws("", *lines), size, block)


def _numbered(flat: DataFrame) -> DataFrame:
    """With ``occurrence``: rows equal in page_id, url and payload are counted from 1."""
    of = ["page_id", "url", "digest"]
    same = F.lit(True)
    twice = flat.groupBy(*of).count().where("count > 1").select(*[F.col(c).alias(f"t_{c}") for c in of])
    if twice.isEmpty():
        return flat.withColumn("occurrence", F.lit(1))
    for c in of:
        same = same & F.col(c).eqNullSafe(F.col(f"t_{c}"))
    alone = flat.join(twice, same, "left_anti").withColumn("occurrence", F.lit(1))
    folded = flat.join(twice, same, "left_semi").groupBy(*of, "size").agg(
        F.min("payload").alias("payload"), F.count(F.lit(1)).cast("int").alias("n")
    )
    again = folded.withColumn("occurrence", F.explode(F.sequence(F.lit(1), "n")))
    return alone.unionByName(again.select(*alone.columns))


def with_revisits(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest, record ids and, for a repeated payload, its response.

    Of equal payloads the one with the largest (page_id, url) is the response;
    rows with the same page_id are responses, too.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    flat = pages.select("page_id", url.alias("url"), payload.alias("payload")).select(
        "*", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").alias("size")
    )
    copies = (
        flat.where(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "kept")
    )
    flat, later = _numbered(flat), F.when(F.col("occurrence") > 1, F.col("occurrence"))
    repeated = F.col("kept").isNotNull() & ~F.col("kept.page_id").eqNullSafe(F.col("page_id"))
    return flat.join(copies, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        "size",
        _id("response", F.col("page_id"), F.col("url"), F.col("digest"), later).alias("response_id"),
        F.when(
            repeated, _id("response", F.col("kept.page_id"), F.col("kept.url"), F.col("digest"), F.lit(None))
        ).alias("refers_to"),
    )


def write(pages: DataFrame, path: str, date: str | None = None) -> None:
    """Write one capture per row of (page_id, url, html) as gzipped archives.

    NULL html is an empty payload; a NULL url or page_id is left out.  Rows
    equal in all three are captures of their own.
    """
    sizes = pages.agg(F.avg(F.octet_length("html")), F.max(F.octet_length("html"))).first()
    mean, largest = (int(s or 0) + 1 for s in sizes)
    per_file = max(1, min(CAPTURES_PER_FILE, FILE_BYTES // mean, MOST_BYTES // largest))
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    revisit, answer = F.col("refers_to").isNotNull(), F.col("response_id")
    about = [("WARC-Date", date), ("WARC-Target-URI", F.col("url"))]
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
    )
    response = _record(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", answer),
            *about,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Profile", F.when(revisit, PROFILE)),
            ("WARC-Refers-To", F.col("refers_to")),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        F.when(revisit, http).otherwise(F.concat(http, "payload")),
    )
    beside = lambda kind: [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _id(kind, answer)),
        *about,
        ("WARC-Concurrent-To", answer),
    ]
    request = _record(
        [*beside("request"), ("Content-Type", "application/http; msgtype=request")],
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{END}")),
    )
    metadata = _record(
        [*beside("metadata"), ("Content-Type", "application/warc-fields")],
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(LINE)), F.lit("")),
    )
    capture = F.concat(request, F.lit(END), response, F.lit(END), metadata)
    writer = with_revisits(pages).select(capture.alias("value")).write
    writer.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", per_file
    ).text(path)


def parse(packed: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(headers, block) of every record of a gzipped archive, unpacked bit by bit."""
    held = bytearray()
    at = 0
    unpacker = zlib.decompressobj(31)

    def more() -> bool:
        nonlocal packed, at, unpacker
        if unpacker.eof:
            packed = unpacker.unused_data
            unpacker = zlib.decompressobj(31)
        if not packed:
            return False
        del held[:at]
        at = 0
        held.extend(unpacker.decompress(packed, 1 << 20))
        packed = unpacker.unconsumed_tail if not unpacker.eof else packed
        return True

    while True:
        end = held.find(b"\r\n\r\n", at)
        while end < 0:
            if not more():
                if held[at:].strip():
                    raise ValueError("an archive ends within a record")
                return
            end = held.find(b"\r\n\r\n", at)
        first, *lines = bytes(held[at:end]).split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError("a record does not begin with a version line")
        headers = {name.lower(): value.strip() for name, _, value in (x.partition(b":") for x in lines)}
        size, start = int(headers[b"content-length"]), end + 4 - at
        while len(held) - at < start + size + 4:
            if not more():
                raise ValueError("an archive ends within a record")
        yield headers, bytes(held[at + start : at + start + size])
        at += start + size + 4


RECORDS = pa.schema(
    [
        ("kind", pa.string()),
        ("record_id", pa.string()),
        ("concurrent_to", pa.string()),
        ("refers_to", pa.string()),
        ("target_uri", pa.string()),
        ("date", pa.string()),
        ("digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
        ("fields", pa.string()),
    ]
)
COLUMNS = (
    "kind string, record_id string, concurrent_to string, refers_to string, target_uri string, "
    "date string, digest string, payload_bytes bigint, payload binary, fields string"
)


def _row(headers: dict[bytes, bytes], block: bytes, payloads: bool) -> dict:
    text = lambda name: headers[name].decode("utf-8") if name in headers else None
    kind = text(b"warc-type")
    row = {
        "kind": kind,
        "record_id": text(b"warc-record-id"),
        "concurrent_to": text(b"warc-concurrent-to"),
        "refers_to": text(b"warc-refers-to"),
        "target_uri": text(b"warc-target-uri"),
        "date": text(b"warc-date"),
    }
    if kind == "metadata":
        row["fields"] = block.decode("utf-8")
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        row["payload_bytes"] = int(lengths[0]) if lengths else len(payload)
        declared = (text(b"warc-payload-digest") or "").removeprefix("sha1:")
        row["digest"] = declared
        if kind == "response":
            row["payload_bytes"], row["digest"] = len(payload), hashlib.sha1(payload).hexdigest()
            if declared and declared != row["digest"]:
                raise ValueError(f"the payload of {row['record_id']} does not have its digest")
            row["payload"] = payload if payloads else None
    return row


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives; response payloads are checked by digest."""

    def records(batches):
        for batch in batches:
            rows, size = [], 0
            for content in batch["content"]:
                for headers, block in parse(content.as_py()):
                    rows.append(_row(headers, block, payloads))
                    size += 500 + (len(block) if payloads else 0)
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, RECORDS)
                        rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, RECORDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(records, COLUMNS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, response, request, metadata.

    Request and metadata are joined to the response they were concurrent to,
    and are NULL if there is none.  A record that occurs twice counts once.
    """
    answer = F.struct("kind", "target_uri", "date", "digest", "payload_bytes", "payload", "refers_to")
    responses = (
        records.where(F.col("kind").isin("response", "revisit"))
        .select("record_id", answer.alias("response"))
        .dropDuplicates(["record_id"])
    )

    def beside(kind: str, *columns: str) -> DataFrame:
        return (
            records.where((F.col("kind") == kind) & F.col("concurrent_to").isNotNull())
            .select(F.col("concurrent_to").alias("of"), F.struct(*columns).alias(kind))
            .dropDuplicates(["of"])
        )

    requests = beside("request", "record_id", "target_uri", "date")
    metadata = beside("metadata", "record_id", "fields")
    return (
        responses.join(requests, responses.record_id == requests.of, "left")
        .drop("of")
        .join(metadata, responses.record_id == metadata.of, "left")
        .drop("of")
    )


ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n,
         sha1(coalesce(html, '')) AS d FROM pages),
k AS (SELECT d, max(page_id) AS kept FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM p LEFT JOIN k USING (d)
"""


@query("op4_warc", ORACLE)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an archive and back: what its records say."""
    path = scratch(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    records = store(read(spark, path, payloads=False), "records")  # unpacked and parsed once
    discard(spark, path)
    captures = stored(assemble(spark.read.parquet(records)), "captures")
    discard(spark, records)
    flat = captures.select(
        "record_id", "response", F.expr("try_cast(nullif(regexp_extract(metadata.fields, 'page-id: (-?[0-9]+)', 1), '') AS bigint)").alias("page_id")
    )
    first = flat.where(F.col("response.kind") == "response").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to")
    )
    joined = flat.join(first, F.col("response.refers_to") == F.col("refers_id"), "left")
    return joined.select(
        "page_id",
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        "refers_to",
    )
