"""Durable keyed history on Parquet, written by micro-batches.

A table is a folder partitioned by span, day, run and batch.  A run is one life
of a stream's checkpoint, and a commit is one of its micro-batches; writing a
commit again replaces exactly its own files, so a batch that is repeated after a
failure changes nothing, and no other run can overwrite it.

* predictions and alerts: insert if the key is absent (the first write wins).
  A span is a range of offsets of a partition, so all rows that can share a key
  lie in one span, whatever day they carry;
* metric windows: versions are appended, and the fullest one counts on reading,
  so a replay of part of the events never replaces more complete windows.  Their
  span is the month.

Beside the rows lies an index of ranges: for every commit the lowest and highest
offset it may hold in each cell of ``CELL`` offsets, and its days.  It is written
before the rows, so it covers at least what is stored.  A batch opens only the
commits whose ranges meet its own; one with new offsets opens no stored row.

Compaction writes commits of its own beside the old ones and then publishes, as
one small folder that appears at once, which commits these replace.  Readers and
writers may work meanwhile: they see the old commits or the new, never both.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import (
    ALERT_SCHEMA,
    METRIC_SCHEMA,
    PREDICTION_SCHEMA,
    RECORD_KEY,
    WINDOW_KEY,
    ContractError,
    field_names,
)
from ..functions.times import iso_millis
from ..session import path_exists, put_once, remove


@dataclass(frozen=True)
class HistoryTable:
    name: str
    schema: str
    key: tuple[str, ...]
    day_of: str
    newest_first: tuple[str, ...]
    recent: tuple[str, ...]


_RECENT_RECORD = (
    "event_timestamp", "topic", "partition", "offset", "prediction_label", "scenario", "source_label"
)
_RECORD_ORDER = ("event_timestamp", *RECORD_KEY)

PREDICTIONS = HistoryTable(
    "predictions", PREDICTION_SCHEMA, RECORD_KEY, "event_timestamp", _RECORD_ORDER,
    _RECENT_RECORD,
)
ALERTS = HistoryTable(
    "alerts", ALERT_SCHEMA, RECORD_KEY, "event_timestamp", _RECORD_ORDER, _RECENT_RECORD
)
METRICS = HistoryTable(
    "metrics", METRIC_SCHEMA, WINDOW_KEY, "window_end", ("window_end", "window_start"),
    ("window_end", "status", "event_rate", "attack_rate", "event_count", "attack_count"),
)
TABLES = (PREDICTIONS, METRICS, ALERTS)
STORED = "span string, day date, run string, batch bigint"
COMMIT = ("span", "day", "run", "batch")
#: Offsets of a span; and the day of rows without a readable time.
SPAN_OFFSETS = 1_000_000
NO_DAY = "1970-01-01"
COMPACTED = "compacted-"
#: Offsets of one entry of the index of ranges.
CELL = 10_000
RANGES = "topic string, partition int, low bigint, high bigint, day date, rows bigint, span string, run string, batch bigint"
REPLACED = "span string, day date, run string, batch bigint, by string"


def _path(root: str, table: HistoryTable) -> str:
    return f"{root}/{table.name}"


def _stored_schema(table: HistoryTable) -> str:
    return f"{table.schema}, {STORED}"


def initialize(spark: SparkSession, root: str) -> None:
    """Create absent tables as empty ones; never touch tables that exist."""
    for table in TABLES:
        empty = spark.createDataFrame([], _stored_schema(table))
        empty.write.mode("ignore").partitionBy(*COMMIT).parquet(_path(root, table))


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run that a checkpoint belongs to, kept beside the checkpoint.

    A stream that goes on from its checkpoint is the same run; one that starts
    without it is another, and its commits are other commits.
    """
    note, files = _files(spark, f"{checkpoint}/run-name")
    if files.exists(note):
        return spark.read.text(note.toString()).first()[0]
    name = uuid.uuid4().hex
    out = files.create(note, False)
    out.writeBytes(name)
    out.close()
    return name


def _present(spark: SparkSession, base: str, spans) -> list[str]:
    """Folders of the spans that are there, found with one listing."""
    pattern, files = _files(spark, f"{base}/span={{{','.join(sorted(spans))}}}")
    return [s.getPath().toString() for s in files.globStatus(pattern) or []] if spans else []


def _below(spark: SparkSession, base: str, schema: str, spans) -> DataFrame:
    """Rows of a table partitioned by span, of all spans or of some, which are opened by path."""
    paths = [base] if spans is None else _present(spark, base, spans)
    if not paths or not path_exists(spark, base):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _ranges_path(root: str, table: HistoryTable) -> str:
    return f"{root}/_ranges/{table.name}"


def ranges(spark: SparkSession, root: str, table: HistoryTable, spans=None) -> DataFrame:
    """The index: what every commit may hold."""
    return _below(spark, _ranges_path(root, table), RANGES, spans)


def _published(spark: SparkSession, root: str, table: HistoryTable) -> tuple[int, DataFrame | None]:
    """Number and content of the newest list of replaced commits."""
    base, files = _files(spark, f"{root}/_compactions/{table.name}")
    if not files.exists(base):
        return 0, None
    names = [s.getPath().getName() for s in files.listStatus(base)]
    last = max([0, *(int(n.removeprefix("v=")) for n in names if n.startswith("v="))])
    return last, spark.read.schema(REPLACED).parquet(f"{base.toString()}/v={last}") if last else None


def read_log(spark: SparkSession, root: str, table: HistoryTable, spans=None, days=None) -> DataFrame:
    """Stored rows with the commit that wrote them, of all spans and days or of some.

    Given spans are opened by path, so neither the age nor the size of the rest
    of the table adds to the file listing.  Given days prune partitions.  Commits
    that a published compaction replaces, and unpublished compactions, are left out.
    """
    base = _path(root, table)
    if spans is None:
        log = spark.read.schema(_stored_schema(table)).option("basePath", base).parquet(base)
    else:
        log = _below(spark, base, _stored_schema(table), spans)
    if days is not None:
        log = log.where(F.col("day").isin(list(days)))
    _, replaced = _published(spark, root, table)
    if replaced is None:
        return log.where(~F.col("run").startswith(COMPACTED))
    live = [r.by for r in replaced.select("by").distinct().collect()]
    log = log.where(~F.col("run").startswith(COMPACTED) | F.col("run").isin(live))
    return log.join(replaced.where("run IS NOT NULL").drop("by"), list(COMMIT), "left_anti")


def _current(log: DataFrame, table: HistoryTable) -> DataFrame:
    """One row per key: rows as they are, or the fullest version of a window."""
    columns = [c for c in log.columns if c not in COMMIT]
    if table is not METRICS:
        return log.select(*columns)
    rest = [c for c in columns if c not in table.key]
    fullest = log.groupBy(*table.key).agg(
        F.max_by(F.struct(*rest), F.struct("event_count", "batch", "run")).alias("v")
    )
    return fullest.select(*table.key, "v.*").select(*columns)


def read_table(spark: SparkSession, root: str, table: HistoryTable) -> DataFrame:
    """Current content: one row per key."""
    return _current(read_log(spark, root, table), table)


def _for_storage(batch: DataFrame, table: HistoryTable, run: str, batch_id: int) -> DataFrame:
    """The table's columns plus span, day and commit; probability arrays become JSON text."""
    if "probability" in batch.columns and isinstance(
        batch.schema["probability"].dataType, T.ArrayType
    ):
        batch = batch.withColumn("probability", F.to_json("probability"))
    span = F.coalesce(F.date_format(F.col(table.day_of), "yyyy-MM"), F.lit("none"))
    if table.key == RECORD_KEY:
        stretch = F.floor(F.col("offset") / SPAN_OFFSETS).cast("string")
        span = F.concat_ws("-", F.col("partition").cast("string"), stretch)
    return batch.select(
        *field_names(table.schema),
        span.alias("span"),
        F.coalesce(F.to_date(F.col(table.day_of)), F.lit(NO_DAY).cast("date")).alias("day"),
        F.lit(run).alias("run"),
        F.lit(batch_id).cast("bigint").alias("batch"),
    )


def _write(rows: DataFrame, root: str, table: HistoryTable) -> None:
    """Replace exactly the folders that the rows of this commit belong to.

    Rows are gathered by span and day, which keeps the number of files near the
    data size; adaptive execution cuts what is too big for one task.
    """
    (
        rows.hint("rebalance", F.col("span"), F.col("day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*COMMIT)
        .parquet(_path(root, table))
    )


def _note_ranges(rows: DataFrame, root: str, table: HistoryTable) -> DataFrame:
    """Enter a commit's rows into the index, before they are stored; returns the entries."""
    cell, of = F.lit(None).cast("bigint"), ["span", "day", "run", "batch"]
    place = [F.lit(None).cast("string").alias("topic"), F.lit(None).cast("int").alias("partition")]
    if table.key == RECORD_KEY:
        cell, place = F.col("offset"), ["topic", "partition"]
    noted = rows.select(*of, *place, cell.alias("at"))
    entries = noted.groupBy(*of, "topic", "partition", F.floor(F.col("at") / CELL).alias("cell")).agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.count(F.lit(1)).alias("rows")
    )
    # Added up by many tasks, then gathered by span, which keeps the number of files small.
    entries = entries.drop("cell").hint("rebalance", F.col("span"))
    path = _ranges_path(root, table)
    writer = entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("span", "run", "batch").parquet(path)
    return entries


def _meeting(spark: SparkSession, root: str, table: HistoryTable, run: str, batch_id: int, spans) -> list[str]:
    """Commits (span/run/batch) of others whose ranges meet those of a commit."""
    every = ranges(spark, root, table, spans).withColumn("cell", F.floor(F.col("low") / CELL))
    own = (F.col("run") == run) & (F.col("batch") == batch_id)
    mine = every.where(own).select(
        "span", "topic", "partition", "cell", F.col("low").alias("from"), F.col("high").alias("to")
    )
    both = every.where(~own).join(mine, ["span", "topic", "partition", "cell"])
    met = both.where((F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")))
    return [r[0] for r in met.select(_commit_name()).distinct().collect()]


def _commit_name():
    return F.concat_ws("/", "span", "run", F.col("batch").cast("string"))


def present_keys(
    spark: SparkSession, root: str, table: HistoryTable, *, run: str, batch_id: int, spans
) -> DataFrame | None:
    """Stored keys that a noted commit may repeat, from the files whose ranges meet its own; None if there are none."""
    met = _meeting(spark, root, table, run, batch_id, spans)
    if not met:
        return None
    where = sorted({name.partition("/")[0] for name in met})
    return read_log(spark, root, table, where).where(_commit_name().isin(met)).select(*table.key)


def insert_absent(
    batch: DataFrame, root: str, table: HistoryTable, *, run: str, batch_id: int
) -> None:
    """Store the rows whose key is not stored yet: the first write wins.

    Stored rows of this very commit do not count as present, so repeating a
    batch writes the same files again.  Of equal keys inside one batch the
    smallest row, earliest time first, is kept whichever task happens to see it.
    The driver sees the spans of the batch, partitions times offset ranges, and
    the names of the commits whose ranges meet the batch's.
    """
    rows = _for_storage(batch, table, run, batch_id)
    rest = [c for c in rows.columns if c not in table.key]
    first = rows.groupBy(*table.key).agg(F.min(F.struct(*rest)).alias("v"))
    # Read for its spans, for the index and for storage; what leads to it runs once.
    rows = first.select(*table.key, "v.*").select(*rows.columns).persist()
    try:
        spark = batch.sparkSession
        spans = [r.span for r in rows.select("span").distinct().collect()]
        if not spans:
            return
        _note_ranges(rows, root, table)
        stored = present_keys(spark, root, table, run=run, batch_id=batch_id, spans=spans)
        _write(rows if stored is None else rows.join(stored, list(table.key), "left_anti"), root, table)
    finally:
        rows.unpersist()


def append_versions(
    batch: DataFrame, root: str, *, run: str, batch_id: int, table: HistoryTable = METRICS
) -> None:
    """Store a new version of every window of the batch (the fullest wins)."""
    rows = _for_storage(batch, table, run, batch_id)
    _note_ranges(rows, root, table)
    _write(rows, root, table)


def compact(spark: SparkSession, root: str, table: HistoryTable, before: datetime.date) -> int:
    """Rewrite the days before a date as one commit per span and day.

    The new commits count, and the old ones stop counting, when the list of
    replaced commits is published; a run that is interrupted before leaves
    files that nobody reads.  Rows that come in meanwhile are commits of their
    own.  Of two compactions at a time one fails.  ``vacuum`` removes old files.
    Returns how many folders were replaced.
    """
    number, replaced = _published(spark, root, table)
    log = read_log(spark, root, table).where(F.col("day") < F.lit(before))
    commits = log.groupBy("span", "day").agg(F.count_distinct("run", "batch").alias("commits"))
    many = commits.where("commits > 1").drop("commits")
    count = many.count()
    if not count:
        return 0
    run = f"{COMPACTED}{uuid.uuid4().hex}"
    chosen = log.join(many, ["span", "day"], "left_semi")
    place = chosen.select(*table.key, "span", "day").dropDuplicates(list(table.key))
    rows = _current(chosen, table).join(place, list(table.key))
    rows = rows.withColumns({"run": F.lit(run), "batch": F.lit(0).cast("bigint")})
    _note_ranges(rows, root, table)
    _write(rows, root, table)
    listed = chosen.select(*COMMIT).distinct().withColumn("by", F.lit(run))
    if replaced is not None:
        listed = listed.unionByName(replaced)
    if not put_once(listed.coalesce(1), f"{root}/_compactions/{table.name}", f"v={number + 1}"):
        raise ContractError("another compaction was published meanwhile")
    return count


def vacuum(spark: SparkSession, root: str, table: HistoryTable) -> int:
    """Delete files that a compaction has replaced, once no reader from before it is left.

    Their entries stay in the index and lead nowhere.  Returns how many folders were deleted.
    """
    number, replaced = _published(spark, root, table)
    if replaced is None:
        return 0
    gone = replaced.where("run IS NOT NULL").select(*COMMIT).collect()  # one row per folder
    for span, day, run, batch in gone:
        remove(spark, f"{_path(root, table)}/span={span}/day={day}/run={run}/batch={batch}")
    left = replaced.select(*[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in STORED.split(", "))], "by")
    if gone:
        put_once(left.distinct().coalesce(1), f"{root}/_compactions/{table.name}", f"v={number + 1}")
    return len(gone)


def table_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per table; a missing table is an error."""
    counts = None
    for table in TABLES:
        one = require_table(spark, root, table).agg(F.count(F.lit(1)).alias("rows"))
        one = one.select(F.lit(table.name).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def require_table(spark: SparkSession, root: str, table: HistoryTable) -> DataFrame:
    try:
        return read_table(spark, root, table)
    except Exception as cause:
        raise ContractError(f"history at {root} has no table {table.name}") from cause


def recent(spark: SparkSession, root: str, table: HistoryTable, limit: int) -> DataFrame:
    """Newest rows of a stored table, from as few of the newest days as hold enough.

    The order begins with the time that names the day, so later days come
    first.  The index says which days and spans there are and how many rows they
    have at most; if they turn out to hold too few, twice as many are opened.
    """
    noted = ranges(spark, root, table).groupBy("day").agg(F.sum("rows").alias("rows"), F.collect_set("span").alias("spans"))
    found = noted.orderBy(F.desc("day")).collect()  # a row per day
    taken, expected = 0, 0
    while taken < len(found) and expected < limit:
        expected, taken = expected + found[taken].rows, taken + 1

    def newest(days) -> DataFrame:
        spans = {s for r in days for s in r.spans}
        return _current(read_log(spark, root, table, spans, [r.day for r in days] or [NO_DAY]), table)

    while taken < len(found) and newest(found[:taken]).limit(limit).count() < limit:
        taken *= 2
    return recent_rows(newest(found[:taken]), table, limit)


def recent_rows(rows: DataFrame, table: HistoryTable, limit: int) -> DataFrame:
    """Newest rows of a table: a bounded top-k, times as ISO text."""
    newest = rows.orderBy(*[F.desc(c) for c in table.newest_first]).limit(limit)
    shown = [
        iso_millis(F.col(c)).alias(c) if c == table.day_of else F.col(c) for c in table.recent
    ]
    return newest.select(*shown)


def reconcile(source: DataFrame, stored: DataFrame, alert_rows: DataFrame) -> DataFrame:
    """Compare stored predictions and alerts with the source by record key.

    Keys are counted per origin in a single aggregation over the union, which
    finds missing, unexpected and repeated records and alerts that do not
    belong to a predicted attack, without any join.
    """
    def tagged(rows, origin, attack):
        return rows.select(*RECORD_KEY, F.lit(origin).alias("origin"), attack.alias("attack"))

    no = F.lit(False)
    every = (
        tagged(source, "source", no)
        .unionByName(tagged(stored, "stored", F.col("prediction") == 1.0))
        .unionByName(tagged(alert_rows, "alert", no))
    )
    seen = every.groupBy(*RECORD_KEY).agg(
        F.count_if(F.col("origin") == "source").alias("in_source"),
        F.count_if(F.col("origin") == "stored").alias("in_stored"),
        F.count_if(F.col("origin") == "alert").alias("in_alerts"),
        F.bool_or("attack").alias("attack"),
    )
    verdict = (
        F.when(F.col("in_source") == 0, "unexpected")
        .when(F.col("in_stored") == 0, "missing")
        .when(F.col("in_stored") > 1, "repeated")
        .when(F.col("attack") != (F.col("in_alerts") > 0), "alert_differs")
        .otherwise("matched")
    )
    return seen.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("records"))


def offset_gaps(rows: DataFrame) -> DataFrame:
    """Offsets that are absent inside the range of each partition."""
    spans = rows.groupBy("topic", "partition", "offset").agg(F.count(F.lit(1)).alias("n"))
    return spans.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("offsets"),
        (F.max("offset") - F.min("offset") + 1 - F.count(F.lit(1))).alias("gaps"),
        F.sum(F.col("n") - 1).alias("repeats"),
    )
