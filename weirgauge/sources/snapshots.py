"""Small published snapshots for readers that poll: newest windows and alerts.

A snapshot is a JSON list of bounded length.  Each publication goes to a folder
of its own; readers take the newest folder whose write has completed, so they
never see half a snapshot.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import (
    RECORD_KEY,
    SNAPSHOT_ALERTS,
    SNAPSHOT_WINDOWS,
    WINDOW_KEY,
    ContractError,
)

RECORDS = "record map<string,string>"
DONE = "_SUCCESS"
#: A superseded publication is removed when it is older than this.
KEPT_SECONDS = 3600
#: A snapshot is one JSON text; lists longer than this are refused, not cut.
PUBLISHED_ROWS = 10_000


def latest_per_key(rows: DataFrame, key, sequence: str) -> DataFrame:
    """Last version of every key, combined on the map side."""
    rest = [c for c in rows.columns if c not in (*key, sequence)]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), sequence).alias("v"))
    return newest.select(*key, "v.*")


def newest_windows(rows: DataFrame, sequence: str, limit: int = SNAPSHOT_WINDOWS) -> DataFrame:
    current = latest_per_key(rows, WINDOW_KEY, sequence)
    return current.orderBy(F.desc("window_end"), F.desc("window_start")).limit(limit)


def newest_alerts(rows: DataFrame, sequence: str, limit: int = SNAPSHOT_ALERTS) -> DataFrame:
    current = latest_per_key(rows, RECORD_KEY, sequence)
    return current.orderBy(*[F.desc(c) for c in ("event_timestamp", *RECORD_KEY)]).limit(limit)


def _folders(spark: SparkSession, root: str) -> list:
    """All publications as (path, time in seconds, whether complete), oldest version first."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found = [
        (s.getPath(), s.getModificationTime() / 1000, fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), DONE)))
        for s in fs.listStatus(base)
    ]
    return sorted(found, key=lambda f: f[0].getName())


def _version(path) -> int:
    return int(path.getName().removeprefix("v="))


def _put(texts: DataFrame, root: str, keep_seconds: float = KEPT_SECONDS) -> str:
    """Write a version above all others, then drop what is old and superseded.

    The version is the largest one there plus one, so a writer with a slow clock
    still comes last.  A reader has ``keep_seconds`` to finish with a folder
    that is no longer the newest; unfinished folders go at that age too.
    """
    spark = texts.sparkSession
    before = _folders(spark, root)
    path = f"{root}/v={max([0, *(_version(p) for p, _, _ in before)]) + 1:020d}"
    texts.write.text(path)
    for old, written_at, _ in before:
        if written_at < time.time() - keep_seconds:
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return path


def publish(rows: DataFrame, root: str, most: int = PUBLISHED_ROWS) -> str:
    """Write a small frame as one JSON list in a new folder; more than ``most`` rows fail."""
    taken = rows.limit(most + 1).persist()
    try:
        if taken.count() > most:
            raise ContractError(f"more than {most} rows for a snapshot")
        return _put(taken.agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")), root)
    finally:
        taken.unpersist()


def reset(spark: SparkSession, root: str) -> str:
    """Publish an empty list, so that an earlier run is not shown as current."""
    return _put(spark.createDataFrame([("[]",)], "value string").coalesce(1), root)


def parse_list(texts: DataFrame, column: str = "value") -> DataFrame:
    """Objects of a JSON list; other elements, and text that is no list, give no row."""
    items = F.from_json(F.col(column), "array<string>")
    objects = F.transform(items, lambda item: F.from_json(item, "map<string,string>"))
    return texts.select(F.explode(objects).alias("record")).where(F.col("record").isNotNull())


def read(spark: SparkSession, root: str) -> DataFrame:
    """Records of the newest completed publication; none if there is not any."""
    folders = [path for path, _, complete in _folders(spark, root) if complete]
    if not folders:
        return spark.createDataFrame([], RECORDS)
    return parse_list(spark.read.option("wholetext", True).text(folders[-1].toString()))
