"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import time
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on: every timestamp is read and written in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@lru_cache(maxsize=None)
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"weirgauge-{application}-")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root(spark.sparkContext.applicationId)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nobody has used before."""
    return f"{shared_root(spark)}/weirgauge/{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared storage, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def put_once(df: DataFrame, path: str, name: str) -> bool:
    """Write rows as one folder that appears whole or not at all; one that is there stays as it is.

    Readers that list the parent, streams too, pass over the folder while it is written.
    """
    spark, aside = df.sparkSession, f"{path}/_{name}"
    if path_exists(spark, f"{path}/{name}"):
        return False
    df.write.mode("overwrite").parquet(aside)
    made, goal = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, f"{path}/{name}"))
    if not made.getFileSystem(spark._jsc.hadoopConfiguration()).rename(made, goal):
        raise OSError(f"{aside} could not be renamed")
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file to shared storage, in place of one that is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def set_times(spark: SparkSession, path: str, step: int = 1000) -> None:
    """Give the partitions of a folder modification times in the order of their names' numbers.

    A file stream takes files by that time, and the files of one job have it by chance.
    """
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [s.getPath() for s in files.listStatus(base) if "=" in s.getPath().getName()]
    folders.sort(key=lambda p: int(p.getName().partition("=")[2]))
    now = int(time.time() * 1000) - step * len(folders)
    for place, folder in enumerate(folders):
        for held in files.listStatus(folder):
            files.setTimes(held.getPath(), now + step * place, -1)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in shared storage, read back.

    For input that is read many times, such as training rows: the work before
    it runs once, and a lost executor costs a re-read and not a recomputation.
    """
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(
    spark: SparkSession, state_partitions: int | None = None, on_disk: bool = False
) -> SparkSession:
    """Session for one stream with its own number of state partitions.

    The number is fixed at a stream's first start, so it is chosen per stream
    rather than taken from whatever the caller's batch queries use.  State kept
    ``on_disk`` (RocksDB) is bounded by the executors' disks and not their heap,
    and a micro-batch writes what it changed to the checkpoint, not all of it.
    """
    side = prepare(spark.newSession())
    if on_disk:
        side.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
        side.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    if state_partitions is not None:
        side.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return side
