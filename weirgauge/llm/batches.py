"""Small helpers for work on Arrow batches, and for tables in shared storage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch

SLICE_BYTES = 4 << 20
SLICE_ROWS = 512


def raw(column: str) -> Column:
    """A text column as its UTF-8 bytes; NULL stays NULL."""
    return F.col(f"`{column}`").cast("binary")


def slices(
    texts: pa.Array, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS
) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of short runs of a batch; NULL is read as empty text.

    Work arrays are many times larger than the text they describe, so they are
    made for a few megabytes, or a few hundred rows, at a time.  A text is
    never cut.
    """
    first, size, run = 0, 0, []
    for value in texts:
        text = value.as_py() or b""
        if run and (size + len(text) > limit or len(run) == rows):
            yield first, run
            first, size, run = first + len(run), 0, []
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def store(df: DataFrame, purpose: str) -> str:
    """Write rows to shared storage and return the place.

    Later steps read the table: a lost executor costs a re-read, and the
    lineage ends here.
    """
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(store(df, purpose))


def discard(spark, path: str) -> None:
    """Remove a table that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of consecutive runs with the given lengths."""
    ends = np.cumsum(lengths)
    return ends - lengths, ends
