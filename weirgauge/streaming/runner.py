"""Running streams: every one has a checkpoint, tests drain what is available."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start(
    df: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    *,
    mode: str = "append",
    name: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Start a stream that hands each micro-batch to ``handle``."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(handle).start()


def start_console(df: DataFrame, checkpoint: str, *, mode: str, name: str) -> StreamingQuery:
    """Print rows for inspection."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.queryName(name).format("console").option("truncate", False).start()


def drain_to_parquet(df: DataFrame, checkpoint: str, path: str) -> StreamingQuery:
    """Process what is there with the exactly-once Parquet sink (append mode)."""
    query = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drain(
    df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Process what is there and return the finished query."""
    query = start(df, checkpoint, handle, mode=mode, drain=True)
    query.awaitTermination()
    return query


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Keep each micro-batch in a folder of its own; a repeated batch replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write

