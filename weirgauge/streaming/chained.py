"""Streams on streams: state that is read, joined, or aggregated again.

Everything here rests on event time.  A window is closed when the watermark has
passed its end; only then is it final, and only closed windows enter a second
stateful step.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..contracts import RECORD_KEY
from ..operators.windows import COUNTS, WindowPlan, window_metrics

# --- state --------------------------------------------------------------------


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Windows that a stopped metric stream still holds in its state, with their counts.

    The state is what a restart goes on with: every window above the watermark
    and no other, so its size depends on lateness and slide, not on the past.
    """
    fields = ", ".join(f"{c}: bigint" for c in COUNTS)
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("value").cast(f"struct<{fields}>").alias("v"),
    ).select("window_start", "window_end", "v.*")


# --- source and store ---------------------------------------------------------


def live_verdicts(source: DataFrame, stored: DataFrame, lateness: int) -> DataFrame:
    """Compare a stream of source records with the stream of stored predictions.

    Both sides carry the log's own timestamp, which is part of the join key: a
    record whose partner has not come when the watermark passes that time is
    given out alone and leaves the state.  Yields the key and a verdict:
    matched, missing (not stored) or unexpected (not in the source).
    """
    delay = f"{lateness} seconds"
    left = source.select(*RECORD_KEY, F.col("timestamp").alias("seen_at")).withWatermark("seen_at", delay)
    right = stored.select(
        *[F.col(k).alias(f"stored_{k}") for k in RECORD_KEY], F.col("kafka_timestamp").alias("stored_at")
    ).withWatermark("stored_at", delay)
    same = F.col("seen_at") == F.col("stored_at")
    for k in RECORD_KEY:
        same = same & (F.col(k) == F.col(f"stored_{k}"))
    verdict = F.when(F.col("stored_at").isNull(), "missing").when(F.col("seen_at").isNull(), "unexpected")
    key = [F.coalesce(F.col(k), F.col(f"stored_{k}")).alias(k) for k in RECORD_KEY]
    return left.join(right, same, "full_outer").select(*key, verdict.otherwise("matched").alias("verdict"))


# --- closed windows -----------------------------------------------------------


def closed_stats(predictions: DataFrame, plan: WindowPlan, period: str, time: str = "event_timestamp") -> DataFrame:
    """Mean and peak event rate of the closed windows of every period.

    Two aggregations in one stream: the first gives a window out once, when it
    is closed; the second counts it to the period that holds its last instant
    and gives the period out when the watermark has passed that too.
    """
    if predictions.isStreaming:
        predictions = predictions.withWatermark(time, f"{plan.lateness} seconds")
    attack = F.count_if(F.col("prediction") == 1.0)
    closed = predictions.groupBy(plan.window(time).alias("w")).agg(
        F.count(F.lit(1)).alias("event_count"), attack.alias("attack_count")
    )
    rate = F.col("event_count") / F.lit(float(plan.length))
    share = F.try_divide(F.col("attack_count").cast("double"), F.col("event_count"))
    return (
        closed.groupBy(F.window(F.window_time("w"), period).alias("p"))
        .agg(
            F.count(F.lit(1)).alias("windows"),
            F.avg(rate).alias("mean_event_rate"),
            F.max(rate).alias("peak_event_rate"),
            F.avg(share * 100.0).alias("mean_attack_percent"),
        )
        .select(F.col("p.start").alias("period_start"), F.col("p.end").alias("period_end"), "windows",
                "mean_event_rate", "peak_event_rate", "mean_attack_percent")
    )


CHANGES = "window_end timestamp, before string, status string, windows_before bigint"


class StatusChanges(StatefulProcessor):
    """Remembers the status of the last closed window and for how many it has lasted.

    Windows of one micro-batch come in any order and are sorted; those of a later
    one are later, because the watermark that closes them only moves forward.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "status string, windows bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = pd.concat(list(rows)).sort_values("window_end")
        status, windows = self.last.get() if self.last.exists() else (None, 0)
        found = []
        for end, now in zip(closed["window_end"], closed["status"]):
            if now == status:
                windows += 1
                continue
            found.append((end, status, now, windows))
            status, windows = now, 1
        self.last.update((status, windows))
        yield pd.DataFrame(found, columns=["window_end", "before", "status", "windows_before"]).astype({"windows_before": "int64"})

    def close(self) -> None:
        pass


def status_changes(predictions: DataFrame, plan: WindowPlan) -> DataFrame:
    """One row for every closed window whose status differs from that of the window before.

    A stream whose session keeps state on disk (``stream_session(on_disk=True)``).
    All windows share one key: there is one row per slide, however much traffic.
    """
    closed = window_metrics(predictions, plan).select("window_end", "status", F.lit(1).alias("all"))
    return closed.groupBy("all").transformWithStateInPandas(
        StatusChanges(), outputStructType=CHANGES, outputMode="Append", timeMode="None"
    )
