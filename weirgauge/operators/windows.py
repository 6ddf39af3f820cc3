"""Event-time windows over predictions, and what is derived from windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import OPEN_WINDOWS
from ..functions.labels import status_band
from .ordering import BUCKET, grid_buckets, previous_row, running_sum

COUNTS = ("event_count", "normal_count", "attack_count")
METRIC_COLUMNS = (
    "window_start",
    "window_end",
    "event_count",
    "event_rate",
    "normal_count",
    "attack_count",
    "normal_rate",
    "attack_rate",
    "status",
)


@dataclass(frozen=True)
class WindowPlan:
    """Window length, slide and allowed lateness, in seconds."""

    length: int = 10
    slide: int = 5
    lateness: int = 30

    def window(self, column: str):
        return F.window(F.col(column), f"{self.length} seconds", f"{self.slide} seconds")


LIVE = WindowPlan()


def window_counts(predictions: DataFrame, plan: WindowPlan, time: str = "event_timestamp"):
    """Events and classes per sliding window; batch and streaming input alike.

    Counting is partial-then-final, so a burst that fills a single window is
    added up by all map tasks.  On a stream the watermark bounds the state to
    the windows that can still change.
    """
    if predictions.isStreaming:
        predictions = predictions.withWatermark(time, f"{plan.lateness} seconds")
    counted = predictions.groupBy(plan.window(time).alias("w")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("prediction") == 0.0).alias("normal_count"),
        F.count_if(F.col("prediction") == 1.0).alias("attack_count"),
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *COUNTS
    )


def window_metrics(predictions: DataFrame, plan: WindowPlan = LIVE, time: str = "event_timestamp"):
    """Counts, rates and status of every window."""
    events = F.col("event_count").cast("double")
    rated = window_counts(predictions, plan, time).withColumns(
        {
            "event_rate": events / float(plan.length),
            "normal_rate": F.try_divide(F.col("normal_count").cast("double"), events),
            "attack_rate": F.try_divide(F.col("attack_count").cast("double"), events),
        }
    )
    return rated.withColumn("status", status_band(F.col("attack_rate"))).select(*METRIC_COLUMNS)


def window_deltas(metrics: DataFrame, plan: WindowPlan = LIVE) -> DataFrame:
    """Change of event rate and attack share against the window before."""
    chained = previous_row(
        grid_buckets(metrics, "window_end", plan.slide),
        "window_end",
        ("event_rate", "attack_rate"),
        "before",
    )
    return chained.select(
        "window_end",
        (F.col("event_rate") - F.col("before.event_rate")).alias("event_rate_change"),
        ((F.col("attack_rate") - F.col("before.attack_rate")) * 100.0).alias("attack_points_change"),
    )


def completed_windows(metrics: DataFrame, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """All but the newest windows, which may still be filling.

    The cut is the oldest of the newest ``open_windows`` ends, found by a
    bounded top-k; with no more windows than that nothing is complete.
    """
    newest = metrics.select("window_end").orderBy(F.desc("window_end")).limit(open_windows)
    cut = newest.agg(F.min("window_end").alias("cut")).scalar()
    return metrics.where(F.col("window_end") < cut)


def latest_window(metrics: DataFrame, by=()) -> DataFrame:
    """Newest window, per entity if ``by`` is given, by aggregation."""
    rest = [c for c in metrics.columns if c not in by]
    newest = metrics.groupBy(*by).agg(F.max_by(F.struct(*rest), "window_end").alias("m"))
    return newest.where(F.col("m").isNotNull()).select(*by, "m.*")


def status_runs(metrics: DataFrame, plan: WindowPlan = LIVE) -> DataFrame:
    """Collapse neighbouring windows of equal status into runs, in time order."""
    chained = previous_row(
        grid_buckets(metrics, "window_end", plan.slide), "window_end", ("status",), "before"
    )
    changed = F.when(F.col("before.status") == F.col("status"), 0).otherwise(1)
    numbered = running_sum(chained, "window_end", changed, "run")
    return (
        numbered.drop(BUCKET)
        .groupBy("run")
        .agg(
            F.min("status").alias("status"),
            F.min("window_end").alias("first_end"),
            F.max("window_end").alias("last_end"),
            F.count(F.lit(1)).alias("windows"),
        )
    )


def against_mean(metrics: DataFrame, column: str, out: str) -> DataFrame:
    """Every window beside the mean of all windows, added as a scalar subquery."""
    mean = metrics.agg(F.avg(column).alias("m")).scalar()
    return metrics.withColumn(f"mean_{out}", mean).withColumn(
        f"{out}_vs_mean", F.col(column) - F.col(f"mean_{out}")
    )


def history_stats(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count(F.lit(1)).alias("windows"),
        F.avg("event_rate").alias("mean_event_rate"),
        F.max("event_rate").alias("peak_event_rate"),
        F.avg(F.col("attack_rate") * 100.0).alias("mean_attack_percent"),
        F.avg("event_count").alias("mean_event_count"),
    )
