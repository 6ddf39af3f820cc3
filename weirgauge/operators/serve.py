"""What a monitoring screen asks for: small frames from windows and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ALERT_SCHEMA, OPEN_WINDOWS, STATUS_TEXT, STATUS_UNKNOWN, field_names
from ..functions.times import clock, parse_moment
from .windows import METRIC_COLUMNS

METRIC_NUMBERS = (
    "event_count",
    "event_rate",
    "normal_count",
    "attack_count",
    "normal_rate",
    "attack_rate",
)


def complete_records(records: DataFrame, column: str = "record") -> DataFrame:
    """Records (maps) that hold every metric field."""
    fields = F.array(*[F.lit(n) for n in METRIC_COLUMNS])
    return records.where(F.size(F.array_except(fields, F.map_keys(column))) == 0)


def metric_frame(records: DataFrame, column: str = "record") -> DataFrame:
    """Typed windows from text records; rows that do not convert are dropped."""
    field = F.col(column)
    typed = records.select(
        parse_moment(field["window_start"]).alias("window_start"),
        parse_moment(field["window_end"]).alias("window_end"),
        *[field[n].try_cast("double").alias(n) for n in METRIC_NUMBERS],
        field["status"].alias("status"),
    )
    return (
        typed.dropna(subset=["window_end", *METRIC_NUMBERS])
        .withColumns(
            {
                "attack_percent": F.col("attack_rate") * 100.0,
                "normal_percent": F.col("normal_rate") * 100.0,
            }
        )
    )


def alert_frame(records: DataFrame) -> DataFrame:
    """Alert rows with every expected column; absent ones become NULL."""
    present = set(records.columns)
    aligned = records.select(
        *[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in field_names(ALERT_SCHEMA)]
    )
    return aligned.withColumn("event_moment", parse_moment(F.col("event_timestamp")))


def alert_display(alert_rows: DataFrame, moment: str = "event_timestamp") -> DataFrame:
    """Alert as shown in a list: clock time, upper-case verdict, no empty cells."""

    def shown(column, default):
        return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))

    return alert_rows.select(
        *("topic", "partition", "offset"),
        clock(F.col(moment)).alias("shown_time"),
        F.upper(shown("prediction_label", "Attack")).alias("verdict"),
        shown("scenario", "Unknown").alias("shown_scenario"),
        shown("source_label", "Unknown").alias("shown_source"),
    )


def status_presentation(metrics: DataFrame) -> DataFrame:
    """Display text for a status and the attack share held within 0 to 100."""

    def text(i):
        known = F.create_map(
            *[part for name, texts in STATUS_TEXT.items() for part in (F.lit(name), F.lit(texts[i]))]
        )
        return F.coalesce(F.try_element_at(known, F.col("status")), F.lit(STATUS_UNKNOWN[i]))

    share = F.col("attack_rate") * 100.0
    return metrics.withColumns(
        {
            "shown_status": text(0),
            "shown_message": text(1),
            "shown_percent": F.greatest(F.lit(0.0), F.least(F.lit(100.0), share)),
        }
    )


def feed_state(metrics: DataFrame, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """Is there anything to show yet?"""
    n = F.col("windows")
    return metrics.agg(F.count(F.lit(1)).alias("windows")).withColumn(
        "state",
        F.when(n == 0, "waiting").when(n <= open_windows, "warming_up").otherwise("ready"),
    )


def prediction_volume(metrics: DataFrame) -> DataFrame:
    """Window counts in long form: one row per window and class."""
    return (
        metrics.select(
            "window_end",
            F.col("normal_count").alias("Normal"),
            F.col("attack_count").alias("Attack"),
        )
        .unpivot("window_end", ["Normal", "Attack"], "prediction", "events")
    )
