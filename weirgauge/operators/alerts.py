"""Predictions with names, and the alerts derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ALERT_SCHEMA, PREDICTION_SCHEMA, field_names
from ..functions.cells import ratio
from ..functions.labels import class_name

ATTACK_ALERT = "Predicted Attack"
PREDICTION_COLUMNS = field_names(PREDICTION_SCHEMA)


def name_predictions(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prediction_label", class_name(F.col("prediction")))


def alerts(predictions: DataFrame) -> DataFrame:
    """Rows of the alert table: its columns, read off predicted attacks."""
    kind = {"alert_type": F.lit(ATTACK_ALERT)}
    shown = [kind.get(name, F.col(name)).alias(name) for name in field_names(ALERT_SCHEMA)]
    return predictions.select(*shown).where(F.col("prediction") == 1.0)


def count_by(alert_rows: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Alerts per value, NULL shown as Unknown; optionally the most frequent."""
    counts = alert_rows.groupBy(F.coalesce(F.col(column), F.lit("Unknown")).alias(column)).agg(
        F.count(F.lit(1)).alias("alerts")
    )
    return counts.orderBy(F.desc("alerts"), column).limit(top) if top else counts


def shares(counts: DataFrame, value: str, out: str = "share") -> DataFrame:
    """Share of the total; all shares are zero when the total is."""
    total = counts.agg(F.sum(value).alias("t")).scalar()
    return counts.withColumn(out, ratio(F.col(value), total))


def feed(alert_rows: DataFrame, limit: int) -> DataFrame:
    """Newest alerts first, alerts without a readable time last."""
    order = [F.desc_nulls_last(c) for c in ("event_timestamp", "topic", "partition", "offset")]
    return alert_rows.orderBy(*order).limit(limit)
