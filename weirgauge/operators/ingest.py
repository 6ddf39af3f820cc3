"""From log records to judged events: valid rows and quarantined rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import (
    EVENT_TIME_FORMAT,
    EVENT_TIME_SHAPE,
    REASONS,
    EventContract,
    require_columns,
)
from ..functions.cells import FEW, all_finite, ref, settle

RECORD = ("topic", "partition", "offset", "kafka_timestamp")


def decode(records: DataFrame) -> DataFrame:
    """Log record with its payload as text."""
    require_columns(records, ("topic", "partition", "offset", "timestamp", "value"))
    return records.select(
        *RECORD[:3],
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("raw_json"),
    )


def parse_views(decoded: DataFrame, contract: EventContract) -> DataFrame:
    """Read the payload twice: as names (what is there) and as types (what it is).

    The map view tells an absent or null field from one of the wrong type; the
    typed view turns a quoted number into NULL instead of accepting it.

    Both views come out of generator steps that yield one row each, the typed
    one as plain columns.  Filters on what is derived from them stay above the
    generators; a filter moved below a projection would copy the parser into
    each of its tests and parse every payload about a dozen times.
    """
    text = F.col("raw_json")
    views = F.struct(
        F.from_json(text, "map<string,string>").alias("__given"),
        F.from_json(text, contract.schema).alias("__typed"),
    )
    both = decoded.select("*", F.inline(F.array(views)))
    flat = both.select(*RECORD, "raw_json", "__given", F.inline(F.array("__typed")))
    moment = F.try_to_timestamp(F.col("event_time"), F.lit(EVENT_TIME_FORMAT))
    return flat.withColumn("event_timestamp", moment)


def metadata_agrees(contract: EventContract) -> Column:
    """Scenario, ground truth and source label tell one consistent story."""
    scenario, truth = F.col("scenario"), F.col("ground_truth")
    source = F.col("source_label")
    quiet = (truth == "Normal") & (source == contract.normal)
    burst = (truth == "Attack") & source.startswith(contract.burst_prefix)
    return F.coalesce(
        (quiet & scenario.isin("NORMAL", "MIXED")) | (burst & scenario.isin("DDOS_BURST", "MIXED")),
        F.lit(False),
    )


def rejection_rules(contract: EventContract) -> dict[str, Column]:
    """What each reason means, in the order in which reasons take precedence."""
    given, when = F.col("__given"), F.col("event_time")

    def absent(names):
        if len(names) <= FEW:
            return reduce(or_, (F.try_element_at(given, F.lit(n)).isNull() for n in names))
        return F.exists(F.array(*[F.lit(n) for n in names]), lambda n: F.try_element_at(given, n).isNull())

    def outside(name, allowed):
        return ~F.coalesce(F.col(name).isin(list(allowed)), F.lit(False))

    tests = (
        given.isNull(),
        absent(contract.required),
        F.col("event_timestamp").isNull()
        | ~F.coalesce(when.rlike(EVENT_TIME_SHAPE), F.lit(False)),
        ~all_finite(contract.features),
        outside("scenario", contract.scenarios),
        outside("ground_truth", contract.truths),
        F.trim("source_label") == "",
        ~metadata_agrees(contract),
    )
    return dict(zip(REASONS, tests))


def judge(records: DataFrame, contract: EventContract) -> DataFrame:
    """Every record with the first reason to reject it, or NULL."""
    rules = rejection_rules(contract)
    reason = F.coalesce(*[F.when(test, F.lit(name)) for name, test in rules.items()])
    return settle(parse_views(decode(records), contract), "invalid_reason", reason)


def accepted(judged: DataFrame, contract: EventContract) -> DataFrame:
    return judged.where(F.col("invalid_reason").isNull()).select(
        *RECORD,
        "event_time",
        "event_timestamp",
        *[ref(n) for n in contract.required if n != "event_time"],
    )


def quarantined(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("invalid_reason").isNotNull()).select(
        *RECORD, "raw_json", "invalid_reason"
    )


def split_records(records: DataFrame, contract: EventContract) -> tuple[DataFrame, DataFrame]:
    """Valid and quarantined events: disjoint, and together all records."""
    judged = judge(records, contract)
    return accepted(judged, contract), quarantined(judged)


def publish_records(events: DataFrame, contract: EventContract, topic: str) -> DataFrame:
    """Events as log records whose value is one compact JSON object."""
    require_columns(events, contract.required)
    body = F.to_json(F.struct(*[ref(n) for n in contract.required]))
    return events.select(F.lit(topic).alias("topic"), body.cast("binary").alias("value"))

