"""Deterministic replay sets: which rows are sent, in which order, and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import FlowContract
from ..functions.cells import all_finite, as_number, ref, settle
from ..functions.labels import label_is_known, tidy_label
from ..session import written
from .ordering import BUCKET, positions, range_buckets

CHUNK = 1024


def replay_class(contract: FlowContract, burst_prefix: str = "DDOS-") -> Column:
    """normal, burst, or NULL for known labels that no scenario replays."""
    tidy = tidy_label(ref(contract.label))
    return F.when(tidy == contract.normal, "normal").when(tidy.startswith(burst_prefix), "burst")


def replay_verdict(contract: FlowContract, burst_prefix: str = "DDOS-") -> Column:
    """What happens to a row: normal, burst, other_class, bad_label or bad_number."""
    kind = replay_class(contract, burst_prefix)
    return (
        F.when(~label_is_known(contract), "bad_label")
        .when(kind.isNull(), "other_class")
        .when(~all_finite(contract.features), "bad_number")
        .otherwise(kind)
    )


def replay_rows(df: DataFrame, contract: FlowContract, keep=()) -> DataFrame:
    """Rows that can be replayed, with numbers, tidy label and ground truth."""
    return (
        settle(df, "replay_class", replay_verdict(contract))
        .where(F.col("replay_class").isin("normal", "burst"))
        .select(
            *[ref(k) for k in keep],
            "replay_class",
            F.when(F.col("replay_class") == "normal", "Normal")
            .otherwise("Attack")
            .alias("ground_truth"),
            tidy_label(ref(contract.label)).alias("source_label"),
            *[as_number(ref(n)).alias(n) for n in contract.features],
        )
    )


def replay_stats(df: DataFrame, contract: FlowContract) -> DataFrame:
    """Sendable and skipped rows of one pass over the data for each class.

    Bad labels are met in either pass; a bad number is met only in the pass of
    the class the row belongs to.
    """
    kind = replay_class(contract)
    judged = df.select(replay_verdict(contract).alias("v"), kind.alias("k"))
    seen = F.col("v")
    counts = judged.agg(
        F.count_if(seen == "normal").alias("n_ok"),
        F.count_if(seen == "burst").alias("b_ok"),
        F.count_if(seen == "bad_label").alias("bad_label"),
        F.count_if((seen == "bad_number") & (F.col("k") == "normal")).alias("n_bad"),
        F.count_if((seen == "bad_number") & (F.col("k") == "burst")).alias("b_bad"),
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("replay_class"),
                        F.col(f"{p}_ok").alias("sendable"),
                        (F.col("bad_label") + F.col(f"{p}_bad")).alias("skipped_invalid"),
                    )
                    for name, p in (("normal", "n"), ("burst", "b"))
                ]
            )
        )
    )


def numbered(rows: DataFrame, key: str, by: str = "replay_class") -> DataFrame:
    """Rows with their position inside their class, in key order, as a stored table.

    Every segment of a replay reads the table; the numbering runs once.
    """
    placed = positions(range_buckets(rows, key), key, "position", by=(by,))
    return written(placed.drop(BUCKET), "numbered")


def _repeat(rows: DataFrame, turns: Column, size: Column, out: str) -> DataFrame:
    """Emit a row at position, position + size, ... below ``turns``.

    A class much shorter than the replay repeats its rows very often, so the
    repetitions are cut into chunks, and the chunks are dealt out by position
    and number before they unfold: even a single row unfolds in many tasks.
    """
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = F.floor((turns - 1 - F.col("position")) / size) + 1
    chunked = (
        rows.withColumn("__size", size)
        .withColumn("__rounds", rounds)
        .where(F.col("__rounds") > 0)
        .withColumn(
            "__chunk",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__rounds") - 1) / CHUNK))),
        )
        # A given number of partitions is kept; few chunks would be gathered into one otherwise.
        .repartition(spread, "replay_class", "position", "__chunk")
    )
    first = F.col("__chunk") * CHUNK
    last = F.least(first + CHUNK, F.col("__rounds")) - 1
    return (
        chunked.withColumn("__round", F.explode(F.sequence(first, last)))
        .withColumn(out, F.col("position") + F.col("__round") * F.col("__size"))
        .drop("__size", "__rounds", "__chunk", "__round")
    )


def class_sizes(rows: DataFrame) -> dict[str, int]:
    """Rows per class on the driver: two numbers."""
    sizes = rows.groupBy("replay_class").agg(F.count(F.lit(1)).alias("n"))
    return {r.replay_class: r.n for r in sizes.collect()}


def scenario_order(
    numbered_rows: DataFrame, scenario: str, events: int, sizes: dict[str, int]
) -> DataFrame:
    """The first ``events`` rows of a scenario, each with its ``slot``.

    NORMAL and DDOS_BURST cycle through one class.  MIXED alternates: even
    slots take normal rows, odd slots burst rows, each class starting over when
    it is used up.  A slot follows from a row's position alone, so nothing is
    joined and nothing passes through one task.
    """
    plan = {
        "NORMAL": (("normal", 1, 0),),
        "DDOS_BURST": (("burst", 1, 0),),
        "MIXED": (("normal", 2, 0), ("burst", 2, 1)),
    }[scenario]
    absent = [name for name, _, _ in plan if not sizes.get(name)]
    if absent:
        raise ValueError(f"{scenario}: no row of class {', '.join(absent)}")
    turn, size, slot = F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), F.lit(None)
    kind = F.col("replay_class")
    for name, stride, shift in plan:
        here = kind == name
        turn = F.when(here, F.lit((events - shift + stride - 1) // stride)).otherwise(turn)
        size = F.when(here, F.lit(sizes[name])).otherwise(size)
        slot = F.when(here, F.col("__turn") * stride + shift).otherwise(slot)
    used = numbered_rows.where(kind.isin([name for name, _, _ in plan]))
    return (
        _repeat(used, turn.cast("bigint"), size.cast("bigint"), "__turn")
        .withColumn("slot", slot.cast("bigint"))
        .withColumn("scenario", F.lit(scenario))
        .drop("__turn")
    )


def schedule(ordered: DataFrame, start_micros: int, per_second: float, slot: str = "slot"):
    """Event ``i`` is due at start + i / rate."""
    due = F.lit(start_micros) + F.floor(F.col(slot) * F.lit(1_000_000.0 / per_second))
    return ordered.withColumn("due", F.timestamp_micros(due.cast("bigint")))


def sequence(numbered_rows: DataFrame, segments, start_micros: int, sizes: dict[str, int]):
    """Scenario segments laid one after another on a single timeline.

    ``segments``: (scenario, events per second, events, pause seconds).  The
    list is the replay script, a handful of entries; each starts when the one
    before has ended and its pause is over.
    """
    parts, start = [], start_micros
    for number, (scenario, rate, events, pause) in enumerate(segments):
        part = scenario_order(numbered_rows, scenario, events, sizes)
        parts.append(schedule(part, start, rate).withColumn("segment", F.lit(number)))
        start += int(events / rate * 1_000_000) + int(pause * 1_000_000)
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined
