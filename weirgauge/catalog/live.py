"""Streams that run long: late rows, state, reconciliation, closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import PREDICTION_SCHEMA
from ..operators import ingest, windows
from ..session import scratch, set_times, stream_session
from ..sources import history, records
from ..streaming import chained, ledger, runner
from . import inputs as i
from .registry import query
from .streams import EVENT_COLUMNS, STATE_PARTITIONS, drained, event_stream

METRICS, PREDS = i.METRICS_SQL, i.PREDICTIONS_SQL
LAST_SLOT = 105
SLOT_SQL = f"""slots AS (
  SELECT *, least({LAST_SLOT}, epoch(ts - TIMESTAMP '2024-01-01')::BIGINT // 25200
    + CASE event_id % 40 WHEN 7 THEN 3 WHEN 27 THEN 9 ELSE 0 END) AS slot FROM preds
)"""


def in_slots(events):
    """Events dealt to steps of seven hours in order of time; one in twenty comes three or nine steps late."""
    m = F.col("event_id") % 40
    behind = F.when(m == 7, 3).when(m == 27, 9).otherwise(0)
    since = F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01 00:00:00"))
    return events.withColumn("slot", F.least(F.lit(LAST_SLOT), (F.floor(since / 25200) + behind).cast("int")))


@query(
    "q_stream_late_exact",
    f"""WITH {PREDS}, {SLOT_SQL}, batches AS (
  SELECT slot, row_number() OVER (ORDER BY slot) - 1 AS batch, 2 * count(*) AS asked, max(et) AS top
  FROM slots GROUP BY slot
), marks AS (
  SELECT *, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
    - INTERVAL 1 HOUR AS mark FROM batches
), places AS (
  SELECT slot, unnest([time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 1 HOUR,
    time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE]) AS window_end FROM slots
)
SELECT batch, any_value(asked)::BIGINT AS asked, count(*) FILTER (window_end <= mark) AS late, true AS reported
FROM places JOIN marks USING (slot) GROUP BY batch""",
)
def _(spark, sf):
    """More than a hundred micro-batches, late rows in most: what each of them dropped, exactly."""
    source, sink, book = (scratch(spark, p) for p in ("arriving", "sink", "ledger"))
    dealt = in_slots(i.table(spark, sf, "events"))
    dealt.repartition("slot").write.partitionBy("slot").parquet(source)
    set_times(spark, source)
    side = stream_session(spark, 2)
    noted = ledger.watch(side, book)
    arrived = records.file_stream(side, source, f"{EVENT_COLUMNS}, slot int", files_per_batch=1)
    rows = ledger.with_arrivals(i.predictions(arrived), i.PLAN, "event_timestamp")
    counted = windows.window_metrics(rows, i.PLAN)
    noted.settle(runner.drain(counted, scratch(spark, "checkpoint"), runner.batch_writer(sink), "update"))
    late = ledger.late_places(ledger.entries(spark, book), spark.read.parquet(sink))
    reported = (F.col("dropped_groups") > 0) == (F.col("late") > 0)
    return late.select("batch", "asked", "late", reported.alias("reported"))


@query(
    "q_stream_open_state",
    f"""WITH {METRICS}
SELECT window_start, window_end, event_count, normal_count, attack_count FROM metrics
WHERE window_end > (SELECT max(et) FROM preds) - INTERVAL 1 HOUR""",
)
def _(spark, sf):
    """State on disk, read after the stream has ended: exactly the windows above the watermark."""
    side, checkpoint = stream_session(spark, STATE_PARTITIONS, on_disk=True), scratch(spark, "checkpoint")
    arriving = records.file_stream(side, sf, EVENT_COLUMNS, glob="events.parquet")
    counted = windows.window_metrics(i.predictions(arriving), i.PLAN)
    runner.drain(counted, checkpoint, runner.batch_writer(scratch(spark, "sink")), "update")
    return i.shown(chained.open_windows(side, checkpoint))


@query(
    "q_stream_reconciliation",
    f"""WITH {i.RECORDS_SQL}
SELECT CASE WHEN reason IS NOT NULL THEN 'missing' WHEN event_id % 997 = 11 THEN 'unexpected' ELSE 'matched' END
  AS verdict, count(*) AS records
FROM records WHERE reason IS NULL OR event_id % 997 <> 11 GROUP BY 1""",
)
def _(spark, sf):
    """Source records and stored predictions as two streams; a heartbeat on both closes the books.

    Invalid records are never stored, and some stored ones are taken from the source.
    """
    root, source = scratch(spark, "history"), scratch(spark, "arriving")
    everything = i.log_records(i.table(spark, sf, "events"))
    good, _ = ingest.split_records(everything, i.EVENTS)
    beat = F.max("timestamp") + F.expr("INTERVAL 3 HOURS")
    beats = everything.agg(beat.alias("timestamp")).select(
        F.lit("heartbeat").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"), "timestamp"
    )
    everything.drop("value").where(F.col("offset") % 997 != 11).unionByName(beats).write.parquet(source)
    history.initialize(spark, root)
    scored = i.rule_score(good).unionByName(
        beats.withColumnRenamed("timestamp", "kafka_timestamp"), allowMissingColumns=True
    )
    history.insert_absent(scored, root, history.PREDICTIONS, run="first", batch_id=0)
    side = stream_session(spark, STATE_PARTITIONS)
    arriving = records.file_stream(side, source, "topic string, partition int, offset bigint, timestamp timestamp")
    stored = records.file_stream(side, f"{root}/predictions", f"{PREDICTION_SCHEMA}, {history.STORED}")
    verdicts = drained(spark, chained.live_verdicts(arriving, stored, 3600)).where("topic <> 'heartbeat'")
    return verdicts.groupBy("verdict").agg(F.count(F.lit(1)).alias("records"))


HOURLY = windows.WindowPlan(length=600, slide=300, lateness=600)


@query(
    "q_stream_hourly",
    f"""WITH {PREDS}, starts AS (
  SELECT unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS s,
    prediction FROM preds
), w AS (
  SELECT s + INTERVAL 10 MINUTE - INTERVAL 1 MICROSECOND AS last, count(*) / 600.0::DOUBLE AS rate,
    100.0 * count(*) FILTER (prediction = 1.0) / count(*) AS share FROM starts GROUP BY s
)
SELECT time_bucket(INTERVAL 1 HOUR, last) AS period_start, time_bucket(INTERVAL 1 HOUR, last) + INTERVAL 1 HOUR AS period_end,
  count(*) AS windows, round(avg(rate), 6) AS mean_event_rate, round(max(rate), 6) AS peak_event_rate,
  round(avg(share), 6) AS mean_attack_percent
FROM w WHERE time_bucket(INTERVAL 1 HOUR, last) + INTERVAL 1 HOUR <= (SELECT max(et) FROM preds) - INTERVAL 10 MINUTE
GROUP BY 1, 2""",
)
def _(spark, sf):
    """Windows, closed, and then hours of closed windows, in one stream."""
    hours = chained.closed_stats(i.predictions(event_stream(spark, sf)), HOURLY, "1 hour")
    return i.shown(drained(spark, hours))


@query(
    "q_stream_status_changes",
    f"""WITH {METRICS}, closed AS (
  SELECT window_end, status FROM metrics WHERE window_end <= (SELECT max(et) FROM preds) - INTERVAL 1 HOUR
), chained AS (
  SELECT *, lag(status) OVER (ORDER BY window_end) AS before, row_number() OVER (ORDER BY window_end) AS n FROM closed
), changes AS (SELECT * FROM chained WHERE before IS DISTINCT FROM status)
SELECT window_end, before, status, coalesce(n - lag(n) OVER (ORDER BY window_end), 0) AS windows_before FROM changes""",
)
def _(spark, sf):
    """One row when the status of closed windows changes, from state kept between micro-batches."""
    source = scratch(spark, "arriving")
    events = i.table(spark, sf, "events")
    events.withColumn("slot", F.floor(F.dayofmonth("ts") / 8)).repartition("slot").write.partitionBy("slot").parquet(source)
    set_times(spark, source)
    side = stream_session(spark, 2, on_disk=True)
    arriving = records.file_stream(side, source, f"{EVENT_COLUMNS}, slot bigint", files_per_batch=1)
    return i.shown(drained(spark, chained.status_changes(i.predictions(arriving), i.PLAN)))
