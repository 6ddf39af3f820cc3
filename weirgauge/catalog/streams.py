"""The same operators on streams, and what only a stream has."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..contracts import RECORD_KEY, ContractError, FlowContract
from ..operators import alerts as alert_ops
from ..operators import clean, forest, ingest, windows
from ..session import scratch, stream_session, written
from ..sources import history, records, snapshots
from ..streaming import ledger, live, runner
from . import inputs as i
from .registry import query
from .stored import days

STATE_PARTITIONS = 8
EVENT_COLUMNS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def event_stream(spark, sf):
    """The events table as a stream, in a session with its own state size."""
    side = stream_session(spark, STATE_PARTITIONS)
    return records.file_stream(side, sf, EVENT_COLUMNS, glob="events.parquet")


def drained(spark, df):
    """Rows of an append stream, after everything available went through it."""
    path = scratch(spark, "sink")
    runner.drain_to_parquet(df, scratch(spark, "checkpoint"), path)
    return spark.read.parquet(path)


def last_versions(spark, path: str, key):
    """Newest emitted version of every key from the folders of ``batch_writer``."""
    return snapshots.latest_per_key(spark.read.parquet(path), key, "batch_id")


class Steps:
    """A source folder that is filled step by step, each step drained before the next.

    The watermark therefore stands at the end of one step when the next begins,
    which makes it certain what counts as late.
    """

    def __init__(self, spark, sf):
        self.spark, self.events = spark, i.table(spark, sf, "events")
        self.source, self.checkpoint = scratch(spark, "arriving"), scratch(spark, "checkpoint")
        self.sink, self.book = scratch(spark, "sink"), scratch(spark, "ledger")
        self.side = stream_session(spark, STATE_PARTITIONS)
        self.noted, self.last = ledger.watch(self.side, self.book), []

    def arrive(self, first: int, last: int):
        days(self.events, first, last, "ts").write.mode("append").parquet(self.source)
        arrived = records.file_stream(self.side, self.source, EVENT_COLUMNS)
        counted = windows.window_metrics(i.predictions(arrived), i.PLAN)
        write = runner.batch_writer(self.sink)
        query = runner.drain(counted, self.checkpoint, write, "update")
        self.noted.settle(query)
        self.last.append(query.lastProgress["batchId"])
        return self

    def dropped(self) -> list[int]:
        """Window groups that each step dropped as too late."""
        rows = ledger.entries(self.spark, self.book).select("batch", "dropped_groups").collect()
        edges = zip([-1, *self.last], self.last)
        return [sum(r.dropped_groups for r in rows if a < r.batch <= b) for a, b in edges]

    def metrics(self):
        return last_versions(self.spark, self.sink, ("window_start", "window_end"))


METRICS = i.METRICS_SQL
ALL_WINDOWS = f"WITH {METRICS} SELECT {i.METRIC_OUT_SQL} FROM metrics"


@query(
    "q_stream_envelope_scan",
    f"""WITH {i.RECORDS_SQL}
SELECT 'events' AS topic, part AS partition, count(*) AS records, min(event_id) AS first_offset,
  max(event_id) AS last_offset FROM records GROUP BY part""",
)
def _(spark, sf):
    decoded = ingest.decode(i.log_records(event_stream(spark, sf)))
    return (
        drained(spark, decoded)
        .groupBy("topic", "partition")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
        )
    )


@query(
    "q_stream_append_rows",
    f"""WITH {i.RECORDS_SQL}
SELECT part AS partition, event_id AS "offset", date_trunc('millisecond', ts) AS event_timestamp,
  value, k FROM valid""",
)
def _(spark, sf):
    good, _ = ingest.split_records(i.log_records(event_stream(spark, sf)), i.EVENTS)
    rows = drained(spark, good)
    return i.shown(rows.select("partition", "offset", "event_timestamp", "value", "k"))


@query(
    "q_stream_invalid",
    f"""WITH {i.RECORDS_SQL}
SELECT part AS partition, event_id AS "offset", reason AS invalid_reason FROM records
WHERE reason IS NOT NULL""",
)
def _(spark, sf):
    _, bad = ingest.split_records(i.log_records(event_stream(spark, sf)), i.EVENTS)
    return drained(spark, bad).select("partition", "offset", "invalid_reason")


@query(
    "q_stream_alerts",
    f"""WITH {i.PREDICTIONS_SQL}
SELECT part AS partition, event_id AS "offset", et AS event_timestamp, scenario
FROM preds WHERE prediction = 1.0""",
)
def _(spark, sf):
    raised = alert_ops.alerts(i.predictions(event_stream(spark, sf)))
    rows = drained(spark, raised)
    return i.shown(rows.select("partition", "offset", "event_timestamp", "scenario"))


@query("q_stream_update_final", ALL_WINDOWS)
def _(spark, sf):
    """Three steps in order: the last version of each window is the batch result."""
    return i.shown(Steps(spark, sf).arrive(1, 9).arrive(10, 19).arrive(20, 31).metrics())


@query(
    "q_stream_late_dropped",
    f"""WITH {i.PREDICTIONS_SQL}, kept AS (SELECT * FROM preds WHERE day(ts) NOT BETWEEN 10 AND 19),
{i.windows_sql("kept")}
SELECT {i.METRIC_OUT_SQL}, true AS drops_reported FROM metrics""",
)
def _(spark, sf):
    """Days 10 to 19 arrive after the watermark has passed them and change nothing."""
    steps = Steps(spark, sf).arrive(1, 9).arrive(20, 31).arrive(10, 19)
    late = steps.dropped()
    reported = late[:2] == [0, 0] and late[2] > 0
    return i.shown(steps.metrics()).withColumn("drops_reported", F.lit(reported))


@query(
    "q_stream_metrics",
    f"WITH {i.VALID_METRICS_SQL} SELECT {i.METRIC_OUT_SQL} FROM metrics",
)
def _(spark, sf):
    """Records, judgement, score, windows, status: one stream."""
    good, _ = ingest.split_records(i.log_records(event_stream(spark, sf)), i.EVENTS)
    counted = windows.window_metrics(i.rule_score(good), i.PLAN)
    path = scratch(spark, "sink")
    runner.drain(counted, scratch(spark, "checkpoint"), runner.batch_writer(path), "update")
    return i.shown(last_versions(spark, path, ("window_start", "window_end")))


@query(
    "q_stream_append_windows",
    f"""WITH {METRICS}
SELECT {i.METRIC_OUT_SQL} FROM metrics
WHERE window_end <= (SELECT max(et) FROM preds) - INTERVAL 1 HOUR""",
)
def _(spark, sf):
    """In append mode a window appears once, after the watermark has passed its end."""
    counted = windows.window_metrics(i.predictions(event_stream(spark, sf)), i.PLAN)
    return i.shown(drained(spark, counted))


def live_job(spark, root: str, checkpoint: str = "checkpoint", **extra) -> live.LiveJob:
    return live.LiveJob(
        events=i.EVENTS,
        scorer=i.rule_score,
        history_root=f"{root}/history",
        checkpoint=f"{root}/{checkpoint}",
        plan=i.PLAN,
        **extra,
    )


def run_live(job: live.LiveJob, stream) -> None:
    for started in job.start(stream, drain=True):
        started.awaitTermination()


@query(
    "q_foreach_batch_fanout",
    f"""WITH {i.VALID_METRICS_SQL}
SELECT (SELECT count(*) FROM valid) AS predictions,
  (SELECT count(*) FROM vpreds WHERE prediction = 1.0) AS alerts,
  (SELECT count(*) FROM metrics) AS metrics,
  (SELECT count(*) FROM records WHERE reason IS NOT NULL) AS quarantined,
  least(60, (SELECT count(*) FROM metrics)) AS published_windows,
  least(100, (SELECT count(*) FROM vpreds WHERE prediction = 1.0)) AS published_alerts""",
)
def _(spark, sf):
    """The whole live job: history, quarantine and snapshots from two streams."""
    root = scratch(spark, "live")
    job = live_job(spark, root, snapshot_root=f"{root}/snapshots")
    run_live(job, i.log_records(event_stream(spark, sf)))
    counts = {
        t.name: history.read_table(spark, job.history_root, t) for t in history.TABLES
    }
    counts["quarantined"] = spark.read.parquet(f"{job.history_root}/quarantine")
    counts["published_windows"] = snapshots.read(spark, f"{root}/snapshots/metrics")
    counts["published_alerts"] = snapshots.read(spark, f"{root}/snapshots/alerts")
    one = spark.range(1)
    return one.select(
        *[df.agg(F.count(F.lit(1)).alias("n")).scalar().alias(name) for name, df in counts.items()]
    )


@query(
    "q_stream_restart_idempotent",
    f"""WITH {i.VALID_METRICS_SQL}
SELECT {i.METRIC_OUT_SQL}, (SELECT count(*) FROM valid) AS stored_predictions,
  (SELECT count(*) FROM vpreds WHERE prediction = 1.0) AS stored_alerts FROM metrics""",
)
def _(spark, sf):
    """Stop and resume, then replay half of it without the checkpoint: history is unchanged."""
    root, source = scratch(spark, "live"), scratch(spark, "arriving")
    side = stream_session(spark, STATE_PARTITIONS)
    events = i.table(spark, sf, "events")

    def run(folder, **where):
        arrived = records.file_stream(side, folder, EVENT_COLUMNS)
        run_live(live_job(spark, root, **where), i.log_records(arrived))

    for first, last in ((1, 15), (16, 31)):
        days(events, first, last, "ts").write.mode("append").parquet(source)
        run(source)
    run(source)
    half = scratch(spark, "arriving")
    events.where(F.col("event_id") % 2 == 0).write.parquet(half)
    run(half, checkpoint="another")
    home = f"{root}/history"
    tables = {t.name: history.read_table(spark, home, t) for t in history.TABLES}

    def stored(name):
        return tables[name].agg(F.count(F.lit(1)).alias("n")).scalar()

    return i.shown(tables["metrics"]).withColumns(
        {"stored_predictions": stored("predictions"), "stored_alerts": stored("alerts")}
    )


@query(
    "q_batch_stream_parity",
    f"""WITH {i.FLOWS_SQL}
SELECT count(*) AS batch_rows, count(*) AS stream_rows, 0::BIGINT AS differing FROM ready""",
)
def _(spark, sf):
    """The clean step gives the same rows, copies included, from a table and from a stream."""
    path = scratch(spark, "flows")
    i.raw_flows(spark, sf).write.parquet(path)
    side = stream_session(spark, STATE_PARTITIONS)
    arriving = side.readStream.schema(i.LINES.raw_schema).parquet(path)
    stream = drained(spark, clean.clean(arriving, i.LINES, labelled=True, vector=False))
    batch = clean.clean(spark.read.parquet(path), i.LINES, labelled=True, vector=False)
    tagged = batch.withColumn("side", F.lit(1)).unionByName(stream.withColumn("side", F.lit(-1)))
    columns = [f"`{c}`" for c in batch.columns]
    folded = tagged.groupBy(*[F.col(c) for c in columns]).agg(
        F.count_if(F.col("side") == 1).alias("b"), F.count_if(F.col("side") == -1).alias("s")
    )
    return folded.agg(
        F.sum("b").alias("batch_rows"),
        F.sum("s").alias("stream_rows"),
        F.count_if(F.col("b") != F.col("s")).alias("differing"),
    )


@query(
    "q_stream_scored",
    f"""WITH {i.RECORDS_SQL}
SELECT count(*) AS stream_rows, count(*) AS batch_rows, 0::BIGINT AS differing FROM valid""",
)
def _(spark, sf):
    """A forest scores a stream exactly as it scores the same rows in batch."""
    contract = FlowContract(numeric=("value", "k"), features=("value", "k"), attacks=("DDOS-ERROR",))
    batch_records = i.log_records(i.table(spark, sf, "events"))
    good = written(ingest.split_records(batch_records, i.EVENTS)[0], "valid")
    labelled = good.withColumnRenamed("source_label", "Label")
    train = clean.clean(labelled, contract, labelled=True)
    scorer = live.forest_scorer(forest.fit_forest(train, contract), contract)
    key = ("topic", "partition", "offset")

    def verdicts(valid, side):
        return live.predictions(valid, scorer).select(
            *key,
            F.struct("prediction", "prediction_label", "probability").alias(side),
        )

    arriving, _ = ingest.split_records(i.log_records(event_stream(spark, sf)), i.EVENTS)
    streamed = drained(spark, verdicts(arriving, "streamed"))
    both = streamed.join(verdicts(good, "batched"), list(key), "full_outer")
    return both.agg(
        F.count("streamed").alias("stream_rows"),
        F.count("batched").alias("batch_rows"),
        F.count_if(~F.col("streamed").eqNullSafe(F.col("batched"))).alias("differing"),
    )


@query(
    "q_live_forest",
    f"""WITH {i.RECORDS_SQL}
SELECT count(*) AS stored_rows, count(*) AS batch_rows, 0::BIGINT AS differing, true AS other_refused
FROM valid""",
)
def _(spark, sf):
    """A stored forest is loaded, checked against its contract, and scores the live job's stream."""
    contract = FlowContract(numeric=("value", "k"), features=("value", "k"), attacks=("DDOS-ERROR",))
    other = FlowContract(numeric=("value",), features=("value",), attacks=("DDOS-ERROR",))
    root = scratch(spark, "live")
    good = written(ingest.split_records(i.log_records(i.table(spark, sf, "events")), i.EVENTS)[0], "valid")
    train = clean.clean(good.withColumnRenamed("source_label", "Label"), contract, labelled=True)
    forest.fit_forest(train, contract).write().save(f"{root}/forest")
    try:
        forest.load_forest(f"{root}/forest", other)
        refused = False
    except ContractError:
        refused = True
    scorer = live.forest_scorer(forest.load_forest(f"{root}/forest", contract), contract)
    job = dataclasses.replace(live_job(spark, root), scorer=scorer)
    run_live(job, i.log_records(event_stream(spark, sf)))

    def verdicts(rows, side):
        chance = F.col("probability") if side == "stored" else F.to_json("probability")
        packed = F.struct("prediction", "prediction_label", chance.alias("probability"))
        return rows.select(*RECORD_KEY, packed.alias(side))

    stored = verdicts(history.read_table(spark, job.history_root, history.PREDICTIONS), "stored")
    batch = verdicts(live.predictions(good, scorer), "batch")
    both = stored.join(batch, list(RECORD_KEY), "full_outer")
    return both.agg(
        F.count("stored").alias("stored_rows"),
        F.count("batch").alias("batch_rows"),
        F.count_if(~F.col("stored").eqNullSafe(F.col("batch"))).alias("differing"),
    ).withColumn("other_refused", F.lit(refused))
