"""The live job: judge, score, count, alert, store and publish.

A stateless stream judges and scores each record once and writes predictions,
alerts and quarantine from the same cached micro-batch.  What a window needs of
a scored record goes to a log of its own, batch by batch, and a second, stateful
stream counts windows from there; it neither parses nor scores.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ALERT_SCHEMA, METRIC_SCHEMA, EventContract, FlowContract
from ..operators import alerts as alert_ops
from ..operators import clean, forest, ingest, windows
from ..session import make_folder, put_once
from ..sources import history, records, snapshots
from .runner import start

SCORED = "event_timestamp timestamp, prediction double"

Scorer = Callable[[DataFrame], DataFrame]


def forest_scorer(model, contract: FlowContract) -> Scorer:
    """Scorer that applies the shared clean step and a frozen forest."""

    def apply(valid: DataFrame) -> DataFrame:
        prepared = clean.clean(valid, contract, labelled=False)
        return alert_ops.name_predictions(forest.score(prepared, model))

    return apply


def predictions(valid: DataFrame, scorer: Scorer) -> DataFrame:
    return scorer(valid).select(*alert_ops.PREDICTION_COLUMNS)


@dataclass(frozen=True)
class LiveJob:
    """Everything one run needs; the checkpoint says which run it is."""

    events: EventContract
    scorer: Scorer
    history_root: str
    checkpoint: str
    snapshot_root: str | None = None
    plan: windows.WindowPlan = windows.LIVE

    def write_records(self, batch: DataFrame, batch_id: int) -> None:
        """Judge and score once, then write three outputs from the cached batch."""
        run = history.run_of(batch.sparkSession, self.checkpoint)
        # The parsed map served the verdict and is not kept in the cache.
        judged = ingest.judge(batch, self.events).drop("__given").persist()
        try:
            scored = predictions(ingest.accepted(judged, self.events), self.scorer).persist()
            try:
                commit = {"run": run, "batch_id": batch_id}
                put_once(scored.select("event_timestamp", "prediction"), self.scored(run), f"batch={batch_id}")
                alert_rows = alert_ops.alerts(scored)
                history.insert_absent(scored, self.history_root, history.PREDICTIONS, **commit)
                history.insert_absent(alert_rows, self.history_root, history.ALERTS, **commit)
                rejected = ingest.quarantined(judged)
                rejected.write.mode("overwrite").parquet(
                    f"{self.history_root}/quarantine/run={run}/batch={batch_id}"
                )
                if self.snapshot_root:
                    publish_alerts(alert_rows, f"{self.snapshot_root}/alerts")
            finally:
                scored.unpersist()
        finally:
            judged.unpersist()

    def scored(self, run: str) -> str:
        """The log of scored records that the metric stream of a run reads."""
        return f"{self.history_root}/scored/run={run}"

    def write_metrics(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            run = history.run_of(batch.sparkSession, self.checkpoint)
            history.append_versions(batch, self.history_root, run=run, batch_id=batch_id)
            if self.snapshot_root:
                publish_windows(batch, f"{self.snapshot_root}/metrics")
        finally:
            batch.unpersist()

    def start(self, source: DataFrame, drain: bool = False):
        """Start both streams over a stream of log records.

        With ``drain`` the first has ended when the second starts, so that the
        second finds all there is.
        """
        spark = source.sparkSession
        history.initialize(spark, self.history_root)
        scored = self.scored(history.run_of(spark, self.checkpoint))
        make_folder(spark, scored)
        if self.snapshot_root:
            for feed in ("metrics", "alerts"):
                snapshots.reset(spark, f"{self.snapshot_root}/{feed}")
        judging = start(source, f"{self.checkpoint}/records", self.write_records, drain=drain)
        if drain:
            judging.awaitTermination()
        arriving = records.file_stream(spark, scored, SCORED, glob="*.parquet")
        metrics = windows.window_metrics(arriving, self.plan)
        counting = start(metrics, f"{self.checkpoint}/metrics", self.write_metrics, mode="update", drain=drain)
        return judging, counting


def _merged(batch: DataFrame, root: str, fields: str) -> DataFrame:
    """Published records as typed rows, followed by the rows of the batch."""
    spark = batch.sparkSession
    columns = [tuple(f.split()) for f in fields.split(", ")]
    before = snapshots.read(spark, root).select(
        *[F.col("record")[n].try_cast(t).alias(n) for n, t in columns], F.lit(0).alias("__seq")
    )
    now = batch.select(*[F.col(n).cast(t) for n, t in columns], F.lit(1).alias("__seq"))
    return before.unionByName(now)


def publish_windows(batch: DataFrame, root: str) -> str:
    """Merge a batch of windows into the published list and keep the newest."""
    return snapshots.publish(
        snapshots.newest_windows(_merged(batch, root, METRIC_SCHEMA), "__seq"), root
    )


def publish_alerts(batch: DataFrame, root: str) -> str:
    if "probability" in batch.columns and dict(batch.dtypes)["probability"] != "string":
        batch = batch.withColumn("probability", F.to_json("probability"))
    return snapshots.publish(
        snapshots.newest_alerts(_merged(batch, root, ALERT_SCHEMA), "__seq"), root
    )
