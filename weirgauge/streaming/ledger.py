"""What every micro-batch did, kept for as long as the run's folder is.

A running query remembers only its last progress reports.  ``Ledger`` listens to
all of them and writes one small file per micro-batch, named by query and batch,
so that a batch that is repeated after a failure replaces its own entry.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.windows import COUNTS, WindowPlan
from ..session import write_text

SCHEMA = (
    "query string, name string, batch bigint, input_rows bigint, state_rows bigint, "
    "dropped_groups bigint, watermark string, observed map<string, string>"
)
ARRIVED = "arrived"
WINDOW_KEY = ("window_start", "window_end")


class Ledger(StreamingQueryListener):
    """Writes the progress of every query of a session; add with ``watch``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        made = event.progress
        if not made.numInputRows and not made.durationMs.get("addBatch"):
            return  # nothing ran
        entry = {
            "query": str(made.id),
            "name": made.name,
            "batch": made.batchId,
            "input_rows": made.numInputRows,
            "state_rows": sum(s.numRowsTotal for s in made.stateOperators),
            "dropped_groups": sum(s.numRowsDroppedByWatermark for s in made.stateOperators),
            "watermark": made.eventTime.get("watermark"),
            "observed": {
                f"{name}.{field}": None if value is None else str(value)
                for name, row in made.observedMetrics.items()
                for field, value in row.asDict().items()
            },
        }
        write_text(self.spark, f"{self.path}/query={made.id}/batch={made.batchId}.json", json.dumps(entry))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def settle(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until the reports of an ended query have all been written."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of query {query.runId} was not reported")


def watch(spark: SparkSession, path: str) -> Ledger:
    """Keep the progress of all queries that this session starts from now on."""
    ledger = Ledger(spark, path)
    spark.streams.addListener(ledger)
    return ledger


def entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch of every query that was watched."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).json(path)


def with_arrivals(rows: DataFrame, plan: WindowPlan, time: str) -> DataFrame:
    """Observe, before any is dropped, how many places in windows the rows of a batch ask for.

    A row asks for one place in every window that its time lies in.
    """
    slots = F.size(F.sequence(F.lit(0), F.lit(plan.length - 1), F.lit(plan.slide)))
    asked = F.sum(F.when(F.col(time).isNotNull(), slots).otherwise(0))
    if plan.length % plan.slide:
        raise ValueError("arrivals are counted for windows that are a multiple of the slide long")
    return rows.observe(ARRIVED, F.coalesce(asked, F.lit(0)).alias("places"), F.count(F.lit(1)).alias("rows"))


def late_places(ledger: DataFrame, versions: DataFrame) -> DataFrame:
    """Per micro-batch: places asked for, and how many were refused as too late.

    ``versions`` holds every version of every window that the stream emitted in
    update mode, with its ``batch_id``.  What a batch added to its windows is
    the difference to the version before; what it asked for beyond was dropped.
    The count is exact, unlike the state operator's own, which counts groups.
    """
    total = F.col(COUNTS[0])
    before = Window.partitionBy(*WINDOW_KEY).orderBy("batch_id")
    added = versions.select("batch_id", (total - F.coalesce(F.lag(total).over(before), F.lit(0))).alias("added"))
    kept = added.groupBy(F.col("batch_id").cast("bigint").alias("batch")).agg(F.sum("added").alias("kept"))
    asked = ledger.select(
        "batch", F.col("observed")[f"{ARRIVED}.places"].cast("bigint").alias("asked"), "dropped_groups"
    ).where("asked > 0")
    return asked.join(kept, "batch", "left").select(
        "batch", "asked", (F.col("asked") - F.coalesce("kept", F.lit(0))).alias("late"), "dropped_groups"
    )
