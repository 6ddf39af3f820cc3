"""Keyed history, snapshots, reconciliation, files and replay sets."""

from __future__ import annotations

import datetime
from functools import lru_cache

from pyspark.sql import functions as F

from ..contracts import ContractError, FlowContract
from ..functions.labels import label_is_known
from ..operators import alerts as alert_ops
from ..operators import ingest, replay, windows
from ..operators.ordering import first_per_group
from ..session import scratch
from ..sources import files, history, snapshots
from . import inputs as i
from .registry import query

PREDS, METRICS = i.PREDICTIONS_SQL, i.METRICS_SQL


def predictions(spark, sf):
    return i.predictions(i.table(spark, sf, "events"))


def days(df, first: int, last: int, column: str = "event_timestamp"):
    return df.where(F.dayofmonth(column).between(first, last))


def flipped(df):
    """The same records with the opposite verdict, to see whose write survived."""
    other = df.withColumn("prediction", 1.0 - F.col("prediction"))
    return alert_ops.name_predictions(other)


def moved(df, last: int):
    """Rows up to a day of the month carry the time of another day."""
    at = F.col("event_timestamp")
    return df.withColumn(
        "event_timestamp",
        F.when(F.dayofmonth(at) <= last, at + F.expr("INTERVAL 40 DAY")).otherwise(at),
    )


@query(
    "q_history_insert_ignore",
    f"""WITH {PREDS}
SELECT 'events' AS topic, part AS partition, event_id AS "offset", et AS event_timestamp,
  CASE WHEN day(ts) BETWEEN 16 AND 25 THEN 1 - prediction ELSE prediction END AS prediction
FROM preds""",
)
def _(spark, sf):
    """Overlapping batches, one repeated, one with known keys on other days: the first write wins.

    Old days are compacted before the last batch.
    """
    root, rows = scratch(spark, "history"), predictions(spark, sf)
    history.initialize(spark, root)
    for batch_id, batch in (
        (0, days(rows, 1, 15)),
        (1, moved(flipped(days(rows, 10, 25)), 15)),
        (0, days(rows, 1, 15)),
        (2, days(rows, 20, 31)),
    ):
        if batch_id == 2:
            history.compact(spark, root, history.PREDICTIONS, datetime.date(2024, 1, 20))
        history.insert_absent(batch, root, history.PREDICTIONS, run="first", batch_id=batch_id)
    stored = history.read_table(spark, root, history.PREDICTIONS)
    return i.shown(
        stored.select("topic", "partition", "offset", "event_timestamp", "prediction")
    )


@query(
    "q_history_upsert_windows",
    f"WITH {METRICS} SELECT {i.METRIC_OUT_SQL} FROM metrics",
)
def _(spark, sf):
    """Partial windows, full ones, then the partial ones again, also as another run: the fullest count."""
    root, rows = scratch(spark, "history"), predictions(spark, sf)
    history.initialize(spark, root)
    partial = windows.window_metrics(days(rows, 1, 15), i.PLAN)
    full = windows.window_metrics(rows, i.PLAN)
    commits = (("first", 0, partial), ("first", 1, full), ("first", 0, partial), ("second", 0, partial))
    for run, batch_id, batch in commits:
        history.append_versions(batch, root, run=run, batch_id=batch_id)
    history.compact(spark, root, history.METRICS, datetime.date(2024, 1, 12))
    return i.shown(history.read_table(spark, root, history.METRICS))


@query(
    "q_history_init_idempotent",
    f"""WITH {PREDS}
SELECT 'predictions' AS table_name, count(*) AS rows FROM preds
UNION ALL SELECT 'metrics', 0 UNION ALL SELECT 'alerts', 0""",
)
def _(spark, sf):
    """Initializing again neither fails nor clears what is stored."""
    root = scratch(spark, "history")
    history.initialize(spark, root)
    history.insert_absent(
        predictions(spark, sf), root, history.PREDICTIONS, run="first", batch_id=0
    )
    history.initialize(spark, root)
    return history.table_counts(spark, root)


@lru_cache(maxsize=None)
def _history(app_id: str, spark, sf: str) -> str:
    root = scratch(spark, "history")
    history.initialize(spark, root)
    return root


@lru_cache(maxsize=None)
def _filled(app_id: str, spark, sf: str, table: history.HistoryTable) -> None:
    root, rows = _history(app_id, spark, sf), predictions(spark, sf)
    if table is history.METRICS:
        history.append_versions(windows.window_metrics(rows, i.PLAN), root, run="first", batch_id=0)
    else:
        chosen = alert_ops.alerts(rows) if table is history.ALERTS else rows
        history.insert_absent(chosen, root, table, run="first", batch_id=0)


def full_history(spark, sf, *tables: history.HistoryTable) -> str:
    """A history of all events, with the tables that are asked for; each written once per session."""
    for table in tables:
        _filled(spark.sparkContext.applicationId, spark, sf, table)
    return _history(spark.sparkContext.applicationId, spark, sf)


@query(
    "q_history_counts",
    f"""WITH {METRICS}
SELECT 'predictions' AS table_name, (SELECT count(*) FROM preds) AS rows
UNION ALL SELECT 'metrics', (SELECT count(*) FROM metrics)
UNION ALL SELECT 'alerts', (SELECT count(*) FROM preds WHERE prediction = 1.0)""",
)
def _(spark, sf):
    return history.table_counts(spark, full_history(spark, sf, *history.TABLES))


ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


@query(
    "q_history_recent_metrics",
    f"""WITH {METRICS}
SELECT {ISO.format("window_end")} AS window_end, status, round(event_rate, 6) AS event_rate,
  round(attack_rate, 6) AS attack_rate, event_count, attack_count
FROM metrics ORDER BY metrics.window_end DESC LIMIT 10""",
)
def _(spark, sf):
    return i.shown(history.recent(spark, full_history(spark, sf, history.METRICS), history.METRICS, 10))


RECENT_RECORD = f"""SELECT {ISO.format("et")} AS event_timestamp, 'events' AS topic,
  part AS partition, event_id AS "offset", prediction_label, scenario, source_label FROM preds
{{}} ORDER BY et DESC, part DESC, event_id DESC LIMIT 10"""


@query("q_history_recent_predictions", f"WITH {PREDS} {RECENT_RECORD.format('')}")
def _(spark, sf):
    return history.recent(spark, full_history(spark, sf, history.PREDICTIONS), history.PREDICTIONS, 10)


@query(
    "q_history_recent_alerts",
    f"WITH {PREDS} {RECENT_RECORD.format('WHERE prediction = 1.0')}",
)
def _(spark, sf):
    return history.recent(spark, full_history(spark, sf, history.ALERTS), history.ALERTS, 10)


@query(
    "q_offset_reconciliation",
    f"""WITH {i.RECORDS_SQL}
SELECT CASE WHEN reason IS NULL THEN 'matched' ELSE 'missing' END AS verdict,
  count(*) AS records FROM records GROUP BY 1""",
)
def _(spark, sf):
    """Stored predictions against source records: exactly the invalid ones are missing."""
    records = i.log_records(i.table(spark, sf, "events"))
    good, _ = ingest.split_records(records, i.EVENTS)
    stored = i.rule_score(good)
    return history.reconcile(records, stored, alert_ops.alerts(stored))


@query(
    "q_offset_gaps",
    f"""WITH {i.RECORDS_SQL}
SELECT 'events' AS topic, part AS partition, count(*) AS offsets,
  max(event_id) - min(event_id) + 1 - count(*) AS gaps, 0::BIGINT AS repeats
FROM valid GROUP BY part""",
)
def _(spark, sf):
    good, _ = ingest.split_records(i.log_records(i.table(spark, sf, "events")), i.EVENTS)
    return history.offset_gaps(good)


# --- snapshots --------------------------------------------------------------


@query(
    "q_snapshot_metrics_topn",
    f"WITH {METRICS} SELECT {i.METRIC_OUT_SQL} FROM metrics ORDER BY window_end DESC LIMIT 60",
)
def _(spark, sf):
    """Two batches of windows, the second replacing the first; the newest 60 remain."""
    rows = predictions(spark, sf)
    early = windows.window_metrics(days(rows, 1, 25), i.PLAN).withColumn("seq", F.lit(0))
    late = windows.window_metrics(rows, i.PLAN).withColumn("seq", F.lit(1))
    return i.shown(snapshots.newest_windows(early.unionByName(late), "seq"))


@query(
    "q_snapshot_alerts_topn",
    f"""WITH {PREDS}
SELECT et AS event_timestamp, 'events' AS topic, part AS partition, event_id AS "offset",
  'second' AS written FROM preds WHERE prediction = 1.0
ORDER BY et DESC, part DESC, event_id DESC LIMIT 100""",
)
def _(spark, sf):
    """Every alert arrives twice; of each the second version is kept."""
    raised = alert_ops.alerts(predictions(spark, sf))
    twice = raised.withColumns({"seq": F.lit(0), "written": F.lit("first")}).unionByName(
        raised.withColumns({"seq": F.lit(1), "written": F.lit("second")})
    )
    kept = snapshots.newest_alerts(twice, "seq")
    return i.shown(kept.select("event_timestamp", "topic", "partition", "offset", "written"))


@query(
    "q_snapshot_publish",
    f"""WITH {METRICS}, newest AS (SELECT * FROM metrics ORDER BY window_end DESC LIMIT 60)
SELECT {ISO.format("window_end")} AS window_end, event_count, status FROM newest""",
)
def _(spark, sf):
    """Reset, publish a part, publish all: a reader sees the last publication only."""
    root, rows = scratch(spark, "snapshot"), predictions(spark, sf)
    if not snapshots.read(spark, root).isEmpty():
        raise ContractError("an unpublished snapshot must read as empty")
    snapshots.reset(spark, root)
    for part in (days(rows, 1, 10), rows):
        counted = windows.window_metrics(part, i.PLAN).withColumn("seq", F.lit(0))
        snapshots.publish(snapshots.newest_windows(counted, "seq"), root)
    record = snapshots.read(spark, root).select("record")
    return record.select(
        F.col("record")["window_end"].alias("window_end"),
        F.col("record")["event_count"].cast("bigint").alias("event_count"),
        F.col("record")["status"].alias("status"),
    )


@query(
    "q_snapshot_read_tolerant",
    """SELECT event_id::VARCHAR AS id, event_type AS kind FROM events
WHERE event_type NOT IN ('click', 'view')""",
)
def _(spark, sf):
    """Only objects inside lists count; broken text and non-lists read as nothing."""
    entry = F.to_json(
        F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    )
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.lit("["), entry))
        .when(kind == "view", entry)
        .when(kind == "error", F.concat(F.lit("[5, "), entry, F.lit(', "x", null, [1]]')))
        .otherwise(F.concat(F.lit("["), entry, F.lit("]")))
    )
    texts = i.table(spark, sf, "events").select(text.alias("value"))
    found = snapshots.parse_list(texts)
    return found.select(
        F.col("record")["id"].alias("id"), F.col("record")["kind"].alias("kind")
    )


# --- files ------------------------------------------------------------------


@lru_cache(maxsize=None)
def _flow_files(app_id: str, spark, sf: str) -> str:
    return files.write_csv(i.raw_flows(spark, sf), scratch(spark, "flows"))


def flow_files(spark, sf) -> str:
    """The raw flow table as CSV files; written once per session."""
    return _flow_files(spark.sparkContext.applicationId, spark, sf)


@query(
    "q_csv_strict_scan",
    f"""WITH {i.FLOWS_SQL}
SELECT count(*) AS rows, count(*) FILTER (q <> 0) AS qty_present, count(*) FILTER (q <> 7)
  AS disc_present, count(*) FILTER (q <> 10) AS label_present,
  count(*) FILTER (q NOT IN (10, 11, 12)) AS known_labels,
  round(sum(l_extendedprice) FILTER (q <> 6), 2) AS price_sum FROM flows""",
)
def _(spark, sf):
    """Raw text survives the round trip through CSV, blanks and NULLs included."""
    back = files.strict_scan(spark, flow_files(spark, sf), i.LINES)
    return back.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("qty").alias("qty_present"),
        F.count("disc").alias("disc_present"),
        F.count("Label").alias("label_present"),
        F.count_if(label_is_known(i.LINES)).alias("known_labels"),
        F.round(F.sum(F.col("price").try_cast("double")), 2).alias("price_sum"),
    )


@query(
    "q_csv_inferred_schema",
    """SELECT * FROM (VALUES ('qty', 'string'), ('price', 'string'), ('disc', 'double'),
  ('tax', 'double'), ('Tot sum', 'string'), ('IPv', 'int'), ('LLC', 'int'), ('Label', 'string'))
  t(column_name, type_name)""",
)
def _(spark, sf):
    """One word in a column makes it text; missing cells and NaN do not."""
    guessed = files.inferred_scan(spark, flow_files(spark, sf))
    return spark.createDataFrame(guessed.dtypes, "column_name string, type_name string")


@query(
    "q_label_scan",
    f"""WITH {i.FLOWS_SQL}
SELECT CASE q WHEN 10 THEN NULL WHEN 11 THEN '' WHEN 12 THEN 'MYSTERY'
  ELSE CASE lab WHEN 'BENIGN' THEN 'benign' ELSE lab END END AS label, count(*) AS rows
FROM flows GROUP BY 1""",
)
def _(spark, sf):
    scanned = files.label_scan(spark, [flow_files(spark, sf)], i.LINES)
    return scanned.groupBy(F.col("Label").alias("label")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "q_file_inventory",
    """SELECT true AS has_files, true AS no_empty_file, true AS all_files_scanned, true AS bytes_agree,
  (SELECT count(*) FROM lineitem) AS data_rows""",
)
def _(spark, sf):
    """The listing agrees with what a scan of the lines reports about its files."""
    path = flow_files(spark, sf)
    listed = files.inventory(spark, path)
    seen = files.csv_lines(spark, path).groupBy("file").agg(
        F.max("bytes").alias("seen_bytes"), (F.count(F.lit(1)) - 1).alias("data_rows")
    )
    both = listed.join(
        seen.withColumn("file", F.regexp_replace("file", "^file:/*", "file:/")), "file", "left"
    )
    return both.agg(
        (F.count(F.lit(1)) > 0).alias("has_files"),
        F.bool_and(F.col("bytes") > 0).alias("no_empty_file"),
        F.bool_and(F.col("seen_bytes").isNotNull()).alias("all_files_scanned"),
        F.bool_and(F.coalesce(F.col("bytes") == F.col("seen_bytes"), F.lit(False))).alias(
            "bytes_agree"
        ),
        F.sum("data_rows").alias("data_rows"),
    )


@query(
    "q_header_audit",
    """SELECT * FROM (VALUES ('a_good', 'ok'), ('b_good', 'ok'), ('c_short', 'missing_column'),
  ('d_order', 'header_mismatch'), ('e_twice', 'duplicate_column')) t(source, status)""",
)
def _(spark, sf):
    """Whole flow files written with five different headers."""
    root, flows = scratch(spark, "headers"), i.raw_flows(spark, sf)
    layouts = {
        "a_good": list(i.LINES.columns),
        "b_good": list(i.LINES.columns),
        "c_short": [c for c in i.LINES.columns if c != "price"],
        "d_order": [*reversed(i.LINES.columns)],
    }
    for name, columns in layouts.items():
        files.write_csv(flows.select(*[f"`{c}`" for c in columns]), f"{root}/{name}")
    twice = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in i.LINES.columns])
    names = ",".join([*i.LINES.columns, "qty"])
    body = flows.select(F.concat(twice, F.lit(",0")).alias(names))
    body.write.options(header=True, quote="", sep="\t").csv(f"{root}/e_twice")
    audit = files.audit_headers(spark, root, (*i.LINES.features, i.LINES.label))
    source = F.element_at(F.split("file", "/"), -2)
    return audit.select(source.alias("source"), "status").distinct()


@query(
    "q_prefix_sample_per_group",
    """SELECT o_orderpriority, o_orderkey, position FROM (
  SELECT o_orderpriority, o_orderkey,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey)::INT AS position
  FROM orders) WHERE position <= 5""",
)
def _(spark, sf):
    """First five orders of every priority (a bounded sample per source)."""
    orders = i.table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return first_per_group(orders, "o_orderpriority", ("o_orderkey",), 5)


@query(
    "q_file_sample",
    """SELECT true AS within_limit, true AS positions_from_one, true AS every_file_sampled,
  true AS is_the_prefix""",
)
def _(spark, sf):
    """First rows of every CSV file: 20 each, or the whole file if it is shorter."""
    path = flow_files(spark, sf)
    sampled = files.sample_per_file(spark, path, i.LINES, 20)
    per_file = sampled.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("lo"), F.max("position").alias("hi")
    )
    # The same lines as text: line 1 is the header, so row n of the sample must be line n + 1.
    prefix = files.first_lines(files.csv_lines(spark, path), 21).where(F.col("position") > 1)
    cells = F.from_csv("value", ", ".join(f"`{c}` string" for c in i.LINES.columns))
    lines = prefix.select("file", (F.col("position") - 1).alias("position"), cells.alias("cells"))
    pairs = sampled.join(lines, ["file", "position"], "full_outer")
    agree = F.col("cells.price").eqNullSafe(F.col("price")) & F.col("cells.tax").eqNullSafe(F.col("tax"))
    is_prefix = pairs.agg(F.bool_and(agree).alias("b")).scalar()
    n_files = files.inventory(spark, path).agg(F.count(F.lit(1)).alias("n")).scalar()
    return per_file.agg(
        F.bool_and(F.col("n") <= 20).alias("within_limit"),
        F.bool_and((F.col("lo") == 1) & (F.col("hi") == F.col("n"))).alias("positions_from_one"),
        (F.count(F.lit(1)) == n_files).alias("every_file_sampled"),
        is_prefix.alias("is_the_prefix"),
    )


# --- replay -----------------------------------------------------------------


def keyed_flows(spark, sf):
    """orders as raw flows with a unique row number."""
    return i.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_totalprice").cast("string").alias("qty"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "n/a")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("price"),
        F.when(F.col("o_orderstatus") == "F", " benign")
        .when(F.col("o_orderstatus") == "O", "DDOS-A")
        .when(F.col("o_orderpriority") == "2-HIGH", "MYSTERY")
        .otherwise("XSS")
        .alias("Label"),
    )


REPLAY = FlowContract(
    numeric=("qty", "price"), features=("qty", "price"), attacks=("DDOS-A", "XSS")
)
REPLAY_SQL = """
rows AS (
  SELECT o_orderkey AS row_id, o_totalprice AS qty,
    CASE o_orderstatus WHEN 'F' THEN 'normal' WHEN 'O' THEN 'burst' END AS cls
  FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '1-URGENT'
), pos AS (
  SELECT *, row_number() OVER (PARTITION BY cls ORDER BY row_id) - 1 AS p,
    count(*) OVER (PARTITION BY cls) AS n FROM rows
), total AS (SELECT 2 * max(n) AS events FROM pos)"""
START = 1_704_067_200_000_000


def numbered_replay(spark, sf):
    """Rows with their position in their class, and the class sizes."""
    rows = replay.replay_rows(keyed_flows(spark, sf), REPLAY, keep=("row_id",))
    return replay.numbered(rows, "row_id"), replay.class_sizes(rows)


@query(
    "q_scenario_filter",
    """SELECT o_orderkey AS row_id, CASE o_orderstatus WHEN 'F' THEN 'normal' ELSE 'burst' END
  AS replay_class, CASE o_orderstatus WHEN 'F' THEN 'Normal' ELSE 'Attack' END AS ground_truth,
  CASE o_orderstatus WHEN 'F' THEN 'BENIGN' ELSE 'DDOS-A' END AS source_label,
  o_totalprice AS qty, o_custkey::DOUBLE AS price
FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '1-URGENT'""",
)
def _(spark, sf):
    return replay.replay_rows(keyed_flows(spark, sf), REPLAY, keep=("row_id",))


@query(
    "q_replay_stats",
    """WITH b AS (SELECT count(*) AS bad FROM orders WHERE o_orderstatus = 'P'
  AND o_orderpriority = '2-HIGH')
SELECT 'normal' AS replay_class,
  count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT') AS sendable,
  count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') + max(bad)
    AS skipped_invalid FROM orders, b
UNION ALL SELECT 'burst',
  count(*) FILTER (o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT'),
  count(*) FILTER (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') + max(bad)
FROM orders, b""",
)
def _(spark, sf):
    return replay.replay_stats(keyed_flows(spark, sf), REPLAY)


@query(
    "q_replay_mixed",
    f"""WITH {REPLAY_SQL}, slots AS (
  SELECT s AS slot, CASE WHEN s % 2 = 0 THEN 'normal' ELSE 'burst' END AS cls, s // 2 AS turn
  FROM (SELECT unnest(range((SELECT events FROM total)::BIGINT)) AS s)
), sizes AS (SELECT DISTINCT cls, n FROM pos)
SELECT slot, slots.cls AS replay_class, row_id, qty
FROM slots JOIN sizes ON slots.cls = sizes.cls
JOIN pos ON pos.cls = slots.cls AND pos.p = turn % sizes.n""",
)
def _(spark, sf):
    """Normal and burst rows alternate; the shorter class starts over."""
    rows, sizes = numbered_replay(spark, sf)
    mixed = replay.scenario_order(rows, "MIXED", 2 * max(sizes.values()), sizes)
    return mixed.select("slot", "replay_class", "row_id", "qty")


@query(
    "q_replay_schedule",
    f"""WITH {REPLAY_SQL}
SELECT p::BIGINT AS slot, row_id, make_timestamp({START} + (p * 200000)::BIGINT) AS due
FROM pos WHERE cls = 'normal'""",
)
def _(spark, sf):
    """One cycle of normal rows at five events a second."""
    rows, sizes = numbered_replay(spark, sf)
    ordered = replay.scenario_order(rows, "NORMAL", sizes["normal"], sizes)
    return i.shown(replay.schedule(ordered, START, 5.0).select("slot", "row_id", "due"))


@query(
    "q_replay_sequence",
    f"""WITH {REPLAY_SQL}, seg(segment, scenario, first_cls, stride) AS (VALUES
  (0, 'NORMAL', 'normal', 1), (1, 'DDOS_BURST', 'burst', 1), (2, 'NORMAL', 'normal', 1),
  (3, 'MIXED', 'normal', 2)
), e AS (SELECT max(n) AS n FROM pos), slots AS (
  SELECT seg.*, unnest(range((SELECT n FROM e)::BIGINT)) AS slot FROM seg
), want AS (
  SELECT *, CASE WHEN stride = 1 THEN first_cls WHEN slot % 2 = 0 THEN 'normal' ELSE 'burst' END
    AS cls, slot // stride AS turn FROM slots
), sizes AS (SELECT DISTINCT cls, n FROM pos)
SELECT segment, scenario, slot, row_id,
  make_timestamp({START} + (segment * ((SELECT n FROM e) * 200000 + 3000000)
    + slot * 200000)::BIGINT) AS due
FROM want JOIN sizes ON want.cls = sizes.cls
JOIN pos ON pos.cls = want.cls AND pos.p = turn % sizes.n""",
)
def _(spark, sf):
    """Normal, burst, recovery and mixed segments, three seconds apart."""
    rows, sizes = numbered_replay(spark, sf)
    events = max(sizes.values())
    script = [(s, 5.0, events, 3.0) for s in ("NORMAL", "DDOS_BURST", "NORMAL", "MIXED")]
    laid = replay.sequence(rows, script, START, sizes)
    return i.shown(laid.select("segment", "scenario", "slot", "row_id", "due"))
