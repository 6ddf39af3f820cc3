"""Judged events, predictions, alerts, and windows over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import iso_millis
from ..operators import alerts as alert_ops
from ..operators import ingest, serve, windows
from ..session import scratch
from . import inputs as i
from .registry import query

RECORDS, PREDS, METRICS = i.RECORDS_SQL, i.PREDICTIONS_SQL, i.METRICS_SQL


def events(spark, sf):
    return i.table(spark, sf, "events")


def records(spark, sf):
    return i.log_records(events(spark, sf))


def predictions(spark, sf):
    return i.predictions(events(spark, sf))


@query(
    "q_envelope_decode",
    f"""WITH {RECORDS}
SELECT 'events' AS topic, part AS partition, event_id AS "offset", ts AS kafka_timestamp,
  m <> 0 AS closed FROM records""",
)
def _(spark, sf):
    decoded = ingest.decode(records(spark, sf))
    return i.shown(
        decoded.select(*ingest.RECORD, F.col("raw_json").endswith("}").alias("closed"))
    )


@query(
    "q_json_two_view",
    f"""WITH {RECORDS}
SELECT count(*) AS rows, count(*) FILTER (m = 0) AS no_map,
  count(*) FILTER (m = 1) AS value_absent, count(*) FILTER (m = 9) AS k_null,
  count(*) FILTER (m IN (1, 3)) AS value_untyped, count(*) FILTER (m = 4) AS value_not_finite,
  round(sum(value) FILTER (m NOT IN (0, 1, 3, 4)), 2) AS value_sum,
  sum(k) FILTER (m NOT IN (0, 9)) AS k_sum
FROM records""",
)
def _(spark, sf):
    """Presence from the map view, types from the struct view."""
    views = ingest.parse_views(ingest.decode(records(spark, sf)), i.EVENTS)
    given, value = F.col("__given"), F.col("value")
    parsed = given.isNotNull()
    finite = F.coalesce(F.abs(value) < float("inf"), F.lit(False))
    return views.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~parsed).alias("no_map"),
        F.count_if(parsed & ~F.map_contains_key(given, "value")).alias("value_absent"),
        F.count_if(
            parsed & F.map_contains_key(given, "k") & F.try_element_at(given, F.lit("k")).isNull()
        ).alias("k_null"),
        F.count_if(parsed & value.isNull()).alias("value_untyped"),
        F.count_if(parsed & value.isNotNull() & ~finite).alias("value_not_finite"),
        F.round(F.sum(F.when(parsed & finite, value)), 2).alias("value_sum"),
        F.sum(F.when(parsed, F.col("k"))).alias("k_sum"),
    )


@query(
    "q_invalid_reason_counts",
    f"""WITH {RECORDS}
SELECT coalesce(reason, 'valid') AS reason, count(*) AS records FROM records GROUP BY 1""",
)
def _(spark, sf):
    judged = ingest.judge(records(spark, sf), i.EVENTS)
    return judged.groupBy(
        F.coalesce(F.col("invalid_reason"), F.lit("valid")).alias("reason")
    ).agg(F.count(F.lit(1)).alias("records"))


@query(
    "q_invalid_rows",
    f"""WITH {RECORDS}
SELECT 'events' AS topic, part AS partition, event_id AS "offset", ts AS kafka_timestamp,
  reason AS invalid_reason, m <> 0 AS closed FROM records WHERE reason IS NOT NULL""",
)
def _(spark, sf):
    _, bad = ingest.split_records(records(spark, sf), i.EVENTS)
    closed = F.col("raw_json").endswith("}").alias("closed")
    return i.shown(bad.select(*ingest.RECORD, "invalid_reason", closed))


VALID_OUT = """
SELECT 'events' AS topic, part AS partition, event_id AS "offset", ts AS kafka_timestamp,
  strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time,
  date_trunc('millisecond', ts) AS event_timestamp,
  CASE WHEN user_id % 3 = 0 THEN 'MIXED' WHEN event_type = 'error' THEN 'DDOS_BURST'
    ELSE 'NORMAL' END AS scenario,
  CASE WHEN event_type = 'error' THEN 'Attack' ELSE 'Normal' END AS ground_truth,
  CASE WHEN event_type = 'error' THEN 'DDOS-ERROR' ELSE 'BENIGN' END AS source_label,
  value, k FROM valid"""


@query("q_valid_events", f"WITH {RECORDS} {VALID_OUT}")
def _(spark, sf):
    good, _ = ingest.split_records(records(spark, sf), i.EVENTS)
    return i.shown(good)


@query(
    "q_metadata_mismatch",
    f"""WITH {RECORDS}
SELECT part AS partition, event_id AS "offset" FROM records WHERE m = 8""",
)
def _(spark, sf):
    judged = ingest.judge(records(spark, sf), i.EVENTS)
    return judged.where(F.col("invalid_reason") == "scenario_metadata_mismatch").select(
        "partition", "offset"
    )


@query(
    "q_event_publish",
    f"""WITH {PREDS}
SELECT source_label, count(*) AS events, round(sum(value), 2) AS value_sum, true AS compact
FROM preds GROUP BY 1""",
)
def _(spark, sf):
    """Events written as JSON records and decoded again, none lost or changed."""
    moment = F.col("ts").cast("timestamp")
    fields = {n: e.alias(n) for n, e in i._event_fields().items()}
    flat = events(spark, sf).select(
        iso_millis(moment).alias("event_time"),
        *fields.values(),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    path = scratch(spark, "published")
    ingest.publish_records(flat, i.EVENTS, i.TOPIC).write.parquet(path)
    text = F.col("value").cast("string")
    back = spark.read.parquet(path).select(
        F.from_json(text, i.EVENTS.schema).alias("e"), text.alias("text")
    )
    return back.groupBy(F.col("e.source_label").alias("source_label")).agg(
        F.count(F.lit(1)).alias("events"),
        F.round(F.sum("e.value"), 2).alias("value_sum"),
        F.bool_and(~F.col("text").contains(" ")).alias("compact"),
    )


@query(
    "q_prediction_label",
    f"""WITH {PREDS}
SELECT prediction, prediction_label, count(*) AS events FROM preds GROUP BY 1, 2""",
)
def _(spark, sf):
    return (
        predictions(spark, sf)
        .groupBy("prediction", "prediction_label")
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query(
    "q_alerts",
    f"""WITH {PREDS}
SELECT et AS event_timestamp, ts AS kafka_timestamp, 'events' AS topic, part AS partition,
  event_id AS "offset", 'Predicted Attack' AS alert_type, prediction, prediction_label,
  scenario, ground_truth, source_label FROM preds WHERE prediction = 1.0""",
)
def _(spark, sf):
    return i.shown(alert_ops.alerts(predictions(spark, sf)).drop("probability"))


@query(
    "q_window_status",
    f"WITH {i.VALID_METRICS_SQL} SELECT {i.METRIC_OUT_SQL} FROM metrics",
)
def _(spark, sf):
    """The whole path: records, judgement, score, sliding windows, status."""
    good, _ = ingest.split_records(records(spark, sf), i.EVENTS)
    return i.shown(windows.window_metrics(i.rule_score(good), i.PLAN))


@query(
    "q_sliding_window_counts",
    f"""WITH {METRICS}
SELECT window_start, window_end, event_count, normal_count, attack_count FROM metrics""",
)
def _(spark, sf):
    return i.shown(windows.window_counts(predictions(spark, sf), i.PLAN))


@query(
    "q_window_rates",
    f"WITH {METRICS} SELECT {i.METRIC_OUT_SQL} FROM metrics",
)
def _(spark, sf):
    return i.shown(i.metrics(spark, sf))


@query(
    "q_window_deltas",
    f"""WITH {METRICS}
SELECT window_end,
  round(event_rate - lag(event_rate) OVER (ORDER BY window_end), 6) AS event_rate_change,
  round((attack_rate - lag(attack_rate) OVER (ORDER BY window_end)) * 100, 6)
    AS attack_points_change
FROM metrics""",
)
def _(spark, sf):
    return i.shown(windows.window_deltas(i.metrics(spark, sf), i.PLAN))


@query(
    "q_completed_windows",
    f"""WITH {METRICS}
SELECT {i.METRIC_OUT_SQL} FROM metrics
WHERE window_end < (SELECT min(e) FROM (SELECT window_end AS e FROM metrics
                                        ORDER BY e DESC LIMIT 2))""",
)
def _(spark, sf):
    return i.shown(windows.completed_windows(i.metrics(spark, sf)))


@query(
    "q_latest_window",
    f"""WITH {METRICS}, done AS (
  SELECT * FROM metrics WHERE window_end <
    (SELECT min(e) FROM (SELECT window_end AS e FROM metrics ORDER BY e DESC LIMIT 2)))
SELECT {i.METRIC_OUT_SQL} FROM done ORDER BY window_end DESC LIMIT 1""",
)
def _(spark, sf):
    done = windows.completed_windows(i.metrics(spark, sf))
    return i.shown(windows.latest_window(done))


@query(
    "q_status_transitions",
    f"""WITH {METRICS}, c AS (
  SELECT *, CASE WHEN status = lag(status) OVER (ORDER BY window_end) THEN 0 ELSE 1 END AS ch
  FROM metrics), n AS (
  SELECT *, sum(ch) OVER (ORDER BY window_end) AS run FROM c)
SELECT run::BIGINT AS run, min(status) AS status, min(window_end) AS first_end,
  max(window_end) AS last_end, count(*) AS windows FROM n GROUP BY run""",
)
def _(spark, sf):
    return i.shown(windows.status_runs(i.metrics(spark, sf), i.PLAN))


@query(
    "q_window_vs_mean",
    f"""WITH {METRICS}
SELECT window_end, round(avg(event_rate) OVER (), 6) AS mean_event_rate,
  round(event_rate - avg(event_rate) OVER (), 6) AS event_rate_vs_mean,
  round(avg(attack_rate) OVER (), 6) AS mean_attack_rate,
  round(attack_rate - avg(attack_rate) OVER (), 6) AS attack_rate_vs_mean
FROM metrics""",
)
def _(spark, sf):
    metrics = i.metrics(spark, sf)
    with_rate = windows.against_mean(metrics, "event_rate", "event_rate")
    both = windows.against_mean(with_rate, "attack_rate", "attack_rate")
    return i.shown(
        both.select(
            "window_end",
            "mean_event_rate",
            "event_rate_vs_mean",
            "mean_attack_rate",
            "attack_rate_vs_mean",
        )
    )


@query(
    "q_window_history_stats",
    f"""WITH {METRICS}
SELECT count(*) AS windows, round(avg(event_rate), 6) AS mean_event_rate,
  round(max(event_rate), 6) AS peak_event_rate,
  round(avg(attack_rate * 100), 6) AS mean_attack_percent,
  round(avg(event_count), 6) AS mean_event_count FROM metrics""",
)
def _(spark, sf):
    return i.shown(windows.history_stats(i.metrics(spark, sf)))


@query(
    "q_alerts_by_label",
    f"""WITH {PREDS}
SELECT CASE WHEN source_label = 'BENIGN' THEN 'Unknown' ELSE source_label END AS source_label,
  count(*) AS alerts FROM preds WHERE prediction = 1.0 GROUP BY 1
ORDER BY alerts DESC, source_label LIMIT 10""",
)
def _(spark, sf):
    """Top ten source labels; here benign sources have lost their label."""
    unnamed = F.nullif(F.col("source_label"), F.lit("BENIGN"))
    raised = alert_ops.alerts(predictions(spark, sf)).withColumn("source_label", unnamed)
    return alert_ops.count_by(raised, "source_label", top=10)


@query(
    "q_alerts_by_scenario",
    f"""WITH {PREDS}
SELECT scenario, count(*) AS alerts FROM preds WHERE prediction = 1.0 GROUP BY 1""",
)
def _(spark, sf):
    return alert_ops.count_by(alert_ops.alerts(predictions(spark, sf)), "scenario")


@query(
    "q_category_share",
    f"""WITH {PREDS}, c AS (
  SELECT scenario, count(*) AS alerts FROM preds WHERE prediction = 1.0 GROUP BY 1)
SELECT scenario, alerts, round(alerts / (sum(alerts) OVER ())::DOUBLE, 6) AS share FROM c""",
)
def _(spark, sf):
    counts = alert_ops.count_by(alert_ops.alerts(predictions(spark, sf)), "scenario")
    return i.shown(alert_ops.shares(counts, "alerts"))


@query(
    "q_alert_feed",
    f"""WITH {PREDS}, a AS (
  SELECT CASE WHEN source_label = 'BENIGN' THEN NULL ELSE et END AS event_timestamp, part, event_id
  FROM preds WHERE prediction = 1.0)
SELECT event_timestamp, 'events' AS topic, part AS partition, event_id AS "offset" FROM a
ORDER BY event_timestamp DESC NULLS LAST, part DESC, event_id DESC LIMIT 25""",
)
def _(spark, sf):
    """Newest 25 alerts; alerts of benign sources have an unreadable time here."""
    when = F.when(F.col("source_label") != "BENIGN", F.col("event_timestamp"))
    raised = alert_ops.alerts(predictions(spark, sf)).withColumn("event_timestamp", when)
    return i.shown(alert_ops.feed(raised, 25).select("event_timestamp", "topic", "partition", "offset"))


@query(
    "q_alert_display",
    f"""WITH {PREDS}
SELECT 'events' AS topic, part AS partition, event_id AS "offset",
  strftime(et, '%H:%M:%S') AS shown_time, 'ATTACK' AS verdict, scenario AS shown_scenario,
  CASE WHEN source_label = 'BENIGN' THEN 'Unknown' ELSE source_label END AS shown_source
FROM preds WHERE prediction = 1.0""",
)
def _(spark, sf):
    unnamed = F.nullif(F.col("source_label"), F.lit("BENIGN"))
    raised = alert_ops.alerts(predictions(spark, sf)).withColumn("source_label", unnamed)
    return serve.alert_display(raised)


def metric_records(spark, sf):
    """Windows as text records; by hour some lack a field or hold a bad number."""
    metrics = i.metrics(spark, sf)
    hour = F.hour("window_start")
    texts = {
        n: iso_millis(F.col(n)) if n in ("window_start", "window_end") else F.col(n).cast("string")
        for n in windows.METRIC_COLUMNS
    }
    texts["event_rate"] = F.when(hour == 4, "abc").otherwise(texts["event_rate"])
    texts["window_end"] = F.when(hour == 5, "soon").otherwise(texts["window_end"])
    full = F.create_map(*[part for n, e in texts.items() for part in (F.lit(n), e)])
    return metrics.select(
        F.when(hour == 3, F.map_filter(full, lambda k, v: k != "status"))
        .otherwise(full)
        .alias("record")
    )


@query(
    "q_metric_records_complete",
    f"""WITH {METRICS}
SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS window_start, status
FROM metrics WHERE hour(window_start) <> 3""",
)
def _(spark, sf):
    kept = serve.complete_records(metric_records(spark, sf))
    return kept.select(
        F.col("record")["window_start"].alias("window_start"),
        F.col("record")["status"].alias("status"),
    )


@query(
    "q_metric_frame",
    f"""WITH {METRICS}
SELECT window_start, window_end, event_count::DOUBLE AS event_count,
  round(event_rate, 6) AS event_rate, normal_count::DOUBLE AS normal_count,
  attack_count::DOUBLE AS attack_count, round(normal_rate, 6) AS normal_rate,
  round(attack_rate, 6) AS attack_rate, status,
  round(attack_rate * 100, 6) AS attack_percent, round(normal_rate * 100, 6) AS normal_percent
FROM metrics WHERE hour(window_start) NOT IN (3, 4, 5) ORDER BY window_end""",
)
def _(spark, sf):
    kept = serve.complete_records(metric_records(spark, sf))
    return i.shown(serve.metric_frame(kept).orderBy("window_end"))


@query(
    "q_alert_frame",
    f"""WITH {PREDS}
SELECT 'events' AS topic, part AS partition, event_id AS "offset",
  CASE WHEN source_label <> 'BENIGN' THEN et END AS event_moment,
  scenario, NULL::VARCHAR AS source_label, NULL::VARCHAR AS alert_type
FROM preds WHERE prediction = 1.0""",
)
def _(spark, sf):
    """Alert records without some columns and with partly unreadable times."""
    when = F.when(F.col("source_label") != "BENIGN", iso_millis(F.col("event_timestamp")))
    raised = (
        alert_ops.alerts(predictions(spark, sf))
        .withColumn("event_timestamp", F.coalesce(when, F.lit("yesterday")))
        .drop("source_label", "alert_type")
    )
    framed = serve.alert_frame(raised)
    return i.shown(
        framed.select(
            "topic", "partition", "offset", "event_moment", "scenario", "source_label", "alert_type"
        )
    )


@query(
    "q_status_presentation",
    f"""WITH {METRICS}
SELECT window_end, CASE WHEN hour(window_start) = 3 THEN 'UNAVAILABLE'
    WHEN status = 'Normal' THEN 'SAFE' WHEN status = 'Warning' THEN 'WARNING'
    ELSE 'CRITICAL' END AS shown_status,
  CASE WHEN hour(window_start) = 3 THEN 'No status of this name is known'
    WHEN status = 'Normal' THEN 'Few or no events of this window look like attacks'
    WHEN status = 'Warning' THEN 'A share of this window''s events looks like attacks'
    ELSE 'Most events of this window look like attacks' END AS shown_message,
  round(greatest(0, least(100, attack_rate * 100)), 6) AS shown_percent FROM metrics""",
)
def _(spark, sf):
    lost = F.when(F.hour("window_start") == 3, "Odd").otherwise(F.col("status"))
    presented = serve.status_presentation(i.metrics(spark, sf).withColumn("status", lost))
    return i.shown(
        presented.select("window_end", "shown_status", "shown_message", "shown_percent")
    )


@query(
    "q_feed_state",
    f"""WITH {METRICS}, newest AS (SELECT * FROM metrics ORDER BY window_end DESC LIMIT 2)
SELECT 'all' AS feed, (SELECT count(*) FROM metrics) AS windows,
  CASE WHEN (SELECT count(*) FROM metrics) > 2 THEN 'ready' ELSE 'warming_up' END AS state
UNION ALL SELECT 'newest two', (SELECT count(*) FROM newest), 'warming_up'
UNION ALL SELECT 'none', 0, 'waiting'""",
)
def _(spark, sf):
    metrics = i.metrics(spark, sf)
    feeds = {
        "all": metrics,
        "newest two": metrics.orderBy(F.desc("window_end")).limit(2),
        "none": metrics.where(F.col("event_count") < 0),
    }
    states = [
        serve.feed_state(df).select(F.lit(name).alias("feed"), "windows", "state")
        for name, df in feeds.items()
    ]
    return states[0].unionByName(states[1]).unionByName(states[2])


@query(
    "q_prediction_volume_long",
    f"""WITH {METRICS}
SELECT window_end, 'Normal' AS prediction, normal_count AS events FROM metrics
UNION ALL SELECT window_end, 'Attack', attack_count FROM metrics""",
)
def _(spark, sf):
    return i.shown(serve.prediction_volume(i.metrics(spark, sf)))


@query(
    "q_prediction_mix",
    f"""WITH {METRICS}, done AS (
  SELECT * FROM metrics WHERE window_end <
    (SELECT min(e) FROM (SELECT window_end AS e FROM metrics ORDER BY e DESC LIMIT 2))
  ORDER BY window_end DESC LIMIT 1)
SELECT 'Normal' AS prediction, normal_count AS events, round(normal_rate, 6) AS share FROM done
UNION ALL SELECT 'Attack', attack_count, round(attack_rate, 6) FROM done""",
)
def _(spark, sf):
    """Class mix of the latest completed window."""
    latest = windows.latest_window(windows.completed_windows(i.metrics(spark, sf)))
    mix = serve.prediction_volume(latest).select("prediction", "events")
    return i.shown(alert_ops.shares(mix, "events"))


@query(
    "q_latest_window_per_type",
    """WITH s AS (
  SELECT event_type, unnest([time_bucket(INTERVAL 30 MINUTE, ts),
    time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS window_start FROM events
), c AS (SELECT event_type, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS event_count
  FROM s GROUP BY 1, 2)
SELECT event_type, window_end, event_count FROM c
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY window_end DESC) = 1""",
)
def _(spark, sf):
    """Newest window of every entity, by aggregation instead of a sort per entity."""
    stamped = events(spark, sf).withColumn("t", F.col("ts").cast("timestamp"))
    counts = stamped.groupBy("event_type", i.PLAN.window("t").alias("w")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    flat = counts.select("event_type", F.col("w.end").alias("window_end"), "event_count")
    return i.shown(windows.latest_window(flat, by=("event_type",)))
