"""Query inputs derived from the given tables, each with its SQL twin.

Faults are put into known rows by key, so that the expected verdict of a row is
known from its key alone and the oracle never has to repeat the parsing.
Every input covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import EventContract, FlowContract
from ..functions.times import iso_millis
from ..operators import alerts as alert_ops
from ..operators.windows import WindowPlan, window_metrics

# A narrow labelled flow table: four features, three further numeric columns.
LINES = FlowContract(
    numeric=("qty", "price", "disc", "tax", "Tot sum", "IPv", "LLC"),
    features=("qty", "price", "disc", "tax"),
    attacks=("DDOS-A", "DOS-R", "XSS"),
)
EVENTS = EventContract(features=("value", "k"))
TOPIC = "events"
PLAN = WindowPlan(length=3600, slide=1800, lateness=3600)
ATTACK_FROM = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _faulty(text: Column, slot: Column, faults: dict) -> Column:
    """Text cell with some slots replaced."""
    cell = text.cast("string")
    for number, value in faults.items():
        cell = F.when(slot == number, F.lit(value).cast("string")).otherwise(cell)
    return cell


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as an all-text flow table with bad cells and bad labels."""
    lines = table(spark, sf_dir, "lineitem")
    slot = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) % 997
    qty_faults = {0: None, 1: "  ", 2: "abc", 3: "NaN", 4: "Infinity", 5: "-Infinity"}
    label = (
        F.when(slot == 10, F.lit(None).cast("string"))
        .when(slot == 11, "  ")
        .when(slot == 12, "MYSTERY")
        .when(F.col("l_returnflag") == "N", " benign ")
        .when(F.col("l_returnflag") == "A", "DDOS-A")
        .otherwise("DOS-R")
    )
    return lines.select(
        _faulty(F.col("l_quantity"), slot, qty_faults).alias("qty"),
        _faulty(F.col("l_extendedprice"), slot, {6: "n/a"}).alias("price"),
        _faulty(F.col("l_discount"), slot, {7: None}).alias("disc"),
        _faulty(F.col("l_tax"), slot, {8: "NaN"}).alias("tax"),
        _faulty(F.col("l_quantity"), slot, {9: "oops", 13: "-Infinity"}).alias("Tot sum"),
        F.lit("1").alias("IPv"),
        _faulty(F.lit("1"), slot, {14: "0"}).alias("LLC"),
        label.alias("Label"),
    )


FLOWS_SQL = """
flows AS (
  SELECT *, (l_orderkey * 10 + l_linenumber) % 997 AS q,
         CASE l_returnflag WHEN 'N' THEN 'BENIGN' WHEN 'A' THEN 'DDOS-A' ELSE 'DOS-R' END AS lab
  FROM lineitem
), ready AS (
  SELECT *, CASE WHEN lab = 'BENIGN' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS target
  FROM flows WHERE q > 8 AND q NOT IN (10, 11, 12)
)"""


def _event_fields() -> dict[str, Column]:
    error = F.col("event_type") == "error"
    return {
        "scenario": F.when(F.col("user_id") % 3 == 0, "MIXED")
        .when(error, "DDOS_BURST")
        .otherwise("NORMAL"),
        "ground_truth": F.when(error, "Attack").otherwise("Normal"),
        "source_label": F.when(error, "DDOS-ERROR").otherwise("BENIGN"),
    }


def log_records(events: DataFrame) -> DataFrame:
    """events as log records with JSON values, one fault class per key slot."""
    m = F.col("event_id") % 101
    moment = F.col("ts").cast("timestamp")
    fields = _event_fields()
    bad_time = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    when = F.when(m.isin(2, 10), bad_time).otherwise(iso_millis(moment))
    scenario = (
        F.when(m.isin(5, 10), "OTHER").when(m == 8, "NORMAL").otherwise(fields["scenario"])
    )
    truth = F.when(m == 6, "Maybe").when(m == 8, "Attack").otherwise(fields["ground_truth"])
    source = F.when(m == 7, "  ").when(m == 8, "DDOS-ERROR").otherwise(fields["source_label"])
    value = (
        F.when(m == 3, '"value":"abc",')
        .when(m == 4, '"value":NaN,')
        .when(m == 1, "")
        .otherwise(F.concat(F.lit('"value":'), F.col("value").cast("string"), F.lit(",")))
    )
    k = F.when(m == 9, "null").otherwise(F.get_json_object("props", "$.k"))
    text = F.concat(
        F.lit('{"event_time":"'), when, F.lit('","scenario":"'), scenario,
        F.lit('","ground_truth":"'), truth, F.lit('","source_label":"'), source, F.lit('",'),
        value, F.lit('"k":'), k, F.when(m == 0, "").otherwise("}"),
    )
    return events.select(
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        moment.alias("timestamp"),
        text.cast("binary").alias("value"),
    )


RECORDS_SQL = """
records AS (
  SELECT *, event_id % 101 AS m, (user_id % 4)::INT AS part,
         (regexp_extract(props, '"k": ([0-9]+)', 1))::DOUBLE AS k,
         CASE event_id % 101
           WHEN 0 THEN 'malformed_json'
           WHEN 1 THEN 'missing_required_field' WHEN 9 THEN 'missing_required_field'
           WHEN 2 THEN 'invalid_event_time' WHEN 10 THEN 'invalid_event_time'
           WHEN 3 THEN 'invalid_numeric_value' WHEN 4 THEN 'invalid_numeric_value'
           WHEN 5 THEN 'invalid_scenario'
           WHEN 6 THEN 'invalid_ground_truth'
           WHEN 7 THEN 'invalid_source_label'
           WHEN 8 THEN 'scenario_metadata_mismatch'
         END AS reason
  FROM events
), valid AS (SELECT * FROM records WHERE reason IS NULL)"""


def rule_score(valid: DataFrame) -> DataFrame:
    """A frozen rule in place of a model: attack when value is high enough."""
    attack = F.least(F.lit(1.0), F.col("value") / (2.0 * ATTACK_FROM))
    scored = valid.withColumns(
        {
            "prediction": F.when(F.col("value") >= ATTACK_FROM, 1.0).otherwise(0.0),
            "probability": F.array(F.lit(1.0) - attack, attack),
        }
    )
    return alert_ops.name_predictions(scored)


def predictions(events: DataFrame) -> DataFrame:
    """All events as predictions, without the way through JSON."""
    moment = F.col("ts").cast("timestamp")
    fields = _event_fields()
    flat = events.select(
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        moment.alias("kafka_timestamp"),
        iso_millis(moment).alias("event_time"),
        F.date_trunc("millisecond", moment).alias("event_timestamp"),
        *[expr.alias(name) for name, expr in fields.items()],
        "value",
    )
    return rule_score(flat).select(*alert_ops.PREDICTION_COLUMNS)


PREDICTIONS_SQL = f"""
preds AS (
  SELECT event_id, ts, user_id, (user_id % 4)::INT AS part, value,
         date_trunc('millisecond', ts) AS et,
         CASE WHEN value >= {ATTACK_FROM} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
         CASE WHEN value >= {ATTACK_FROM} THEN 'Attack' ELSE 'Normal' END AS prediction_label,
         CASE WHEN event_type = 'error' THEN 'Attack' ELSE 'Normal' END AS ground_truth,
         CASE WHEN event_type = 'error' THEN 'DDOS-ERROR' ELSE 'BENIGN' END AS source_label,
         CASE WHEN user_id % 3 = 0 THEN 'MIXED' WHEN event_type = 'error' THEN 'DDOS_BURST'
              ELSE 'NORMAL' END AS scenario
  FROM events
)"""


def windows_sql(source: str, name: str = "metrics") -> str:
    """Sliding one-hour windows every 30 minutes over (ts, prediction) rows."""
    return f"""
{name}_starts AS (
  SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts),
                 time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS window_start,
         prediction
  FROM {source}
), {name}_counts AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
         count(*)::BIGINT AS event_count,
         (count(*) FILTER (prediction = 0.0))::BIGINT AS normal_count,
         (count(*) FILTER (prediction = 1.0))::BIGINT AS attack_count
  FROM {name}_starts GROUP BY window_start
), {name} AS (
  SELECT *, event_count / 3600.0::DOUBLE AS event_rate,
         normal_count::DOUBLE / event_count AS normal_rate,
         attack_count::DOUBLE / event_count AS attack_rate,
         CASE WHEN attack_count::DOUBLE / event_count < 0.2 THEN 'Normal'
              WHEN attack_count::DOUBLE / event_count < 0.8 THEN 'Warning'
              ELSE 'Critical' END AS status
  FROM {name}_counts
)"""


METRICS_SQL = PREDICTIONS_SQL + "," + windows_sql("preds")
VALID_METRICS_SQL = (
    RECORDS_SQL
    + f""", vpreds AS (
  SELECT *, CASE WHEN value >= {ATTACK_FROM} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM valid
),"""
    + windows_sql("vpreds")
)

METRIC_OUT_SQL = """
  window_start, window_end, event_count, normal_count, attack_count,
  round(event_rate, 6) AS event_rate, round(normal_rate, 6) AS normal_rate,
  round(attack_rate, 6) AS attack_rate, status"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window metrics over the predictions of all events."""
    return window_metrics(predictions(table(spark, sf_dir, "events")), PLAN)


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output form that two engines can be compared on: rounded, zone-free times."""
    return df.select(
        *[
            F.round(F.col(f"`{n}`"), digits).alias(n)
            if t == "double"
            else F.col(f"`{n}`").cast("timestamp_ntz").alias(n)
            if t == "timestamp"
            else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )
