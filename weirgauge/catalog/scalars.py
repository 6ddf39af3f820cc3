"""The scalar functions the operators rest on, one query per group."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cells import as_number
from ..functions.keys import fingerprint, hash_point
from ..functions.labels import fold_label
from ..functions.times import clock, iso_millis, parse_moment
from . import inputs as i
from .registry import query


@query(
    "q_scalar_string",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, upper(p_brand) AS upper_brand,
  length(p_type)::INT AS type_length, starts_with(p_type, 'PROMO') AS is_promo,
  regexp_matches(p_brand, '^Brand#[0-9]+$') AS brand_shape,
  p_brand || '/' || p_name AS joined,
  regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS folded FROM part""",
)
def _(spark, sf):
    return i.table(spark, sf, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.upper("p_brand").alias("upper_brand"),
        F.length("p_type").alias("type_length"),
        F.col("p_type").startswith("PROMO").alias("is_promo"),
        F.col("p_brand").rlike("^Brand#[0-9]+$").alias("brand_shape"),
        F.concat("p_brand", F.lit("/"), "p_name").alias("joined"),
        fold_label(F.col("p_brand")).alias("folded"),
    )


@query(
    "q_scalar_cast",
    """SELECT o_orderkey, try_cast(' ' || o_orderkey || ' ' AS DOUBLE) AS padded,
  try_cast(o_orderpriority AS DOUBLE) AS not_a_number,
  (o_custkey::DOUBLE) AS as_double, (o_orderkey::VARCHAR) AS as_text,
  try_cast(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS as_time,
  try_cast(o_orderstatus AS TIMESTAMP) AS not_a_time FROM orders""",
)
def _(spark, sf):
    padded = F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" "))
    return i.shown(
        i.table(spark, sf, "orders").select(
            "o_orderkey",
            as_number(padded).alias("padded"),
            as_number(F.col("o_orderpriority")).alias("not_a_number"),
            F.col("o_custkey").cast("double").alias("as_double"),
            F.col("o_orderkey").cast("string").alias("as_text"),
            parse_moment(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("as_time"),
            parse_moment(F.col("o_orderstatus")).alias("not_a_time"),
        )
    )


@query(
    "q_scalar_numeric",
    """WITH l AS (SELECT *, CASE l_linenumber WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN 'Infinity'::DOUBLE
  WHEN 3 THEN '-Infinity'::DOUBLE ELSE l_tax END AS x FROM lineitem)
SELECT l_linenumber, count(*) AS rows, count(*) FILTER (isnan(x)) AS nans,
  count(*) FILTER (x = 'Infinity'::DOUBLE) AS positive_inf,
  count(*) FILTER (x = '-Infinity'::DOUBLE) AS negative_inf,
  count(*) FILTER (isfinite(x)) AS finite,
  round(sum(l_quantity / nullif(l_discount, 0)), 2) AS safe_quotients,
  round(sum(greatest(0, least(100, l_extendedprice / 500 - 20))), 2) AS clamped
FROM l GROUP BY 1""",
)
def _(spark, sf):
    n = F.col("l_linenumber")
    x = (
        F.when(n == 1, float("nan")).when(n == 2, float("inf")).when(n == 3, float("-inf"))
    ).otherwise(F.col("l_tax"))
    lines = i.table(spark, sf, "lineitem").withColumn("x", x)
    price = F.col("l_extendedprice") / 500 - 20
    return lines.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.isnan("x")).alias("nans"),
        F.count_if(F.col("x") == float("inf")).alias("positive_inf"),
        F.count_if(F.col("x") == float("-inf")).alias("negative_inf"),
        F.count_if(F.abs("x") < float("inf")).alias("finite"),
        F.round(F.sum(F.try_divide("l_quantity", "l_discount")), 2).alias("safe_quotients"),
        F.round(F.sum(F.greatest(F.lit(0.0), F.least(F.lit(100.0), price))), 2).alias("clamped"),
    )


@query(
    "q_scalar_null_logic",
    """WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS s,
  nullif(o_orderpriority, '5-LOW') AS p FROM orders)
SELECT o_orderkey, s IS NULL AS s_missing, s IS NOT DISTINCT FROM nullif(s, 'O') AS same_or_null,
  coalesce(p IN ('1-URGENT', '2-HIGH'), false) AS pressing,
  CASE WHEN s = 'O' THEN 'open' WHEN s = 'P' THEN 'partial' ELSE 'other' END AS word FROM o""",
)
def _(spark, sf):
    orders = i.table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("s"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"),
    )
    word = F.when(F.col("s") == "O", "open").when(F.col("s") == "P", "partial").otherwise("other")
    return orders.select(
        "o_orderkey",
        F.col("s").isNull().alias("s_missing"),
        F.col("s").eqNullSafe(F.nullif("s", F.lit("O"))).alias("same_or_null"),
        F.coalesce(F.col("p").isin("1-URGENT", "2-HIGH"), F.lit(False)).alias("pressing"),
        word.alias("word"),
    )


@query(
    "q_scalar_datetime",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso,
  date_trunc('millisecond', ts) AS back, strftime(ts, '%H:%M:%S') AS clock,
  NULL::TIMESTAMP AS without_millis, time_bucket(INTERVAL 30 MINUTE, ts) AS bucket_start,
  time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS bucket_end FROM events""",
)
def _(spark, sf):
    moment = F.col("ts").cast("timestamp")
    iso = iso_millis(moment)
    short = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    pattern = F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX")
    bucket = F.window(moment, "30 minutes")
    rows = i.table(spark, sf, "events").select(
        "event_id",
        iso.alias("iso"),
        F.try_to_timestamp(iso, pattern).alias("back"),
        clock(moment).alias("clock"),
        F.try_to_timestamp(short, pattern).alias("without_millis"),
        bucket.alias("w"),
    )
    return i.shown(
        rows.select(
            *("event_id", "iso", "back", "clock", "without_millis"),
            F.col("w.start").alias("bucket_start"),
            F.col("w.end").alias("bucket_end"),
        )
    )


@query(
    "q_scalar_json_map",
    """SELECT event_id, (props->>'k')::DOUBLE AS k, (props->>'k') AS k_text,
  (props->>'z') AS absent, '{"t":"' || event_type || '","v":' || event_id || '}' AS packed
FROM events""",
)
def _(spark, sf):
    parsed = i.table(spark, sf, "events").select(
        "*",
        F.from_json("props", "map<string,string>").alias("m"),
        F.from_json("props", "k double").alias("s"),
    )
    return parsed.select(
        "event_id",
        F.col("s.k").alias("k"),
        F.try_element_at("m", F.lit("k")).alias("k_text"),
        F.try_element_at("m", F.lit("z")).alias("absent"),
        F.to_json(
            F.struct(F.col("event_type").alias("t"), F.col("event_id").alias("v"))
        ).alias("packed"),
    )


@query(
    "q_scalar_hash",
    """SELECT c_custkey, sha256(concat_ws('|', c_custkey, c_name, c_mktsegment)) AS print,
  ('0x' || substr(md5(concat_ws('|', c_custkey, c_nationkey)), 1, 8))::BIGINT AS point
FROM customer""",
)
def _(spark, sf):
    return i.table(spark, sf, "customer").select(
        "c_custkey",
        fingerprint(["c_custkey", "c_name", "c_mktsegment"]).alias("print"),
        hash_point(["c_custkey", "c_nationkey"]).alias("point"),
    )


@query(
    "q_scalar_aggregate",
    """SELECT o_orderpriority, count(*) AS rows, round(avg(o_totalprice), 2) AS mean_price,
  min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
  count(*) FILTER (o_orderstatus = 'O') AS open_orders FROM orders GROUP BY 1""",
)
def _(spark, sf):
    return (
        i.table(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(F.avg("o_totalprice"), 2).alias("mean_price"),
            F.min("o_totalprice").alias("min_price"),
            F.max("o_totalprice").alias("max_price"),
            F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
        )
    )
