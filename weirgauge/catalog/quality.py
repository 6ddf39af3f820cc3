"""Cells, labels, cleaning and profiles of the flow table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import ContractError, require_columns
from ..functions.cells import cell_problem, ref
from ..functions.labels import label_is_known, tidy_label
from ..operators import clean, profile, quality, sketches
from ..session import scratch
from . import inputs as i
from .registry import query

FLOWS = i.FLOWS_SQL
NAMES = list(i.LINES.numeric)


@query(
    "q_required_columns",
    f"""WITH {FLOWS} SELECT frame, accepted, CASE WHEN accepted THEN (SELECT count(*) FROM flows) END AS rows
FROM (VALUES ('complete', true), ('without_price', false)) t(frame, accepted)""",
)
def _(spark, sf):
    """The column contract passes the rows of the full table and refuses one without a column."""
    flows = i.raw_flows(spark, sf)
    verdicts = []
    for name, df in (("complete", flows), ("without_price", flows.drop("price"))):
        try:
            verdicts.append((name, True, require_columns(df, i.LINES.columns).count()))
        except ContractError:
            verdicts.append((name, False, None))
    return spark.createDataFrame(verdicts, "frame string, accepted boolean, rows bigint")


@query(
    "q_cell_problems",
    f"""WITH {FLOWS}
SELECT CASE q WHEN 0 THEN 'missing' WHEN 1 THEN 'missing' WHEN 2 THEN 'invalid_cast'
  WHEN 3 THEN 'nan' WHEN 4 THEN 'positive_inf' WHEN 5 THEN 'negative_inf'
  ELSE 'valid' END AS problem, count(*) AS cells
FROM flows GROUP BY 1""",
)
def _(spark, sf):
    judged = i.raw_flows(spark, sf).select(
        F.coalesce(cell_problem(ref("qty")), F.lit("valid")).alias("problem")
    )
    return judged.groupBy("problem").agg(F.count(F.lit(1)).alias("cells"))


@query(
    "q_rows_by_problem",
    f"""WITH {FLOWS}
SELECT 'missing' AS problem, count(*) FILTER (q IN (0, 1, 7)) AS rows FROM flows
UNION ALL SELECT 'invalid_cast', count(*) FILTER (q IN (2, 6)) FROM flows
UNION ALL SELECT 'nan', count(*) FILTER (q IN (3, 8)) FROM flows
UNION ALL SELECT 'positive_inf', count(*) FILTER (q = 4) FROM flows
UNION ALL SELECT 'negative_inf', count(*) FILTER (q = 5) FROM flows""",
)
def _(spark, sf):
    return quality.rows_by_problem(i.raw_flows(spark, sf), i.LINES.features)


@query(
    "q_invalid_labels",
    f"""WITH {FLOWS}
SELECT CASE q WHEN 10 THEN NULL WHEN 11 THEN '' ELSE 'MYSTERY' END AS label, count(*) AS rows
FROM flows WHERE q IN (10, 11, 12) GROUP BY 1""",
)
def _(spark, sf):
    bad = i.raw_flows(spark, sf).where(~label_is_known(i.LINES))
    return bad.groupBy(tidy_label(ref("Label")).alias("label")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "q_bulk_cast",
    f"""WITH {FLOWS}
SELECT count(*) AS rows,
  count(*) FILTER (q NOT IN (0, 1, 2)) AS qty_present,
  count(*) FILTER (q <> 9) AS tot_sum_present,
  count(*) FILTER (q = 13) AS tot_sum_infinite,
  count(*) FILTER (q = 8) AS tax_nan,
  round(sum(l_extendedprice) FILTER (q <> 6), 2) AS price_sum,
  count(*) FILTER (q <> 10) AS label_present
FROM flows""",
)
def _(spark, sf):
    """Text becomes double or NULL; infinities and NaN stay, other columns pass."""
    numbers = clean.to_numbers(i.raw_flows(spark, sf), i.LINES)
    return numbers.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("qty").alias("qty_present"),
        F.count(ref("Tot sum")).alias("tot_sum_present"),
        F.count_if(ref("Tot sum") == float("-inf")).alias("tot_sum_infinite"),
        F.count_if(F.isnan("tax")).alias("tax_nan"),
        F.round(F.sum("price"), 2).alias("price_sum"),
        F.count("Label").alias("label_present"),
    )


@query(
    "q_binary_label",
    f"""WITH {FLOWS}, l AS (
  SELECT CASE q WHEN 10 THEN NULL WHEN 11 THEN '' WHEN 12 THEN 'MYSTERY' ELSE lab END AS label
  FROM flows)
SELECT label, CASE WHEN label = 'BENIGN' THEN 0.0::DOUBLE
  WHEN label IN ('DDOS-A', 'DOS-R') THEN 1.0::DOUBLE END AS binary_label, count(*) AS rows
FROM l GROUP BY 1, 2""",
)
def _(spark, sf):
    mapped = clean.add_target(i.raw_flows(spark, sf), i.LINES)
    return mapped.groupBy(F.col("Label").alias("label"), "binary_label").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "q_clean_labelled",
    f"""WITH {FLOWS}
SELECT lab AS label, target AS binary_label, count(*) AS rows,
  round(sum(l_quantity), 2) AS qty_sum, round(sum(l_extendedprice), 2) AS price_sum,
  round(sum(l_discount), 2) AS disc_sum, round(sum(l_tax), 2) AS tax_sum,
  count(*) FILTER (q = 9) AS tot_sum_missing, count(*) FILTER (q = 13) AS tot_sum_infinite
FROM ready GROUP BY 1, 2""",
)
def _(spark, sf):
    """Bad features and labels drop the row, bad cells elsewhere do not."""
    ready = clean.clean(i.raw_flows(spark, sf), i.LINES, labelled=True, vector=False)
    return ready.groupBy(F.col("Label").alias("label"), "binary_label").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.round(F.sum(n), 2).alias(f"{n}_sum") for n in i.LINES.features],
        F.count_if(ref("Tot sum").isNull()).alias("tot_sum_missing"),
        F.count_if(ref("Tot sum") == float("-inf")).alias("tot_sum_infinite"),
    )


@query(
    "q_clean_unlabelled",
    f"""WITH {FLOWS}
SELECT count(*) AS rows, round(sum(l_quantity), 2) AS qty_sum,
  round(sum(l_extendedprice), 2) AS price_sum
FROM flows WHERE q > 8""",
)
def _(spark, sf):
    features = clean.project_features(i.raw_flows(spark, sf), i.LINES)
    ready = clean.clean(features, i.LINES, labelled=False, vector=False)
    return ready.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("qty"), 2).alias("qty_sum"),
        F.round(F.sum("price"), 2).alias("price_sum"),
    )


@query(
    "q_feature_projection",
    f"""WITH {FLOWS}
SELECT l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax, target
FROM ready""",
)
def _(spark, sf):
    ready = clean.clean(i.raw_flows(spark, sf), i.LINES, labelled=True, vector=False)
    return clean.project_features(ready, i.LINES, "binary_label").withColumnRenamed(
        "binary_label", "target"
    )


@query(
    "q_assembled_vectors",
    f"""WITH {FLOWS}
SELECT target, round(sum(l_quantity), 2) AS v0_sum, round(sum(l_extendedprice), 2) AS v1_sum,
  round(sum(l_discount), 2) AS v2_sum, round(sum(l_tax), 2) AS v3_sum, true AS json_agrees
FROM ready GROUP BY target""",
)
def _(spark, sf):
    """Vector entries in feature order, and the same read back from its JSON form."""
    from pyspark.ml.functions import vector_to_array

    ready = clean.clean(i.raw_flows(spark, sf), i.LINES, labelled=True)
    told = clean.vector_json(ready, i.LINES).select(
        F.col("binary_label").alias("target"),
        vector_to_array("features").alias("v"),
        F.from_json("features_json", "array<double>").alias("j"),
    )
    return told.groupBy("target").agg(
        *[F.round(F.sum(F.col("v")[n]), 2).alias(f"v{n}_sum") for n in range(4)],
        F.bool_and(F.col("v") == F.col("j")).alias("json_agrees"),
    )


@query(
    "q_vector_dims",
    f"""WITH {FLOWS}
SELECT 4::BIGINT AS dimension, count(*) AS rows, true AS as_declared FROM ready""",
)
def _(spark, sf):
    return clean.vector_sizes(
        clean.clean(i.raw_flows(spark, sf), i.LINES, labelled=True), i.LINES
    )


@query(
    "q_numeric_issue_profile",
    f"""WITH {FLOWS}, p AS (
SELECT 'qty' AS column_name, count(*) FILTER (q IN (0, 1)) AS missing,
  count(*) FILTER (q = 2) AS invalid_cast, count(*) FILTER (q = 3) AS nan,
  count(*) FILTER (q = 4) AS positive_inf, count(*) FILTER (q = 5) AS negative_inf FROM flows
UNION ALL SELECT 'price', 0, count(*) FILTER (q = 6), 0, 0, 0 FROM flows
UNION ALL SELECT 'disc', count(*) FILTER (q = 7), 0, 0, 0, 0 FROM flows
UNION ALL SELECT 'tax', 0, 0, count(*) FILTER (q = 8), 0, 0 FROM flows
UNION ALL SELECT 'Tot sum', 0, count(*) FILTER (q = 9), 0, 0, count(*) FILTER (q = 13) FROM flows)
SELECT * FROM p WHERE missing + invalid_cast + nan + positive_inf + negative_inf > 0""",
)
def _(spark, sf):
    return quality.issue_profile(i.raw_flows(spark, sf), NAMES)


@query(
    "q_post_clean_invariants",
    f"""WITH {FLOWS}
SELECT (SELECT count(*) FROM ready) AS rows, true AS all_features_finite,
  true AS all_rows_labelled, true AS label_free_path_keeps_same_rows,
  true AS label_free_path_adds_no_label""",
)
def _(spark, sf):
    """Cleaning leaves nothing invalid, and the label-free path keeps the same rows."""
    flows = i.raw_flows(spark, sf)
    labelled = clean.clean(flows, i.LINES, labelled=True, vector=False)
    features = clean.project_features(flows.where(label_is_known(i.LINES)), i.LINES)
    return quality.clean_report(
        labelled, clean.clean(features, i.LINES, labelled=False, vector=False), i.LINES
    )


@query(
    "q_label_tallies",
    f"""WITH {FLOWS}
SELECT count(*) FILTER (q = 10) AS null_rows, count(*) FILTER (q = 11) AS empty_rows,
  count(*) FILTER (q NOT IN (10, 11, 12) AND lab = 'BENIGN') AS normal_rows,
  count(*) FILTER (q NOT IN (10, 11, 12) AND lab <> 'BENIGN') AS attack_rows,
  count(*) FILTER (q = 12) AS unknown_rows
FROM flows""",
)
def _(spark, sf):
    return quality.label_tallies(i.raw_flows(spark, sf), i.LINES)


@query(
    "q_clean_funnel",
    f"""WITH {FLOWS}, c AS (SELECT (SELECT count(*) FROM flows) AS raw_rows,
  (SELECT count(*) FROM ready) AS ready_rows,
  (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_extendedprice, l_discount, l_tax, target
   FROM ready)) AS unique_rows)
SELECT raw_rows, ready_rows, unique_rows, raw_rows - ready_rows AS removed_by_cleaning,
  round((raw_rows - ready_rows) / raw_rows::DOUBLE, 6) AS removed_by_cleaning_share,
  ready_rows - unique_rows AS removed_as_copies,
  round((ready_rows - unique_rows) / ready_rows::DOUBLE, 6) AS removed_as_copies_share
FROM c""",
)
def _(spark, sf):
    return clean.funnel(i.raw_flows(spark, sf), i.LINES)


@query(
    "q_quality_scorecard",
    f"""WITH {FLOWS}, txt AS (
  SELECT CASE WHEN q = 0 THEN NULL WHEN q = 1 THEN '  ' WHEN q = 2 THEN 'abc' WHEN q = 3 THEN 'NaN'
      WHEN q = 4 THEN 'Infinity' WHEN q = 5 THEN '-Infinity' ELSE l_quantity::VARCHAR END AS a,
    CASE WHEN q = 6 THEN 'n/a' ELSE l_extendedprice::VARCHAR END AS b,
    CASE WHEN q = 7 THEN NULL ELSE l_discount::VARCHAR END AS c,
    CASE WHEN q = 8 THEN 'NaN' ELSE l_tax::VARCHAR END AS d,
    CASE WHEN q = 9 THEN 'oops' WHEN q = 13 THEN '-Infinity' ELSE l_quantity::VARCHAR END AS e,
    CASE WHEN q = 14 THEN '0' ELSE '1' END AS f,
    CASE q WHEN 10 THEN NULL WHEN 11 THEN '' WHEN 12 THEN 'MYSTERY' ELSE lab END AS g, q
  FROM flows)
, s AS (
SELECT 'raw' AS stage, count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT a,b,c,d,e,f,g FROM txt)) AS u,
  count(a) + count(b) + count(c) + count(d) + count(e) + count(f) + count(*) + count(g) AS p,
  count(*) FILTER (q > 8) AS v, count(*) FILTER (q NOT IN (10, 11, 12)) AS k FROM txt
UNION ALL
SELECT 'cleaned', count(*), (SELECT count(*) FROM (SELECT DISTINCT a,b,c,d,e,f,g FROM txt
    WHERE q > 8 AND q NOT IN (10, 11, 12))),
  count(*) * 8 - count(*) FILTER (q = 9), count(*), count(*)
FROM txt WHERE q > 8 AND q NOT IN (10, 11, 12))
SELECT stage, 'uniqueness' AS dimension, round(u / n::DOUBLE, 6) AS share FROM s
UNION ALL SELECT stage, 'completeness', round(p / (8.0::DOUBLE * n), 6) FROM s
UNION ALL SELECT stage, 'validity', round(v / n::DOUBLE, 6) FROM s
UNION ALL SELECT stage, 'consistency', round(k / n::DOUBLE, 6) FROM s""",
)
def _(spark, sf):
    """The same four quality dimensions before and after cleaning."""
    flows = i.raw_flows(spark, sf)
    ready = clean.clean(flows, i.LINES, labelled=True, vector=False)
    before = quality.scorecard(flows, i.LINES, "raw")
    return i.shown(before.unionByName(quality.scorecard(ready, i.LINES, "cleaned")))


# --- profiles ---------------------------------------------------------------

@query(
    "q_column_types",
    """SELECT column_name, CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT')
  THEN 'numeric' ELSE 'other' END AS kind, (SELECT count(*) FROM lineitem) AS values
FROM (DESCRIBE lineitem) t(column_name, data_type, a, b, c, d)""",
)
def _(spark, sf):
    """Kind of every column, beside how many values it has."""
    lines = i.table(spark, sf, "lineitem")
    kinds = spark.createDataFrame(list(profile.column_kinds(lines).items()), "column_name string, kind string")
    filled = profile.distinct_estimates(lines).select("column_name", (F.col("rows") - F.col("null_rows")).alias("values"))
    return kinds.join(filled, "column_name")


@query(
    "q_label_column",
    f"""WITH {FLOWS} SELECT * FROM (VALUES ('labels', 'toxic', 'toxic', (SELECT count(toxic) FROM labels)),
  ('embeddings', NULL, 'label', (SELECT count(label) FROM embeddings)), ('orders', NULL, NULL, NULL),
  ('flows', 'LABEL', 'Label', (SELECT count(*) FROM flows WHERE q <> 10))) t(frame, wanted, found, labelled)""",
)
def _(spark, sf):
    """Label column by given or usual name, and its rows with a label; none or several give nothing."""
    frames = {
        "labels": (i.table(spark, sf, "labels"), "toxic"),
        "embeddings": (i.table(spark, sf, "embeddings"), None),
        "orders": (i.table(spark, sf, "orders"), None),
        "flows": (i.raw_flows(spark, sf), "LABEL"),
    }
    rows = []
    for name, (df, wanted) in frames.items():
        try:
            found = profile.find_label_column(df.columns, wanted)
            rows.append((name, wanted, found, df.agg(F.count(ref(found))).first()[0]))
        except ContractError:
            rows.append((name, wanted, None, None))
    return spark.createDataFrame(rows, "frame string, wanted string, found string, labelled bigint")


@query(
    "q_label_distribution",
    f"""WITH {FLOWS}, l AS (
  SELECT CASE q WHEN 10 THEN NULL WHEN 11 THEN '' WHEN 12 THEN 'MYSTERY' ELSE lab END AS label
  FROM flows)
SELECT label, count(*) AS rows,
  round(count(*) / (SELECT count(*) FROM flows)::DOUBLE, 6) AS share
FROM l GROUP BY label ORDER BY rows DESC, label""",
)
def _(spark, sf):
    flows = i.raw_flows(spark, sf).select(tidy_label(ref("Label")).alias("label"))
    return i.shown(profile.value_shares(flows, "label"))


@query(
    "q_binary_mapping_proposal",
    f"""WITH {FLOWS}
SELECT 1::BIGINT AS normal_like_labels, true AS accepted, ' benign ' AS normal_label,
  count(*) FILTER (q NOT IN (10, 11, 12) AND lab = 'BENIGN') AS normal_rows,
  count(*) FILTER (q IN (10, 11, 12) OR lab <> 'BENIGN') AS attack_rows
FROM flows""",
)
def _(spark, sf):
    return profile.mapping_proposal(i.raw_flows(spark, sf), "Label")


@query(
    "q_null_profile",
    f"""WITH {FLOWS}
SELECT 'qty' AS column_name, count(*) FILTER (q = 0) AS null_rows FROM flows
UNION ALL SELECT 'disc', count(*) FILTER (q = 7) FROM flows
UNION ALL SELECT 'Label', count(*) FILTER (q = 10) FROM flows
UNION ALL SELECT c, 0 FROM (VALUES ('price'), ('tax'), ('Tot sum'), ('IPv'), ('LLC')) t(c)""",
)
def _(spark, sf):
    return quality.column_null_counts(i.raw_flows(spark, sf))


@query(
    "q_nonfinite_profile",
    f"""WITH {FLOWS}
SELECT 'qty' AS column_name, count(*) FILTER (q = 3) AS nan,
  count(*) FILTER (q = 4) AS positive_inf, count(*) FILTER (q = 5) AS negative_inf FROM flows
UNION ALL SELECT 'tax', count(*) FILTER (q = 8), 0, 0 FROM flows
UNION ALL SELECT 'Tot sum', 0, 0, count(*) FILTER (q = 13) FROM flows
UNION ALL SELECT c, 0, 0, 0 FROM (VALUES ('price'), ('disc'), ('IPv'), ('LLC')) t(c)""",
)
def _(spark, sf):
    numbers = clean.to_numbers(i.raw_flows(spark, sf), i.LINES)
    return quality.non_finite_counts(numbers, NAMES)


@query(
    "q_string_numeric_quality",
    f"""WITH {FLOWS}
SELECT 'qty' AS column_name, count(*) FILTER (q IN (1, 2)) AS invalid_numeric,
  count(*) FILTER (q = 3) AS nan, count(*) FILTER (q = 4) AS positive_inf,
  count(*) FILTER (q = 5) AS negative_inf FROM flows
UNION ALL SELECT 'price', count(*) FILTER (q = 6), 0, 0, 0 FROM flows
UNION ALL SELECT 'disc', 0, 0, 0, 0
UNION ALL SELECT 'tax', 0, count(*) FILTER (q = 8), 0, 0 FROM flows
UNION ALL SELECT 'Tot sum', count(*) FILTER (q = 9), 0, 0, count(*) FILTER (q = 13) FROM flows
UNION ALL SELECT 'IPv', 0, 0, 0, 0
UNION ALL SELECT 'LLC', 0, 0, 0, 0""",
)
def _(spark, sf):
    return quality.text_number_quality(i.raw_flows(spark, sf), NAMES)


@query(
    "q_exact_duplicates",
    """WITH w AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 3 = 0),
d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM w)), r AS (SELECT count(*) AS n FROM w)
SELECT r.n AS rows, d.n AS distinct_rows, r.n - d.n AS duplicate_rows FROM r, d""",
)
def _(spark, sf):
    """All columns of the line table, a third of whose rows come twice."""
    lines = i.table(spark, sf, "lineitem")
    return profile.duplicate_rows(lines.unionByName(lines.where(F.col("l_orderkey") % 3 == 0)))


LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


@query(
    "q_approx_distinct",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS exact, true AS within_15_percent FROM lineitem"
        for c in LINE_COLUMNS
    ),
)
def _(spark, sf):
    """The sketch against the exact distinct count of every column."""
    lines = i.table(spark, sf, "lineitem")
    return _against_exact(profile.distinct_estimates(lines), lines).select("column_name", "exact", "within_15_percent")


def _against_exact(estimates, rows):
    """Estimates beside the exact distinct counts of all columns."""
    cells = [F.struct(F.lit(n).alias("column_name"), F.col(n).cast("string").alias("v")) for n in rows.columns]
    long = rows.select(F.inline(F.array(*cells))).where(F.col("v").isNotNull())
    exact = long.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("exact"))
    off = F.abs(F.col("approx_distinct") - F.col("exact")) / F.col("exact")
    return estimates.join(exact, "column_name").withColumn("within_15_percent", off <= 0.15)


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@query(
    "q_stored_sketches",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT ts::DATE) AS days, count(*) AS rows, count(*) - count({c}) AS null_rows, "
        f"count(DISTINCT {c}) <= 10 AS low_cardinality, true AS within_15_percent FROM events"
        for c in EVENT_COLUMNS
    ),
)
def _(spark, sf):
    """Sketches stored by day, some days replaced and others added later, profiled without the rows."""
    events, path = i.table(spark, sf, "events"), scratch(spark, "sketches")
    for first, last in ((1, 20), (15, 18), (21, 31)):
        part = events.where(F.dayofmonth("ts").between(first, last))
        sketches.store_days(part, F.col("ts"), path, EVENT_COLUMNS)
    shown = _against_exact(sketches.stored_profile(spark, path), events.select(*EVENT_COLUMNS))
    return shown.select("column_name", "days", "rows", "null_rows", "low_cardinality", "within_15_percent")


NEAR = """near AS (
  SELECT o_orderstatus, o_orderpriority, o_custkey, 'x' AS constant,
    CASE WHEN o_orderkey % 100 < 3 THEN o_orderkey::VARCHAR ELSE 'usual' END AS spread,
    CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey END AS rare,
    CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey ELSE 7 END AS often FROM orders
)"""
NEAR_COLUMNS = ("o_orderstatus", "o_orderpriority", "o_custkey", "constant", "spread", "rare", "often")


@query(
    "q_near_constant",
    f"WITH {NEAR}, v AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS rows FROM near GROUP BY 2" for c in NEAR_COLUMNS
    )
    + """), s AS (SELECT *, rows / sum(rows) OVER (PARTITION BY column_name)::DOUBLE AS share FROM v)
SELECT column_name, value, rows, round(share, 6) AS share FROM s WHERE share >= 0.95""",
)
def _(spark, sf):
    """Nearly constant columns whatever the number of their values, NULL counted as one."""
    key = F.col("o_orderkey")
    orders = i.table(spark, sf, "orders").select(
        "o_orderstatus",
        "o_orderpriority",
        "o_custkey",
        F.lit("x").alias("constant"),
        F.when(key % 100 < 3, key.cast("string")).otherwise("usual").alias("spread"),
        F.when(key % 50 == 0, key).alias("rare"),
        F.when(key % 10 == 0, key).otherwise(7).alias("often"),
    )
    return sketches.near_constant(orders)


@query("q_constant_columns", "SELECT 'IPv' AS column_name")
def _(spark, sf):
    return profile.constant_columns(i.raw_flows(spark, sf))


@query(
    "q_low_cardinality",
    "SELECT c AS column_name FROM (VALUES ('o_orderstatus'), ('o_orderpriority')) t(c)",
)
def _(spark, sf):
    """Columns with few values; the others are far from the limit at every scale."""
    return profile.low_cardinality_columns(i.table(spark, sf, "orders"))


@query(
    "q_dominant_values",
    """WITH v AS (
  SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS rows FROM orders GROUP BY 2
  UNION ALL
  SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
  UNION ALL
  SELECT 'constant', '1', count(*) FROM orders
), r AS (
  SELECT *, sum(rows) OVER (PARTITION BY column_name) AS n,
    row_number() OVER (PARTITION BY column_name ORDER BY rows DESC, value) AS p FROM v)
SELECT column_name, value, rows, round(rows / n::DOUBLE, 6) AS share,
  rows / n::DOUBLE >= 0.95 AS near_constant FROM r WHERE p = 1""",
)
def _(spark, sf):
    orders = i.table(spark, sf, "orders").withColumn("constant", F.lit("1"))
    return profile.dominant_values(orders)


@query(
    "q_pair_equality",
    f"""WITH {FLOWS}
SELECT 'qty == Tot sum' AS pair, count(*) FILTER (q NOT IN (0, 1, 2, 3, 4, 5, 9, 13)) AS equal_rows,
  round(count(*) FILTER (q NOT IN (0, 1, 2, 3, 4, 5, 9, 13)) / count(*)::DOUBLE, 6) AS share FROM flows
UNION ALL SELECT 'IPv == LLC', count(*) FILTER (q <> 14),
  round(count(*) FILTER (q <> 14) / count(*)::DOUBLE, 6) FROM flows""",
)
def _(spark, sf):
    pairs = (("qty", "Tot sum"), ("IPv", "LLC"))
    return profile.pair_equality(i.raw_flows(spark, sf), pairs)


@query(
    "q_numeric_stats",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS min_value, "
        f"round(avg({c}), 4) AS mean_value, max({c})::DOUBLE AS max_value FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
    ),
)
def _(spark, sf):
    names = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
    return i.shown(profile.numeric_stats(i.table(spark, sf, "lineitem"), names), 4)
