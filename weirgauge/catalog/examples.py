"""Examples: deduplication, splits, leakage, weights, evaluation, promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import fingerprint
from ..operators import evaluate, examples
from ..operators.clean import clean
from ..operators.quality import counts_to_rows
from ..session import scratch
from ..sources import example_store
from . import inputs as i
from .registry import query

# Whole-number keys: two engines print the same integers, but not the same doubles.
KEY = ("q100", "d100", "t100", "target")
ROW = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def lines(spark, sf):
    """lineitem with a narrow example key (many copies) and a unique row key."""
    df = i.table(spark, sf, "lineitem")
    return df.select(
        *ROW,
        *[
            F.round(F.col(c) * 100).cast("bigint").alias(n)
            for n, c in (("q100", "l_quantity"), ("d100", "l_discount"), ("t100", "l_tax"))
        ],
        F.when(F.col("l_returnflag") == "N", 0).otherwise(1).alias("target"),
    )


def split_sql(key: str) -> str:
    return (
        f"CASE WHEN ('0x' || substr(md5({key}), 1, 8))::BIGINT < {int(0.70 * 2**32)} THEN 'train' "
        f"WHEN ('0x' || substr(md5({key}), 1, 8))::BIGINT < {int(0.85 * 2**32)} "
        "THEN 'validation' ELSE 'test' END"
    )


LINES = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(l_quantity * 100)::BIGINT AS q100, round(l_discount * 100)::BIGINT AS d100,
    round(l_tax * 100)::BIGINT AS t100, CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS target
  FROM lineitem
), keyed AS (
  SELECT *, concat_ws('|', q100, d100, t100, target) AS k,
    concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS r FROM lines
), byrow AS (SELECT *, sha256(k) AS f, {split_sql("r")} AS split FROM keyed
), uniq AS (SELECT DISTINCT q100, d100, t100, target, k FROM keyed
), byex AS (SELECT *, {split_sql("k")} AS split FROM uniq)"""


def split_by_row(spark, sf):
    """Copies of an example fall into several splits: the leak to be found."""
    printed = examples.with_fingerprint(lines(spark, sf), KEY)
    return examples.hash_split(printed, ROW)


def split_by_example(spark, sf):
    return examples.hash_split(lines(spark, sf).select(*KEY).distinct(), KEY)


@query(
    "q_dedup_examples",
    f"""WITH {i.FLOWS_SQL}
SELECT DISTINCT l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax,
  target AS binary_label FROM ready""",
)
def _(spark, sf):
    ready = clean(i.raw_flows(spark, sf), i.LINES, labelled=True, vector=False)
    return examples.unique_examples(ready, i.LINES)


@query(
    "q_row_fingerprint",
    f"""WITH {LINES}
SELECT f AS example_key, count(*) AS copies FROM byrow GROUP BY 1""",
)
def _(spark, sf):
    printed = lines(spark, sf).select(fingerprint(KEY).alias("example_key"))
    return printed.groupBy("example_key").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "q_hash_split",
    f"""WITH {LINES} SELECT q100, d100, t100, target, split FROM byex""",
)
def _(spark, sf):
    return split_by_example(spark, sf)


@query(
    "q_random_split",
    f"""WITH {LINES}
SELECT (SELECT count(*) FROM uniq) AS rows, true AS parts_cover_whole,
  true AS parts_are_disjoint, true AS shares_as_asked""",
)
def _(spark, sf):
    """The seeded random split: complete, disjoint, and of about the asked sizes."""
    unique = lines(spark, sf).select(*KEY).distinct()
    parts = examples.random_split(unique)
    tagged = None
    for name, part in parts.items():
        named = part.withColumn("split", F.lit(name))
        tagged = named if tagged is None else tagged.unionByName(named)
    owners = tagged.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.first("split").alias("split")
    )
    total = unique.agg(F.count(F.lit(1)).alias("n")).scalar()
    sums = owners.agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "validation", "test")],
    )
    near = [
        F.abs(F.col(s) / F.col("keys") - share) < 0.05
        for s, share in (("train", 0.70), ("validation", 0.15), ("test", 0.15))
    ]
    return sums.select(
        "rows",
        (F.col("rows") == total).alias("parts_cover_whole"),
        (F.col("rows") == F.col("keys")).alias("parts_are_disjoint"),
        (near[0] & near[1] & near[2]).alias("shares_as_asked"),
    )


@query(
    "q_split_overlap_keys",
    f"""WITH {LINES}
SELECT count(*) AS shared_keys FROM (SELECT f FROM byrow WHERE split = 'train'
  INTERSECT SELECT f FROM byrow WHERE split = 'test')""",
)
def _(spark, sf):
    rows = split_by_row(spark, sf)
    train, test = (rows.where(F.col("split") == s) for s in ("train", "test"))
    return examples.shared_keys(train, test).agg(F.count(F.lit(1)).alias("shared_keys"))


@query(
    "q_split_overlap_rows",
    f"""WITH {LINES}, a AS (SELECT f FROM byrow WHERE split = 'train'),
b AS (SELECT f FROM byrow WHERE split = 'test')
SELECT (SELECT count(*) FROM a WHERE f IN (SELECT f FROM b)) AS left_rows,
  (SELECT count(*) FROM b WHERE f IN (SELECT f FROM a)) AS right_rows""",
)
def _(spark, sf):
    rows = split_by_row(spark, sf)
    train, test = (rows.where(F.col("split") == s) for s in ("train", "test"))
    return examples.rows_with_shared_key(train, test)


def _pair_sql(a, b):
    return f"""SELECT 'before' AS stage, '{a}' AS left_split, '{b}' AS right_split,
  (SELECT count(*) FROM (SELECT f FROM byrow WHERE split = '{a}' INTERSECT
    SELECT f FROM byrow WHERE split = '{b}')) AS shared_keys,
  (SELECT count(*) FROM byrow WHERE split = '{a}' AND f IN
    (SELECT f FROM byrow WHERE split = '{b}')) AS left_rows,
  (SELECT count(*) FROM byrow WHERE split = '{b}' AND f IN
    (SELECT f FROM byrow WHERE split = '{a}')) AS right_rows
UNION ALL SELECT 'after', '{a}', '{b}', 0, 0, 0"""


@query(
    "q_leakage_report",
    f"WITH {LINES}\n"
    + "\nUNION ALL ".join(
        _pair_sql(a, b)
        for a, b in (("train", "validation"), ("train", "test"), ("validation", "test"))
    ),
)
def _(spark, sf):
    """Row-wise splitting leaks copies; splitting by the example's own hash cannot."""
    before = examples.leakage_report(split_by_row(spark, sf), examples.PRINT, "split")
    unique = examples.with_fingerprint(split_by_example(spark, sf), KEY)
    after = examples.leakage_report(unique, examples.PRINT, "split")
    return before.select(F.lit("before").alias("stage"), "*").unionByName(
        after.select(F.lit("after").alias("stage"), "*")
    )


BUCKETED = 8


def bucketed(spark, df, name, rows: int):
    """Rows with a fingerprint as a table of this session, in buckets for a table of ``rows``."""
    path = scratch(spark, name)
    buckets = example_store.buckets_for(rows, BUCKETED)
    return example_store.save(df, path.rpartition("/")[2].replace("-", "_"), path, buckets)


@query(
    "q_bucketed_leakage",
    f"WITH {LINES}\n"
    + "\nUNION ALL ".join(
        _pair_sql(a, b).partition("UNION ALL")[0].replace("'before' AS stage, ", "")
        for a, b in (("train", "validation"), ("train", "test"), ("validation", "test"))
    ),
)
def _(spark, sf):
    """The leak report over stored buckets: no exchange of rows."""
    stored = bucketed(spark, split_by_row(spark, sf), "examples", i.table(spark, sf, "lineitem").count())
    return examples.leakage_report(stored, examples.PRINT, "split")


@query(
    "q_bucketed_delivery",
    f"""WITH {LINES}
SELECT DISTINCT f AS example_key, q100, d100, t100, target FROM byrow WHERE l_suppkey % 2 = 1
  AND f NOT IN (SELECT f FROM byrow WHERE l_suppkey % 2 = 0)""",
)
def _(spark, sf):
    """A delivery against the stored examples, both in buckets: new ones only, once each."""
    rows, count = split_by_row(spark, sf), i.table(spark, sf, "lineitem").count()
    stored, delivered = (
        bucketed(spark, rows.where(F.col("l_suppkey") % 2 == part).select(examples.PRINT, *KEY).distinct(), name, count)
        for part, name in ((0, "examples"), (1, "delivery"))
    )
    return example_store.new_examples(delivered, stored)


@query(
    "q_split_distribution",
    f"""WITH {LINES}
SELECT split, count(*) AS rows, count(*) FILTER (target = 0) AS normal_rows,
  count(*) FILTER (target = 1) AS attack_rows,
  round(count(*) FILTER (target = 1) / count(*)::DOUBLE, 6) AS attack_share,
  round(count(*) / (SELECT count(*) FROM byex)::DOUBLE, 6) AS rows_share,
  true AS classes_cover_rows
FROM byex GROUP BY split""",
)
def _(spark, sf):
    return examples.split_distribution(split_by_example(spark, sf), "split", "target")


@query(
    "q_class_distribution",
    f"""WITH {LINES}
SELECT count(*) AS rows, count(*) FILTER (target = 0) AS normal_rows,
  count(*) FILTER (target = 1) AS attack_rows, 0::BIGINT AS other_rows,
  round(count(*) FILTER (target = 0) / count(*)::DOUBLE, 6) AS normal_share,
  round(count(*) FILTER (target = 1) / count(*)::DOUBLE, 6) AS attack_share
FROM uniq""",
)
def _(spark, sf):
    return examples.class_counts(lines(spark, sf).select(*KEY).distinct(), "target")


@query(
    "q_class_weights",
    f"""WITH {LINES}
SELECT count(*) AS rows, count(*) FILTER (target = 0) AS normal_rows,
  count(*) FILTER (target = 1) AS attack_rows,
  round(count(*) / (2.0::DOUBLE * count(*) FILTER (target = 0)), 9) AS normal_weight,
  round(count(*) / (2.0::DOUBLE * count(*) FILTER (target = 1)), 9) AS attack_weight
FROM byex WHERE split = 'train'""",
)
def _(spark, sf):
    train = split_by_example(spark, sf).where(F.col("split") == "train")
    return i.shown(examples.class_weights(train, "target"), 9)


@query(
    "q_class_weighted_rows",
    f"""WITH {LINES}, t AS (SELECT * FROM byex WHERE split = 'train'), w AS (
  SELECT count(*) / (2.0::DOUBLE * count(*) FILTER (target = 0)) AS n,
    count(*) / (2.0::DOUBLE * count(*) FILTER (target = 1)) AS a FROM t)
SELECT q100, d100, t100, target, round(CASE WHEN target = 0 THEN n ELSE a END, 9) AS class_weight
FROM t, w""",
)
def _(spark, sf):
    train = split_by_example(spark, sf).where(F.col("split") == "train").drop("split")
    return i.shown(examples.add_class_weight(train, "target"), 9)


@query(
    "q_label_coverage",
    f"""WITH {i.FLOWS_SQL}
SELECT 'MYSTERY' AS label, count(*) AS rows, 'seen_not_listed' AS side FROM flows WHERE q = 12
HAVING count(*) > 0
UNION ALL SELECT 'XSS', 0, 'listed_not_seen'""",
)
def _(spark, sf):
    listed = spark.createDataFrame([(n,) for n in i.LINES.dictionary], "label string")
    return examples.dictionary_coverage(i.raw_flows(spark, sf), "Label", listed)


# --- evaluation -------------------------------------------------------------

RULES = {
    "baseline": "value >= 50",
    "stricter": "value >= 100",
    "informed": "value >= 100 OR event_type = 'error'",
    "contrary": "value >= 40 AND event_type <> 'error'",
}


def judged(spark, sf):
    """Every event with its ground truth and the prediction of every rule."""
    return i.table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("truth"),
        *[F.when(F.expr(text), 1.0).otherwise(0.0).alias(name) for name, text in RULES.items()],
    )


def evaluations(spark, sf):
    return evaluate.evaluate_all(judged(spark, sf), "truth", {name: name for name in RULES})


def cells_sql(rule: str, name: str) -> str:
    hit, error = f"({RULES[rule]})", "event_type = 'error'"
    return f"""{name} AS (SELECT *, (tn + tp) / n::DOUBLE AS accuracy,
  coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS attack_precision,
  coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS attack_recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS attack_f1,
  coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS normal_specificity,
  coalesce(fp / nullif(tn + fp, 0)::DOUBLE, 0) AS false_positive_rate,
  (coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)
    + coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0)) / 2 AS balanced_accuracy
FROM (SELECT count(*) FILTER (NOT {hit} AND NOT {error}) AS tn,
    count(*) FILTER ({hit} AND NOT {error}) AS fp,
    count(*) FILTER (NOT {hit} AND {error}) AS fn,
    count(*) FILTER ({hit} AND {error}) AS tp, count(*) AS n FROM events))"""


@query(
    "q_confusion_matrix",
    f"WITH {cells_sql('baseline', 'e')} SELECT tn, fp, fn, tp, n AS rows FROM e",
)
def _(spark, sf):
    return evaluate.confusions(judged(spark, sf), "truth", {"": "baseline"}).drop("model")


@query(
    "q_binary_metrics",
    f"""WITH {cells_sql('baseline', 'e')} SELECT tn, fp, fn, tp, n AS rows,
"""
    + ", ".join(f"round({m}, 6) AS {m}" for m in evaluate.RATES)
    + ", round(1 - attack_recall, 6) AS attack_miss_rate FROM e",
)
def _(spark, sf):
    return i.shown(evaluate.evaluate(judged(spark, sf), "truth", "baseline"))


@query(
    "q_metric_comparison",
    f"WITH {cells_sql('baseline', 'b')}, {cells_sql('stricter', 'c')}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{m}' AS metric, round(b.{m}, 6) AS baseline, round(c.{m}, 6) AS candidate, "
        f"round(c.{m} - b.{m}, 6) AS delta FROM b, c"
        for m in evaluate.RATES
    ),
)
def _(spark, sf):
    return i.shown(evaluate.compare(evaluations(spark, sf), "baseline", "stricter"))


@query(
    "q_promotion_decision",
    f"WITH {cells_sql('baseline', 'b')}, "
    + ", ".join(cells_sql(r, r) for r in ("stricter", "informed", "contrary"))
    + "\n"
    + "\nUNION ALL ".join(
        f"""SELECT '{r}' AS candidate_rule,
  round(c.normal_specificity - b.normal_specificity, 6) AS specificity_delta,
  round(c.attack_recall - b.attack_recall, 6) AS recall_delta,
  CASE WHEN c.normal_specificity > b.normal_specificity AND c.attack_recall >= b.attack_recall
    THEN '{evaluate.CLEAR_GAIN}'
  WHEN c.normal_specificity <= b.normal_specificity AND c.attack_recall <= b.attack_recall
    THEN '{evaluate.KEEP_BASELINE}' ELSE '{evaluate.TRADE_OFF}' END AS decision
FROM b, {r} c"""
        for r in ("stricter", "informed", "contrary")
    ),
)
def _(spark, sf):
    """One clear gain, one clear loss and one trade-off against the same baseline."""
    scored, decided = evaluations(spark, sf), None
    for rule in ("stricter", "informed", "contrary"):
        compared = evaluate.compare(scored, "baseline", rule)
        one = evaluate.promotion(compared).withColumn("candidate_rule", F.lit(rule))
        decided = one if decided is None else decided.unionByName(one)
    return i.shown(decided)


@query(
    "q_expectation_check",
    f"""WITH {cells_sql('baseline', 'e')}
SELECT 'tp' AS metric, tp::DOUBLE AS expected, tp::DOUBLE AS actual, true AS matches FROM e
UNION ALL SELECT 'fp', fp + 1.0::DOUBLE, fp::DOUBLE, false FROM e
UNION ALL SELECT 'attack_recall', round(attack_recall + 5e-7, 6), round(attack_recall, 6), true FROM e
UNION ALL SELECT 'accuracy', round(accuracy + 1e-5, 6), round(accuracy, 6), false FROM e
UNION ALL SELECT 'not_measured', 1.0::DOUBLE, NULL, false""",
)
def _(spark, sf):
    """Counts must agree exactly, rates within a millionth."""
    found = evaluate.evaluate(judged(spark, sf), "truth", "baseline")
    names = ("tp", "fp", "attack_recall", "accuracy")
    actual = counts_to_rows(
        found.select(*[F.col(n).cast("double").alias(n) for n in names]),
        {n: {"actual": n} for n in names},
        "metric",
    )
    shift = {"tp": (0.0, 0.0), "fp": (1.0, 0.0), "attack_recall": (5e-7, 1e-6)}
    shift["accuracy"] = (1e-5, 1e-6)
    expected = None
    for name, (off, tolerance) in shift.items():
        one = actual.where(F.col("metric") == name).select(
            "metric",
            (F.col("actual") + off).alias("expected"),
            F.lit(tolerance).alias("tolerance"),
        )
        expected = one if expected is None else expected.unionByName(one)
    absent = actual.select(
        F.lit("not_measured").alias("metric"),
        F.lit(1.0).alias("expected"),
        F.lit(0.0).alias("tolerance"),
    ).limit(1)
    checked = evaluate.check_expectations(actual, expected.unionByName(absent))
    return i.shown(checked.select("metric", "expected", "actual", "matches"))


@query(
    "q_scenario_summary",
    f"""WITH {i.PREDICTIONS_SQL}
SELECT scenario, count(*) AS events, count(*) FILTER (prediction_label = 'Normal') AS predicted_normal,
  count(*) FILTER (prediction_label = 'Attack') AS predicted_attack,
  count(*) FILTER (prediction_label = ground_truth) AS matches,
  count(*) FILTER (prediction_label <> ground_truth) AS mismatches,
  count(*) FILTER (prediction = 1.0) AS alerts
FROM preds GROUP BY scenario""",
)
def _(spark, sf):
    return evaluate.scenario_summary(i.predictions(i.table(spark, sf, "events")))
