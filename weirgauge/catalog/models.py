"""Forests: fitting, weighting, scoring, gate, contract and the whole job."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ..contracts import ContractError, FlowContract
from ..operators import clean, evaluate, examples, forest
from ..plans import training, verify
from ..session import path_exists, scratch, written
from ..sources import files
from . import inputs as i
from .registry import query
from .stored import flow_files

RULED = FlowContract(
    numeric=("qty", "disc", "tax", "price"),
    features=("qty", "disc", "tax", "price"),
    attacks=("rest",),
)
LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def ruled(spark, sf, rule: str, *splits: str):
    """lineitem as examples whose class is a threshold of one feature; of all splits or the named ones.

    A tree finds such a rule exactly, so every cell of a forest's confusion
    matrix is known from the table alone.  Splits are chosen before the vectors
    are made, because filters do not move below that step.
    """
    rows = i.table(spark, sf, "lineitem").select(
        *LINE,
        F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
        F.col("l_extendedprice").alias("price"),
        F.expr(f"CASE WHEN {rule} THEN 1.0D ELSE 0.0D END").alias("binary_label"),
    )
    split = examples.hash_split(rows, LINE[:1])
    return clean.add_vector(split.where(F.col("split").isin(*splits)) if splits else split, RULED)


ATTACKS, MISTAKEN = "l_discount >= 0.05", "l_tax >= 0.04"
SPLIT_SQL = f"""lines AS (SELECT *, {ATTACKS} AS attack, {MISTAKEN} AS mistaken,
  CASE WHEN ('0x' || substr(md5(l_orderkey::VARCHAR), 1, 8))::BIGINT < {int(0.70 * 2**32)} THEN 'train'
  WHEN ('0x' || substr(md5(l_orderkey::VARCHAR), 1, 8))::BIGINT < {int(0.85 * 2**32)} THEN 'validation'
  ELSE 'test' END AS split FROM lineitem)"""


@lru_cache(maxsize=None)
def _model(app_id: str, spark, sf: str, name: str):
    rule = {"baseline": MISTAKEN, "candidate": ATTACKS}[name]
    kept = ruled(spark, sf, rule, "train")
    if name == "baseline":
        return forest.fit_forest(kept, RULED)
    train = written(kept.select("binary_label", "features"), "train")
    return forest.fit_forest(examples.add_class_weight(train, "binary_label"), RULED, "class_weight")


def model(spark, sf, name: str):
    """A baseline taught a wrong rule, or a class-weighted candidate; each fitted once per session."""
    return _model(spark.sparkContext.applicationId, spark, sf, name)


def models(spark, sf) -> dict:
    return {name: model(spark, sf, name) for name in ("baseline", "candidate")}


def judged(spark, sf, name: str):
    """Cells and rates of one model over validation and test."""
    rows = ruled(spark, sf, ATTACKS, "validation", "test")
    found = evaluate.evaluate(forest.score(rows, model(spark, sf, name)), "binary_label")
    return i.shown(found.select("rows", *evaluate.CELLS, *evaluate.RATES))


def eval_sql(guess: str) -> str:
    return f"""WITH {SPLIT_SQL}, c AS (SELECT count(*) AS rows,
  count(*) FILTER (NOT attack AND NOT {guess}) AS tn, count(*) FILTER (NOT attack AND {guess}) AS fp,
  count(*) FILTER (attack AND NOT {guess}) AS fn, count(*) FILTER (attack AND {guess}) AS tp
  FROM lines WHERE split <> 'train'),
r AS (SELECT *, (tn + tp) / rows AS accuracy, tp / (tp + fp) AS attack_precision,
  tp / (tp + fn) AS attack_recall, tn / (tn + fp) AS normal_specificity, fp / (tn + fp)
  AS false_positive_rate FROM c)
SELECT rows, tn, fp, fn, tp, round(accuracy, 6) AS accuracy,
  round(attack_precision, 6) AS attack_precision, round(attack_recall, 6) AS attack_recall,
  round(2 * attack_precision * attack_recall / (attack_precision + attack_recall), 6) AS attack_f1,
  round(normal_specificity, 6) AS normal_specificity,
  round(false_positive_rate, 6) AS false_positive_rate,
  round((attack_recall + normal_specificity) / 2, 6) AS balanced_accuracy FROM r"""


@query("q_rf_baseline_eval", eval_sql("mistaken"))
def _(spark, sf):
    return judged(spark, sf, "baseline")


@query("q_rf_weighted_eval", eval_sql("attack"))
def _(spark, sf):
    return judged(spark, sf, "candidate")


@query(
    "q_rf_scored_rows",
    f"""SELECT {", ".join(LINE)}, CASE WHEN {ATTACKS} THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
  true AS probability_sums_to_one, true AS prediction_is_likelier_class FROM lineitem""",
)
def _(spark, sf):
    """Every row scored; probabilities and prediction agree."""
    scored = forest.score(ruled(spark, sf, ATTACKS), model(spark, sf, "candidate"))
    normal, attack = F.col("probability")[0], F.col("probability")[1]
    likelier = F.when(attack > normal, 1.0).otherwise(0.0)
    return scored.select(
        *LINE,
        "prediction",
        (F.abs(normal + attack - 1.0) < 1e-9).alias("probability_sums_to_one"),
        (F.col("prediction") == likelier).alias("prediction_is_likelier_class"),
    )


@query(
    "q_rf_gate",
    f"""WITH {SPLIT_SQL}, v AS (SELECT * FROM lines WHERE split = 'validation')
SELECT count(*) AS validation_rows, 'promote' AS decision,
  round(1 - count(*) FILTER (NOT attack AND NOT mistaken) / count(*) FILTER (NOT attack), 6)
    AS specificity_delta,
  round(1 - count(*) FILTER (attack AND mistaken) / count(*) FILTER (attack), 6) AS recall_delta
FROM v""",
)
def _(spark, sf):
    """Both forests on the same validation rows, in one scan, and the decision."""
    rows = ruled(spark, sf, ATTACKS, "validation")
    found = training.judge_models(rows, models(spark, sf), RULED)
    decided = evaluate.promotion(evaluate.compare(found, "baseline", "candidate"))
    total = found.agg(F.max("rows").alias("n")).scalar()
    return i.shown(
        decided.select(total.alias("validation_rows"), "decision", "specificity_delta", "recall_delta")
    )


@query(
    "q_feature_importances",
    "SELECT 'disc' AS top_feature, 4::BIGINT AS features, true AS descending, true AS sum_is_one",
)
def _(spark, sf):
    """Importances of the candidate: the feature of its rule comes first."""
    ranked = forest.importances(model(spark, sf, "candidate"), RULED)
    values = [v for _, v in ranked]
    row = (ranked[0][0], len(ranked), values == sorted(values, reverse=True), abs(sum(values) - 1) < 1e-9)
    return spark.createDataFrame([row], "top_feature string, features bigint, descending boolean, sum_is_one boolean")


@query(
    "q_model_contract",
    """SELECT * FROM (VALUES ('saved forest', true), ('other contract', false),
  ('no forest there', false)) t(model, accepted)""",
)
def _(spark, sf):
    """A saved forest reloads; one that does not fit the contract is refused."""
    path = scratch(spark, "forest")
    model(spark, sf, "baseline").write().save(path)
    cases = {
        "saved forest": (path, RULED),
        "other contract": (path, FlowContract(("a", "b"), ("a", "b"), ("rest",))),
        "no forest there": (f"{path}-absent", RULED),
    }
    verdicts = []
    for name, (where, contract) in cases.items():
        try:
            forest.load_forest(where, contract)
            verdicts.append((name, True))
        except ContractError:
            verdicts.append((name, False))
    return spark.createDataFrame(verdicts, "model string, accepted boolean")


@lru_cache(maxsize=None)
def _job(app_id: str, spark, sf: str) -> tuple[str, training.TrainingReport]:
    path = scratch(spark, "job-forest")
    return path, training.train(spark, flow_files(spark, sf), i.LINES, path)


def trained_job(spark, sf):
    """The baseline training job over the flow files; run once per session."""
    return _job(spark.sparkContext.applicationId, spark, sf)


@query(
    "q_training_job_summary",
    f"""WITH {i.FLOWS_SQL}
SELECT (SELECT count(*) FROM flows) AS raw_rows, (SELECT count(*) FROM ready) AS ready_rows,
  (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_extendedprice, l_discount, l_tax, target
    FROM ready)) AS unique_rows,
  true AS splits_cover_rows, true AS validation_complete, true AS test_complete,
  true AS existing_model_refused""",
)
def _(spark, sf):
    """From CSV files to a saved forest; a second run into the same place is refused."""
    path, report = trained_job(spark, sf)
    counts = report.counts
    try:
        training.train(spark, flow_files(spark, sf), i.LINES, path)
        refused = False
    except ContractError:
        refused = True
    row = (
        counts["raw_rows"],
        counts["ready_rows"],
        counts["unique_rows"],
        sum(counts[f"{s}_rows"] for s in training.SPLITS) == counts["unique_rows"],
        report.validation["baseline"]["rows"] == counts["validation_rows"],
        report.test["baseline"]["rows"] == counts["test_rows"],
        refused,
    )
    return spark.createDataFrame(
        [row],
        "raw_rows bigint, ready_rows bigint, unique_rows bigint, splits_cover_rows boolean, "
        "validation_complete boolean, test_complete boolean, existing_model_refused boolean",
    )


def threshold_files(spark, sf, rule: str) -> str:
    """The raw flow table as CSV files, its label a threshold of one cell."""
    raw = i.raw_flows(spark, sf)
    label = F.when(F.expr(rule), "DDOS-A").otherwise(" benign ")
    return files.write_csv(raw.withColumn("Label", label), scratch(spark, "rule-flows"))


DISC_RULE, TAX_RULE = "try_cast(disc AS double) >= 0.05", "try_cast(tax AS double) >= 0.04"
RULE_COUNTS = """WITH u AS (SELECT DISTINCT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
  WHERE (l_orderkey * 10 + l_linenumber) % 997 > 8)"""


def outcome(report: training.TrainingReport, path: str, spark) -> dict:
    cells = lambda found: all(found["candidate"][c] == 0 for c in ("fp", "fn"))
    return {
        "decision": report.decision,
        "promoted": report.promoted,
        "validation_exact": cells(report.validation),
        "test_exact": bool(report.test) and cells(report.test),
        "stored": path_exists(spark, path),
    }


@query(
    "q_training_candidate",
    RULE_COUNTS + """ SELECT * FROM (VALUES
  ('better', 'promote', true, true, true, true), ('no better', 'keep_baseline', false, true, false, false))
  t(candidate, decision, promoted, validation_exact, test_exact, stored),
  (SELECT count(*) AS unique_rows FROM u)""",
)
def _(spark, sf):
    """A candidate beats a baseline of a wrong rule and is stored; its equal is refused untested."""
    wrong, right = threshold_files(spark, sf, TAX_RULE), threshold_files(spark, sf, DISC_RULE)
    paths = {n: scratch(spark, f"forest-{n}") for n in ("baseline", "better", "no-better")}
    training.train(spark, wrong, i.LINES, paths["baseline"])
    with training.stored_examples(spark, right, i.LINES) as table:
        held = {"table": table}
        better = training.train(spark, right, i.LINES, paths["better"], baseline_path=paths["baseline"], **held)
        equal = training.train(spark, right, i.LINES, paths["no-better"], baseline_path=paths["better"], **held)
    rows = [
        {"candidate": "better", **outcome(better, paths["better"], spark), "unique_rows": better.counts["unique_rows"]},
        {"candidate": "no better", **outcome(equal, paths["no-better"], spark), "unique_rows": equal.counts["unique_rows"]},
    ]
    return spark.createDataFrame(
        rows,
        "candidate string, decision string, promoted boolean, validation_exact boolean, test_exact boolean, "
        "stored boolean, unique_rows bigint",
    )


@query(
    "q_training_finalization",
    """SELECT * FROM (VALUES ('recorded values', true, true), ('wrong count', false, false),
  ('wrong weight', false, false), ('unknown metric', false, false))
  t(expected, accepted, stored)""",
)
def _(spark, sf):
    """A run that must reproduce recorded counts, weights and metrics, and stops before the test if not."""
    source = threshold_files(spark, sf, DISC_RULE)
    base, first = scratch(spark, "forest"), scratch(spark, "forest")
    training.train(spark, threshold_files(spark, sf, TAX_RULE), i.LINES, base)
    seen = training.train(spark, source, i.LINES, first, baseline_path=base)
    good = {"unique_rows": seen.counts["unique_rows"], "validation_rows": seen.counts["validation_rows"],
            "weight_normal": seen.weights["normal_weight"], "weight_attack": seen.weights["attack_weight"],
            "validation_attack_recall": 1.0, "promoted": 1.0}
    cases = {
        "recorded values": good,
        "wrong count": good | {"unique_rows": good["unique_rows"] + 1},
        "wrong weight": good | {"weight_normal": good["weight_normal"] + 0.01},
        "unknown metric": good | {"no_such_value": 1.0},
    }
    rows = []
    for name, values in cases.items():
        path = scratch(spark, "forest")
        wanted = spark.createDataFrame(
            [(k, float(v), 1e-9) for k, v in values.items()], "metric string, expected double, tolerance double"
        )
        try:
            training.train(spark, source, i.LINES, path, baseline_path=base, expected=wanted)
            accepted = True
        except ContractError:
            accepted = False
        rows.append((name, accepted, path_exists(spark, path)))
    return spark.createDataFrame(rows, "expected string, accepted boolean, stored boolean")


def attempt(check, *args) -> str:
    try:
        check(*args)
        return "passes"
    except ContractError:
        return "fails"


@query(
    "q_verify_job",
    f"""WITH {i.FLOWS_SQL}
SELECT job, input, verdict, (SELECT count(*) FROM ready) AS ready_rows FROM (VALUES
  ('cleaning', 'good', 'passes'), ('cleaning', 'no usable row', 'fails'), ('cleaning', 'no label column', 'fails'),
  ('labels', 'good', 'passes'), ('labels', 'strange label', 'fails'),
  ('splits', 'hashed', 'passes'), ('splits', 'random', 'fails')) t(job, input, verdict)""",
)
def _(spark, sf):
    """Each verification job on an input that passes and on one that must fail."""
    raw = written(i.raw_flows(spark, sf), "flows")
    listed = raw.where("coalesce(trim(Label), '') <> 'MYSTERY'")
    keyed = examples.with_fingerprint(clean.clean(raw, i.LINES, labelled=True, vector=False), i.LINES.features)
    hashed = examples.hash_split(keyed, i.LINES.features)
    lot = F.xxhash64("price", F.monotonically_increasing_id()) % 2 == 0
    random = keyed.unionByName(keyed).withColumn("split", F.when(lot, "train").otherwise("test"))
    rows = verify.verify_cleaning(raw, i.LINES)["rows"]
    verdicts = [
        ("cleaning", "good", "passes"),
        ("cleaning", "no usable row", attempt(verify.verify_cleaning, raw.withColumn("qty", F.lit("x")), i.LINES)),
        ("cleaning", "no label column", attempt(verify.verify_cleaning, raw.drop("Label"), i.LINES)),
        ("labels", "good", attempt(verify.verify_labels, listed, i.LINES)),
        ("labels", "strange label", attempt(verify.verify_labels, raw, i.LINES)),
        ("splits", "hashed", attempt(verify.verify_splits, hashed, examples.PRINT, "split")),
        ("splits", "random", attempt(verify.verify_splits, random, examples.PRINT, "split")),
    ]
    table = spark.createDataFrame(verdicts, "job string, input string, verdict string")
    return table.withColumn("ready_rows", F.lit(rows).cast("bigint"))


@query(
    "q_profile_job",
    f"""WITH {i.FLOWS_SQL}
SELECT column_name, role, (SELECT count(*) FROM flows) AS rows, null_rows, 'fails' AS without_rows FROM (VALUES
  ('qty', 'feature', (SELECT count(*) FROM flows WHERE q = 0)), ('price', 'feature', 0),
  ('disc', 'feature', (SELECT count(*) FROM flows WHERE q = 7)), ('tax', 'feature', 0),
  ('Tot sum', 'other', 0), ('IPv', 'other', 0), ('LLC', 'other', 0),
  ('Label', 'label', (SELECT count(*) FROM flows WHERE q = 10))) t(column_name, role, null_rows)""",
)
def _(spark, sf):
    """The profile of every column of the contract; a table without rows fails."""
    raw = i.raw_flows(spark, sf)
    found = verify.profile_job(raw, i.LINES).select("column_name", "role", "rows", "null_rows")
    return found.withColumn("without_rows", F.lit(attempt(verify.profile_job, raw.where("false"), i.LINES)))


@query(
    "q_sample_predictions",
    f"""WITH {i.FLOWS_SQL}, few AS (SELECT target FROM ready
  ORDER BY l_quantity, l_extendedprice, l_discount, l_tax, target LIMIT 5)
SELECT count(*) AS rows, sum(target)::DOUBLE AS attacks, count(*)::DOUBLE AS probability_sum,
  count(*) AS matching FROM few""",
)
def _(spark, sf):
    """Five predictions of the stored forest, as a check that it reloads."""
    path, _ = trained_job(spark, sf)
    few = training.sample_predictions(spark, flow_files(spark, sf), i.LINES, path, 5)
    chances = F.col("probability")
    total = F.aggregate(chances, F.lit(0.0), lambda a, b: a + b)
    likeliest = F.when(F.element_at(chances, 2) > F.element_at(chances, 1), 1.0).otherwise(0.0)
    return few.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(i.LINES.target).alias("attacks"),
        F.sum(total).alias("probability_sum"),
        F.count_if(F.col("prediction") == likeliest).alias("matching"),
    )


@query(
    "q_text_forest_eval",
    """WITH t AS (SELECT regexp_matches(text, '[0-9]') AS attack,
  ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT AS h
  FROM documents JOIN labels USING (doc_id))
SELECT count(*) AS rows, count(*) FILTER (NOT attack) AS tn, 0::BIGINT AS fp, 0::BIGINT AS fn,
  count(*) FILTER (attack) AS tp FROM t WHERE h >= """ + str(int(0.70 * 2**32)),
)
def _(spark, sf):
    """A class-weighted forest on whole-text counts, judged on documents it has not seen."""
    text = F.col("text")
    counts = {
        "chars": F.col("n_chars").cast("double"),
        "words": F.size(F.split(text, r"\s+")).cast("double"),
        "lines": F.size(F.split(text, "\n")).cast("double"),
        "digits": F.least(F.length(F.regexp_replace(text, "[^0-9]", "")), F.lit(20)).cast("double"),
    }
    contract = FlowContract(numeric=tuple(counts), features=tuple(counts), attacks=("digits",))
    labelled = i.table(spark, sf, "documents").join(i.table(spark, sf, "labels"), "doc_id")
    rows = labelled.select("doc_id", *[c.alias(n) for n, c in counts.items()]).withColumn(
        "binary_label", F.when(F.col("digits") > 0, 1.0).otherwise(0.0)
    )
    split = examples.hash_split(clean.add_vector(rows, contract), ("doc_id",))
    ready = written(split.select("split", "features", "binary_label"), "text-counts")
    seen = examples.add_class_weight(ready.where(F.col("split") == "train"), "binary_label")
    fitted = forest.fit_forest(seen, contract, "class_weight")
    unseen = forest.score(ready.where(F.col("split") != "train"), fitted)
    return evaluate.evaluate(unseen, "binary_label").select("rows", *evaluate.CELLS)
