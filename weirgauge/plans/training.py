"""The training job: scan, clean, deduplicate, split, fit, judge, save."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ContractError, FlowContract
from ..functions.cells import ref, settle
from ..functions.keys import hash_word, split_at
from ..operators import clean, evaluate, examples, forest
from ..session import path_exists, remove, scratch
from ..sources import files

SPLITS = ("train", "validation", "test")
REJECTED = "rejected"


@dataclass
class TrainingReport:
    """What one run found; every field is small."""

    counts: dict = field(default_factory=dict)
    weights: dict = field(default_factory=dict)
    validation: dict = field(default_factory=dict)
    test: dict = field(default_factory=dict)
    decision: str | None = None
    promoted: bool = False
    importances: list = field(default_factory=list)


def store_examples(raw: DataFrame, contract: FlowContract) -> str:
    """Cleaned, unique, split examples as a written table, one folder per split.

    This is the only scan of the source: the copies kept beside each example
    give the row counts of every stage.  All later steps read the table.  It
    lies in the shared folder, so a lost executor costs a re-read and not the
    deduplication, and each split is a partition-pruned scan.
    """
    folded = clean.fold_examples(raw, contract)
    # Every key is hashed once; a split looks at the hash more than once.
    hashed = settle(folded, "__word", hash_word((*contract.features, contract.target)))
    split = F.when(F.col("keep"), split_at(F.col("__word"))).otherwise(REJECTED)
    # Kept rows hold finite numbers only; vectors are made once and read by every pass of the fitting.
    vector = F.when(F.col("keep"), array_to_vector(F.array(*[ref(n) for n in contract.features])))
    dealt = hashed.select(
        "keep", "copies", ref(contract.target), vector.alias(contract.vector), split.alias("split")
    )
    path = scratch(raw.sparkSession, "examples")
    dealt.write.option("maxRecordsPerFile", forest.TASK_ROWS).partitionBy("split").parquet(path)
    return path


@contextmanager
def stored_examples(spark: SparkSession, csv_path: str, contract: FlowContract) -> Iterator[str]:
    """The table of ``store_examples`` for files on which several runs are based; removed at the end."""
    table = store_examples(files.strict_scan(spark, csv_path, contract), contract)
    try:
        yield table
    finally:
        remove(spark, table)


def read_split(spark: SparkSession, path: str, name: str, contract: FlowContract) -> DataFrame:
    """Vectors and targets of one split, every file in a task of its own."""
    rows = forest.by_file(spark).read.parquet(path).where(F.col("split") == name)
    return rows.select(contract.vector, contract.target)


def _guesses(rows: DataFrame, models: dict, contract: FlowContract) -> DataFrame:
    """All models' predictions beside the truth, from one pass over the rows."""
    for name, model in models.items():
        one = model.copy()
        one.setPredictionCol(f"p_{name}").setProbabilityCol("").setRawPredictionCol("")
        rows = one.transform(rows)
    return rows.select(contract.target, *[f"p_{name}" for name in models])


def judge_models(rows: DataFrame, models: dict, contract: FlowContract) -> DataFrame:
    guesses = {name: f"p_{name}" for name in models}
    return evaluate.evaluate_all(_guesses(rows, models, contract), contract.target, guesses)


def _by_model(evaluations: DataFrame) -> dict:
    return {r["model"]: r.asDict() for r in evaluations.collect()}


def refuse_existing(spark: SparkSession, path: str) -> None:
    if path_exists(spark, path):
        raise ContractError(f"a model is already stored at {path}")


def train(
    spark: SparkSession,
    csv_path: str,
    contract: FlowContract,
    model_path: str,
    *,
    baseline_path: str | None = None,
    accept_trade_off: bool = False,
    expected: DataFrame | None = None,
    table: str | None = None,
) -> TrainingReport:
    """Fit a baseline, or with ``baseline_path`` a class-weighted candidate.

    A candidate is compared with the baseline on the validation split; the test
    split is looked at, and the model saved, only if the gate is passed.
    ``expected`` holds recorded values (metric, expected, tolerance) that a run
    must reproduce: counts before anything is fitted; ``weight_*``,
    ``validation_*`` and ``promoted`` (1 or 0) before the test split is touched.
    The table of cleaned examples is removed when the run ends, however it ends.
    ``table`` names one that ``stored_examples`` keeps for several runs on the same
    files, which are then not scanned again.
    """
    refuse_existing(spark, model_path)
    weighted = baseline_path is not None
    baseline = forest.load_forest(baseline_path, contract) if weighted else None
    with nullcontext(table) if table else stored_examples(spark, csv_path, contract) as held:
        return _fit_and_judge(spark, held, contract, model_path, baseline, accept_trade_off, expected)


#: Recorded values that are known only when a model has been judged; all others are counts.
LATE = {f"validation_{rate}" for rate in evaluate.RATES} | {"weight_normal", "weight_attack", "promoted"}


def _require(spark: SparkSession, measured: dict, expected: DataFrame | None, later: bool) -> None:
    """The recorded values of one stage, all of which must have been measured and match."""
    if expected is None:
        return
    names = [r.metric for r in expected.select("metric").distinct().collect()]
    due = [n for n in names if (n in LATE) == later]
    if due:
        rows = [(k, float(v)) for k, v in measured.items()]
        actual = spark.createDataFrame(rows, "metric string, actual double")
        evaluate.require_expectations(actual, expected.where(F.col("metric").isin(due)))


def _fit_and_judge(
    spark: SparkSession,
    table: str,
    contract: FlowContract,
    model_path: str,
    baseline,
    accept_trade_off: bool,
    expected: DataFrame | None,
) -> TrainingReport:
    report, weighted = TrainingReport(), baseline is not None
    stored = spark.read.parquet(table)
    report.counts = clean.funnel_counts(stored).first().asDict()
    usable = stored.where(F.col("split") != REJECTED)
    spread = examples.split_distribution(usable, "split", contract.target).collect()
    by_split = {r["split"]: r for r in spread}
    for name in SPLITS:
        row = by_split.get(name)
        if row is None or not row["normal_rows"] or not row["attack_rows"]:
            raise ContractError(f"split {name} does not hold both classes")
        report.counts[f"{name}_rows"] = row["rows"]
        report.counts[f"{name}_normal"] = row["normal_rows"]
        report.counts[f"{name}_attack"] = row["attack_rows"]
    _require(spark, report.counts, expected, later=False)

    rows = {name: read_split(spark, table, name, contract) for name in SPLITS}
    fit_on, weight = rows["train"], None
    if weighted:
        weight = "class_weight"
        report.weights = examples.class_weights(fit_on, contract.target).first().asDict()
        fit_on = fit_on.withColumn(
            weight,
            F.when(F.col(contract.target) == 0.0, report.weights["normal_weight"]).otherwise(
                report.weights["attack_weight"]
            ),
        )
    model = forest.fit_forest(fit_on, contract, weight, stored=True)
    models = {"baseline": baseline, "candidate": model} if weighted else {"baseline": model}

    validation = judge_models(rows["validation"], models, contract)
    report.validation = _by_model(validation)
    report.promoted = True
    if weighted:
        measured = spark.createDataFrame(list(report.validation.values()))
        gate = evaluate.promotion(evaluate.compare(measured, "baseline", "candidate"))
        report.decision = gate.first()["decision"]
        report.promoted = report.decision == evaluate.CLEAR_GAIN or (
            accept_trade_off and report.decision == evaluate.TRADE_OFF
        )
    report.importances = forest.importances(model, contract)
    fitted = report.validation["candidate" if weighted else "baseline"]
    found = {f"validation_{rate}": fitted[rate] for rate in evaluate.RATES}
    found |= {f"weight_{k.removesuffix('_weight')}": v for k, v in report.weights.items() if k.endswith("_weight")}
    _require(spark, found | {"promoted": report.promoted}, expected, later=True)
    if report.promoted:
        report.test = _by_model(judge_models(rows["test"], models, contract))
        model.save(model_path)
    return report


def sample_predictions(
    spark: SparkSession, csv_path: str, contract: FlowContract, model_path: str, rows: int
) -> DataFrame:
    """Predictions of a stored model for the usable rows with the smallest features.

    The sampling is the feature here.  Rows are judged before any is chosen, so
    bad rows never take a place; too few usable rows are an error.
    """
    if rows < 1:
        raise ContractError("rows must be positive")
    model = forest.load_forest(model_path, contract)
    usable = clean.clean(files.strict_scan(spark, csv_path, contract), contract, labelled=True, vector=False)
    order = [ref(name) for name in (*contract.features, contract.target)]
    chosen = usable.orderBy(*order).limit(rows).persist()
    found = chosen.count()
    if found < rows:
        chosen.unpersist()
        raise ContractError(f"{rows} rows asked for, {found} are usable")
    scored = forest.score(clean.add_vector(chosen, contract), model)
    return scored.select(contract.target, "prediction", "probability")
