"""Binary evaluation, model comparison and the promotion gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ContractError
from ..functions.cells import ratio, ref
from .quality import counts_to_rows

CELLS = {"tn": (0.0, 0.0), "fp": (0.0, 1.0), "fn": (1.0, 0.0), "tp": (1.0, 1.0)}
RATES = (
    "accuracy",
    "attack_precision",
    "attack_recall",
    "attack_f1",
    "normal_specificity",
    "false_positive_rate",
    "balanced_accuracy",
)
CLEAR_GAIN = "promote"
KEEP_BASELINE = "keep_baseline"
TRADE_OFF = "needs_decision"


def confusions(df: DataFrame, truth: str, guesses: dict[str, str]) -> DataFrame:
    """Four cells for every named prediction column, all in one scan.

    Models that are to be compared are scored side by side on the same rows, so
    the rows are read once.  Rows outside the four cells fail the query, and so
    does an empty input.
    """
    aggs, cells = [F.count(F.lit(1)).alias("rows")], {}
    for i, (name, guess) in enumerate(guesses.items()):
        cells[name] = {"rows": "rows"}
        for cell, (t, g) in CELLS.items():
            aggs.append(F.count_if((ref(truth) == t) & (ref(guess) == g)).alias(f"{cell}{i}"))
            cells[name][cell] = f"{cell}{i}"
    counts = counts_to_rows(df.agg(*aggs), cells, "model")
    stray = F.col("rows") - sum((F.col(c) for c in CELLS), F.lit(0))
    trouble = F.when(F.col("rows") == 0, F.lit("nothing to evaluate")).when(
        stray != 0, F.concat(stray.cast("string"), F.lit(" rows are not binary"))
    )
    checked = F.when(trouble.isNull(), F.col("rows")).otherwise(
        F.raise_error(trouble).cast("bigint")
    )
    return counts.select("model", *CELLS, checked.alias("rows"))


def rates(cells: DataFrame) -> DataFrame:
    """Rates from the four cells; a zero denominator gives 0.0."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    first = cells.withColumns(
        {
            "accuracy": ratio(tn + tp, F.col("rows")),
            "attack_precision": ratio(tp, tp + fp),
            "attack_recall": ratio(tp, tp + fn),
            "normal_specificity": ratio(tn, tn + fp),
            "false_positive_rate": ratio(fp, tn + fp),
        }
    )
    p, r = F.col("attack_precision"), F.col("attack_recall")
    return first.withColumns(
        {
            "attack_f1": ratio(2 * p * r, p + r),
            "balanced_accuracy": (r + F.col("normal_specificity")) / 2,
            "attack_miss_rate": 1.0 - r,
        }
    )


def evaluate_all(df: DataFrame, truth: str, guesses: dict[str, str]) -> DataFrame:
    """One row of cells and rates per model."""
    return rates(confusions(df, truth, guesses))


def evaluate(df: DataFrame, truth: str, guess: str = "prediction") -> DataFrame:
    return evaluate_all(df, truth, {"": guess}).drop("model")


def compare(evaluations: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """Metric by metric, candidate minus baseline, from rows of ``evaluate_all``."""
    long = evaluations.where(F.col("model").isin(baseline, candidate)).unpivot(
        "model", list(RATES), "metric", "value"
    )

    def side(name):
        return F.max(F.when(F.col("model") == name, F.col("value")))

    return (
        long.groupBy("metric")
        .agg(side(baseline).alias("baseline"), side(candidate).alias("candidate"))
        .withColumn("delta", F.col("candidate") - F.col("baseline"))
    )


def promotion(comparison: DataFrame) -> DataFrame:
    """Decision on specificity and recall of the same validation rows."""

    def delta(metric):
        return F.max(F.when(F.col("metric") == metric, F.col("delta")))

    moved = comparison.agg(
        delta("normal_specificity").alias("specificity_delta"),
        delta("attack_recall").alias("recall_delta"),
    )
    s, r = F.col("specificity_delta"), F.col("recall_delta")
    return moved.withColumn(
        "decision",
        F.when((s > 0) & (r >= 0), CLEAR_GAIN)
        .when((s <= 0) & (r <= 0), KEEP_BASELINE)
        .otherwise(TRADE_OFF),
    )


def check_expectations(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare named values with recorded ones, each with its own tolerance.

    ``actual``: metric, actual.  ``expected``: metric, expected, tolerance (0
    for counts).  A metric without a measured value does not match.
    """
    return expected.join(actual, "metric", "left").withColumn(
        "matches",
        F.coalesce(F.abs(F.col("actual") - F.col("expected")) <= F.col("tolerance"), F.lit(False)),
    )


def require_expectations(actual: DataFrame, expected: DataFrame) -> None:
    missed = check_expectations(actual, expected).where(~F.col("matches")).orderBy("metric")
    bad = [f"{r.metric}: {r.actual} instead of {r.expected}" for r in missed.collect()]
    if bad:
        raise ContractError("not reproduced: " + "; ".join(bad))


def scenario_summary(predictions: DataFrame) -> DataFrame:
    """Prediction against ground truth per scenario."""
    guessed = F.col("prediction_label")
    return predictions.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(guessed == "Normal").alias("predicted_normal"),
        F.count_if(guessed == "Attack").alias("predicted_attack"),
        F.count_if(guessed == F.col("ground_truth")).alias("matches"),
        F.count_if(guessed != F.col("ground_truth")).alias("mismatches"),
        F.count_if(F.col("prediction") == 1.0).alias("alerts"),
    )
