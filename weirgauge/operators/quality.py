"""Cell and label quality of a raw flow table, each report in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import PROBLEMS, FlowContract, require_columns
from ..functions.keys import fingerprint
from ..functions.cells import all_finite, as_number, cell_problem, ratio, ref
from ..functions.labels import label_is_known, tidy_label


def counts_to_rows(one_row: DataFrame, cells: dict, key_name: str) -> DataFrame:
    """Turn a one-row frame of named counters into one row per key.

    ``cells`` maps a key to ``{output column: counter column}``.  Only the
    single aggregate row is unfolded, never the data.
    """
    rows = F.array(
        *[
            F.struct(F.lit(key).alias(key_name), *[ref(c).alias(out) for out, c in cols.items()])
            for key, cols in cells.items()
        ]
    )
    return one_row.select(F.inline(rows))


def cell_array(df: DataFrame, names) -> Column:
    """The columns side by side: numbers if all are numeric, else their text."""
    require_columns(df, names)
    kinds = {f.name: f.dataType for f in df.schema}
    numeric = all(isinstance(kinds[n], T.NumericType) for n in names)
    return F.array(*[ref(n).cast("double" if numeric else "string") for n in names])


def _found_cells(df: DataFrame, names, problem) -> DataFrame:
    """One row per cell that has a problem: column_name and problem.

    Rows pass the cheap test first.  Where it fails, every cell is judged inside
    its row and only bad ones leave it, so what is counted grows with the faults
    and not with the columns.  The judgement is written once and applied to each
    element, which keeps the plan the same size for four columns and for forty.
    The outer form keeps the optimizer from testing the array for emptiness in a
    filter of its own, which would judge every cell a second time.
    """
    judged = F.transform(
        cell_array(df, names),
        lambda cell, i: F.struct(i.alias("i"), problem(cell).alias("problem")),
    )
    bad = F.when(~all_finite(names), F.filter(judged, lambda c: c["problem"].isNotNull()))
    spelled = F.array(*[F.lit(n) for n in names])
    rows = df.select(F.inline_outer(bad)).where(F.col("problem").isNotNull())
    return rows.select(F.get(spelled, F.col("i")).alias("column_name"), "problem")


def bad_cells(df: DataFrame, names) -> DataFrame:
    """One row per bad cell: column_name and problem."""
    return _found_cells(df, names, cell_problem)


def issue_profile(df: DataFrame, names) -> DataFrame:
    """Bad cells per column and problem; columns without any are left out."""
    return (
        bad_cells(df, names)
        .groupBy("column_name")
        .agg(*[F.count_if(F.col("problem") == p).alias(p) for p in PROBLEMS])
    )


def rows_by_problem(df: DataFrame, names) -> DataFrame:
    """Rows having each problem in at least one of the columns, in one scan."""
    found = F.when(~all_finite(names), F.transform(cell_array(df, names), cell_problem))
    totals = df.select(found.alias("found")).agg(
        *[F.count_if(F.array_contains("found", p)).alias(p) for p in PROBLEMS]
    )
    return counts_to_rows(totals, {p: {"rows": p} for p in PROBLEMS}, "problem")


def label_tallies(df: DataFrame, contract: FlowContract) -> DataFrame:
    """How many labels are null, empty, normal, attack or unknown."""
    tidy = tidy_label(ref(contract.label))
    kind = (
        F.when(tidy.isNull(), "null")
        .when(tidy == "", "empty")
        .when(tidy == contract.normal, "normal")
        .when(tidy.isin(list(contract.attacks)), "attack")
        .otherwise("unknown")
    )
    kinds = ("null", "empty", "normal", "attack", "unknown")
    totals = df.select(kind.alias("kind")).agg(
        *[F.count_if(F.col("kind") == k).alias(f"{k}_rows") for k in kinds]
    )
    return totals


def column_null_counts(df: DataFrame, names=None) -> DataFrame:
    names = list(names or df.columns)
    totals = df.agg(*[F.count_if(ref(n).isNull()).alias(f"n{i}") for i, n in enumerate(names)])
    return counts_to_rows(
        totals, {n: {"null_rows": f"n{i}"} for i, n in enumerate(names)}, "column_name"
    )


def non_finite_counts(df: DataFrame, names) -> DataFrame:
    """NaN, +Inf and -Inf per column in one pass, zeros included."""
    kinds = ("nan", "positive_inf", "negative_inf")
    listed = df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")
    counted = listed.join(issue_profile(df, names), "column_name", "left")
    return counted.select("column_name", *[F.coalesce(F.col(k), F.lit(0)).alias(k) for k in kinds])


def text_number_quality(df: DataFrame, names) -> DataFrame:
    """How well text columns would read as numbers; blanks count as invalid."""
    kinds = ("invalid_numeric", "nan", "positive_inf", "negative_inf")

    def problem(cell: Column) -> Column:
        number = as_number(cell)
        return (
            F.when(cell.isNull(), F.lit(None).cast("string"))
            .when(number.isNull(), kinds[0])
            .when(F.isnan(number), kinds[1])
            .when(number == float("inf"), kinds[2])
            .when(number == float("-inf"), kinds[3])
        )

    found = _found_cells(df, names, problem).groupBy("column_name")
    counts = found.agg(*[F.count_if(F.col("problem") == k).alias(k) for k in kinds])
    listed = df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")
    return listed.join(counts, "column_name", "left").select(
        "column_name", *[F.coalesce(F.col(k), F.lit(0)).alias(k) for k in kinds]
    )


def clean_report(cleaned: DataFrame, unlabelled: DataFrame, contract: FlowContract) -> DataFrame:
    """What must hold after cleaning, as one row of yes/no answers."""
    state = cleaned.select(
        all_finite(contract.features).alias("finite"), ref(contract.target).alias("target")
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("finite")).alias("bad_rows"),
        F.count_if(F.col("target").isNull()).alias("unlabelled_rows"),
    )
    other_rows = unlabelled.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return state.select(
        F.col("rows"),
        (F.col("bad_rows") == 0).alias("all_features_finite"),
        (F.col("unlabelled_rows") == 0).alias("all_rows_labelled"),
        (F.col("rows") == other_rows).alias("label_free_path_keeps_same_rows"),
        F.lit(contract.target not in unlabelled.columns).alias("label_free_path_adds_no_label"),
    )


def scorecard(raw: DataFrame, contract: FlowContract, stage: str, names=None) -> DataFrame:
    """Uniqueness, completeness, validity and consistency of one table.

    Rows are judged where they are read and folded by fingerprint: what crosses
    the network is a digest with four counts, once per map task and distinct row.
    """
    names = list(names or contract.columns)
    filled = F.size(F.filter(F.array(*[ref(n).isNotNull() for n in names]), lambda there: there))
    judged = raw.select(
        fingerprint(names).alias("print"),
        filled.cast("bigint").alias("filled"),
        all_finite(contract.features).cast("bigint").alias("valid"),
        label_is_known(contract).cast("bigint").alias("known"),
    )
    copies = judged.groupBy("print").agg(
        F.count(F.lit(1)).alias("__copies"), *[F.sum(c).alias(c) for c in ("filled", "valid", "known")]
    )
    cells, valid, known = F.col("filled"), F.col("valid"), F.col("known")
    sums = copies.agg(
        F.sum("__copies").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum(cells).alias("present_cells"),
        F.sum(valid).alias("valid_rows"),
        F.sum(known).alias("known_rows"),
    )
    rows = F.col("rows")
    shares = {
        "uniqueness": ratio(F.col("distinct_rows"), rows),
        "completeness": ratio(F.col("present_cells"), rows * len(names)),
        "validity": ratio(F.col("valid_rows"), rows),
        "consistency": ratio(F.col("known_rows"), rows),
    }
    table = sums.select(*[share.alias(name) for name, share in shares.items()])
    return counts_to_rows(table, {n: {"share": n} for n in shares}, "dimension").select(
        F.lit(stage).alias("stage"), "dimension", "share"
    )
