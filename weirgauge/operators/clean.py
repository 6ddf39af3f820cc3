"""The row-wise clean step: the same function for batch and for streams."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import FlowContract, require_columns
from ..functions.cells import all_finite, as_number, ratio, ref, settle
from ..functions.labels import binary_target, label_is_known, tidy_label


def keep_rule(contract: FlowContract, labelled: bool) -> Column:
    """Rows that survive cleaning: finite features and, if asked, a known label."""
    rule = all_finite(contract.features)
    return rule & label_is_known(contract) if labelled else rule


def to_numbers(df: DataFrame, contract: FlowContract, need=None) -> DataFrame:
    """Known numeric columns become double in one projection, others pass through."""
    require_columns(df, contract.numeric if need is None else need)
    numeric = frozenset(contract.numeric)
    return df.select(
        *[
            as_number(ref(n)).alias(n) if n in numeric and kind != "double" else ref(n)
            for n, kind in df.dtypes
        ]
    )


def add_target(df: DataFrame, contract: FlowContract) -> DataFrame:
    """Tidy the label in place and add the binary target beside it."""
    require_columns(df, [contract.label])
    return df.withColumns(
        {contract.target: binary_target(contract), contract.label: tidy_label(ref(contract.label))}
    )


def add_vector(df: DataFrame, contract: FlowContract) -> DataFrame:
    """Fixed-order feature vector; an invalid cell is an error, not a zero."""
    require_columns(df, contract.features)
    return VectorAssembler(
        inputCols=list(contract.features), outputCol=contract.vector, handleInvalid="error"
    ).transform(df)


def clean(
    df: DataFrame, contract: FlowContract, *, labelled: bool, vector: bool = True
) -> DataFrame:
    """Cast, drop unusable rows, label and assemble.  No shuffle, no state.

    Cells are parsed once; the rule then looks at numbers only.
    """
    need = contract.numeric if labelled else contract.features
    require_columns(df, [*need, contract.label] if labelled else need)
    numbers = to_numbers(df, contract, need)
    usable = settle(numbers, "__keep", keep_rule(contract, labelled)).where("__keep")
    usable = usable.drop("__keep")
    if labelled:
        usable = add_target(usable, contract)
    return add_vector(usable, contract) if vector else usable


def project_features(df: DataFrame, contract: FlowContract, *keep: str) -> DataFrame:
    return require_columns(df, contract.features).select(
        *[ref(n) for n in (*keep, *contract.features)]
    )


def vector_sizes(df: DataFrame, contract: FlowContract) -> DataFrame:
    """Observed vector lengths over all rows, beside the declared one."""
    size = F.size(vector_to_array(F.col(contract.vector)))
    return (
        df.groupBy(size.cast("bigint").alias("dimension"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("as_declared", F.col("dimension") == len(contract.features))
    )


def vector_json(df: DataFrame, contract: FlowContract, out: str = "features_json") -> DataFrame:
    return df.withColumn(out, F.to_json(vector_to_array(F.col(contract.vector))))


def fold_examples(df: DataFrame, contract: FlowContract) -> DataFrame:
    """Distinct usable examples with their number of copies, in one shuffle.

    All rows that cleaning rejects fold into a single row with ``keep`` false
    and no values, so the copies still add up to the rows of the input.  Copies
    are added up on the map side first: an example that makes up a third of the
    table crosses the network once per task.
    """
    numbers = df.select(
        *[as_number(ref(n)).alias(n) for n in contract.features],
        F.when(label_is_known(contract), binary_target(contract)).alias(contract.target),
    )
    # Every cell is parsed once, above; the rule only compares the numbers.
    keep = all_finite(contract.features) & ref(contract.target).isNotNull()
    marked = numbers.withColumn("keep", keep)
    judged = marked.select(
        "keep", *[F.when(F.col("keep"), ref(n)).alias(n) for n in numbers.columns]
    )
    return judged.groupBy(*[ref(n) for n in judged.columns]).agg(
        F.count(F.lit(1)).alias("copies")
    )


def funnel_counts(folded: DataFrame) -> DataFrame:
    return folded.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.when(F.col("keep"), F.col("copies"))), F.lit(0)).alias("ready_rows"),
        F.count_if(F.col("keep")).alias("unique_rows"),
    )


def funnel(df: DataFrame, contract: FlowContract) -> DataFrame:
    """Rows before cleaning, after cleaning and after deduplication."""
    raw, ready, unique = F.col("raw_rows"), F.col("ready_rows"), F.col("unique_rows")
    return funnel_counts(fold_examples(df, contract)).select(
        raw,
        ready,
        unique,
        (raw - ready).alias("removed_by_cleaning"),
        F.round(ratio(raw - ready, raw), 6).alias("removed_by_cleaning_share"),
        (ready - unique).alias("removed_as_copies"),
        F.round(ratio(ready - unique, ready), 6).alias("removed_as_copies_share"),
    )
