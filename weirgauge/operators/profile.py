"""Column profiles: few scans, driver sees only one row per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import LABEL_COLUMN_NAMES, LOW_CARDINALITY, NEAR_CONSTANT_SHARE, ContractError
from ..functions.keys import fingerprint
from ..functions.cells import ratio, ref
from ..functions.labels import is_normal_like
from .quality import counts_to_rows


def find_label_column(columns, wanted: str | None = None) -> str:
    """The one label column, by given or usual name, ignoring case."""
    names = {wanted.casefold()} if wanted else set(LABEL_COLUMN_NAMES)
    hits = [c for c in columns if c.casefold() in names]
    if len(hits) != 1:
        raise ContractError(f"expected exactly one label column, found {hits or 'none'}")
    return hits[0]


def column_kinds(df: DataFrame) -> dict[str, str]:
    return {
        f.name: "numeric" if isinstance(f.dataType, T.NumericType) else "other" for f in df.schema
    }


def value_shares(df: DataFrame, column: str, out: str = "share") -> DataFrame:
    """Count and share per value, most frequent first, ties by value.

    The total is summed over the grouped counts, so the table itself is read
    for the grouping only.
    """
    counts = df.groupBy(ref(column)).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("n")).scalar()
    return counts.withColumn(out, ratio(F.col("rows"), total)).orderBy(
        F.desc("rows"), ref(column).asc_nulls_first()
    )


def mapping_proposal(df: DataFrame, label: str) -> DataFrame:
    """Propose normal = the single normal-like label, attack = all others.

    Without exactly one normal-like label nothing is proposed.
    """
    counts = df.groupBy(ref(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    like = is_normal_like(F.col("label"))
    totals = counts.agg(
        F.count_if(like).alias("normal_like_labels"),
        F.max(F.when(like, F.col("label"))).alias("candidate"),
        F.coalesce(F.sum(F.when(like, F.col("rows"))), F.lit(0)).alias("normal"),
        F.sum("rows").alias("all"),
    )
    accepted = F.col("normal_like_labels") == 1
    return totals.select(
        "normal_like_labels",
        accepted.alias("accepted"),
        F.when(accepted, F.col("candidate")).alias("normal_label"),
        F.when(accepted, F.col("normal")).alias("normal_rows"),
        F.when(accepted, F.col("all") - F.col("normal")).alias("attack_rows"),
    )


def duplicate_rows(df: DataFrame, names=None) -> DataFrame:
    """Rows, distinct rows and surplus copies with one shuffle of fingerprints.

    A row crosses the network as 64 hexadecimal digits however wide it is, and
    partial aggregation folds copies on the map side, so a row that makes up a
    third of the table is sent once per map task.
    """
    names = list(names or df.columns)
    copies = df.groupBy(fingerprint(names).alias("print")).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("duplicate_rows", F.col("rows") - F.col("distinct_rows"))


def distinct_estimates(df: DataFrame, names=None, rsd: float = 0.05) -> DataFrame:
    """HyperLogLog++ distinct count and null count per column, one scan."""
    names = list(names or df.columns)
    aggs, cells = [F.count(F.lit(1)).alias("rows")], {}
    for i, n in enumerate(names):
        aggs.append(F.approx_count_distinct(ref(n), rsd).alias(f"d{i}"))
        aggs.append(F.count_if(ref(n).isNull()).alias(f"n{i}"))
        cells[n] = {"approx_distinct": f"d{i}", "null_rows": f"n{i}", "rows": "rows"}
    return counts_to_rows(df.agg(*aggs), cells, "column_name")


def constant_columns(df: DataFrame, names=None) -> DataFrame:
    return (
        distinct_estimates(df, names)
        .where((F.col("approx_distinct") == 1) & (F.col("null_rows") < F.col("rows")))
        .select("column_name")
    )


def low_cardinality_columns(df: DataFrame, names=None, limit: int = LOW_CARDINALITY) -> DataFrame:
    return (
        distinct_estimates(df, names)
        .where(F.col("approx_distinct") <= limit)
        .select("column_name")
    )


def dominant_values(
    df: DataFrame, names=None, label: str | None = None, always=(), limit: int = LOW_CARDINALITY
) -> DataFrame:
    """Most frequent value of every low-cardinality column, with its share.

    One estimate pass picks the columns (one row per column on the driver); one
    grouped count over the unpivoted picks finds the values.  Both steps
    combine on the map side, so a value held by most rows costs nothing extra.
    Ties go to the smaller value.
    """
    names = [n for n in (names or df.columns) if n != label]
    picked = [r.column_name for r in low_cardinality_columns(df, names, limit).collect()]
    picked += [n for n in always if n in names and n not in picked]
    long = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("column_name"), ref(n).cast("string").alias("value"))
                    for n in picked
                ]
            )
        )
    )
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    best = counts.groupBy("column_name").agg(
        F.min(F.struct((-F.col("rows")).alias("minus"), F.col("value"))).alias("top"),
        F.sum("rows").alias("all"),
    )
    share = ratio(-F.col("top.minus"), F.col("all"))
    return best.select(
        "column_name",
        F.col("top.value").alias("value"),
        (-F.col("top.minus")).alias("rows"),
        F.round(share, 6).alias("share"),
        (share >= NEAR_CONSTANT_SHARE).alias("near_constant"),
    )


def pair_equality(df: DataFrame, pairs) -> DataFrame:
    """Rows in which two columns agree (NULL equals NULL), all pairs in one scan."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    cells = {}
    for i, (a, b) in enumerate(pairs):
        aggs.append(F.count_if(ref(a).eqNullSafe(ref(b))).alias(f"e{i}"))
        cells[f"{a} == {b}"] = {"equal_rows": f"e{i}", "rows": "rows"}
    return counts_to_rows(df.agg(*aggs), cells, "pair").select(
        "pair", "equal_rows", F.round(ratio(F.col("equal_rows"), F.col("rows")), 6).alias("share")
    )


def numeric_stats(df: DataFrame, names) -> DataFrame:
    aggs, cells = [], {}
    for i, n in enumerate(names):
        cells[n] = {}
        for stat, fn in (("min", F.min), ("mean", F.avg), ("max", F.max)):
            aggs.append(fn(ref(n)).cast("double").alias(f"s{i}_{stat}"))
            cells[n][f"{stat}_value"] = f"s{i}_{stat}"
    return counts_to_rows(df.agg(*aggs), cells, "column_name")
