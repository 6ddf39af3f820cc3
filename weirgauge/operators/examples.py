"""Model examples: deduplication, splitting, leakage, class balance."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SPLIT_SEED, SPLIT_SHARES, ContractError, FlowContract, require_columns
from ..functions.cells import ratio, ref
from ..functions.keys import fingerprint, split_name

PRINT = "example_key"


def unique_examples(df: DataFrame, contract: FlowContract) -> DataFrame:
    """One row per distinct (features, target).

    Only the key columns are kept, so the result does not depend on which copy
    a task happens to see first, and copies are folded before the shuffle.
    """
    key = [*contract.features, contract.target]
    return require_columns(df, key).select(*[ref(n) for n in key]).distinct()


def hash_split(df: DataFrame, key, shares=SPLIT_SHARES, out: str = "split") -> DataFrame:
    """Name the split of every row from its key: no shuffle, no randomness.

    Equal examples share a split, which makes leakage impossible, and a task
    that is retried after a lost executor assigns the same splits again.
    """
    return df.withColumn(out, split_name(key, shares))


def random_split(df: DataFrame, shares=SPLIT_SHARES, seed: int = SPLIT_SEED) -> dict:
    """Seeded Bernoulli split.  Stable only while the partitioning is stable."""
    parts = df.randomSplit([share for _, share in shares], seed=seed)
    return {name: part for (name, _), part in zip(shares, parts)}


def with_fingerprint(df: DataFrame, columns, out: str = PRINT) -> DataFrame:
    return df.withColumn(out, fingerprint(columns))


def split_presence(df: DataFrame, key: str, split: str, names) -> DataFrame:
    """Rows of every key in every split: the single shuffle behind all overlap reports."""
    return df.groupBy(ref(key)).agg(
        *[F.count_if(ref(split) == n).alias(f"in_{n}") for n in names]
    )


def leakage_report(df: DataFrame, key: str, split: str, names=("train", "validation", "test")):
    """Shared keys and affected rows for every pair of splits, in one pass."""
    presence = split_presence(df, key, split, names)
    aggs, pairs = [], list(combinations(names, 2))
    for i, (a, b) in enumerate(pairs):
        both = (F.col(f"in_{a}") > 0) & (F.col(f"in_{b}") > 0)
        aggs += [
            F.count_if(both).alias(f"k{i}"),
            F.coalesce(F.sum(F.when(both, F.col(f"in_{a}"))), F.lit(0)).alias(f"a{i}"),
            F.coalesce(F.sum(F.when(both, F.col(f"in_{b}"))), F.lit(0)).alias(f"b{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("left_split"),
                F.lit(b).alias("right_split"),
                F.col(f"k{i}").alias("shared_keys"),
                F.col(f"a{i}").alias("left_rows"),
                F.col(f"b{i}").alias("right_rows"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return presence.agg(*aggs).select(F.inline(rows))


def shared_keys(left: DataFrame, right: DataFrame, key: str = PRINT) -> DataFrame:
    """Keys on both sides.  Each side is made distinct before it is joined."""
    return left.select(ref(key)).distinct().join(right.select(ref(key)).distinct(), key)


def rows_with_shared_key(left: DataFrame, right: DataFrame, key: str = PRINT) -> DataFrame:
    """How many rows of each side have a key that the other side has too.

    Both sides are counted per key first, so the join meets each key once and a
    key with very many copies cannot make a hot task.
    """
    a = left.groupBy(ref(key)).agg(F.count(F.lit(1)).alias("left_n"))
    b = right.groupBy(ref(key)).agg(F.count(F.lit(1)).alias("right_n"))
    return a.join(b, key).agg(
        F.coalesce(F.sum("left_n"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("right_n"), F.lit(0)).alias("right_rows"),
    )


def split_distribution(df: DataFrame, split: str, target: str) -> DataFrame:
    """Rows and classes per split, and whether the splits cover the whole."""
    counts = df.groupBy(ref(split).alias("split")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(ref(target) == 0.0).alias("normal_rows"),
        F.count_if(ref(target) == 1.0).alias("attack_rows"),
    )
    total = counts.agg(F.sum("rows").alias("n")).scalar()
    return counts.withColumns(
        {
            "attack_share": F.round(ratio(F.col("attack_rows"), F.col("rows")), 6),
            "rows_share": F.round(ratio(F.col("rows"), total), 6),
            "classes_cover_rows": F.col("normal_rows") + F.col("attack_rows") == F.col("rows"),
        }
    )


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """One row: rows per class and the number of rows that are in neither."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(ref(target) == 0.0).alias("normal_rows"),
        F.count_if(ref(target) == 1.0).alias("attack_rows"),
    )
    rows = F.col("rows")
    return counts.withColumns(
        {
            "other_rows": rows - F.col("normal_rows") - F.col("attack_rows"),
            "normal_share": F.round(ratio(F.col("normal_rows"), rows), 6),
            "attack_share": F.round(ratio(F.col("attack_rows"), rows), 6),
        }
    )


def require_two_classes(df: DataFrame, target: str, name: str) -> dict:
    """Class counts on the driver; refuses data a binary model cannot use."""
    row = class_counts(df, target).first().asDict()
    if row["rows"] == 0:
        raise ContractError(f"{name}: no rows")
    if row["other_rows"]:
        raise ContractError(f"{name}: {row['other_rows']} rows are neither normal nor attack")
    if not row["normal_rows"] or not row["attack_rows"]:
        raise ContractError(f"{name}: only one class is present ({row})")
    return row


def class_weights(train: DataFrame, target: str) -> DataFrame:
    """Balanced weights, rows / (2 * class rows), from the training rows only."""
    counts = class_counts(train, target)
    return counts.select(
        "rows",
        "normal_rows",
        "attack_rows",
        F.try_divide(F.col("rows"), F.col("normal_rows") * 2).alias("normal_weight"),
        F.try_divide(F.col("rows"), F.col("attack_rows") * 2).alias("attack_weight"),
    )


def add_class_weight(train: DataFrame, target: str, out: str = "class_weight") -> DataFrame:
    """Attach the weights as scalar subqueries: no join and no driver round trip."""
    weights = class_weights(train, target)
    return train.withColumn(
        out,
        F.when(ref(target) == 0.0, weights.select("normal_weight").scalar()).otherwise(
            weights.select("attack_weight").scalar()
        ),
    )


def dictionary_coverage(df: DataFrame, label: str, dictionary: DataFrame) -> DataFrame:
    """Labels seen but not listed, and listed but not seen, with row counts.

    Works on grouped labels, so both anti-joins are small whatever the table
    size; the dictionary may be a table of any length.
    """
    seen = (
        df.select(F.upper(F.trim(ref(label))).alias("label"))
        .where(F.coalesce(F.col("label") != "", F.lit(False)))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = dictionary.select("label").distinct()
    extra = seen.join(known, "label", "left_anti").select(
        "label", "rows", F.lit("seen_not_listed").alias("side")
    )
    absent = known.join(seen, "label", "left_anti").select(
        "label", F.lit(0).cast("bigint").alias("rows"), F.lit("listed_not_seen").alias("side")
    )
    return extra.unionByName(absent)
