"""Column profiles from small summaries: stored sketches per day, frequent values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import LOW_CARDINALITY, NEAR_CONSTANT_SHARE, ContractError
from ..functions.cells import ratio, ref
from .quality import counts_to_rows

#: Registers of a sketch, as a power of two: about 1.6 % error.
SKETCH_BITS = 12
SKETCHES = "column_name string, rows bigint, null_rows bigint, sketch binary, day date"
#: Values that a summary of frequent ones tracks.
TRACKED = 64


def day_sketches(df: DataFrame, day, names=None) -> DataFrame:
    """Per day and column: rows, missing cells, and a HyperLogLog sketch of the rest.

    One scan and one shuffle of a row per task and day, all columns side by side.
    """
    names = list(names or df.columns)
    aggs, cells = [F.count(F.lit(1)).alias("rows")], []
    for k, n in enumerate(names):
        aggs.append(F.hll_sketch_agg(ref(n).cast("string"), F.lit(SKETCH_BITS)).alias(f"s{k}"))
        aggs.append(F.count_if(ref(n).isNull()).alias(f"n{k}"))
        cells.append(
            F.struct(F.lit(n).alias("column_name"), "rows", F.col(f"n{k}").alias("null_rows"), F.col(f"s{k}").alias("sketch"))
        )
    per_day = df.groupBy(F.to_date(day).alias("day")).agg(*aggs)
    return per_day.select(F.inline(F.array(*cells)), "day")


def store_days(df: DataFrame, day, path: str, names=None) -> None:
    """Sketch the days of ``df`` and put them in the place of what is stored for them.

    Other days are neither read nor written.
    """
    rows = day_sketches(df, day, names).coalesce(1)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)


def stored_profile(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Profile of all stored days, or those between two dates, without the rows themselves.

    Columns whose cells are all missing have no distinct value.
    """
    days = spark.read.schema(SKETCHES).parquet(path)
    for bound, keep in ((first, F.col("day") >= F.lit(first)), (last, F.col("day") <= F.lit(last))):
        days = days if bound is None else days.where(keep)
    merged = days.groupBy("column_name").agg(
        F.count_distinct("day").alias("days"),
        F.sum("rows").alias("rows"),
        F.sum("null_rows").alias("null_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"),
    )
    some = F.col("null_rows") < F.col("rows")
    return merged.withColumns(
        {
            "constant": (F.col("approx_distinct") == 1) & some,
            "low_cardinality": F.col("approx_distinct") <= LOW_CARDINALITY,
        }
    )


def near_constant(df: DataFrame, names=None, share: float = NEAR_CONSTANT_SHARE) -> DataFrame:
    """Columns in which one value, or no value, fills at least ``share`` of the rows.

    Every task keeps a summary of TRACKED frequent values per column, and merged
    summaries still hold every value with a share above 1 / (0.75 * TRACKED)
    whatever the number of distinct values.  The one candidate of each column is
    then counted exactly in a second scan, so nothing of the answer is estimated.
    """
    if share * 0.75 * TRACKED <= 1:
        raise ContractError(f"shares of {share} are too small for {TRACKED} tracked values")
    names = list(names or df.columns)
    texts = [ref(n).cast("string").alias(f"c{k}") for k, n in enumerate(names)]
    narrow = df.select(*texts)
    tops = narrow.agg(*[F.expr(f"approx_top_k(c{k}, 1, {TRACKED})").alias(f"t{k}") for k in range(len(names))]).first()
    found = [next((r.item for r in tops[k] or [] if r.item is not None), None) for k in range(len(names))]
    aggs, cells = [F.count(F.lit(1)).alias("rows")], {}
    for k, n in enumerate(names):
        aggs.append(F.count_if(F.col(f"c{k}") == F.lit(found[k])).alias(f"v{k}"))
        aggs.append(F.count_if(F.col(f"c{k}").isNull()).alias(f"n{k}"))
        cells[n] = {"value_rows": f"v{k}", "null_rows": f"n{k}", "all_rows": "rows"}
    counted = counts_to_rows(narrow.agg(*aggs), cells, "column_name")
    value = F.create_map(*[F.lit(x) for pair in zip(names, found) for x in pair])[F.col("column_name")]
    missing = F.col("null_rows") > F.col("value_rows")
    rows = F.greatest("null_rows", "value_rows")
    return counted.select(
        "column_name",
        F.when(~missing, value).alias("value"),
        rows.alias("rows"),
        F.round(ratio(rows, F.col("all_rows")), 6).alias("share"),
    ).where((rows > 0) & (ratio(rows, F.col("all_rows")) >= share))
