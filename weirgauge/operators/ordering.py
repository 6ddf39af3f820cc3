"""Order-dependent results over one long sequence, without one long task.

``lag``, running sums and row positions over a whole table would put every row
into a single window partition.  Here the sequence is cut into consecutive
buckets; each bucket is handled by its own task, and only one summary row per
bucket is ordered globally.  The bucket number must grow with the sort key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import ref
from ..session import written

BUCKET = "__bucket"
GRID_CELLS = 4096
BUCKET_ROWS = 500_000


def grid_buckets(df: DataFrame, key: str, step_seconds: float) -> DataFrame:
    """Buckets for rows that lie on a time grid, one row per grid point.

    A bucket spans ``GRID_CELLS`` grid steps, so it can never hold more rows
    than that, however uneven the traffic behind the rows was.
    """
    width = max(1, int(step_seconds * GRID_CELLS))
    return df.withColumn(BUCKET, F.floor(F.unix_seconds(ref(key)) / width))


def range_buckets(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Buckets of about equal row count for a unique key, as a stored table.

    The rows are range-partitioned by the key and written once; a bucket is one
    partition.  They are counted first, and their number is the number of
    buckets of about BUCKET_ROWS rows, or the session's shuffle partitions if
    these are more: it grows with the data and no bucket does.
    """
    if parts is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(least, -(-df.count() // BUCKET_ROWS))
    sliced = df.repartitionByRange(parts, ref(key))
    return written(sliced.withColumn(BUCKET, F.spark_partition_id().cast("bigint")), "ranges")


def _across_buckets(by):
    # One row per bucket: the bucket count is bounded by the two functions above.
    return Window.partitionBy(*[ref(b) for b in by]).orderBy(BUCKET)


def _join_summary(df: DataFrame, summary: DataFrame, by) -> DataFrame:
    on = [*by, BUCKET]
    return df.join(summary.select(*on, "__carry"), on)


def previous_row(df: DataFrame, key: str, columns, out: str, by=()) -> DataFrame:
    """Add ``out``: a struct with ``columns`` of the row before, NULL for the first."""
    packed = F.struct(*[ref(c) for c in columns])
    last = df.groupBy(*[ref(b) for b in by], BUCKET).agg(
        F.max_by(packed, ref(key)).alias("__last")
    )
    carried = last.withColumn("__carry", F.lag("__last").over(_across_buckets(by)))
    inside = Window.partitionBy(*[ref(b) for b in by], BUCKET).orderBy(ref(key))
    return (
        _join_summary(df, carried, by)
        .withColumn(out, F.coalesce(F.lag(packed).over(inside), F.col("__carry")))
        .drop("__carry")
    )


def running_sum(df: DataFrame, key: str, amount: Column, out: str, by=()) -> DataFrame:
    """Add the sum of ``amount`` over all rows up to and including this one."""
    df = df.withColumn("__amount", amount.cast("bigint"))
    totals = df.groupBy(*[ref(b) for b in by], BUCKET).agg(F.sum("__amount").alias("__total"))
    before = _across_buckets(by).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn(
        "__carry", F.coalesce(F.sum("__total").over(before), F.lit(0)).cast("bigint")
    )
    inside = (
        Window.partitionBy(*[ref(b) for b in by], BUCKET)
        .orderBy(ref(key))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _join_summary(df, carried, by)
        .withColumn(out, F.col("__carry") + F.sum("__amount").over(inside))
        .drop("__carry", "__amount")
    )


def positions(df: DataFrame, key: str, out: str, by=()) -> DataFrame:
    """Add the zero-based position of every row in the order of ``key``."""
    counted = running_sum(df, key, F.lit(1), out, by)
    return counted.withColumn(out, F.col(out) - 1)


def first_per_group(
    df: DataFrame, group: str, order, limit: int, spread: int = 64, rank: str = "position"
) -> DataFrame:
    """First ``limit`` rows of every group, in two rounds.

    The first round ranks inside ``spread`` slices of each group, so a group
    with a third of all rows is ranked by many tasks; the second round sees at
    most ``spread * limit`` rows of a group.
    """
    order = [c if isinstance(c, Column) else ref(c) for c in order]
    sliced = df.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(spread)))
    near = Window.partitionBy(ref(group), "__slice").orderBy(*order)
    whole = Window.partitionBy(ref(group)).orderBy(*order)
    return (
        sliced.withColumn("__near", F.row_number().over(near))
        .where(F.col("__near") <= limit)
        .drop("__slice", "__near")
        .withColumn(rank, F.row_number().over(whole))
        .where(F.col(rank) <= limit)
    )
