"""Examples stored in buckets by fingerprint, so that checks need no shuffle.

A table is written with one file per bucket, sorted by the fingerprint.  Rows
with equal fingerprints lie in the same bucket of every such table, so counting
by fingerprint and joining two tables run where the files are.  The files are
the table; a session knows it by name after ``save`` or ``attach``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.cells import ref
from ..operators.examples import PRINT

BUCKETS = 32
#: Rows of a bucket when their number is known.
BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int = BUCKETS) -> int:
    """Buckets for a table of that many rows: a bucket, which is one task, holds about BUCKET_ROWS."""
    return max(least, -(-rows // BUCKET_ROWS))


def save(df: DataFrame, name: str, path: str, buckets: int = BUCKETS, key: str = PRINT) -> DataFrame:
    """Store rows with a fingerprint as a table of that many buckets: the only shuffle.

    Choose the number of buckets once for all tables that meet, so that the
    largest bucket fits a task; a fingerprint with very many copies should be
    made distinct, or counted, before it is stored.
    """
    dealt = df.repartition(buckets, ref(key)).write.bucketBy(buckets, key).sortBy(key)
    dealt.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def attach(spark: SparkSession, name: str, path: str, schema: str, buckets: int = BUCKETS, key: str = PRINT) -> DataFrame:
    """Know a stored table in another session."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({schema}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def new_examples(delivery: DataFrame, stored: DataFrame, key: str = PRINT) -> DataFrame:
    """Examples of a delivery, one for each fingerprint, that are not stored yet."""
    rest = [c for c in delivery.columns if c != key]
    fresh = delivery.join(stored.select(ref(key)), key, "left_anti")
    return fresh.dropDuplicates([key]).select(key, *rest)
