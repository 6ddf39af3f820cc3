"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import discard, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every linked node; the root is the component's smallest node.

    ``edges`` has bigint columns a and b; order, loops and repetition do not
    matter.  Every round is written to shared storage and the one before it
    removed.  Rounds end when a round changes nothing.
    """
    spark = edges.sparkSession
    pointed = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    path = store(pointed.distinct(), "links")
    before = None
    while True:
        now = spark.read.schema("a bigint, b bigint").parquet(path)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        starred = _small_star(_large_star(now).distinct())
        after = store(starred.distinct(), "links")
        discard(spark, path)
        path = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
