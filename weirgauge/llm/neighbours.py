"""Approximate nearest neighbours with a forest of hash-prefix trees.

Every tree hashes a vector to a long string of bits, the sides of random planes.
A tree of a shard is the shard's strings in sorted order: the vectors below any
prefix are a run.  A query descends every tree to its longest matching prefix
and then ascends all trees together, one bit at a time, and looks at what the
wider runs add.  It stops when a neighbour as near as its current last one
would by now have been seen in some tree with probability ``1 - MISS``.

With ``p`` the chance that two vectors at that distance fall on one side of a
plane, a tree has them under a common prefix of ``x`` bits with chance p**x, so
the chance to be missed by all trees is (1 - p**x)**TREES.  Well clustered
vectors stop early; vectors without any structure are nearly all looked at,
which no hashing avoids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import stored
from .registry import query, table

TREES = 24
BITS = 32
MISS = 0.02
NEAREST = 10
#: Vectors a shard should have, and queries that are answered together.
SHARD_ROWS = 16_384
QUERY_ROWS = 512


def planes(dims: int) -> np.ndarray:
    return np.random.default_rng(dims).standard_normal((dims, TREES * BITS)).astype(np.float32)


def strings(vectors: np.ndarray) -> np.ndarray:
    """Bit strings as numbers, one row per vector and one column per tree."""
    weights = (np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).astype(np.float64)
    out = np.empty((len(vectors), TREES), np.int64)
    directions = planes(vectors.shape[1])
    for at in range(0, len(vectors), 2048):
        part = vectors[at : at + 2048]
        # The direction alone decides the side; the scale is taken out so that nothing overflows.
        part = part / np.abs(part).max(axis=1, keepdims=True)
        sides = (part.astype(np.float32) @ directions > 0).reshape(len(part), TREES, BITS)
        out[at : at + 2048] = (sides @ weights).astype(np.int64)
    return out


class Forest:
    """Sorted strings of a shard's vectors, one order per tree."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        hashed = strings(vectors)
        self.order = np.argsort(hashed, axis=0, kind="stable")
        self.sorted = np.take_along_axis(hashed, self.order, axis=0)
        self.norms = np.linalg.norm(vectors, axis=1)

    def runs(self, string: np.ndarray, bits: int) -> list[tuple[int, int]]:
        """In every tree, the run of vectors that share ``bits`` leading bits."""
        low = string >> (BITS - bits) << (BITS - bits)
        high = low + (1 << (BITS - bits))
        return [
            (int(np.searchsorted(self.sorted[:, t], low[t])), int(np.searchsorted(self.sorted[:, t], high[t])))
            for t in range(TREES)
        ]

    def nearest(self, query: np.ndarray, string: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, distance) of at least ``want`` near vectors, all if there are fewer."""
        seen = np.zeros(len(self.vectors), bool)
        index, far = np.zeros(0, np.int64), np.zeros(0)
        length = float(np.linalg.norm(query))
        before: list[tuple[int, int]] = [(0, 0)] * TREES
        for bits in range(BITS, -1, -1):
            now = self.runs(string, bits)
            if now == before:
                continue
            fresh = []
            for t, ((a, b), (c, d)) in enumerate(zip(now, before)):
                held = self.order[:, t]
                fresh += [held[a:c], held[d:b]] if d > c else [held[a:b]]
            before = now
            added = np.unique(np.concatenate(fresh))
            added = added[~seen[added]]
            if not len(added):
                continue
            seen[added] = True
            gap = self.vectors[added] - query
            index = np.concatenate([index, added])
            far = np.concatenate([far, np.sqrt((gap * gap).sum(axis=1))])
            if len(index) >= want:
                # Keep all that tie with the last, so that ids decide among them later.
                cut = np.partition(far, want - 1)[want - 1]
                index, far = index[far <= cut], far[far <= cut]
                widest = max(cut, 1e-12)
                cosine = (length**2 + self.norms[index] ** 2 - far**2) / (2 * length * self.norms[index])
                angle = float(np.arccos(np.clip(cosine, -1, 1)).max()) if widest else 0.0
                if (1 - (1 - angle / np.pi) ** bits) ** TREES <= MISS:
                    break
        return index, far


def usable(vector: str):
    """Whether a vector takes part: there, not zero, all components finite."""
    values = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(
        values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(values, lambda v: v != 0), F.lit(False))


ANSWER = "query_id bigint, vec_ids array<bigint>, score double"


def search(
    queries: DataFrame, vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for every query.

    The score is the Euclidean distance in double precision; ties go to the
    smaller key.  A query's own key is no candidate.  NULL keys, and vectors
    that are NULL, empty, zero, or hold NULL or non-finite components, take no
    part; vectors of different lengths never meet.  Equal vectors are indexed
    once, with the smallest keys that can be an answer.  Repeated rows of one
    key and vector count once.
    """
    spark = vectors.sparkSession
    packed = lambda df: df.where(usable(vector) & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    # Only the nearest + 1 smallest ids of a vector can be answers; one may be the query itself.
    copies = packed(vectors).select("id", "v").distinct()
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    least = (
        copies.withColumn("place", place)
        .where(F.col("place") <= nearest + 1)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )
    items = stored(least.withColumn("dims", F.size("v")), "vectors")
    shards = max(1, -(-items.count() // SHARD_ROWS))
    asked = stored(packed(queries).distinct().withColumn("dims", F.size("v")), "queries")
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    shard = F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def answer(key, left: pa.Table, right: pa.Table) -> pa.Table:
        none = {"query_id": pa.array([], pa.int64()), "vec_ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(none)
        dims = key[0].as_py()
        points = lambda t: t["v"].combine_chunks().flatten().to_numpy().reshape(-1, dims)
        forest, wanted = Forest(points(right)), points(left)
        ids, asks, hashed = right["ids"].to_pylist(), left["id"].to_pylist(), strings(wanted)
        out = ([], [], [])
        for number, ask in enumerate(asks):
            index, far = forest.nearest(wanted[number], hashed[number], nearest + 1)
            for k, score in zip(index.tolist(), far.tolist()):
                out[0].append(ask)
                out[1].append(ids[k])
                out[2].append(score)
        return pa.table(
            {n: pa.array(c, f.type) for (n, f), c in zip(none.items(), out)}
        )

    left = asked.select("dims", block.alias("block"), every(shards).alias("shard"), "id", "v")
    right = items.select("dims", every(blocks).alias("block"), shard.alias("shard"), "ids", "v")
    on = ["dims", "block", "shard"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(answer, ANSWER)
    flat = found.select("query_id", "score", F.explode("vec_ids").alias("vec_id")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    # A query repeated under its key with another vector keeps the better score of a candidate.
    best = flat.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


@query("op9_neighbours")
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors.where("vec_id % 100 = 0"), vectors)
