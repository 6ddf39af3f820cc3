"""Language identification by the nearest of several centroids per language.

A text becomes a vector of its lower-cased character n-grams (one to three
characters), hashed to ``DIMS`` places, weighted by log frequency and inverse
document frequency, and normalised.  Each language is described by up to
``CLUSTERS`` centroids, found by spherical k-means, and a text gets the language
of the centroid with the largest cosine.  A cosine below ``min_cosine`` is too
far from everything known, and the text is rejected as ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .batches import discard, fresh, raw, slices, store
from .registry import query, table

DIMS = 4096
CLUSTERS = 3
#: The model is fitted on at most so many texts of a language, and in all besides the first of each language.
ROWS_PER_LANGUAGE = 400
ROWS_IN_ALL = 6000
UNKNOWN = "und"


_LETTERS = np.array([chr(c).isalpha() for c in range(1 << 16)])


def letters_of(text: bytes) -> np.ndarray:
    """Lower-cased code points; each run of other characters becomes one blank."""
    chars = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    known = _LETTERS[np.minimum(chars, (1 << 16) - 1)] | (chars >= 1 << 16)
    keep = known.copy()
    keep[1:] |= known[:-1]
    return np.where(known, chars, 32)[keep]


def gram_counts(texts: list[bytes]) -> np.ndarray:
    """Hashed n-gram counts, one row per text."""
    chars = [letters_of(t) for t in texts]
    sizes = np.array([len(c) for c in chars])
    joined = np.concatenate(chars) if chars else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    out = np.zeros(len(texts) * DIMS, np.float32)
    key = np.zeros(len(joined), np.uint32)
    for length in (1, 2, 3):
        if len(joined) < length:
            break
        keep = len(joined) - length + 1
        key = key[:keep] * np.uint32(2654435761) + joined[length - 1 :] + np.uint32(1)
        mixed = (key ^ (key >> np.uint32(15))) * np.uint32(2246822519)
        inside = owner[:keep] == owner[length - 1 :]
        place = owner[:keep] * DIMS + (mixed >> np.uint32(20)).astype(np.int64)
        out += np.bincount(place[inside], minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), DIMS)


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def cluster(rows: np.ndarray, most: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids of unit vectors; starts far apart, so runs repeat."""
    centres = [unit(rows.mean(0, keepdims=True))[0]]
    near = rows @ centres[0]
    while len(centres) < min(most, len(rows)):
        centres.append(rows[int(np.argmin(near))])
        near = np.maximum(near, rows @ centres[-1])
    found = np.array(centres)
    for _ in range(rounds):
        owner = np.argmax(rows @ found.T, axis=1)
        held = [rows[owner == k] for k in range(len(found))]
        found = unit(np.array([h.mean(0) if len(h) else f for h, f in zip(held, found)]))
    return found


def _sample(docs: DataFrame, key: Column, text: str, lang: str) -> DataFrame:
    """(lang, text) of the labelled rows with the smallest key hashes of their language.

    The first row of every language is taken, then second rows, and so on,
    until the sample is full, so a frequent language displaces no rare one.
    Ranking sees the keys alone; the texts come from a second scan that keeps
    what lies below the cut of its language.
    """
    name = F.col(f"`{lang}`")
    rows = docs.where(name.isNotNull() & F.col(f"`{text}`").isNotNull())
    order = F.xxhash64(key)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    ranked = (
        rows.select(name.alias("lang"), order.alias("at")).withColumn("rank", rank).where(F.col("rank") <= ROWS_PER_LANGUAGE)
    )
    further = ranked.where("rank > 1").orderBy("rank", "at", "lang").limit(ROWS_IN_ALL)
    cuts = ranked.where("rank = 1").unionByName(further).groupBy("lang").agg(F.max("at").alias("cut"), F.max("rank").alias("most"))
    chosen = rows.select(name.alias("lang"), order.alias("at"), raw(text).alias("text"))
    return (
        # One number per language, as in the model.
        chosen.join(F.broadcast(cuts), "lang").where(F.col("at") <= F.col("cut"))
        .withColumn("rank", rank)
        .where((F.col("rank") <= ROWS_PER_LANGUAGE) & (F.col("rank") <= F.col("most")))
        .select("lang", "text")
    )


def _counted(batches):
    for batch in batches:
        for first, texts in slices(batch["text"]):
            rows = gram_counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch["lang"].slice(first, len(texts)), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["lang", "counts"],
            )


def _presence(batches):
    seen = np.zeros(DIMS)
    for batch in batches:
        for value in batch["counts"]:
            seen += np.frombuffer(value.as_py(), np.float32) > 0
    yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()], pa.binary())], ["seen"])


def weigh(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts) * rarity)


class Languages:
    """Centroids of all languages; small whatever was read."""

    def __init__(self, names: list[str], centroids: np.ndarray, rarity: np.ndarray):
        self.names, self.centroids, self.rarity = names, centroids, rarity

    def nearest(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosines = weigh(gram_counts(texts), self.rarity) @ self.centroids.T
        best = np.argmax(cosines, axis=1)
        score = cosines[np.arange(len(texts)), best].astype(float)
        return [self.names[k] for k in best], np.clip(score, 0.0, 1.0)


def fit(docs: DataFrame, key: Column, *, text: str = "text", lang: str = "lang") -> Languages:
    """Learn centroids from a bounded sample of labelled rows.

    At most ``ROWS_PER_LANGUAGE`` texts of a language, those with the smallest
    hash of ``key``: the first of every language and ``ROWS_IN_ALL`` further
    ones, dealt evenly.  Vectors are made and
    clustered by tasks, one language per group; the driver gets document
    frequencies and centroids.
    """
    spark = docs.sparkSession
    path = store(
        _sample(docs, key, text, lang).mapInArrow(_counted, "lang string, counts binary"), "language"
    )
    sample = spark.read.schema("lang string, counts binary").parquet(path)
    seen = np.zeros(DIMS)
    for row in sample.mapInArrow(_presence, "seen binary").collect():
        seen += np.frombuffer(bytes(row.seen), float)
    rarity = (np.log((sample.count() + 1) / (seen + 1)) + 1).astype(np.float32)

    def describe(group: pa.Table) -> pa.Table:
        counts = np.array([np.frombuffer(v.as_py(), np.float32) for v in group["counts"]])
        centres = cluster(weigh(counts, rarity), CLUSTERS).astype(np.float32)
        return pa.table(
            {"lang": [group["lang"][0].as_py()] * len(centres), "centre": [c.tobytes() for c in centres]},
            schema=pa.schema([("lang", pa.string()), ("centre", pa.binary())]),
        )

    found = sample.groupBy("lang").applyInArrow(describe, "lang string, centre binary")
    rows = sorted((r.lang, bytes(r.centre)) for r in found.collect())
    discard(spark, path)
    centres = [np.frombuffer(c, np.float32) for _, c in rows]
    return Languages([n for n, _ in rows], np.array(centres).reshape(-1, DIMS), rarity)


def identify(
    docs: DataFrame, model: Languages, *, text: str = "text", min_cosine: float = 0.0, out: str = "language"
) -> DataFrame:
    """Add ``out``, with underscores if there is such a column: struct of lang and score (the cosine, 0 to 1).

    ``und`` with score 0 for NULL, empty and letterless texts; ``und`` with its
    score for a text whose best cosine is below ``min_cosine``.  Nothing is
    shuffled, other columns stay, repeated rows are judged alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("struct<lang:string,score:double>")
    def judge(texts: pa.Array, lettered: pa.Array) -> pa.Array:
        names, scores = [], []
        for _, part in slices(texts):
            near, score = shared.value.nearest(part)
            names += [n if s >= min_cosine else UNKNOWN for n, s in zip(near, score)]
            scores += score.tolist()
        known = [bool(x.as_py()) for x in lettered]
        return pa.StructArray.from_arrays(
            [
                pa.array([n if k else UNKNOWN for n, k in zip(names, known)], pa.string()),
                pa.array([s if k else 0.0 for s, k in zip(scores, known)], pa.float64()),
            ],
            ["lang", "score"],
        )

    name = fresh(docs, out)
    letters = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(name, judge(raw(text), letters))


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    model = fit(docs.where(~held), F.col("doc_id"))
    judged = identify(docs.select("doc_id", "text"), model)
    return judged.select(
        "doc_id",
        held.alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )
