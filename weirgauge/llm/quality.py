"""Text quality by ordinal regression with cumulative links.

Graded ratings 0..G-1 share one weight per hashed feature; G-1 ordered
thresholds cut the score: P(grade <= k) = sigmoid(threshold[k] - score).  From
this follow the expected grade and the probability of any tail of grades.

Features are the lower-cased words of the whole text without outer punctuation,
and trigrams of character classes, which show junk whatever its words are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .batches import fresh, raw, slices
from .registry import query, table

WORD_DIMS = 1 << 18
CLASSES = 16
SHAPE_DIMS = CLASSES**3
DIMS = WORD_DIMS + SHAPE_DIMS
#: The model is fitted on at most so many rated rows.
FIT_ROWS = 8_000
ROUNDS = 150
RIDGE = 5e-5
#: A feature met in fewer rated rows is not learned.
LEAST_ROWS = 8
GRADES = 3

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
# classes: 0 space, 1 line end, 2 lower, 3 upper, 4 digit, 5 non-ASCII, 6.. punctuation by code
_SHAPE = bytes(
    1 if c in (10, 13) else 0 if c <= 32 else 5 if c >= 128 else 4 if 48 <= c <= 57
    else 3 if 65 <= c <= 90 else 2 if 97 <= c <= 122 else 6 + c % 10
    for c in range(256)
)


class _Places(dict):
    """Features of a word: itself and two beginnings, which inflections share."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        bare = word.strip(_PUNCTUATION) or word
        forms = (bare, bare[:4] + b"*", bare[:6] + b"*")
        places = self[word] = tuple(xxhash.xxh64_intdigest(f, 7) % WORD_DIMS for f in forms)
        return places


_places = _Places()


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of the non-zero features of some texts."""
    words = [t.lower().split() for t in texts]
    sizes = np.array([3 * len(w) for w in words], np.int64)
    place = np.fromiter((p for ws in words for w in ws for p in _places[w]), np.int64, int(sizes.sum()))
    row = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    cell, times = np.unique(row * WORD_DIMS + place, return_counts=True)
    word_row, word_place, word_value = cell // WORD_DIMS, cell % WORD_DIMS, np.log1p(times)
    norm = np.sqrt(np.bincount(word_row, word_value**2, minlength=len(texts)))
    word_value = word_value / np.sqrt(norm[word_row])

    joined = np.frombuffer(b"".join(texts).translate(_SHAPE), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) for t in texts])
    if len(joined) < 3:
        return word_row, word_place, word_value
    triple = joined[:-2] * CLASSES**2 + joined[1:-1] * CLASSES + joined[2:]
    inside = owner[:-2] == owner[2:]
    cell, times = np.unique((owner[:-2] * SHAPE_DIMS + triple)[inside], return_counts=True)
    shape_row, shape_place = cell // SHAPE_DIMS, cell % SHAPE_DIMS
    total = np.bincount(shape_row, times, minlength=len(texts))
    shape_value = 3 * np.sqrt(times / total[shape_row])
    return (
        np.concatenate([word_row, shape_row]),
        np.concatenate([word_place, WORD_DIMS + shape_place]),
        np.concatenate([word_value, shape_value]),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, texts: list[bytes]) -> np.ndarray:
        """P(grade > k) for every threshold k, one row per text."""
        row, place, value = features(texts)
        score = np.bincount(row, self.weights[place] * value, minlength=len(texts))
        return 1 - sigmoid(self.thresholds[None, :] - score[:, None])


def fit_rows(row, place, value, grade, rounds: int = ROUNDS) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on the whole sample.

    The first threshold is free; each further one is the one before plus the
    exponential of a parameter, which keeps them in order.
    """
    count = len(grade)
    weights, cuts = np.zeros(DIMS), np.zeros(GRADES - 1)
    cuts[0] = -1.0
    moments = [[np.zeros(DIMS), np.zeros(DIMS)], [np.zeros(GRADES - 1), np.zeros(GRADES - 1)]]
    for step in range(1, rounds + 1):
        thresholds = np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])]))
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        score = np.bincount(row, weights[place] * value, minlength=count)
        upper, lower = sigmoid(edges[grade + 1] - score), sigmoid(edges[grade] - score)
        chance = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_score = (up - low) / count
        by_weight = np.bincount(place, by_score[row] * value, minlength=DIMS) + RIDGE * weights
        by_edge = np.array(
            [(low[grade == k + 1].sum() - up[grade == k].sum()) / count for k in range(GRADES - 1)]
        )
        tail = np.cumsum(by_edge[::-1])[::-1]
        by_cut = np.concatenate([tail[:1], tail[1:] * np.exp(cuts[1:])])
        for held, (first, second), slope in zip((weights, cuts), moments, (by_weight, by_cut)):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            rate = 0.1 * (1 - 0.9 * step / rounds)
            held -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return OrdinalModel(weights, np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])])))


def _featured(batches):
    for batch in batches:
        for first, texts in slices(batch["text"]):
            row, place, value = features(texts)
            order = np.argsort(row, kind="stable")
            bounds = np.searchsorted(row[order], np.arange(len(texts) + 1))
            cut = lambda a, t: [a[order[x:y]].astype(t).tobytes() for x, y in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["grade"].slice(first, len(texts)),
                    pa.array(cut(place, np.int32), pa.binary()),
                    pa.array(cut(value, np.float32), pa.binary()),
                ],
                ["grade", "place", "value"],
            )


def fit(docs: DataFrame, ratings: DataFrame, *, key: str = "doc_id", text: str = "text", grade: str = "grade") -> OrdinalModel:
    """Fit on at most ``FIT_ROWS`` rated documents, those with the smallest key hashes.

    Of rows with the same key the text with the smallest hash is learned.  A
    document with several ratings has its lowest.  Rows without grade, text
    or key are not learned from; without any row the model has no opinion and
    passes everything.
    """
    rated = (
        ratings.where(F.col(f"`{grade}`").isNotNull() & F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("key"))
        .agg(F.min(f"`{grade}`").cast("int").alias("grade"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(FIT_ROWS)
    )
    texts = docs.select(F.col(f"`{key}`").alias("key"), raw(text).alias("text")).where("text IS NOT NULL")
    # FIT_ROWS pairs of numbers: a size known before anything is read.
    sample = texts.join(F.broadcast(rated), "key").groupBy("key", "grade").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    ).select("grade", "text")
    found = sample.mapInArrow(_featured, "grade int, place binary, value binary")
    rows = sorted((r.grade, bytes(r.place), bytes(r.value)) for r in found.toLocalIterator())
    if not rows:
        return OrdinalModel(np.zeros(DIMS), np.full(GRADES - 1, -40.0))
    grades = np.array([g for g, _, _ in rows], np.int64)
    sizes = [len(p) // 4 for _, p, _ in rows]
    row = np.repeat(np.arange(len(rows)), sizes)
    place = np.frombuffer(b"".join(p for _, p, _ in rows), np.int32)
    value = np.frombuffer(b"".join(v for _, _, v in rows), np.float32)
    known = np.bincount(place, minlength=DIMS)[place] >= LEAST_ROWS
    return fit_rows(row[known], place[known], value[known], grades)


def grade_texts(docs: DataFrame, model: OrdinalModel, *, text: str = "text", out: str = "quality") -> DataFrame:
    """Add ``out``, with underscores if there is such a column: struct of expected_grade and tail_probability (highest grade).

    A NULL or empty text has no features and gets what the thresholds alone
    say.  Other columns stay; nothing is shuffled; equal texts get equal grades.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("struct<expected_grade:double,tail_probability:double>")
    def judge(texts: pa.Array) -> pa.Array:
        tails = [shared.value.tails(part) for _, part in slices(texts)]
        joined = np.concatenate(tails) if tails else np.zeros((0, GRADES - 1))
        return pa.StructArray.from_arrays(
            [pa.array(joined.sum(axis=1)), pa.array(joined[:, -1].copy())],
            ["expected_grade", "tail_probability"],
        )

    name = fresh(docs, out)
    return docs.withColumn(name, judge(raw(text)))


def rating() -> Column:
    """Grade of a row of ``labels``: 0 toxic, 1 poor, 2 good."""
    return (
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    )


#: A document is selected if the highest grade is more likely than not.
SELECT_FROM = 0.5


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, and whether it is selected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = table(spark, sf_dir, "labels").select("doc_id", rating().alias("grade"))
    judged = grade_texts(docs, fit(docs, ratings))
    return judged.select(
        "doc_id",
        "quality.expected_grade",
        "quality.tail_probability",
        (F.col("quality.tail_probability") >= SELECT_FROM).alias("selected"),
    )
