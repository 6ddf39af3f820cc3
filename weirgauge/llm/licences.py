"""Licence scan: sparse TF-IDF cosine to templates, then inheritance by directory.

Every run of as many words as a template has, across line ends, is compared with
that template; a shorter text is compared as a whole.  Terms are words and pairs
of words; rare terms of the templates weigh most, and words no template has weigh
as the rarest.

Licences whose statements are nearly alike are told apart by the words in which
they differ: a span must have its template's decisive words, names and versions,
and no others, so an unknown version has no licence rather than a wrong one.  A
statement that is negated does not count.  "Or later" after a statement of the
GNU licences makes it one for later versions.  An SPDX tag names its licence
itself.

A file without a licence of its own gets that of the nearest directory above it
that has a licence file: directories are joined to their ancestors' licences by
path, one row per directory and level.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .batches import fresh, raw, stored
from .licence_texts import DECISIVE, EITHER, NEGATIONS, templates
from .registry import query, table

#: A span at least so near to its template carries its licence.
LEAST_COSINE = 0.7
#: Words before a span in which a negation counts, and after it in which "later" or "only" does.
BEFORE, AFTER = 3, 12

LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[^/]*)?$"
_WORD = re.compile(rb"[a-z0-9']+(?:[.-][a-z0-9]+)*")
_DECISIVE = frozenset(w.encode() for w in DECISIVE)
_LEADING = frozenset((b"version", b"v", b"license", b"licence"))
_VERSION = re.compile(rb"v?([0-9](?:\.[0-9])?)$")
_TAG = re.compile(rb"(?i:spdx-license-identifier):[ \t]*\(?([A-Za-z0-9.+-]+(?:[ \t]+(?:OR|AND|WITH)[ \t]+[A-Za-z0-9.+-]+)*)")


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case; versions without "v" and without a final ".0"."""
    words = []
    for word in _WORD.findall(text.lower()):
        version = _VERSION.match(word)
        words.append(version[1].removesuffix(b".0") if version else word)
    return words


def decisive_places(words: list[bytes]) -> list[int]:
    """Where names of licences stand, and numbers that follow one, or "version", "v" or "license"."""
    found, named = [], False
    for k, word in enumerate(words):
        name = word in _DECISIVE
        if name or named and _VERSION.match(word):
            found.append(k)
        named = name or word in _LEADING
    return found


def terms_of(words: list[bytes]) -> Counter:
    return Counter([*words, *zip(words, words[1:])])


class Templates:
    """Unit vectors of the templates, found by the decisive word of each that fewest templates have."""

    def __init__(self):
        self.names = [name for name, _ in templates()]
        self.words = [words_of(text.encode()) for _, text in templates()]
        counted = [terms_of(words) for words in self.words]
        seen = Counter(t for c in counted for t in c)
        self.rarest = math.log(len(counted) + 1) + 1
        self.rarity = {t: math.log((len(counted) + 1) / n) + 1 for t, n in seen.items()}
        self.unit = [self.weigh(c) for c in counted]
        self.decisive = [frozenset(words[k] for k in decisive_places(words)) for words in self.words]
        self.negations = [sum(w in NEGATIONS for w in words) for words in self.words]
        self.by_anchor: dict[bytes, list[int]] = {}
        for number, words in enumerate(self.decisive):
            anchor = min((w for w in words if not _VERSION.match(w)), key=lambda w: (w == b"by", seen[w], w))
            self.by_anchor.setdefault(anchor, []).append(number)
        self.anchors = sorted(self.by_anchor)

    def weigh(self, counts: Counter) -> dict:
        rarity, rarest = self.rarity, self.rarest
        weights = {t: (1 + math.log(n)) * rarity.get(t, rarest) for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values())) or 1.0
        return {t: w / norm for t, w in weights.items()}

    def candidates(self, words: list[bytes]) -> set[tuple[int, int]]:
        """(template, start) of every span that has just the template's decisive words.

        Such a span holds the template's anchor, so spans around anchors are all there are.
        """
        found: set[tuple[int, int]] = set()
        places: dict[bytes, list[int]] = {}
        marked = decisive_places(words)
        for k in marked:
            if words[k] in self.by_anchor:
                places.setdefault(words[k], []).append(k)
        at = np.array(marked, np.int64)
        for anchor, where in places.items():
            for number in self.by_anchor[anchor]:
                wanted, length = self.decisive[number], min(len(self.words[number]), len(words))
                for place in where:
                    first, last = max(0, place - length + 1), min(place, len(words) - length)
                    for start in range(first, last + 1):
                        low, high = np.searchsorted(at, (start, start + length)) if len(marked) > 64 else (0, len(marked))
                        if {words[k] for k in marked[low:high] if start <= k < start + length} == wanted:
                            found.add((number, start))
        return found

    def scan(self, text: bytes) -> tuple[float, str | None]:
        """(cosine, licence) of the nearest span or tag; (0, None) if nothing is near.  Ties go to the first template."""
        tag = _TAG.search(text)
        if tag:
            return 1.0, " ".join(tag.group(1).decode().split())
        low = text.lower()
        if not any(a in low for a in self.anchors):
            return 0.0, None
        words = words_of(low)
        best: tuple[float, int, int] = (0.0, 0, 0)
        for number, start in sorted(self.candidates(words)):
            length = min(len(self.words[number]), len(words))
            span, unit = words[start : start + length], self.unit[number]
            denied = sum(w in NEGATIONS for w in words[max(0, start - BEFORE) : start + length])
            if denied > self.negations[number]:
                continue
            score = sum(w * unit.get(t, 0.0) for t, w in self.weigh(terms_of(span)).items())
            if score >= LEAST_COSINE and score > best[0] + 1e-9:
                best = (score, number, start + length)
        if not best[0]:
            return 0.0, None
        return best[0], self.named(self.names[best[1]], words[best[2] : best[2] + AFTER])

    @staticmethod
    def named(name: str, following: list[bytes]) -> str:
        """With "-only" or "-or-later" where the licence has both."""
        if name.partition("-")[0] not in EITHER:
            return name
        return f"{name}-or-later" if b"later" in following and b"or" in following else f"{name}-only"


def declared(files: DataFrame, *, text: str = "text", out: str = "declared") -> DataFrame:
    """Add ``out``, with underscores if there is such a column: struct of licence and cosine, NULL and 0 if nothing is near.

    NULL and empty texts declare nothing.  Other columns stay; nothing is
    shuffled; equal texts are judged alike.
    """
    known = Templates()

    @arrow_udf("struct<licence:string,cosine:double>")
    def judge(texts: pa.Array) -> pa.Array:
        found = [known.scan(t.as_py() or b"") for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([n for _, n in found], pa.string()), pa.array([s for s, _ in found], pa.float64())],
            ["licence", "cosine"],
        )

    name = fresh(files, out)
    return files.withColumn(name, judge(raw(text)))


def directory(path: Column) -> Column:
    """The part before the last slash; "" for a file at the root."""
    return F.coalesce(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.lit(""))


def inherited(files: DataFrame, *, path: str = "path", found: str = "declared") -> DataFrame:
    """(dir, licence, from_dir) of every directory below a licence file.

    Several licence files of a directory: the nearest to its template, then the
    smallest path.  A directory's own licence counts before any above it.
    """
    named = files.select(F.col(f"`{path}`").alias("path"), F.col(f"`{found}`").alias("found"))
    placed = named.withColumn("dir", directory(F.col("path")))
    licensed = (
        placed.where(F.col("path").rlike(LICENCE_FILE) & F.col("found.licence").isNotNull())
        .groupBy("dir")
        .agg(F.min(F.struct((-F.col("found.cosine")).alias("far"), "path", F.col("found.licence").alias("licence"))).alias("best"))
        .select(F.col("dir").alias("from_dir"), F.col("best.licence").alias("licence"))
    )
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("from_dir")))
    levels = placed.select("dir").distinct().select("dir", F.inline(above).alias("depth", "from_dir"))
    return (
        levels.join(licensed, "from_dir")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "from_dir", "licence")).alias("nearest"))
        .select("dir", F.col("nearest.licence").alias("licence"), F.col("nearest.from_dir").alias("from_dir"))
    )


def scan(files: DataFrame, *, path: str = "path", text: str = "text", out: str = "licence") -> DataFrame:
    """Add ``out``, with underscores if there is such a column: struct of licence, origin (text, directory, none), cosine and from_dir.

    A NULL path lies in the root directory.  ``text`` is dropped; all other
    columns and every row are kept.
    """
    own = [c for c in files.columns if c != text]
    name, held = fresh(files, out), fresh(files, "declared")
    rows = stored(
        declared(files, text=text, out=held).select(
            F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col(f"`{path}`").alias("path"),
            F.col(held).alias("declared"),
        ),
        "licences",
    )
    above = inherited(rows)
    joined = rows.withColumn("dir", directory(F.col("path"))).join(above, "dir", "left")
    mine = F.col("declared.licence")
    answer = F.struct(
        F.coalesce(mine, F.col("licence")).alias("licence"),
        F.when(mine.isNotNull(), "text").when(F.col("licence").isNotNull(), "directory").otherwise("none").alias("origin"),
        F.col("declared.cosine").alias("cosine"),
        F.when(mine.isNull(), F.col("from_dir")).alias("from_dir"),
    )
    return joined.select("row", answer.alias(name)).select(*[F.col(f"row.`{c}`") for c in own], name)


@query("op5_licences")
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, declared in its text or by its directory.

    The table has no paths: documents lie in source/language/thousand/hundred,
    and one that opens with a licence statement is a licence file of its
    thousand.
    """
    docs = table(spark, sf_dir, "documents")
    opens = F.coalesce(F.lower("text").rlike(r"^\s*(licensed|released|this work is licensed|all rights reserved)"), F.lit(False))
    number = F.col("doc_id").cast("string")
    group = lambda size: F.floor(F.col("doc_id") / size).cast("string")
    name = F.when(opens, F.concat(F.lit("LICENSE."), number)).otherwise(
        F.concat_ws("/", group(100), F.concat(F.lit("doc-"), number))
    )
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), group(1000), name)
    scanned = scan(docs.select("doc_id", path.alias("path"), "text"))
    return scanned.select("doc_id", "path", "licence.licence", "licence.origin", "licence.cosine", "licence.from_dir")
