"""Tables whose columns bear the operators' own names, and repeated or missing keys."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weirgauge.llm import decontaminate, language, licences, packing, quality, sharding, simhash, substrings

OWN = (
    "found quality language licence declared shard n_removed pos row key kept mark size part base number name "
    "first second content shingles node root hits items judged dir path_ cosine bytes depth at place start length"
).split()
WORDS = " ".join(f"word{n}" for n in range(40))
ROWS = [
    (3, WORDS, "en", "a", 1), (1, WORDS + " end", "en", "a", 1), (None, "Licensed under CC BY 4.0", "en", "b", 2),
    (None, None, None, None, None), (1, "", "fr", "b", 0), (1, WORDS, "fr", "b", 0), (8, "une autre phrase", "fr", "c", 3),
]


def documents(spark, upper=False):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.select("*", *[F.lit(f"mine {c}").alias(c.upper() if upper else c) for c in OWN])


def check(df, out, rows=len(ROWS)):
    """The caller's columns come back as they were; the result stands under a name that was free."""
    lower = [c.lower() for c in df.columns]
    assert len(set(lower)) == len(lower)
    got = df.collect()
    assert len(got) == rows
    for c in OWN:
        name = next(n for n in df.columns if n.lower() == c)
        assert all(r[name] == f"mine {c}" for r in got)
    assert out is None or out in df.columns
    return got


@pytest.mark.parametrize("upper", [False, True])
def test_results_leave_the_callers_columns_alone(spark, upper):
    docs = documents(spark, upper)
    bench = spark.createDataFrame([("i", " ".join(WORDS.split()[5:20])), (None, "x")], "item_id string, text string")
    found = check(decontaminate.find_hits(docs, bench.withColumn("words", F.lit(1))), "found_")
    assert sum(len(r["found_"].hits) > 0 for r in found) == 3
    ratings = docs.select("doc_id", F.lit(2).alias("grade"), F.lit(1).alias("key"))
    check(quality.grade_texts(docs, quality.fit(docs, ratings)), "quality_")
    check(language.identify(docs, language.fit(docs, F.col("doc_id"))), "language_")
    placed = docs.withColumn("path", F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    scanned = licences.scan(placed)
    assert "text" not in scanned.columns
    check(scanned, "licence_")
    check(sharding.assign(docs, F.col("doc_id"), F.length("text"), 100), "shard_")
    cut = check(substrings.remove_repeats(docs), "n_removed_")
    assert sorted(r["n_removed_"] for r in cut)[-2:] == [40, 40]


def test_stages_take_such_tables(spark, sf_dir):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns, name
        check(kept, None, kept.count())
        assert stage(spark, docs.where("false"), sf_dir).collect() == []
    near = {(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()}
    assert (1, WORDS) in near and (3, WORDS) not in near and len(near) == 4
    assert corpus_pipeline.pack_tokens(spark, docs, sf_dir).count() >= len(ROWS)
    file = public_tokenizers.path("word_bpe_49k.json")
    assert packing.pack(docs, file).groupBy("doc_id").count().count() == 4


def test_order_of_equal_keys_does_not_depend_on_files(spark):
    docs = documents(spark).withColumn("n_words", F.lit(0))
    results = [
        sorted((str(r.doc_id), str(r.text), r["n_removed_"]) for r in substrings.remove_repeats(docs.repartition(n)).collect())
        for n in (1, 3, 7)
    ]
    assert results[0] == results[1] == results[2]
    survivors = [sorted(str((r.doc_id, r.text)) for r in simhash.keep_one(docs.repartition(n)).collect()) for n in (1, 5)]
    assert survivors[0] == survivors[1]
