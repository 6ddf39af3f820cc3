"""Operators on single texts: decontamination, quality, language, licences."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirgauge.llm import decontaminate, language, licence_texts, licences, quality

DOCS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"


def brute_hits(text, items):
    words = decontaminate.words_of((text or "").encode())
    hit, owners = set(), set()
    for item, other in items:
        theirs = decontaminate.words_of((other or "").encode())
        length = min(10, len(theirs))
        windows = {tuple(theirs[k : k + length]) for k in range(len(theirs) - length + 1)} if length else set()
        for at in range(len(words) - length + 1):
            if tuple(words[at : at + length]) in windows:
                hit |= set(range(at, at + length))
                owners |= {str(item)} if item is not None else set()
    return len(words), len(hit), sorted(owners)


@pytest.mark.parametrize("chunk", [50_000, 7])
def test_hits_match_brute_force(spark, chunk):
    rng = random.Random(chunk)
    word = lambda: f"w{rng.randrange(30)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([0, 2, 4, 10, 11, 25])))) for k in range(12)]
    items += [items[3], (None, " ".join(f"n{k}" for k in range(12))), (90, None), (91, "ÄRGER über Größe")]
    docs = []
    for key in range(40):
        parts = [rng.choice(items)[1] or "" for _ in range(3)] + [" ".join(word() for _ in range(20))]
        rng.shuffle(parts)
        docs.append((key, ", ".join(parts).upper() if key % 2 else "\n".join(parts)))
    docs += [(50, None), (51, ""), (None, docs[0][1]), docs[1], docs[1], (52, "x Ärger über Größe; n0 n1 n2 n3 n4 n5 n6 n7 n8 n9")]
    df = spark.createDataFrame(docs, DOCS).withColumn("Found", F.lit(5)).withColumn("hits", F.lit(6))
    got = decontaminate.find_hits(df, spark.createDataFrame(items, ITEMS), chunk_windows=chunk, out="seen")
    rows = got.select("doc_id", "text", "Found", "seen.n_words", decontaminate.hit_words(F.col("seen")).alias("n"), "seen.items").collect()
    assert len(rows) == len(docs) and all(r.Found == 5 for r in rows)
    for r in rows:
        assert (r.n_words, r.n, r["items"]) == brute_hits(r.text, items), r


def test_no_benchmark_and_no_documents(spark):
    none, one = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b c")], DOCS)
    row = decontaminate.find_hits(one, none).first()
    assert (row.found.n_words, row.found.hits, row.found["items"]) == (3, [], [])
    assert decontaminate.find_hits(spark.createDataFrame([], DOCS), none).collect() == []


WORDS = "stone river meadow window garden evening letter bridge winter morning".split()


def rated(count=400, seed=1):
    rng = random.Random(seed)
    docs, grades = [], []
    for key in range(count):
        words, grade = [rng.choice(WORDS) for _ in range(rng.randrange(20, 80))], key % 3
        if grade == 0:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["grobian", "grobianly"])
        if grade == 1:
            words = [w + rng.choice(["###", "&&&", "$$$"]) for w in words]
        docs.append((key, " ".join(words)))
        grades.append((key, grade))
    return docs, grades


def test_grades_are_learned_and_ordered(spark):
    docs, grades = rated()
    learn = spark.createDataFrame([g for g in grades if g[0] < 300] + [(None, 1), (5, None), (999, 2)], "doc_id bigint, grade int")
    df = spark.createDataFrame(docs + [(1000, None), (1001, ""), (None, docs[2][1])], DOCS).withColumn("Quality", F.lit("q"))
    model = quality.fit(df, learn)
    assert (np.diff(model.thresholds) > 0).all()
    rows = quality.grade_texts(df, model, out="judged").collect()
    assert len(rows) == len(docs) + 3 and all(r.Quality == "q" for r in rows)
    judged = {r.doc_id: r.judged for r in rows if r.doc_id is not None}
    held = [(k, g) for k, g in grades if k >= 300]
    assert np.mean([(judged[k].tail_probability >= 0.5) == (g == 2) for k, g in held]) > 0.95
    means = [np.mean([judged[k].expected_grade for k, g in held if g == want]) for want in range(3)]
    assert means == sorted(means) and all(0 <= j.expected_grade <= 2 for j in judged.values())
    assert judged[1000] == judged[1001]


def test_a_model_of_nothing_passes_everything(spark):
    df = spark.createDataFrame([(1, "a text"), (2, None)], DOCS)
    model = quality.fit(df, spark.createDataFrame([], "doc_id bigint, grade int"))
    assert all(r.quality.tail_probability > 0.5 for r in quality.grade_texts(df, model).collect())
    assert quality.grade_texts(spark.createDataFrame([], DOCS), model).collect() == []


SYLLABLES = {"aa": "lo mi ra te nu".split(), "bb": "scht krz pfl ung ber".split(), "cc": "éa ço ñu œi ãe".split()}


def spoken(count=240, seed=3):
    rng = random.Random(seed)
    rows = []
    for key in range(count):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(30)]
        rows.append((key, " ".join(words), lang))
    return rows


def test_languages(spark):
    rows = spoken()
    schema = "doc_id bigint, text string, lang string"
    learn = spark.createDataFrame([r for r in rows if r[0] < 160] + [(None, "lo mi", "aa"), (300, "krz", None), (301, None, "bb")], schema)
    model = language.fit(learn, F.col("doc_id"))
    assert sorted(set(model.names)) == ["aa", "bb", "cc"]
    asked = [(k, t) for k, t, _ in rows if k >= 160] + [(900, None), (901, ""), (902, "12 + 34!"), (903, "LO MI RA"), (903, "LO MI RA")]
    df = spark.createDataFrame(asked, DOCS).withColumn("Language", F.lit(1))
    got = language.identify(df, model, out="spoken").collect()
    assert len(got) == len(asked) and all(0 <= r.spoken.score <= 1 for r in got)
    found = {r.doc_id: r.spoken.lang for r in got}
    assert all(found[k] == lang for k, _, lang in rows if k >= 160) and found[903] == "aa"
    assert [found[k] for k in (900, 901, 902)] == ["und"] * 3
    far = language.identify(df, model, min_cosine=1.1).collect()
    assert {r.language_.lang for r in far} == {"und"}  # the table has a column Language
    none = language.fit(learn.where("false"), F.col("doc_id"))
    assert {r.language_.lang for r in language.identify(df, none).collect()} == {"und"}


def test_licences_are_declared_and_inherited(spark):
    files = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/code.c", "int main;\n// Licensed under the Apache License, Version 2.0.\nreturn"),
        ("a/b/other.c", "nothing here"),
        ("a/b/c/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/c/d/deep.c", "still nothing"),
        ("a/b/c/d/deep.c", "still nothing"),
        ("z/far.c", "a licence to say other things, at great length and with many further words"),
        ("root.c", ""), (None, None), ("a/empty.c", None),
        ("abc/not_below_a.c", "x"),
    ]
    df = spark.createDataFrame(files, "path string, text string").withColumn("Licence", F.lit(7))
    got = licences.scan(df, out="found")
    assert got.columns == ["path", "Licence", "found"]
    rows = sorted((str(r.path), r.found.licence, r.found.origin, r.found.from_dir) for r in got.collect())
    assert rows == sorted(
        [
            ("None", None, "none", None),
            ("a/LICENSE", "MIT", "text", None),
            ("a/b/c/COPYING.txt", "GPL-3.0-only", "text", None),
            ("a/b/c/d/deep.c", "GPL-3.0-only", "directory", "a/b/c"),
            ("a/b/c/d/deep.c", "GPL-3.0-only", "directory", "a/b/c"),
            ("a/b/code.c", "Apache-2.0", "text", None),
            ("a/b/other.c", "MIT", "directory", "a"),
            ("a/empty.c", "MIT", "directory", "a"),
            ("abc/not_below_a.c", None, "none", None),
            ("root.c", None, "none", None),
            ("z/far.c", None, "none", None),
        ]
    )
    assert licences.scan(df.where("false")).collect() == []
    known = licences.Templates()
    assert all(known.scan(t.encode())[1] == known.named(n, []) for n, t in licence_texts.templates())


NOTICE = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the {} as published by "
    "the Free Software Foundation; either version {} of the License, or (at your option) any later version."
)
STATEMENTS = [
    ("Copyright (c) 2020 Foo Corp. All rights reserved.", "Proprietary"),
    ("Copyright (c) 2020 Jane Doe. Licensed under the MIT license.", "MIT"),
    ("This project is licensed under the MIT License - see the LICENSE file for details", "MIT"),
    ("Photo of a river by someone, and it is licensed under CC BY 4.0 on Flickr", "CC-BY-4.0"),
    ("Photo of a river by someone, and it is licensed under CC BY-SA 4.0 on Flickr", "CC-BY-SA-4.0"),
    ("# Some tool of ours. Licensed\n# under the Apache License,\n# Version 2.0 and no other, as was said", "Apache-2.0"),
    ("Our whole library is licensed under the GNU General Public License, version 2 as we all know", "GPL-2.0-only"),
    ("// SPDX-License-Identifier: MIT", "MIT"),
    ("/* SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) */ int x;", "GPL-2.0-only OR BSD-3-Clause"),
    *((NOTICE.format(f"GNU {name}General Public License", v), f"{licence}-{full}-or-later") for name, licence, v, full in (
        ("", "GPL", "2", "2.0"), ("", "GPL", "3", "3.0"), ("Lesser ", "LGPL", "2.1", "2.1"), ("Affero ", "AGPL", "3", "3.0"))),
    ("Licensed under the GNU Library General Public License, version 2 or (at your option) any later version", "LGPL-2.0-or-later"),
    ("licensed under the GNU General Public License, version 4", None),
    (licence_texts.BSD_SENTENCE + "\n1. " + licence_texts.BSD_SOURCE + "\n2. " + licence_texts.BSD_BINARY + "\n" + licence_texts.BSD_WARRANTY, "BSD-2-Clause"),
    (licence_texts.BSD_SENTENCE + "\n1. " + licence_texts.BSD_SOURCE + "\n2. " + licence_texts.BSD_BINARY + "\n3. "
     + licence_texts.BSD_NAMES.replace("the copyright holder", "the Foo Project") + licence_texts.BSD_WARRANTY, "BSD-3-Clause"),
    ("This product is under the Apache License, Version 1.1", "Apache-1.1"),
    ("Licensed under the Apache License, Version 3.0", None),
    ("It is licensed under CC BY 3.0", "CC-BY-3.0"),
    ("It is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"),
    ("It is licensed under CC BY-ND 4.0", "CC-BY-ND-4.0"),
    (licence_texts.ISC_GRANT + '. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS', "0BSD"),
    (licence_texts.ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.", "ISC"),
    ("This code is NOT released under the MIT License", None),
    ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the License)", "MPL-1.1"),
    ("made available under the terms of the Eclipse Public License v2.0 which is available at", "EPL-2.0"),
    ("They gave up all rights to the house and were paid for it", None),
    ("The school was released from the plan under the public license office", None),
]


def test_statements_inside_longer_and_wrapped_lines(spark):
    filler = " ".join(WORDS * 5)
    files = [(f"f{k}", text) for k, (text, _) in enumerate(STATEMENTS)]
    files += [(f"g{k}", f"{filler} {text} {filler}") for k, (text, _) in enumerate(STATEMENTS)]
    got = licences.declared(spark.createDataFrame(files, "path string, text string")).collect()
    found = {r.path: r.declared.licence for r in got}
    assert found == {f"{c}{k}": name for c in "fg" for k, (_, name) in enumerate(STATEMENTS)}


def test_rare_languages_keep_rows_beside_many_frequent_ones(spark):
    rows, key = [], 0
    for number in range(20):
        for _ in range(450 if number < 17 else 5):
            rows.append((key, " ".join(f"{chr(0x4E00 + 50 * number + (key + k) % 7)}" * 3 for k in range(4)), f"l{number:02}"))
            key += 1
    df = spark.createDataFrame(rows + [(None, "x", "l19")] * 3, "doc_id bigint, text string, lang string")
    sample = language._sample(df, F.col("doc_id"), "text", "lang").groupBy("lang").count().collect()
    counts = {r["lang"]: r["count"] for r in sample}
    assert len(counts) == 20 and sum(counts.values()) <= language.ROWS_IN_ALL + 20
    assert [counts[f"l{k}"] for k in (17, 18, 19)] == [5, 5, 8]
    model = language.fit(df, F.col("doc_id"))
    assert len(set(model.names)) == 20
    asked = df.where("doc_id is not null and lang >= 'l17'")
    judged = language.identify(asked, model).select("lang", F.col("language.lang").alias("found")).collect()
    assert all(r.lang == r.found for r in judged)


def test_ordinal_fit_against_its_likelihood():
    """The fitted model is near the best of the penalised likelihood, computed row by row."""
    rng = np.random.default_rng(2)
    count, dims = 400, 12
    table = np.round(rng.random((count, dims)) * (rng.random((count, dims)) < 0.5), 3)
    true = rng.standard_normal(dims) * 2
    chance = lambda x: 1 / (1 + np.exp(-x))
    grade = np.array([int(u < chance(s)) + int(u < chance(s - 1.5)) for u, s in zip(rng.random(count), table @ true)])
    row, place = np.nonzero(table)

    def loss(weights, thresholds):
        total = 0.0
        for line, g in zip(table, grade):
            tails = [1.0, *(1 - chance(t - line @ weights) for t in thresholds), 0.0]
            total -= np.log(max(tails[g] - tails[g + 1], 1e-9))
        return total / count + quality.RIDGE / 2 * (weights**2).sum()

    model = quality.fit_rows(row, place, table[row, place], grade, rounds=600)
    weights, thresholds = model.weights[:dims], model.thresholds
    assert (model.weights[dims:] == 0).all() and thresholds[0] < thresholds[1]
    best = loss(weights, thresholds)
    assert best < loss(np.zeros(dims), np.array([-0.5, 0.5])) - 0.1
    for _ in range(60):
        step, shift = rng.standard_normal(dims) * 0.1, rng.standard_normal(2) * 0.1
        assert loss(weights + step, np.sort(thresholds + shift)) > best - 2e-4
    tails = model.tails([b"some text", b""])
    assert (tails[:, 0] >= tails[:, 1]).all() and tails.shape == (2, 2)


def test_nearest_centroid_and_rejection_at_a_real_distance(spark):
    rng = random.Random(6)
    sets = {"a": "abcdefg", "h": "hijklmn", "o": "opqrstu", "w": "vwxyzäö"}
    line = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(20))
    rows = [(k, line(sets[n]), n) for k, n in enumerate("aho" * 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(df.where("doc_id % 4 <> 2"), F.col("doc_id"))
    unseen = [r for r in rows if r[0] % 4 == 2] + [(900 + k, line(sets["w"]), "w") for k in range(20)]
    asked = spark.createDataFrame(unseen, "doc_id bigint, text string, lang string")
    judged = {r.doc_id: r for r in language.identify(asked, model, min_cosine=0.3, out="found").collect()}
    for key, text, lang in unseen:
        vector = language.weigh(language.gram_counts([text.encode()]), model.rarity)[0]
        cosines = [sum(float(a) * float(b) for a, b in zip(vector, centre)) for centre in model.centroids]
        near = max(range(len(cosines)), key=lambda k: cosines[k])
        assert abs(judged[key].found.score - cosines[near]) < 1e-4
        want = model.names[near] if cosines[near] >= 0.3 else "und"
        assert judged[key].found["lang"] == want == (lang if lang != "w" else "und")
