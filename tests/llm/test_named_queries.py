"""Registered queries that SQL cannot state, against plain versions over whole tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from .test_pairs import brute_components

from weirgauge.llm import licences
from weirgauge.llm.catalog import QUERIES


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def test_fingerprints_and_components(spark, sf_dir, docs):
    got = sorted((tuple(r) for r in QUERIES["op1_simhash"](spark, sf_dir).collect()), key=repr)
    assert got == brute_components([(r.doc_id, r.text) for r in docs])


def test_packed_pieces(spark, sf_dir, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: np.array(plain.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4") for r in docs}
    rows = QUERIES["op3_pack"](spark, sf_dir).collect()
    taken = dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == taken[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        taken[r.doc_id] += r.length
    assert taken == {k: len(v) for k, v in ids.items()}
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    full = [k for k, n in ends.items() if n == 2048]
    assert len(full) == sum(taken.values()) // 2048 and max(ends.values()) == 2048


def nearest_of_all_spans(templates, text):
    """Every span of every template's length, by the definition alone."""
    words = licences.words_of(text.encode())
    marks = set(licences.decisive_places(words))
    denied = [w in licences.NEGATIONS for w in words]
    best = (0.0, None)
    for name, theirs, wanted in zip(templates.names, templates.words, templates.decisive):
        length = min(len(theirs), len(words))
        vector = dict(templates.weigh(licences.terms_of(theirs)))
        for at in range(len(words) - length + 1):
            span = words[at : at + length]
            if {words[k] for k in marks & set(range(at, at + length))} != wanted:
                continue
            if sum(denied[max(0, at - licences.BEFORE) : at + length]) > sum(w in licences.NEGATIONS for w in theirs):
                continue
            counts = Counter(span) + Counter(zip(span, span[1:]))
            raw = {t: (1 + math.log(n)) * templates.rarity.get(t, templates.rarest) for t, n in counts.items()}
            cosine = sum(w * vector.get(t, 0) for t, w in raw.items()) / math.sqrt(sum(w * w for w in raw.values()))
            if cosine >= licences.LEAST_COSINE and cosine > best[0] + 1e-9:
                best = (cosine, templates.named(name, words[at + length : at + length + licences.AFTER]))
    return best


def test_licences_of_all_documents(spark, sf_dir, docs):
    templates, own, paths = licences.Templates(), {}, {}
    opens = re.compile(r"\s*(licensed|released|this work is licensed|all rights reserved)", re.I)
    for r in docs:
        text = r.text or ""
        base = f"{r.source or '-'}/{r.lang or '-'}/{r.doc_id // 1000}"
        licence_file = bool(opens.match(text))
        paths[r.doc_id] = f"{base}/LICENSE.{r.doc_id}" if licence_file else f"{base}/{r.doc_id // 100}/doc-{r.doc_id}"
        own[r.doc_id] = nearest_of_all_spans(templates, text)
    assert len({name for _, name in own.values()}) >= 5
    folders = {}
    for key, path in paths.items():
        if "/LICENSE." in path and own[key][1]:
            folders.setdefault(path.rpartition("/")[0], []).append((-own[key][0], path, own[key][1]))
    want = []
    for key, path in paths.items():
        licence, origin, folder = own[key][1], "text", path.rpartition("/")[0]
        while licence is None and folder:
            if folder in folders:
                licence, origin = min(folders[folder])[2], "directory"
            folder = folder.rpartition("/")[0]
        want.append((key, path, licence, origin if licence else "none"))
    got = [(r.doc_id, r.path, r.licence, r.origin) for r in QUERIES["op5_licences"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want)


def test_quality_and_language_on_rows_not_learned_from(spark, sf_dir, docs):
    judged = QUERIES["op8_language"](spark, sf_dir).collect()
    lang = {r.doc_id: r.lang for r in docs}
    assert {r.doc_id: r.held_out for r in judged} == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in lang}
    unseen = [r for r in judged if r.held_out and lang[r.doc_id] is not None]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in unseen]) > 0.9
    rows = {r.doc_id: r for r in QUERIES["op6_quality"](spark, sf_dir).collect()}
    assert set(rows) == set(lang)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    good = [rows[r.doc_id].selected == (r.quality == 1 and r.toxic == 0) for r in labels if r.doc_id in rows]
    assert np.mean(good) > 0.9
    assert all(r.selected == (r.tail_probability >= 0.5) and 0 <= r.expected_grade <= 2 for r in rows.values())


def test_neighbours_of_the_query_vectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, data = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got, hits, total = QUERIES["op9_neighbours"](spark, sf_dir).collect(), 0, 0
    assert {r.query_id for r in got} == {k for k in ids.tolist() if k % 100 == 0}
    for q in {r.query_id for r in got}:
        far = np.sqrt(((data - data[ids == q][0]) ** 2).sum(1))
        best = {k for _, k in sorted((d, k) for d, k in zip(far, ids.tolist()) if k != q)[:10]}
        mine = [r for r in got if r.query_id == q]
        assert sorted(r.rank for r in mine) == list(range(1, 11))
        assert all(abs(far[ids == r.vec_id][0] - r.score) < 1e-12 for r in mine)
        hits, total = hits + len(best & {r.vec_id for r in mine}), total + len(best)
    assert hits >= 0.9 * total
