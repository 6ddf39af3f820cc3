"""Packing, archives and shards: exact round trips and limits."""

import gzip
import itertools
import random
import zlib

import compare
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weirgauge.llm import packing, sharding, warc

DOCS = "doc_id bigint, text string"


@pytest.mark.parametrize("axes, bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(axes, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    place = packing.hilbert_place(points, bits)
    assert sorted(place.tolist()) == list(range(len(points)))
    walk = points[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_words_have_the_ids_of_the_whole_text():
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(file), packing.WordIds(file)
    texts = [
        "", " ", "It's the dog's, isn't it? 1234 ÉÀ", "a b c é ́x", "x" * 300 + " y",
        "<|endoftext|> mid<|startoftext|>dle <|endo", "İstanbul straße ǅ ŉ",
        "日本語 текст 🙂🙂 ﬁ", "Σίσυφος ΣΣ", "\x00\x01 tab\there",
    ]
    for text, ids in zip(texts, own.ids([t.encode() for t in texts])):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids + [1]
    rng = random.Random(3)
    pool = [chr(c) for c in range(0x250)] + [chr(c) for c in range(0x300, 0x370)] + ["<|endoftext|>", "<|ENDOFTEXT|>", " the", "'s", "\u3000"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(50))) for _ in range(3000)]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        want = [e.ids + [1] for e in plain.encode_batch_fast(part, add_special_tokens=False)]
        assert [i.tolist() for i in own.ids([t.encode() for t in part])] == want


@pytest.mark.parametrize("length", [16, 2048])
def test_packing_is_whole_and_gapless(spark, length):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(length)
    rows = [(k, " ".join(rng.choice(["tree", "sky", "boat", "Xyzzy!"]) for _ in range(rng.randrange(60)))) for k in range(50)]
    rows += [(60, None), (61, ""), rows[4], rows[4], (None, "no key"), (62, "long " * 3000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("start", F.lit("mine")).repartition(3)
    file = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(df, file, length=length).collect()
    plain = Tokenizer.from_file(file)
    want = {}
    for key, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault(key, []).append(np.array(ids, "<u4").tobytes())
    by_sequence, total = {}, 0
    for p in pieces:
        assert p.length > 0 and len(p.ids) == 4 * p.length
        assert any(p.ids == w[4 * p.start : 4 * (p.start + p.length)] and len(w) == 4 * p.doc_tokens for w in want[p.doc_id])
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        total += p.length
    assert total == sum(len(w) // 4 for ws in want.values() for w in ws)
    sizes = {}
    for number, parts in by_sequence.items():
        at = 0
        for offset, count in sorted(parts):
            assert offset == at
            at += count
        sizes[number] = at
    assert sorted(sizes) == list(range(len(sizes)))
    full = total // length
    assert all(sizes[k] == length for k in range(full))
    assert all(sizes[k] & (sizes[k] - 1) == 0 for k in range(full, len(sizes)))
    assert packing.pack(spark.createDataFrame([], DOCS), file).collect() == []


PAGES = "page_id bigint, url string, html string"


def test_archives_come_back(spark, tmp_path):
    same = "<p>equal</p>" * 100
    rows = [
        (1, "http://a/1", same), (2, "http://a/2", same), (3, "http://a/3", "short"), (4, "http://a/4", "short"),
        (5, "http://a/5", None), (6, None, "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n"), (7, "http://a/\r\n7", "é" * 2000),
        (8, "http://a/8", same), (8, "http://a/8", same), (None, "http://a/9", "nobody"),
    ]
    df = spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit("x")).repartition(3)
    warc.write(df, str(tmp_path / "w"))
    captures = warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()
    assert len(captures) == 10 and len({c.record_id for c in captures}) == 10
    text = {k: (h or "").encode() for k, _, h in rows}
    ids, answered = {}, {x.response.refers_to for x in captures}
    for c in sorted(captures, key=lambda c: c.record_id in answered):
        fields = c.metadata.fields
        page = int(fields.split(": ")[1]) if fields else None
        ids[page] = c
        assert c.response.payload_bytes == len(text[page]) and c.request.target_uri == c.response.target_uri
        kind = "revisit" if page in (1, 2) else "response"
        assert c.response.kind == kind
        assert c.response.payload == (None if kind == "revisit" else text[page])
    assert ids[1].response.refers_to == ids[2].response.refers_to == ids[8].record_id
    kinds = [c.response.kind for c in captures if c.metadata.fields == "page-id: 8\r\n"]
    assert kinds == ["response"] * 2
    warc.write(df.where("false"), str(tmp_path / "none"))
    assert warc.assemble(warc.read(spark, str(tmp_path / "none"))).collect() == []


def test_files_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 12 << 20)
    page = F.concat(F.repeat(F.lit("<p>long page.</p>"), 300_000), F.col("id").cast("string"))
    df = spark.range(0, 7, 1, 1).select(F.col("id").alias("page_id"), F.lit("http://a").alias("url"), page.alias("html"))
    warc.write(df, str(tmp_path / "w"))
    assert len(list((tmp_path / "w").glob("*.gz"))) == 4
    captures = warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()
    assert len(captures) == 7 and all(c.response.payload_bytes == 5_100_001 == len(c.response.payload) for c in captures)


def test_repeated_rows_come_back_as_often(spark, sf_dir):
    from weirgauge.llm.catalog import QUERIES

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    some = pages.orderBy("page_id").limit(5)
    later = some.withColumn("page_id", F.col("page_id") + 1_000_000)
    other = some.withColumn("url", F.concat("url", F.lit("/other")))
    folder = warc.scratch(spark, "pages")
    pages.unionByName(some).unionByName(later).unionByName(later).unionByName(other).write.parquet(f"{folder}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder.removeprefix('file:')}/pages.parquet/*.parquet'")
    assert compare.compare(db, QUERIES["op4_warc"](spark, folder), warc.ORACLE) is None


def test_archives_of_many_members_and_broken_ones():
    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 6\r\n\r\na\r\n\r\nb\r\n\r\n"
    parts = gzip.compress(record) + gzip.compress(record * 3)
    assert [b for _, b in warc.parse(parts)] == [b"a\r\n\r\nb"] * 4
    for broken in (gzip.compress(record[:-9]), zlib.compress(b"x"), gzip.compress(b"text\r\n\r\n")):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.parse(broken))


def shard_rows(df, limit):
    out = sharding.assign(df, F.col("key"), F.col("size"), limit)
    assert out.columns == [*df.columns, "shard"]
    return out.collect()


def test_shards_fit_and_split_only_where_needed(spark):
    rng = random.Random(4)
    rows = [(k, rng.randrange(100), "x") for k in range(2000)] + [(5000, 7000, "big"), (5001, None, "none")]
    df = spark.createDataFrame(rows, "key bigint, size bigint, bytes string")
    got = shard_rows(df, 3000)
    assert sorted((r.key, r.size, r.bytes) for r in got) == sorted(rows)or len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault(r.shard.name, []).append(r)
    for name, held in groups.items():
        total = sum(r.size or 0 for r in held)
        assert len(name) == held[0].shard.depth and held[0].shard.bytes == total and held[0].shard.rows == len(held)
        assert total <= 3000 or len(held) == 1
        parent = sum(r.size or 0 for r in got if r.shard.name.startswith(name[:-1]))
        assert not name or parent > 3000
        assert not any(o != name and o.startswith(name) for o in groups)


def test_shards_of_one_key(spark):
    rows = [("hot", 10)] * 300 + [(None, 10)] * 50 + [(f"k{n}", 10) for n in range(100)]
    got = shard_rows(spark.createDataFrame(rows, "key string, size int"), 400)
    totals = {}
    for r in got:
        totals[r.shard.name] = totals.get(r.shard.name, 0) + r.size
    assert len(got) == 450 and max(totals.values()) <= 400
    assert len({r.shard.name for r in got if r.key == "hot"}) >= 8
    assert shard_rows(spark.createDataFrame([], "key string, size int"), 10) == []
