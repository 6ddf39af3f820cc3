"""Token files, alignment and lexical search against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weirgauge.llm import alignment, byte_words, hash_index, lexical, run_table, token_files
from weirgauge.llm.catalog import QUERIES

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id bigint, text string"
ODD = [
    "", " ", "a  b", "a \n b", "a\n \nb", "a   b  ", " \t\n x", "It's we'll 12ab !!'s", "<|endoftext|>", "x<|endoftext|>y",
    "▁ x", "日本語 текст 🙂🙂 ﬁ", "\x00\x01 \x85　z", "end \n", "end \n ", "᳀ ༓", "# " * 50, "é" * 400,
]


def random_texts(seed, count):
    rng = random.Random(seed)
    pool = [chr(c) for c in range(0x250)] + list("  \n\n\t 's'll 12!") + ["<|endoftext|>", " the", " of"]
    pool += [chr(rng.choice([c, 0x1F600]) if 0xD800 <= c < 0xE000 else c) for c in (rng.randrange(0x110000) for _ in range(200))]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(50))).encode("utf-8", "replace").decode() for _ in range(count)]


@pytest.mark.parametrize("specials", [True, False])
def test_words_give_the_ids_of_the_whole_text(specials, monkeypatch):
    monkeypatch.setattr(run_table, "ENTRIES", 500)
    plain, own = Tokenizer.from_file(BYTES), byte_words.ByteWords(BYTES, specials)
    plain.encode_special_tokens = not specials
    texts = ODD + random_texts(7, 3000)
    found = [i for at in range(0, len(texts), 100) for i in own.ids([t.encode() for t in texts[at : at + 100]])]
    want = plain.encode_batch_fast(texts, add_special_tokens=False)
    assert all(np.array_equal(a, b.ids) for a, b in zip(found, want))
    assert own.runs.entries < 1500


def test_table_of_runs_keeps_what_it_holds():
    rng = random.Random(8)
    table, want = run_table.RunTable(np.dtype("<u2")), {}
    for _ in range(30):
        words = {bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(1, 25))) for _ in range(300)} - set(want)
        new = {w: [rng.randrange(1 << 16) for _ in range(rng.randrange(1, 5))] for w in words}
        both = lambda ws: (run_table.words_of(np.frombuffer(b"".join(w.ljust(32, b"?") for w in ws), np.uint8), 32 * np.arange(len(ws)), np.array([len(w) for w in ws])), np.array([len(w) for w in ws]))
        assert (table.find(*both(list(new))) < 0).all()
        table.add(*both(list(new)), np.array([i for ids in new.values() for i in ids], "<u2"), np.array([len(i) for i in new.values()]))
        want |= new
    ids, counts = table.gather(table.find(*both(list(want))))
    assert np.split(ids, np.cumsum(counts)[:-1]) and [i.tolist() for i in np.split(ids, np.cumsum(counts)[:-1])] == list(want.values())


def test_perfect_hash_is_minimal_and_exact():
    rng = np.random.default_rng(3)
    h1, h2 = rng.integers(0, 2**63, (2, 5000)).astype(np.uint64)
    h1[10:13], h2[10:13] = 5, 6  # three keys whose hashes are all equal
    keys = sorted(f"k{n:05}".encode() for n in range(5000))
    keys[0] = None
    entry = np.repeat(np.arange(5000), rng.integers(1, 4, 5000))
    values = np.stack([entry, np.arange(len(entry))], axis=1)
    built = hash_index.HashIndex.build([keys[e] for e in entry], h1[entry], h2[entry], values)
    index = hash_index.HashIndex.from_bytes(built.to_bytes())
    slots = index.levels.slot(h1, h2)
    assert sorted(set(slots.tolist()) - {-1}) == list(range(index.levels.slots)) and index.levels.slots >= 4990
    assert sorted(index.kept) == sorted(keys[10:13])
    who, found = index.look_up(keys, h1, h2)
    assert sorted(zip(who.tolist(), found[:, 0].tolist(), found[:, 1].tolist())) == [(e, e, n) for n, e in enumerate(entry.tolist())]
    absent = rng.integers(0, 2**63, (2, 20000)).astype(np.uint64)
    assert len(index.look_up([b"no"] * 20000, *absent)[0]) == 0
    empty = hash_index.HashIndex.build([], h1[:0], h2[:0], values[:0])
    assert len(hash_index.HashIndex.from_bytes(empty.to_bytes()).look_up(keys, h1, h2)[0]) == 0


def expected_files(rows):
    plain, at, want = Tokenizer.from_file(BYTES), 0, []
    for key, text in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        want.append((key, at, len(ids) // 4, zlib.crc32(ids), ids))
        at += len(ids) // 4
    return want


@pytest.mark.parametrize("shard_bytes", [4, 500, 1 << 20])
def test_token_files_come_back(spark, tmp_path, shard_bytes):
    rows = [(None, None), (None, "x")] + [(-3, "word " * 9000)] + [(5, "a"), (5, "a"), (5, "a"), (5, "bc"), (5, "bcde")]
    rows += [(10 + k, t) for k, t in enumerate(ODD + random_texts(1, 60)) if "\x00" not in t or k > 12]
    df = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), DOCS).withColumn("Key", F.lit(1)).withColumn("shard", F.lit("x"))
    path = str(tmp_path / "files")
    token_files.write(df.repartition(5), path, BYTES, shard_bytes=shard_bytes)
    want = expected_files(rows)
    got = token_files.fetch(spark, path, df).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    some = spark.createDataFrame([(5,), (5,), (-3,), (99999,), (None,)], "doc_id bigint")
    got = token_files.fetch(spark, path, some, payloads=False).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == [w[:4] for w in want if w[0] in (5, -3, None)]
    files = token_files.read(spark, path, payloads=True).orderBy("shard", "place").collect()
    assert b"".join(r.ids for r in files) == b"".join(w[4] for w in want)


def test_token_files_of_nothing_and_damaged_ones(spark, tmp_path):
    path = str(tmp_path / "none")
    empty = spark.createDataFrame([], DOCS)
    token_files.write(empty, path, BYTES)
    assert token_files.fetch(spark, path, spark.createDataFrame([(1, "a")], DOCS)).collect() == []
    whole = token_files.pack_shard(3, [b"a", None], [np.array([1, 2], "<u2"), np.array([2], "<u2")], np.dtype("<u2")) + b"\n"
    number, keys, ids, counts = token_files.open_shard(memoryview(whole))
    assert (number, keys, ids.tolist(), counts.tolist()) == (3, [b"a", None], [1, 2, 2], [2, 1])
    for broken in (whole[:-1], whole[1:], b"", b"x" * 80 + b"\n"):
        with pytest.raises(ValueError):
            token_files.open_shard(memoryview(broken))


def brute_alignment(rows):
    """Groups by walking over both token lists; counts by plain dictionaries."""
    plain, pieces = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain.encode_special_tokens = True
    letters = alignment._byte_letters()
    found, linked = [], collections.Counter()
    for key, text in rows:
        whole = (" " + (text or "")).encode()
        a = plain.encode(whole.decode(), add_special_tokens=False) if text else None
        b = pieces.encode(text or "")
        of_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(of_b) != whole:
            found.append((key, 0, 0, 0, [], ""))
            continue
        of_a = [bytes(letters[c] for c in t) for t in a.tokens]
        groups, links, i, j, at_a, at_b = [], [], 0, 0, 0, 0
        while i < len(of_a):
            first, other = i, j
            at_a, i = at_a + len(of_a[i]), i + 1
            at_b, j = at_b + len(of_b[j]), j + 1
            while at_a != at_b:
                if at_a < at_b:
                    at_a, i = at_a + len(of_a[i]), i + 1
                else:
                    at_b, j = at_b + len(of_b[j]), j + 1
            groups.append(",".join(map(str, a.ids[first:i])) + "|" + ",".join(map(str, b[other:j])))
            spans = [np.cumsum([0, *map(len, x)]) for x in (of_a[first:i], of_b[other:j])]
            for p in range(i - first):
                for q in range(j - other):
                    if spans[0][p] < spans[1][q + 1] and spans[1][q] < spans[0][p + 1]:
                        links.append((a.ids[first + p], b[other + q]))
        linked.update(set(links))
        found.append((key, len(of_a), len(of_b), len(groups), links, ";".join(groups)))
    top = collections.Counter()
    for (a, _), n in linked.items():
        top[a] = max(top[a], n)
    return [
        (key, n_a, n_b, n, len(links), sum(linked[x] == top[x[0]] for x in links), sum(linked[x] for x in links), groups)
        for key, n_a, n_b, n, links, groups in found
    ]


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def test_alignment_equals_a_walk(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 2000)
    rows = [(k, t) for k, t in enumerate(ODD + random_texts(3, 150))]
    rows += [(None, None), (None, "no key"), (7, "a 12 b"), (7, "a 12 b"), (900, "antidisestablishment 日本 " * 900)]
    df = spark.createDataFrame(rows, DOCS).withColumn("Block", F.lit(1)).withColumn("n_a", F.lit("x")).withColumn("key", F.lit(0))
    got = alignment.align(df.repartition(4), BYTES, PIECES).collect()
    want = by_key(brute_alignment(rows))
    assert by_key(got) == want
    short = alignment.align(df, BYTES, PIECES, as_text=False).collect()
    assert by_key(short) == by_key((*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in want)
    assert alignment.align(df.where("false"), BYTES, PIECES).collect() == []


def test_jumping_over_long_chains():
    a = np.array([2 * k + 2 for k in range(5000)])
    b = np.append(np.array([2 * k + 1 for k in range(5000)]), 10000)
    assert set(alignment.jump(a, b).tolist()) == {4999}
    assert alignment.jump(a, a).tolist() == list(range(5000)) * 2
    assert alignment.jump(a[:0], a[:0]).tolist() == []


def test_alignment_query_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in brute_alignment(rows)]
    got = QUERIES["op11_align"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert by_key(got.collect()) == by_key(want)


def test_token_files_query_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    got = QUERIES["op13_token_files"](spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [w[:4] for w in expected_files(rows)]


def brute_search(docs, items, k):
    parts = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    held = [(key, parts(text)) for key, text in docs]
    n, total = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = collections.Counter(t for _, w in held for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for key, words in held:
            tf, m = collections.Counter(words), 75 + (25 * len(words) * n) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
                for t in parts(text) if tf[t]
            )
            if score > 0:
                scores.append((-score, key is not None, key or 0))
        out += [(item, r + 1, key if known else None, -s) for r, (s, known, key) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("portion", [300, 1 << 20])
def test_search_equals_brute_force(spark, monkeypatch, portion):
    monkeypatch.setattr(lexical, "PORTION_BYTES", portion)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 40)
    rng = random.Random(5)
    words = [f"w{n}" for n in range(60)] + ["É", "Éa", "Straße", "日本", "X-Y", "don't"]
    weights = [1 / (1 + n) for n in range(len(words))]
    line = lambda n: " ".join(rng.choices(words, weights, k=n))
    docs = [(k, line(rng.randrange(1, 40))) for k in range(300)]
    docs += [(None, None), (None, line(9)), (None, line(9)), (400, ""), (401, "!!"), (402, line(9000)), (5, "w1 w2"), (5, "w1 w2")]
    docs += [(500 + k, "W50 w51 w52, the same") for k in range(40)]
    items = [(k, line(rng.randrange(1, 25))) for k in range(30)] + [(30, None), (31, ""), (32, "absent"), (33, "w50 W51 w51"), (None, "w3"), (7, "w9 w9")]
    df = spark.createDataFrame(docs, DOCS).withColumn("Score", F.lit(1)).withColumn("item", F.lit("x")).repartition(4)
    wanted = spark.createDataFrame(items, "item_id int, text string").withColumn("number", F.lit(1))
    got = lexical.search(df, wanted, k=20).collect()
    show = lambda rows: sorted(((str(r[0]), r[1], str(r[2]), r[3]) for r in rows))
    assert show(got) == show(brute_search(docs, items, 20))
    assert lexical.search(df.where("false"), wanted).collect() == []
    assert lexical.search(df, wanted.where("false")).collect() == []


def test_search_by_string_keys(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("é", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [(r.rank, r.doc_id) for r in lexical.search(docs, items, k=3).orderBy("rank").collect()] == [(1, None), (2, "a"), (3, "b")]


def test_trees_prune_and_stay_exact():
    rng = np.random.default_rng(11)
    groups, width = 16, 400
    of = np.repeat(np.arange(groups), 64)
    columns = np.sort(of[:, None] * 25 + np.argsort(rng.random((len(of), 25)), axis=1)[:, :8], axis=1)
    docs = lexical.Sparse(np.arange(0, columns.size + 1, 8), columns.ravel(), rng.integers(1, 1000, columns.size), width)
    pick = rng.permutation(len(of))[:40]
    items = docs.take(pick)
    best = lexical.Best(40, 5, np.zeros(40, np.int64))
    items_tree, docs_tree = lexical.Tree(items, 4), lexical.Tree(docs, 16)
    scored = lexical.search_block(items_tree, docs_tree, list(range(len(of))), best)
    every = (1 << items_tree.depth) * (1 << docs_tree.depth)
    assert scored < every / 4
    dense = np.zeros((len(of), width), np.int64)
    dense[docs.rows, docs.columns] = docs.values
    for k, row in enumerate(pick.tolist()):
        scores = dense @ dense[row]
        order = sorted((-s, d) for d, s in enumerate(scores.tolist()) if s > 0)[:5]
        assert [(s, key) for s, _, key in best.found[k]] == order
