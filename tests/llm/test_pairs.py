"""Near-duplicates, repeated passages and neighbours against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weirgauge.llm import neighbours, run_hashes, simhash, substrings
from weirgauge.llm.components import connected
from weirgauge.llm.fm_index import FMIndex

DOCS = "doc_id bigint, text string"


def groups_of(count, pairs):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


def near_texts(seed, groups=12, copies=4, words=120):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(words)]
        for k in range(copies):
            some = list(base)
            for _ in range(k):
                some[rng.randrange(words)] = f"x{rng.randrange(500)}"
            texts.append(" ".join(some))
    return texts


def brute_components(rows):
    prints = [simhash.majority(simhash.shingle_hashes((t or "").encode(), 3)) for _, t in rows]
    bits = np.array(prints, np.int64).view(np.uint64)
    apart = np.bitwise_count(bits[:, None] ^ bits[None, :])
    roots = groups_of(len(rows), np.argwhere(apart <= 3).tolist())
    least = {}
    for (key, _), root in zip(rows, roots):
        if key is not None:
            least[root] = min(least.get(root, key), key)
    return sorted(
        ((k, f"{int(b):016x}", least.get(r)) for (k, _), b, r in zip(rows, bits, roots)), key=repr
    )


def test_components_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 8)
    rows = list(enumerate(near_texts(1)))
    rows += [(900, None), (901, ""), (902, "  \n"), (903, "Two words"), (904, "two WORDS"), (None, "two words")]
    rows += [rows[5], rows[5], (None, "alone among all the others here")]
    df = spark.createDataFrame(rows, DOCS).withColumn("fingerprint", F.lit(1)).withColumn("Row", F.lit(2))
    got = sorted((tuple(r) for r in simhash.components(df).collect()), key=repr)
    assert got == brute_components(rows)


def test_large_shards_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 30)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 7)
    rows = list(enumerate(near_texts(2, groups=6, copies=12)))
    got = sorted((tuple(r) for r in simhash.components(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
    assert got == brute_components(rows)


def test_components_of_an_empty_table(spark):
    assert simhash.components(spark.createDataFrame([], DOCS)).collect() == []
    assert simhash.keep_one(spark.createDataFrame([], DOCS)).collect() == []


def at_similarity(rng, base, share):
    """The words of ``base`` with its end replaced, so that ``share`` of all five-word shingles are common."""
    count = len(base) - 4
    common = round(2 * share * count / (1 + share))
    return base[: common + 4] + [f"y{rng.randrange(10**6)}" for _ in range(count - common)]


def jaccard(one, other):
    a, b = (set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in (one, other))
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.mark.parametrize("shingles", [4_000_000, 700])
def test_near_copies_are_those_of_brute_force(spark, monkeypatch, shingles):
    monkeypatch.setattr(simhash, "SET_SHINGLES", shingles)
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for share in (0.5, 0.6, 0.7, 0.78, 0.8, 0.82, 0.85, 0.9, 0.95):
        for _ in range(12):
            base = words(rng.choice([60, 100, 300]))
            texts += [" ".join(base), " ".join(at_similarity(rng, base, share))]
    # Texts that share a passage of half their length, and passages said many times over.
    shared = words(120)
    texts += [" ".join(shared + words(60)) for _ in range(60)]
    often = words(20) * 20
    texts += [" ".join(often + words(60)) for _ in range(4)] + ["", "   "]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    roots = groups_of(len(texts), pairs)
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).coalesce(1)
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == sorted(set(roots))


@pytest.mark.parametrize("crowd", [2, 20])
def test_crowded_shingles_are_compared_in_blocks(spark, monkeypatch, crowd):
    for name, value in (("CROWD", crowd), ("BLOCK_ROWS", 7), ("BUCKET_SHINGLES", 300)):
        monkeypatch.setattr(simhash, name, value)
    # Near copies of one text, and texts that are mostly a passage they share.
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    base, shared = words(200), words(200)
    texts = [" ".join(at_similarity(rng, base, 0.9)) for _ in range(40)]
    texts += [" ".join(shared + words(n)) for n in range(20, 140, 3)] + ["few words", "few words more", ""]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    kept = sorted(r.doc_id for r in simhash.keep_one(df).collect())
    assert kept == sorted(set(groups_of(len(texts), pairs))) and len(kept) < 60


def test_unrelated_texts_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 20)
    counts, stored = {}, simhash.stored

    def counted(df, purpose):
        out = stored(df, purpose)
        counts[purpose] = max(counts.get(purpose, 0), out.count())
        return out

    monkeypatch.setattr(simhash, "stored", counted)
    rng = random.Random(4)
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(80))) for k in range(400)]
    assert simhash.keep_one(spark.createDataFrame(rows, DOCS)).count() == 400
    assert max(counts.values()) <= 400, counts


def test_sets_and_majorities_of_many_texts(monkeypatch):
    monkeypatch.setattr(run_hashes, "AT_ONCE", 50)
    texts = [t.encode() for t in near_texts(6)] + [b"", b" \n", b"One", b"a b c d e", b"x" * 700 + b" y z Y Z x y"]
    expected = [np.unique(simhash.shingle_hashes(t, 5)) for t in texts]
    sets = simhash.shingle_sets(texts, 5)
    assert [s.tolist() for s in sets] == [e.tolist() for e in expected]
    sets.append(np.random.default_rng(1).integers(0, 1 << 63, 70_000, dtype=np.uint64))
    sizes = np.array([len(s) for s in sets])
    assert simhash.majorities(np.concatenate(sets), sizes).tolist() == [simhash.majority(s) for s in sets]


def test_hashes_of_runs():
    rng = np.random.default_rng(3)
    text = rng.bytes(9000)
    begin = np.sort(rng.integers(0, 8700, 12_000))
    end = begin + rng.integers(0, 300, 12_000)
    expected = [xxhash.xxh64_intdigest(text[a:b], 42) for a, b in zip(begin.tolist(), end.tolist())]
    assert run_hashes.xxh64(text, begin, end, 42).tolist() == expected


@pytest.mark.parametrize("known", [0, 30, 120])
def test_similar_sets_share_one_of_their_rarest(known):
    rng = np.random.default_rng(known)
    common = (np.sort(rng.choice(200, known, replace=False)).astype(np.uint64), rng.permutation(known) + 1)
    seen = 0
    for _ in range(4000):
        one = np.sort(rng.choice(200, rng.integers(1, 30), replace=False)).astype(np.uint64)
        some = one[rng.random(len(one)) > 0.1]
        other = np.unique(np.append(some, rng.integers(0, 200, rng.integers(0, 3)).astype(np.uint64)))
        shared = len(np.intersect1d(one, other))
        if shared / (len(one) + len(other) - shared) >= 0.8 and one.tolist() != other.tolist():
            seen += 1
            a, b = (simhash.rarest(s, 0.8, common) for s in (one, other))
            assert len(np.intersect1d(a, b))
    assert seen > 300


def test_links_of_shared_shingles_span_the_near_values(monkeypatch):
    monkeypatch.setattr(simhash, "PAIRED", 5)
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 20, dtype=np.uint64).repeat(6) ^ (np.uint64(1) << rng.integers(0, 64, 120).astype(np.uint64))
    shingle, node = rng.integers(0, 40, 900), rng.integers(0, 120, 900)
    shingle, node = np.unique(np.stack([shingle, node]), axis=1)
    a, b, left = simhash.sharing(shingle.view(np.uint64), values[node], values[node], node, 2, 4, 25)
    crowded = {s for s in range(40) if (shingle == s).sum() > 25}
    assert {*shingle[left].tolist()} == crowded and 0 < len(crowded) < 40
    pairs = [
        (x, y)
        for s in set(range(40)) - crowded
        for x in node[shingle == s].tolist()
        for y in node[shingle == s].tolist()
        if (values[x] ^ values[y]).bit_count() <= 2
    ]
    assert groups_of(120, zip(a.tolist(), b.tolist())) == groups_of(120, pairs) and len(a) < 120


def test_a_component_is_linked_through_its_similar_pairs_alone():
    sets = [np.arange(a, a + 100, dtype=np.uint64) for a in (0, 11, 22, 60, 500)]
    same = np.zeros(5, np.uint64)
    a, b = simhash.similar_links(same, same, np.arange(5), sets, 0, 0, 0.8)
    assert groups_of(5, zip(a, b)) == [0, 0, 0, 3, 4]


@pytest.mark.parametrize("bits", [1, 3, 9])
def test_every_near_pair_meets(bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.zeros(300, np.uint64)
    for _ in range(bits):
        flips |= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    values = np.concatenate([base, base ^ flips])
    met = set()
    for half in range(2):
        tree = simhash.plan_tree(np.sort(values), half, bits, 20)
        shard, row, home = simhash.route(tree, values)
        assert sorted(row[home]) == list(range(600)) and (tree.shards > 4)
        for s in set(shard.tolist()):
            here = row[shard == s]
            living = set(row[(shard == s) & home].tolist())
            held = set(here.tolist())
            met |= {k for k in range(300) if {k, k + 300} <= held and (k in living or k + 300 in living)}
    assert met == set(range(300))


def test_keep_one_keeps_columns_and_one_of_each_group(spark):
    texts = near_texts(3, groups=5, copies=3, words=300)
    rows = [(k, t, k % 3) for k, t in enumerate(texts)] + [(None, texts[0], 9), (70, None, 1), (71, "", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, row int").coalesce(1)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 6, 9, 12, 70]


def test_connected(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}
    assert found == want
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("depth", [2, 3, 5, 8, 20])
def test_index_finds_what_is_there(depth):
    rng = np.random.default_rng(depth)
    text = np.concatenate([[*rng.integers(1, 5, 90), 0] for _ in range(5)]).astype(np.int64)
    index = FMIndex(text, 5, depth)
    for at in rng.integers(0, 60, 40):
        pattern = text[at : at + depth]
        if 0 in pattern:
            continue
        low, high = np.array([0]), np.array([len(text)])
        for word in pattern[::-1]:
            low, high = index.extend(np.array([word]), low, high)
        places = [k for k in range(len(text) - depth + 1) if (text[k : k + depth] == pattern).all()]
        assert sorted(index.suffixes[low[0] : high[0]].tolist()) == places
        assert index.earliest(low, high)[0] == places[0]
        shorter = [k for k in range(len(text) - depth + 2) if (text[k : k + depth - 1] == pattern[:-1]).all()]
        wide = index.shorten(low)
        assert sorted(index.suffixes[wide[0][0] : wide[1][0]].tolist()) == shorter


def brute_kept(rows):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = set()
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            gone |= set(range(at, at + 20)) if window in seen else set()
            seen.add(window)
        out[key] = b" ".join(w for k, w in enumerate(words) if k not in gone).decode(), len(gone)
    return out


def repeating_rows(seed):
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(400)}"
    shared = [[word() for _ in range(rng.choice([19, 20, 26, 70]))] for _ in range(5)]
    line = [word() for _ in range(8)]
    rows = []
    for key in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += [word() for _ in range(rng.randrange(40))] + rng.choice(shared) + line
        rows.append((key * 3 + 1, "\t".join(words)))
    rows.append((500, " ".join(["a", "b", "c"] * 30)))
    rows.append((501, rows[3][1]))
    return rows + [(502, None), (503, ""), (504, " \n"), (505, "few words")]


@pytest.mark.parametrize("crowd, words", [(2000, 400_000), (3, 300)])
def test_passages_match_brute_force(spark, monkeypatch, crowd, words):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    monkeypatch.setattr(substrings, "SHARD_WORDS", words)
    rows = repeating_rows(crowd)
    df = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("mine")).repartition(3)
    got = substrings.remove_repeats(df).collect()
    want = brute_kept(rows)
    text = dict(rows)
    assert {r.doc_id: r.n_removed for r in got} == {k: n for k, (_, n) in want.items()}
    for r in got:
        assert r.text == (want[r.doc_id][0] if want[r.doc_id][1] else text[r.doc_id]) and r.kept == "mine"


def test_passages_with_repeated_and_missing_keys(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(2, passage), (2, passage), (None, passage), (1, "other words"), (3, passage + " and more")]
    got = substrings.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", 0), ("2", 0), ("2", 30), ("3", 30), ("None", 30)]
    empty = substrings.remove_repeats(spark.createDataFrame([], DOCS))
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "n_removed"]


VECTORS = "vec_id bigint, embedding array<float>"


def test_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 500)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    data = (centres[rng.integers(0, 40, 1500)] + 0.2 * rng.standard_normal((1500, 16))).astype(np.float32)
    data[77] = data[78] = data[300]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], VECTORS)
    got = neighbours.search(df.where("vec_id % 50 = 0"), df).collect()
    hits, wide = 0, data.astype(float)
    for q in range(0, 1500, 50):
        far = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        best = sorted((d, k) for k, d in enumerate(far) if k != q)[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(far[k] - s) < 1e-12 for _, k, s in mine)
        assert [(s, k) for _, k, s in mine] == sorted((s, k) for _, k, s in mine)
        hits += len({k for _, k in best} & {m[1] for m in mine})
    assert hits >= 0.9 * 300


def test_neighbours_of_unusable_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]),
        (5, []), (6, [1.0, 0.5]), (7, [1.0, 0.0, 0.0]), (None, [1.0, 0.1]), (8, [1.0, 0.5]), (8, [1.0, 0.5]),
        (9, [float("inf"), 0.0]),
    ]
    df = spark.createDataFrame(rows, VECTORS)
    got = neighbours.search(df, df).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in got) == [
        (0, 1, 6, 0.5), (0, 2, 8, 0.5), (6, 1, 8, 0.0), (6, 2, 0, 0.5), (8, 1, 6, 0.0), (8, 2, 0, 0.5)
    ]
    none = spark.createDataFrame([], VECTORS)
    assert neighbours.search(none, none).collect() == [] and neighbours.search(df, none).collect() == []
