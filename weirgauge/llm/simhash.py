"""SimHash near-duplicates, found with a forest of vantage-point trees.

A fingerprint has a bit set if more than half of the shingle hashes have it.
Two fingerprints are linked if they differ in at most ``bits`` places.

If two fingerprints differ in at most r places, they differ in at most r // 2
places of one half.  One tree is built per half.  A node holds a vantage point
v, a set of bits, and a radius m; a fingerprint x lies inside if its distance
d(x, v) on those bits is at most m.  By the triangle inequality a partner of x
lies inside only if d(x, v) - s <= m, and outside only if d(x, v) + s > m,
where s is the most that partners can differ on those bits; other branches are
pruned.  The leaves are the shards.  A fingerprint lives in one shard and visits
those across a boundary that it is too near to; a shard compares its residents
with each other and with its visitors, and returns a spanning forest of links.

``keep_one`` uses fingerprints only to propose: documents of one component of
proposed links are compared by their sets of shingles, and the Jaccard
similarity of a pair decides whether it is linked.  It allows so many bits that
a tree would exclude next to nothing.  But two sets of similarity t have at
least a share t of either in common; so whatever order all shingles are put in,
of n shingles the first n - ceil(t n) + 1 hold one that is also among those of
the other set.  Fingerprints are therefore compared only where documents share
such a shingle.  The order begins with the shingles few documents hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .batches import discard, fresh, raw, slices, spans, store, stored
from .components import connected
from .registry import query, table
from .run_hashes import xxh64
from .substrings import in_order, release

SEED = 42
#: Trees are planned on a sample of at most so many fingerprints, those with the smallest hashes.
PLAN_ROWS = 50_000
#: Residents a shard should have, and rows of one kind after which it is split into blocks.
SHARD_ROWS = 4096
BLOCK_ROWS = 60_000
#: Half of the bits that may differ; from here on a half says little, and one tree over all bits serves.
WIDE_BITS = 8
CANDIDATES = 6
WORK_CELLS = 1 << 22
#: Shingles and documents of a proposed component after which its sets are compared in blocks.
SET_SHINGLES = 4_000_000
SET_ROWS = 20_000
#: Shingles are counted in so many documents, or in one of so many, to put the common ones last; how many must hold a common one, and the most of these.
COMMON_DOCS = 8192
COMMON_EVERY = 128
COMMON_LEAST = 3
COMMON_MOST = 50_000
#: Shingles a bucket should hold; values with one shingle up to which all are paired at once, and after which they are dealt to tasks of their own.
BUCKET_SHINGLES = 250_000
PAIRED = 64
CROWD = 4096
ENTRY = ("shingle", "first", "second", "node")
LOW = np.uint64(0xFFFFFFFF)
HALVES = (LOW, LOW << np.uint64(32))


def shingle_hashes(text: bytes, width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included.

    ASCII letters are lower-cased and words parted by ASCII white space; fewer
    words than ``width`` are one shingle, no words are none.
    """
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= width:
        count = 1 if words else 0
        pieces: list[bytes] | Iterator[bytes] = [joined] * count
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        count = len(words) - width + 1
        pieces = (joined[a:b] for a, b in zip(starts[:count].tolist(), ends[width - 1 :].tolist()))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(p, seed) for p in pieces), np.uint64, count)


def shingle_sets(texts: list[bytes], width: int, seed: int = SEED) -> list[np.ndarray]:
    """The sorted distinct ``shingle_hashes`` of every text."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        own = text.lower().split()
        words += own
        counts[k] = len(own)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, _ = spans(counts)
    sizes = np.where(counts > width, counts - width + 1, np.minimum(counts, 1))
    begin, end = spans(sizes)
    at = np.arange(int(sizes.sum())) + np.repeat(first - begin, sizes)
    last = at + np.repeat(np.minimum(counts, width), sizes) - 1
    hashes = xxh64(b" ".join(words), (ends - lengths)[at], ends[last], seed)
    return [distinct(hashes[a:b]) for a, b in zip(begin.tolist(), end.tolist())]


def distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[np.append(np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])]


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed number."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            0, dtype=np.uint16
        )
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def majorities(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ``majority`` of every run of ``flat``, of which ``sizes`` has the lengths."""
    out = np.zeros(len(sizes), np.int64)
    begin, end = spans(sizes)
    few = np.flatnonzero((sizes > 0) & (sizes < 1 << 16))
    for k in np.flatnonzero(sizes >= 1 << 16).tolist():
        out[k] = majority(flat[begin[k] : end[k]])
    if len(few):
        # Every 16th bit is counted at once, in the four quarters of a number.
        own = flat[np.repeat((sizes > 0) & (sizes < 1 << 16), sizes)]
        starts, _ = spans(sizes[few])
        votes = np.empty((len(few), 64), np.int64)
        for bit in range(16):
            ones = (own >> np.uint64(bit)) & np.uint64(0x0001000100010001)
            votes[:, bit::16] = np.add.reduceat(ones, starts).view(np.uint16).reshape(-1, 4)
        bits = np.packbits(votes * 2 > sizes[few][:, None], axis=1, bitorder="little")
        out[few] = bits.view(np.int64)[:, 0]
    return out


def remix(hashes: np.ndarray) -> np.ndarray:
    """A second, independent 64 bits from each hash."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return (mixed ^ (mixed >> np.uint64(28))) * np.uint64(0xD6E8FEB86659FD93)


def fingerprint(width: int):
    """Column function: text bytes to struct of two 64-bit fingerprints."""

    @arrow_udf("struct<first:bigint,second:bigint>")
    def of(texts: pa.Array) -> pa.Array:
        first, second = [], []
        for text in texts:
            hashes = shingle_hashes(text.as_py() or b"", width)
            first.append(majority(hashes))
            second.append(majority(remix(hashes)))
        return pa.StructArray.from_arrays(
            [pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["first", "second"]
        )

    return of


@dataclass
class Tree:
    """A planned tree as parallel lists; ``child`` below zero is a shard, coded -1 - shard."""

    point: list[int] = field(default_factory=list)
    mask: list[int] = field(default_factory=list)
    radius: list[int] = field(default_factory=list)
    slack: list[int] = field(default_factory=list)
    child: list[list[int]] = field(default_factory=list)
    shards: int = 0


def distance(values: np.ndarray, point: int, mask: int) -> np.ndarray:
    return np.bitwise_count((values ^ np.uint64(point)) & np.uint64(mask)).astype(np.int16)


def plan_tree(sample: np.ndarray, half: int, bits: int, most: int) -> Tree:
    """A tree whose leaves hold at most ``most`` of the sample, where it can be split."""
    tree, rng = Tree(), np.random.default_rng(half + 1)
    metrics = [(LOW | HALVES[1], bits)]
    if bits < WIDE_BITS:
        metrics = [(HALVES[half], bits // 2), (HALVES[1 - half], bits)]

    def grow(values: np.ndarray) -> int:
        best = None
        if len(values) > most:
            for mask, slack in metrics:
                for point in values[rng.integers(0, len(values), CANDIDATES)]:
                    far = distance(values, int(point), int(mask))
                    radius = int(np.median(far))
                    inside = far <= radius
                    if inside.all():
                        radius -= 1
                        inside = far <= radius
                    share = inside.mean()
                    near = ((far > radius - slack) & (far <= radius + slack)).mean()
                    cost = near + 4 * max(0.0, abs(share - 0.5) - 0.2)
                    if 0 < share < 1 and (best is None or cost < best[0]):
                        best = (cost, int(point), int(mask), radius, slack, inside)
        if best is None:
            tree.shards += 1
            return -tree.shards
        _, point, mask, radius, slack, inside = best
        at = len(tree.point)
        for held, value in ((tree.point, point), (tree.mask, mask), (tree.radius, radius), (tree.slack, slack)):
            held.append(value)
        tree.child.append([0, 0])
        tree.child[at] = [grow(values[inside]), grow(values[~inside])]
        return at

    root = grow(sample)
    if root < 0:
        tree.child = []
    return tree


def route(tree: Tree, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, index, resident) of all shards that each value lives in or visits.

    A pair that a node parts meets inside: the outer value visits the inner
    branch if it can have a partner there.
    """
    every = np.arange(len(values))
    shards, rows, lives = [], [], []
    todo = [(0 if tree.child else -1, every, every[:0])]
    while todo:
        node, home, guest = todo.pop()
        if not len(home) and not len(guest):
            continue
        if node < 0:
            shards.append(np.full(len(home) + len(guest), -1 - node))
            rows += [home, guest]
            lives += [np.ones(len(home), bool), np.zeros(len(guest), bool)]
            continue
        radius, slack = tree.radius[node], tree.slack[node]
        far_home = distance(values[home], tree.point[node], tree.mask[node])
        far_guest = distance(values[guest], tree.point[node], tree.mask[node])
        outer = far_home > radius
        inner_guests = np.concatenate([guest[far_guest - slack <= radius], home[outer & (far_home - slack <= radius)]])
        todo.append((tree.child[node][0], home[~outer], inner_guests))
        todo.append((tree.child[node][1], home[outer], guest[far_guest + slack > radius]))
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return join(shards, np.int32), join(rows, np.int64), join(lives, bool)


def spanning_links(
    first: np.ndarray, second: np.ndarray, node: np.ndarray, home: np.ndarray, bits: int, both_bits: int | None
) -> tuple[list[int], list[int]]:
    """A forest that spans every component of a shard; guests are not compared among themselves.

    Values not yet reached are scanned by those just reached, so a dense group
    costs one scan and as many links as it has members.
    """

    def near(some: np.ndarray, others: np.ndarray) -> np.ndarray:
        apart = np.bitwise_count(first[some][:, None] ^ first[others][None, :])
        hit = apart <= bits
        if both_bits is not None:
            apart += np.bitwise_count(second[some][:, None] ^ second[others][None, :])
            hit &= apart <= both_bits
        return hit & (home[some][:, None] | home[others][None, :])

    a, b = [], []
    left = np.argsort(~home, kind="stable")
    while len(left) and home[left[0]]:
        count = max(1, min(WORK_CELLS // len(left), int(home[left].sum())))
        seeds = left[:count]
        hits = near(seeds, left)
        alone = hits.sum(axis=1) == 1
        left = left[~np.isin(left, seeds[alone])]
        reached = np.zeros(len(first), bool)
        for seed in seeds[~alone]:
            if reached[seed]:
                continue
            frontier = np.array([seed])
            left = left[left != seed]
            reached[seed] = True
            while len(frontier) and len(left):
                step = frontier[: max(1, WORK_CELLS // len(left))]
                frontier = frontier[len(step) :]
                found = near(step, left).any(axis=0)
                fresh = left[found]
                left = left[~found]
                reached[fresh] = True
                a += node[fresh].tolist()
                b += [int(node[seed])] * len(fresh)
                frontier = np.concatenate([frontier, fresh])
    return a, b


def link(values: DataFrame, bits: int, both_bits: int | None = None) -> DataFrame:
    """Links (a, b) that span the components of near values.

    ``values``: distinct (first, second) with a bigint ``node``.  Values link if
    ``first`` differs in at most ``bits`` places and, if ``both_bits`` is given,
    both together in at most that many.
    """
    count = values.count()
    sample = values.orderBy(F.xxhash64("first", "second")).limit(PLAN_ROWS).select("first").toPandas()
    points = np.sort(sample["first"].to_numpy(np.int64)).view(np.uint64)
    wide = bits >= WIDE_BITS
    most = max(32, len(points) * (BLOCK_ROWS if wide else SHARD_ROWS) // max(1, count))
    trees = values.sparkSession.sparkContext.broadcast(
        [plan_tree(points, half, bits, most) for half in range(1 if wide else 2)]
    )

    def spread(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch["first"].to_numpy(zero_copy_only=False).view(np.uint64)
            for number, tree in enumerate(trees.value):
                shard, row, home = route(tree, numbers)
                for at in range(0, len(row), 200_000):
                    take = pa.array(row[at : at + 200_000])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard[at : at + 200_000].astype(np.int32) * 2 + number, pa.int32()),
                            pa.array(home[at : at + 200_000], pa.bool_()),
                            *[batch[c].take(take) for c in ("first", "second", "node")],
                        ],
                        ["shard", "home", "first", "second", "node"],
                    )

    routed = stored(
        values.select("first", "second", "node").mapInArrow(
            spread, "shard int, home boolean, first bigint, second bigint, node bigint"
        ),
        "shards",
    )
    return in_blocks(routed, bits, both_bits)


def in_blocks(routed: DataFrame, bits: int, both_bits: int | None) -> DataFrame:
    """Links (a, b) that span the components of every shard of ``routed``: shard, home, first, second, node."""
    # A shard's residents and guests are cut into blocks of bounded size; each block of residents
    # meets each other block of residents and each block of guests in a group of its own.
    sizes = routed.groupBy("shard").agg(
        F.ceil(F.count_if("home") / BLOCK_ROWS).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / BLOCK_ROWS).cast("int").alias("guests"),
    )
    block = lambda n: F.pmod(F.xxhash64("node"), F.greatest(F.col(n), F.lit(1))).cast("int")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    key = lambda guest, low, high: F.struct(guest.alias("guest"), low.alias("low"), high.alias("high"))
    yes, no = F.lit(True), F.lit(False)
    mine, hosted = block("homes"), block("guests")
    with_homes = F.transform(upto("homes"), lambda j: key(no, F.least(mine, j), F.greatest(mine, j)))
    with_guests = F.transform(upto("guests"), lambda j: key(yes, mine, j))
    # A single block of residents is compared with itself wherever it meets guests.
    alone = (F.col("homes") == 1) & (F.col("guests") > 0)
    resident = F.when(alone, with_guests).otherwise(F.concat(with_homes, with_guests))
    visitor = F.transform(upto("homes"), lambda i: key(yes, i, hosted))
    groups = F.explode(F.when(F.col("home"), resident).otherwise(visitor)).alias("group")
    paired = routed.join(sizes, "shard").select("shard", groups, "home", "first", "second", "node")

    def compare(group: pa.Table) -> pa.Table:
        column = lambda name: group[name].to_numpy()
        a, b = spanning_links(
            column("first").view(np.uint64),
            column("second").view(np.uint64),
            column("node"),
            column("home").astype(bool),
            bits,
            both_bits,
        )
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return paired.groupBy("shard", "group").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(rows: DataFrame, bits: int, both_bits: int | None = None) -> DataFrame:
    """(first, second, node, root): the component of every distinct fingerprint.

    ``rows`` has first, second and a unique bigint ``row``.  ``node`` is the
    smallest row with the fingerprint, ``root`` the smallest of its component.
    Equal fingerprints are one value, so copies cost nothing further.
    """
    values = stored(rows.groupBy("first", "second").agg(F.min("row").alias("node")), "fingerprints")
    roots = connected(link(values, bits, both_bits))
    return values.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def common_shingles(rows: DataFrame, text: str, number: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that many documents hold, and their places from the least to the most common.

    Counted in some documents only.  This orders shingles; links are the same in any order.
    """
    every = max(1, min(COMMON_EVERY, rows.count() // COMMON_DOCS))
    some = rows.where(F.pmod(F.xxhash64(number), F.lit(every)) == 0).select(raw(text).alias("text"))

    def counted(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch["text"]):
                shingle, documents = np.unique(np.concatenate(shingle_sets(texts, width)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle.view(np.int64)), pa.array(documents.astype(np.int64))], ["shingle", "documents"]
                )

    counts = some.mapInArrow(counted, "shingle bigint, documents bigint").groupBy("shingle")
    most = (
        counts.agg(F.sum("documents").alias("documents"))
        .where(F.col("documents") >= COMMON_LEAST)
        .orderBy(F.desc("documents"), "shingle")
        .limit(COMMON_MOST)
        .select("shingle")
        .toPandas()
    )
    shingles = most["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], len(shingles) - order


def rarest(held: np.ndarray, least: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a sorted set, in an order with the common ones last.

    So many that two sets of Jaccard similarity ``least`` or more have one of them in common.
    None if the set is so small that only its equal is similar.
    """
    if len(held) / (len(held) + 1) < least - 1e-9:
        return held[:0]
    count = len(held) + 1 - max(1, int(np.ceil(least * len(held) - 1e-6)))
    shingles, places = common
    if not len(shingles):
        return held[:count]
    at = np.minimum(np.searchsorted(shingles, held), len(shingles) - 1)
    known = shingles[at] == held
    first = held[~known][:count]
    if len(first) == count:
        return first
    late = at[known][np.argsort(places[at[known]])]
    return np.concatenate([first, shingles[late[: count - len(first)]]])


def sketch(width: int, least: float, common: Broadcast):
    """Column function: text bytes to two fingerprints, a hash and the size of the shingle set, and its rarest shingles."""

    @arrow_udf("struct<first:bigint,second:bigint,content:bigint,shingles:bigint,rare:binary>")
    def of(texts: pa.Array) -> pa.Array:
        first, second, content, sizes, rare = [], [], [], [], []
        for _, some in slices(texts):
            sets = shingle_sets(some, width)
            flat, lengths = np.concatenate(sets), np.array([len(s) for s in sets], np.int64)
            first.append(majorities(flat, lengths))
            second.append(majorities(remix(flat), lengths))
            sizes.append(lengths)
            digests = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64)
            content.append(digests.view(np.int64))
            rare += [rarest(s, least, common.value).tobytes() for s in sets]
        numbers = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (first, second, content, sizes)]
        return pa.StructArray.from_arrays(
            [*map(pa.array, numbers), pa.array(rare, pa.binary())], ["first", "second", "content", "shingles", "rare"]
        )

    return of


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every node to the smallest node of its component, but for that node."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = place[: len(a)], place[len(a) :]
    root = np.arange(len(names))
    while True:
        low = root.copy()
        np.minimum.at(low, root[one], root[other])
        np.minimum.at(low, root[other], root[one])
        low = low[low]
        if (low == root).all():
            break
        root = low
    hung = np.flatnonzero(root != np.arange(len(names)))
    return names[hung], names[root[hung]]


def sharing(
    shingle: np.ndarray, first: np.ndarray, second: np.ndarray, node: np.ndarray, bits: int, both_bits: int, crowd: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, crowded): links that span the near values with one shingle, and the entries left to others.

    An entry is a shingle and a value that holds it.  Those of a shingle with more than ``crowd`` values are left.
    """
    order = np.argsort(shingle, kind="stable")
    edge = np.flatnonzero(np.diff(shingle[order], prepend=~shingle[order[:1]]))
    sizes = np.diff(np.append(edge, len(order)))
    crowded = order[np.repeat(sizes > crowd, sizes)]
    few = (sizes > 1) & (sizes <= min(PAIRED, crowd))
    small = order[np.repeat(few, sizes)]
    begin, end = spans(sizes[few])
    end = np.repeat(end, sizes[few])
    one, other = first[small], second[small]
    a, b = [], []
    at, step = np.arange(len(small)), 0
    while len(at):
        step += 1
        at = at[at + step < end[at]]
        apart = np.bitwise_count(one[at] ^ one[at + step])
        both = apart + np.bitwise_count(other[at] ^ other[at + step])
        hit = at[(apart <= bits) & (both <= both_bits)]
        a.append(node[small[hit]])
        b.append(node[small[hit + step]])
    for k in np.flatnonzero((sizes > PAIRED) & (sizes <= crowd)):
        here = order[edge[k] : edge[k] + sizes[k]]
        links = spanning_links(first[here], second[here], node[here], np.ones(len(here), bool), bits, both_bits)
        for held, found in zip((a, b), links):
            held.append(np.array(found, np.int64))
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return *forest(join(a), join(b)), crowded


def shared(values: DataFrame, bits: int, both_bits: int) -> DataFrame:
    """Links (a, b) that span the components of near values with a rare shingle in common.

    ``values``: distinct sets by first, second, a bigint ``node`` and ``rare``, their rarest shingles.
    Entries of shingle and value meet in buckets by shingle; a shingle with very many values is
    compared in blocks, in tasks of its own.
    """
    total = values.agg(F.sum(F.octet_length("rare"))).first()[0] or 0
    buckets, crowd = total // 8 // BUCKET_SHINGLES + 1, CROWD

    def dealt(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.fromiter((len(r.as_py()) // 8 for r in batch["rare"]), np.int64, batch.num_rows)
            # Long texts have many shingles: a few rows are dealt at a time.
            runs = np.cumsum(sizes) // (1 << 20)
            for some in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(runs)) + 1):
                part = batch.slice(some[0], len(some)) if len(some) else batch
                shingle = np.frombuffer(b"".join(r.as_py() for r in part["rare"]), np.uint64)
                bucket = (shingle % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                there, begin = np.unique(bucket[order], return_index=True)
                owner = np.repeat(np.arange(len(some)), sizes[some])[order]
                held = [shingle[order], *(part[c].to_numpy(zero_copy_only=False)[owner] for c in ENTRY[1:])]
                cuts = np.append(begin, len(order)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(there, pa.int32()),
                        *(pa.array([h[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()) for h in held),
                    ],
                    ["bucket", *ENTRY],
                )

    def meet(group: pa.Table) -> pa.Table:
        held = [np.frombuffer(b"".join(r.as_py() for r in group[c]), np.int64) for c in ENTRY]
        shingle, first, second = (h.view(np.uint64) for h in held[:3])
        a, b, crowded = sharing(shingle, first, second, held[3], bits, both_bits, crowd)
        blank = pa.nulls(len(a), pa.int64())
        links = pa.table([blank, blank, blank, pa.array(a), pa.array(b)], [*ENTRY, "other"])
        rest = pa.table([*(pa.array(h[crowded]) for h in held), pa.nulls(len(crowded), pa.int64())], [*ENTRY, "other"])
        return pa.concat_tables([links, rest])

    blobs = values.select(*ENTRY[1:], "rare").mapInArrow(dealt, "bucket int, " + ", ".join(f"{c} binary" for c in ENTRY))
    found = ", ".join(f"{c} bigint" for c in (*ENTRY, "other"))
    met = stored(blobs.groupBy("bucket").applyInArrow(meet, found), "met")
    links = met.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    crowded = met.where("other IS NULL")
    if crowded.isEmpty():
        return links
    routed = crowded.select(F.col("shingle").alias("shard"), F.lit(True).alias("home"), "first", "second", "node")
    return links.unionByName(in_blocks(routed, bits, both_bits))


def shingle_set(width: int):
    """Column function: text bytes to the sorted distinct shingle hashes, 8 bytes each."""

    @arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        sets = (s.tobytes() for _, some in slices(texts) for s in shingle_sets(some, width))
        return pa.array(sets, pa.binary())

    return of


def similar_links(
    first: np.ndarray, second: np.ndarray, node: np.ndarray, sets: list[np.ndarray], bits: int, both_bits: int, least: float
) -> tuple[list[int], list[int]]:
    """A forest over the pairs with near fingerprints and a Jaccard similarity of ``least`` or more.

    Sets not yet reached are compared with those just reached, one of these at
    a time, so a dense group costs one pass.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    starts, _ = spans(sizes)
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(number.max(initial=-1)) + 1, bool)
    a, b = [], []
    left = np.argsort(node, kind="stable")
    while len(left):
        seed, left = left[0], left[1:]
        frontier = [seed]
        while frontier and len(left):
            at = frontier.pop()
            apart = np.bitwise_count(first[left] ^ first[at])
            both = apart + np.bitwise_count(second[left] ^ second[at])
            small, large = np.minimum(sizes[left], sizes[at]), np.maximum(sizes[left], sizes[at])
            asked = np.flatnonzero((apart <= bits) & (both <= both_bits) & (small > 0) & (small / np.maximum(large, 1) >= least))
            own = number[starts[at] : starts[at] + sizes[at]]
            mark[own] = True
            taken = np.zeros(len(left), bool)
            runs = np.cumsum(sizes[left[asked]]) // WORK_CELLS if len(asked) else np.zeros(0, np.int64)
            for some in np.split(asked, np.flatnonzero(np.diff(runs)) + 1) if len(asked) else ():
                lengths = sizes[left[some]]
                begin, _ = spans(lengths)
                places = np.repeat(starts[left[some]] - begin, lengths) + np.arange(int(lengths.sum()))
                common = np.add.reduceat(mark[number[places]].astype(np.int64), begin)
                taken[some] = common / (lengths + sizes[at] - common) >= least
            mark[own] = False
            found = left[taken]
            left = left[~taken]
            a += node[found].tolist()
            b += [int(node[at])] * len(found)
            frontier += found.tolist()
    return a, b


def verified(members: DataFrame, bits: int, both_bits: int, least: float) -> DataFrame:
    """Links (a, b) that span the components of similar documents.

    ``members``: first, second, node, root (the component of proposed links),
    shingles (their number) and ``held`` (shingle_set).  A component with many
    shingles or documents is cut into blocks, and each block meets each other.
    """
    sizes = members.groupBy("root").agg(
        F.ceil(F.greatest(F.sum("shingles") / SET_SHINGLES, F.count("*") / SET_ROWS)).cast("int").alias("blocks")
    )
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(mine, j).alias("low"), F.greatest(mine, j).alias("high")),
    )
    dealt = members.join(sizes, "root").select("root", F.explode(meets).alias("group"), "first", "second", "node", "held")

    def compare(group: pa.Table) -> pa.Table:
        a, b = similar_links(
            group["first"].to_numpy().view(np.uint64),
            group["second"].to_numpy().view(np.uint64),
            group["node"].to_numpy(),
            [np.frombuffer(v.as_py(), np.uint64) for v in group["held"]],
            bits,
            both_bits,
            least,
        )
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("root", "group").applyInArrow(compare, "a bigint, b bigint")


def keep_one(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, bits: int = 22, both_bits: int = 32, least: float = 0.8
) -> DataFrame:
    """One document of every group of near copies, with all columns.

    Two documents are linked if the Jaccard similarity of their sets of
    five-word shingles is ``least`` or more.  Pairs are proposed by
    fingerprints of the sets, which must agree in all but ``bits`` places of
    one and all but ``both_bits`` of two, and only those are compared, where
    the sets have one of their rarest shingles in common.  Groups
    are connected components of links; the row with the smallest key stays, of
    equal keys the shortest text, then that with the smallest hash; NULL keys
    come last.  Equal sets are one value; wordless texts are one group.
    Repeated rows are copies like any others.
    """
    number = fresh(docs, "row")
    rows = stored(in_order(docs, key, text, number), "documents")
    spark = rows.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(rows, text, number, width))
    prints = rows.select(F.col(number).alias("row"), sketch(width, least, common)(raw(text)).alias("f")).select("row", "f.*")
    paths = [store(prints, "prints")]
    sets = spark.read.schema(prints.schema).parquet(paths[0]).groupBy("first", "second", "content").agg(
        F.min("row").alias("node"), F.min("shingles").alias("shingles"), F.min_by("rare", "row").alias("rare")
    )
    paths.append(store(sets, "sets"))
    entries = spark.read.schema(sets.schema).parquet(paths[1])
    values = stored(entries.drop("rare"), "fingerprints")
    discard(spark, paths[0])
    release(spark)
    proposed = stored(values.join(connected(shared(entries, bits, both_bits)), "node"), "proposed")
    discard(spark, paths[1])
    release(spark)
    texts = rows.select(F.col(number).alias("node"), raw(text).alias("text"))
    held = proposed.join(texts, "node").withColumn("held", shingle_set(width)(F.col("text"))).drop("text")
    paths.append(store(held, "members"))
    members = spark.read.schema(held.schema).parquet(paths[2])
    copies = connected(verified(members, bits, both_bits, least)).where("node <> root")
    discard(spark, paths[2])
    release(spark)
    kept = values.join(copies, "node", "left_anti").select(F.col("node").alias(number))
    return rows.join(kept, number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, over three-word shingles."""
    docs = table(spark, sf_dir, "documents")
    return components(docs)


def components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id of every document.

    A component is named by its smallest key.  NULL and wordless texts have
    fingerprint zero and are linked like any other; repeated rows each keep
    their row; rows with a NULL key take part, and a component of such rows
    alone has a NULL name.  Columns other than key and text are not returned.
    """
    flat = docs.select(F.col(f"`{key}`").alias("key"), fingerprint(width)(raw(text)).alias("f")).select(
        "key", F.col("f.first").alias("first"), F.lit(0).cast("bigint").alias("second"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(flat, "documents")
    found = near_duplicates(rows, bits).select("first", "root")
    firsts = rows.groupBy("first").agg(F.min("key").alias("least"))
    known = firsts.join(found, "first")
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = known.join(names, "root").select("first", "component_id")
    return rows.join(named, "first").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("first"), 16, "0")).alias("fingerprint"),
        F.col("component_id"),
    )
