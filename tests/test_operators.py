"""Operators against brute force on small inputs, with hostile shapes."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from weirgauge.contracts import ContractError, FlowContract
from weirgauge.functions.cells import cell_problem, is_finite_cell
from weirgauge.operators import evaluate, examples, ordering, replay, windows
from weirgauge.session import scratch
from weirgauge.sources import history, records, snapshots
from weirgauge.streaming import live, runner


def test_cell_verdicts_agree(spark):
    cells = [None, "", "  ", "abc", "NaN", "Infinity", "-Infinity", " 2 ", "1e3", "-0", "1,5"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    rows = df.select(
        "c", cell_problem(F.col("c")).alias("p"), is_finite_cell(F.col("c")).alias("ok")
    ).collect()
    assert all((r.p is None) == r.ok for r in rows)
    found = {r.c: r.p for r in rows}
    assert found["  "] == found[None] == "missing"
    assert found["1,5"] == found["abc"] == "invalid_cast"
    assert (found["NaN"], found["Infinity"]) == ("nan", "positive_inf")
    assert found["-Infinity"] == "negative_inf"
    assert found[" 2 "] is None


@pytest.mark.parametrize("parts", [1, 7, 300])
def test_positions_and_sums_do_not_depend_on_buckets(spark, parts):
    rng = random.Random(7)
    keys = rng.sample(range(1_000_000), 300)
    data = [(k, rng.choice("ab"), rng.randrange(10)) for k in keys]
    df = spark.createDataFrame(data, "k bigint, g string, v bigint").repartition(5)
    cut = ordering.range_buckets(df, "k", parts)
    got = {
        r.k: (r.pos, r.gpos, r.total)
        for r in ordering.running_sum(
            ordering.positions(ordering.positions(cut, "k", "pos"), "k", "gpos", by=("g",)),
            "k",
            F.col("v"),
            "total",
        ).collect()
    }
    seen, total, expected = {}, 0, {}
    for n, (k, g, v) in enumerate(sorted(data)):
        total += v
        expected[k] = (n, seen.get(g, 0), total)
        seen[g] = seen.get(g, 0) + 1
    assert got == expected


def test_previous_row_crosses_bucket_borders(spark):
    start = datetime.datetime(2026, 1, 1)
    step = ordering.GRID_CELLS * 5
    times = [start + datetime.timedelta(seconds=s) for s in (0, 5, step, step + 5, 7 * step)]
    df = spark.createDataFrame([(t, n) for n, t in enumerate(times)], "t timestamp, n int")
    chained = ordering.previous_row(ordering.grid_buckets(df, "t", 5), "t", ("n",), "before")
    rows = {r.n: r.before and r.before.n for r in chained.select("n", "before").collect()}
    assert rows == {0: None, 1: 0, 2: 1, 3: 2, 4: 3}


def test_first_per_group_with_one_hot_group(spark):
    rows = [("hot", n) for n in range(2000)] + [("cold", n) for n in range(3)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, n int").repartition(6)
    got = ordering.first_per_group(df, "g", ("n",), 4).collect()
    assert sorted((r.g, r.n, r.position) for r in got) == [
        *[("cold", n, n + 1) for n in range(3)],
        *[("hot", n, n + 1) for n in range(4)],
    ]


def test_status_runs_and_completed_windows(spark):
    start = datetime.datetime(2026, 1, 1)
    status = ["Normal", "Normal", "Critical", "Normal", "Normal", "Warning"]
    rows = [(start + datetime.timedelta(seconds=5 * n), s) for n, s in enumerate(status)]
    df = spark.createDataFrame(rows, "window_end timestamp, status string")
    runs = windows.status_runs(df).orderBy("run").collect()
    assert [(r.run, r.status, r.windows) for r in runs] == [
        (1, "Normal", 2),
        (2, "Critical", 1),
        (3, "Normal", 2),
        (4, "Warning", 1),
    ]
    assert windows.completed_windows(df).count() == 4
    assert windows.completed_windows(df.limit(2)).count() == 0
    assert windows.completed_windows(df.where("false")).count() == 0


def test_default_window_plan_counts_like_brute_force(spark):
    rng = random.Random(3)
    start = datetime.datetime(2026, 1, 1)
    events = [(start + datetime.timedelta(seconds=rng.random() * 60), rng.choice([0.0, 1.0]))
              for _ in range(400)]
    df = spark.createDataFrame(events, "event_timestamp timestamp, prediction double")
    got = {
        r.window_start: (r.event_count, r.attack_count, round(r.event_rate, 6), r.status)
        for r in windows.window_metrics(df).collect()
    }
    expected = {}
    for n in range(-1, 13):
        lo = start + datetime.timedelta(seconds=5 * n)
        inside = [p for t, p in events if lo <= t < lo + datetime.timedelta(seconds=10)]
        if inside:
            share = sum(inside) / len(inside)
            band = "Normal" if share < 0.2 else "Warning" if share < 0.8 else "Critical"
            expected[lo] = (len(inside), int(sum(inside)), round(len(inside) / 10, 6), band)
    assert got == expected


CONTRACT = FlowContract(numeric=("v",), features=("v",), attacks=("DDOS-A", "XSS"))


def brute_replay(classes, scenario, events):
    order = {"NORMAL": ["normal"], "DDOS_BURST": ["burst"], "MIXED": ["normal", "burst"]}[scenario]
    taken, out = {}, []
    for slot in range(events):
        kind = order[slot % len(order)]
        rows = classes[kind]
        n = taken.get(kind, 0)
        out.append((slot, rows[n % len(rows)]))
        taken[kind] = n + 1
    return out


@pytest.mark.parametrize("scenario,events", [("NORMAL", 1), ("MIXED", 25), ("DDOS_BURST", 3000)])
def test_replay_cycles_like_brute_force(spark, scenario, events):
    rows = [(n, "benign", str(n)) for n in range(7)] + [(n, "DDOS-A", str(n)) for n in (7, 8)]
    rows += [(9, "XSS", "1"), (10, "BENIGN", "bad"), (11, "?", "1")]
    df = spark.createDataFrame(rows, "row_id bigint, Label string, v string")
    kept = replay.replay_rows(df, CONTRACT, keep=("row_id",))
    sizes = replay.class_sizes(kept)
    assert sizes == {"normal": 7, "burst": 2}
    ordered = replay.scenario_order(replay.numbered(kept, "row_id"), scenario, events, sizes)
    got = sorted((r.slot, r.row_id) for r in ordered.collect())
    classes = {"normal": list(range(7)), "burst": [7, 8]}
    assert got == brute_replay(classes, scenario, events)


def test_replay_without_rows_of_a_class_fails(spark):
    df = spark.createDataFrame([(1, "XSS", "1")], "row_id bigint, Label string, v string")
    kept = replay.replay_rows(df, CONTRACT, keep=("row_id",))
    with pytest.raises(ValueError):
        replay.scenario_order(replay.numbered(kept, "row_id"), "MIXED", 4, {})


def test_leakage_report_equals_joins(spark):
    rng = random.Random(5)
    rows = [(str(rng.randrange(30)), rng.choice(["train", "validation", "test"]))
            for _ in range(200)]
    rows += [("hot", "train")] * 100 + [("hot", "test")] * 50
    df = spark.createDataFrame(rows, f"{examples.PRINT} string, split string")
    for r in examples.leakage_report(df, examples.PRINT, "split").collect():
        left = [k for k, s in rows if s == r.left_split]
        right = [k for k, s in rows if s == r.right_split]
        both = set(left) & set(right)
        assert r.shared_keys == len(both)
        assert r.left_rows == sum(k in both for k in left)
        assert r.right_rows == sum(k in both for k in right)


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(5000)
    def split(n):
        part = examples.hash_split(df.repartition(n), ("id",))
        return {r.id: r.split for r in part.collect()}
    one, many = split(1), split(13)
    assert one == many
    shares = [sum(s == n for s in one.values()) / 5000 for n in ("train", "validation", "test")]
    assert all(abs(a - b) < 0.03 for a, b in zip(shares, (0.70, 0.15, 0.15)))


def test_two_class_guard(spark):
    for rows, message in (([], "no rows"), ([(0.0,)], "one class"), ([(2.0,)], "neither")):
        df = spark.createDataFrame(rows, "y double")
        with pytest.raises(ContractError, match=message):
            examples.require_two_classes(df, "y", "train")


def test_evaluation_guards_and_zero_denominators(spark):
    df = spark.createDataFrame([(0.0, 0.0)] * 3, "y double, prediction double")
    row = evaluate.evaluate(df, "y").first()
    assert (row.accuracy, row.attack_precision, row.attack_f1) == (1.0, 0.0, 0.0)
    with pytest.raises(Exception, match="not binary"):
        evaluate.evaluate(df.withColumn("prediction", F.lit(3.0)), "y").collect()
    with pytest.raises(Exception, match="nothing to evaluate"):
        evaluate.evaluate(df.limit(0), "y").collect()


def test_expectations_must_hold(spark):
    actual = spark.createDataFrame([("a", 1.0)], "metric string, actual double")
    fine = spark.createDataFrame([("a", 1.0, 0.0)], "metric string, expected double, tolerance double")
    evaluate.require_expectations(actual, fine)
    with pytest.raises(ContractError, match="a: 1.0 instead of 2.0"):
        evaluate.require_expectations(actual, fine.withColumn("expected", F.lit(2.0)))


# --- history and snapshots ---------------------------------------------------


def prediction_rows(spark, offsets, verdict):
    when = datetime.datetime(2026, 1, 1, 12)
    rows = [("t", 0, o, when, "x", when, "NORMAL", "Normal", "BENIGN", verdict, "?", "[]")
            for o in offsets]
    return spark.createDataFrame(rows, history.PREDICTIONS.schema)


def test_first_write_wins_over_runs_and_repeats(spark):
    root = scratch(spark, "history")
    history.initialize(spark, root)

    def put(offsets, verdict, run, batch_id, shift=0):
        rows = prediction_rows(spark, offsets, verdict)
        later = F.col("event_timestamp") + F.make_interval(days=F.lit(shift))
        rows = rows.withColumn("event_timestamp", F.when(F.col("offset") != 5, later))
        history.insert_absent(rows, root, history.PREDICTIONS, run=run, batch_id=batch_id)

    put([1, 2, 2], 0.0, "a", 0)
    put([2, 3], 1.0, "a", 1)
    put([2, 3], 1.0, "a", 1)
    put([1, 2, 3, 4, 5], 0.5, "b", 0, shift=3)
    put([5, 4], 0.25, "c", 0, shift=9)
    put([], 0.5, "b", 1)
    assert history.compact(spark, root, history.PREDICTIONS, datetime.date(2027, 1, 1)) == 1
    assert history.compact(spark, root, history.PREDICTIONS, datetime.date(2027, 1, 1)) == 0
    put([1, 2, 3, 4, 5], 0.75, "d", 0)
    stored = history.read_table(spark, root, history.PREDICTIONS).collect()
    assert sorted((r.offset, r.prediction) for r in stored) == [
        (1, 0.0), (2, 0.0), (3, 1.0), (4, 0.5), (5, 0.5)
    ]
    newest = history.recent(spark, root, history.PREDICTIONS, 2).collect()
    assert [r.offset for r in newest] == [4, 3]


def test_fuller_windows_win_over_later_commits(spark):
    root = scratch(spark, "history")
    history.initialize(spark, root)
    at = datetime.datetime(2026, 1, 1)
    for run, batch_id, count in (("a", 0, 3), ("a", 1, 9), ("b", 5, 4)):
        row = (at, at, count, 1.0, count, 0, 1.0, 0.0, "Normal")
        rows = spark.createDataFrame([row], history.METRICS.schema)
        history.append_versions(rows, root, run=run, batch_id=batch_id)
    assert [r.event_count for r in history.read_table(spark, root, history.METRICS).collect()] == [9]
    history.compact(spark, root, history.METRICS, datetime.date(2027, 1, 1))
    assert [r.event_count for r in history.read_table(spark, root, history.METRICS).collect()] == [9]


def test_a_compaction_shows_all_at_once_and_never_in_part(spark):
    root = scratch(spark, "history")
    table = history.PREDICTIONS
    history.initialize(spark, root)

    def put(offsets, batch_id):
        history.insert_absent(prediction_rows(spark, offsets, 0.0), root, table, run="a", batch_id=batch_id)

    put([0], 0)
    put([1], 1)
    log = history.read_log(spark, root, table)
    aborted = log.withColumns({"run": F.lit("compacted-x"), "batch": F.lit(0).cast("bigint")})
    history._write(aborted, root, table)  # as if a compaction had stopped before it published
    assert history.read_table(spark, root, table).count() == 2
    opened = history.read_table(spark, root, table)  # a reader from before
    assert history.compact(spark, root, table, datetime.date(2027, 1, 1)) == 1
    put([1, 2], 2)
    assert sorted(r.offset for r in opened.collect()) == [0, 1]
    rows = history.read_log(spark, root, table).collect()
    assert sorted((r.offset, r.run.startswith("compacted-")) for r in rows) == [(0, True), (1, True), (2, False)]
    assert history.vacuum(spark, root, table) == 2 and history.vacuum(spark, root, table) == 0
    assert sorted(r.offset for r in history.read_table(spark, root, table).collect()) == [0, 1, 2]
    assert history.compact(spark, root, table, datetime.date(2027, 1, 1)) == 1
    put([0, 1, 2, 3], 3)
    assert sorted(r.offset for r in history.read_table(spark, root, table).collect()) == [0, 1, 2, 3]


def test_new_offsets_open_no_stored_row(spark):
    root, table = scratch(spark, "history"), history.PREDICTIONS
    history.initialize(spark, root)

    def opened(offsets, batch_id):
        """Batches whose stored keys the batch may repeat; the batch is stored, too."""
        rows = prediction_rows(spark, offsets, 0.0)
        history.insert_absent(rows, root, table, run="a", batch_id=batch_id)
        spans = {f"0-{o // history.SPAN_OFFSETS}" for o in offsets}
        met = history._meeting(spark, root, table, "a", batch_id, spans)
        keys = history.present_keys(spark, root, table, run="a", batch_id=batch_id, spans=spans)
        assert (keys is None) == (not met)
        stored = 0 if keys is None else keys.count()
        read = [r for r in history.read_log(spark, root, table).collect() if f"{r.span}/{r.run}/{r.batch}" in met]
        assert stored == len(read)
        return sorted(name.rpartition("/")[2] for name in met)

    assert opened(range(0, 500), 0) == []
    assert opened(range(500, 900), 1) == []
    assert opened([2_500_000, 30_000], 2) == []
    assert opened(range(450, 460), 3) == ["0"]
    assert opened([400, 600, 40_000], 4) == ["0", "1", "3"]
    assert history.read_table(spark, root, table).count() == 903


def test_buckets_of_a_range_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BUCKET_ROWS", 1000)
    rows = spark.range(30_000).select((F.col("id") * 7 % 30_000).alias("k"))
    sizes = ordering.range_buckets(rows, "k").groupBy(ordering.BUCKET).count().collect()
    assert len(sizes) == 30 and max(r["count"] for r in sizes) < 2500
    placed = ordering.positions(ordering.range_buckets(rows, "k"), "k", "at")
    assert placed.where("at != k").count() == 0


def test_a_row_that_repeats_often_unfolds_in_many_tasks(spark):
    from weirgauge.operators import replay

    row = spark.createDataFrame([(7, "normal", 0)], "k int, replay_class string, position bigint")
    spread = replay._repeat(row, F.lit(100_000), F.lit(1), "turn")
    sizes = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 100_000 and len(sizes) > 3
    assert spread.select("turn").distinct().count() == 100_000


def test_publications_are_ordered_by_version_not_by_clock(spark, monkeypatch):
    root = scratch(spark, "snapshot")
    one = lambda n: spark.createDataFrame([(n,)], "n int")
    snapshots.publish(one(1), root)
    monkeypatch.setattr(snapshots.time, "time", lambda: 0.0)
    snapshots.publish(one(2), root)
    assert [r.record["n"] for r in snapshots.read(spark, root).collect()] == ["2"]
    assert len(snapshots._folders(spark, root)) == 2
    monkeypatch.undo()
    snapshots._put(spark.createDataFrame([("[]",)], "value string"), root, keep_seconds=-5)
    assert [done for _, _, done in snapshots._folders(spark, root)] == [True]
    with pytest.raises(ContractError):
        snapshots.publish(spark.range(3), root, most=2)


def test_missing_table_is_an_error(spark):
    with pytest.raises(ContractError):
        history.table_counts(spark, scratch(spark, "nothing"))


def test_reconciliation_finds_every_kind_of_difference(spark):
    source = prediction_rows(spark, [1, 2, 3, 4], 0.0).select("topic", "partition", "offset")
    stored = prediction_rows(spark, [1, 3, 3, 9], 0.0).unionByName(
        prediction_rows(spark, [4], 1.0)
    )
    found = history.reconcile(source, stored, stored.limit(0)).collect()
    assert {r.verdict: r.records for r in found} == {
        "matched": 1, "missing": 1, "repeated": 1, "unexpected": 1, "alert_differs": 1
    }


def test_snapshots_merge_and_stay_bounded(spark):
    root = scratch(spark, "snapshot")
    start = datetime.datetime(2026, 1, 1)

    def batch(numbers, count):
        rows = [
            (start + datetime.timedelta(seconds=5 * n), start + datetime.timedelta(seconds=5 * n + 10),
             count, 1.0, 0, count, 0.0, 1.0, "Critical")
            for n in numbers
        ]
        return spark.createDataFrame(rows, history.METRICS.schema)

    snapshots.reset(spark, root)
    assert snapshots.read(spark, root).count() == 0
    live.publish_windows(batch(range(50), 1), root)
    live.publish_windows(batch(range(40, 80), 2), root)
    got = [r.record for r in snapshots.read(spark, root).collect()]
    assert len(got) == 60
    assert sorted({r["event_count"] for r in got}) == ["1", "2"]
    assert sum(r["event_count"] == "2" for r in got) == 40
    assert max(r["window_end"] for r in got).startswith("2026-01-01T00:06:45")


def test_broken_snapshot_reads_as_empty(spark):
    root = scratch(spark, "snapshot")
    bad = spark.createDataFrame([("[{\"a\": 1",)], "value string")
    bad.coalesce(1).write.text(f"{root}/v=1")
    assert snapshots.read(spark, root).count() == 0


# --- streams ------------------------------------------------------------------


def test_console_sink_runs_to_the_end(spark, capfd):
    source = scratch(spark, "arriving")
    spark.range(3).write.parquet(source)
    stream = records.file_stream(spark, source, "id bigint", files_per_batch=1)
    query = runner.start_console(stream, scratch(spark, "checkpoint"), mode="append", name="seen")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None and not query.isActive


def test_rate_limit_makes_more_batches(spark):
    source, sink = scratch(spark, "arriving"), scratch(spark, "sink")
    spark.range(40).repartition(4).write.parquet(source)
    stream = records.file_stream(spark, source, "id bigint", files_per_batch=1)
    runner.drain(stream, scratch(spark, "checkpoint"), runner.batch_writer(sink))
    kept = spark.read.parquet(sink)
    assert kept.count() == 40 and kept.select("batch_id").distinct().count() == 4


def test_topic_start_is_checked(spark):
    with pytest.raises(ContractError):
        records.topic_stream(spark, "localhost:1", "t", start="yesterday")
