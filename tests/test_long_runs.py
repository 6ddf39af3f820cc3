"""What is stored over many days and batches: sketches, buckets, ledgers, first lines."""

import datetime

import pytest
from pyspark.sql import functions as F

from weirgauge.catalog import inputs as i
from weirgauge.catalog import models, streams
from weirgauge.catalog.registry import QUERIES
from weirgauge.contracts import ContractError, FlowContract
from weirgauge.functions import cells, keys
from weirgauge.operators import clean, examples, forest, sketches, windows
from weirgauge.plans import training
from weirgauge.session import put_once, scratch, set_times, stream_session
from weirgauge.sources import example_store, files, history, records
from weirgauge.streaming import chained, ledger, runner


def scanned_rows(df):
    """Rows that the scans of an executed plan gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    text = plan.collectLeaves()
    found = [text.apply(k) for k in range(text.size())]
    return sum(leaf.metrics().apply("numOutputRows").value() for leaf in found if "Scan" in leaf.nodeName())


def test_first_lines_are_read_and_not_the_rest(spark, monkeypatch):
    path = scratch(spark, "lines")
    contract = FlowContract(numeric=("a",), features=("a",), attacks=("X",))
    rows = spark.range(300_000).select(F.format_string("%07d", "id").alias("a"), F.lit("X").alias("Label"))
    rows.repartitionByRange(3, "a").write.options(header=True).csv(path)
    monkeypatch.setattr(files, "FILES_PER_JOB", 2)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")  # files of several blocks
    try:
        sampled = files.sample_per_file(spark, path, contract, 700).collect()
        assert [r.header for r in files.headers(spark, path).collect()] == ["a,Label"] * 3
        one = files.inventory(spark, path).first().file
        part = files.head(files._whole_files(spark).read.text(one), 5)
        assert [r.position for r in part.collect()] == [1, 2, 3, 4, 5] and scanned_rows(part) < 100
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert len(sampled) == 2100
    of = {}
    for r in sampled:
        of.setdefault(r.file, []).append((r.position, int(r.a)))
    for got in of.values():
        first = min(a for _, a in got)
        assert sorted(got) == [(k + 1, first + k) for k in range(700)]
    with pytest.raises(ContractError):
        files.sample_per_file(spark, path, contract, 0)


def test_checks_over_buckets_move_no_rows(spark):
    key = examples.PRINT
    first = examples.with_fingerprint(spark.range(500).select(F.col("id") % 90, F.lit("train").alias("split")), ["(id % 90)"])
    second = examples.with_fingerprint(spark.range(80, 120).select(F.col("id").alias("(id % 90)"), F.lit("test").alias("split")), ["(id % 90)"])
    tables = []
    for name, df in (("kept", first), ("sent", second)):
        path = scratch(spark, name)
        example_store.save(df, path.rpartition("/")[2].replace("-", "_"), path, 4)
        again = path.rpartition("/")[2].replace("-", "_") + "_again"
        tables.append(example_store.attach(spark, again, path, f"`(id % 90)` bigint, split string, {key} string", 4))
    stored, delivered = tables
    reports = {
        "new": example_store.new_examples(delivered, stored),
        "shared": examples.shared_keys(delivered, stored),
        "presence": examples.split_presence(stored, key, "split", ("train", "test")),
    }
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in reports.values():
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(r[1] for r in reports["new"].collect()) == list(range(90, 120))
        assert reports["shared"].count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_day_is_sketched_alone(spark):
    path = scratch(spark, "sketches")
    rows = spark.range(4000).select(
        F.expr("timestamp'2024-01-01' + make_interval(0,0,0,cast(id % 4 as int))").alias("ts"),
        F.col("id").alias("many"), F.lit("a").alias("one"), F.when(F.col("id") < 0, 1).alias("none"), (F.col("id") % 5).alias("few"),
    )
    names = ["many", "one", "none", "few"]
    sketches.store_days(rows.where("id % 4 < 3"), F.col("ts"), path, names)
    before = {r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).collect()}
    sketches.store_days(rows.where("id % 4 = 3"), F.col("ts"), path, names)
    after = {r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).collect()}
    assert before < after
    got = {r.column_name: r for r in sketches.stored_profile(spark, path).collect()}
    assert got["many"].rows == 4000 and abs(got["many"].approx_distinct - 4000) < 400 and got["many"].days == 4
    assert got["one"].constant and not got["none"].constant and got["none"].null_rows == 4000
    assert got["few"].low_cardinality and got["few"].approx_distinct == 5
    some = sketches.stored_profile(spark, path, datetime.date(2024, 1, 2), datetime.date(2024, 1, 3))
    assert {r.days for r in some.collect()} == {2}


def test_frequent_values_among_many(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 33 == 0, F.col("id")).otherwise(-1).alias("near"),
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("not"),
        F.when(F.col("id") % 50 == 0, "x").alias("missing"),
        F.lit(None).cast("string").alias("empty"),
    )
    got = {r.column_name: (r.value, r.rows) for r in sketches.near_constant(rows).collect()}
    assert got == {"near": ("-1", 20_000 - 607), "missing": (None, 19_600), "empty": (None, 20_000)}
    assert sketches.near_constant(rows.where("false")).collect() == []
    with pytest.raises(ContractError):
        sketches.near_constant(rows, share=0.01)


def test_a_folder_appears_whole_or_not_at_all(spark):
    path = scratch(spark, "log")
    assert put_once(spark.range(3), path, "batch=0") and not put_once(spark.range(9), path, "batch=0")
    assert spark.read.parquet(path).count() == 3


def test_the_ledger_outlives_what_a_query_remembers(spark):
    source, book = scratch(spark, "arriving"), scratch(spark, "ledger")
    spark.range(12).withColumn("part", F.col("id")).repartition("part").write.partitionBy("part").parquet(source)
    set_times(spark, source)
    side = stream_session(spark, 2)
    side.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    noted = ledger.watch(side, book)
    arriving = records.file_stream(side, source, "id bigint, part bigint", files_per_batch=1)
    checkpoint = scratch(spark, "checkpoint")
    query = runner.drain(arriving, checkpoint, runner.batch_writer(scratch(spark, "sink")))
    noted.settle(query)
    assert len(query.recentProgress) <= 3
    rows = ledger.entries(spark, book).where("input_rows > 0").orderBy("batch").collect()
    assert [(r.batch, r.input_rows) for r in rows] == [(k, 1) for k in range(12)]


def test_late_places_are_counted_by_batch(spark):
    counts = "batch_id bigint, window_start timestamp, window_end timestamp, event_count bigint"
    at = [datetime.datetime(2024, 1, 1, h) for h in range(4)]
    versions = spark.createDataFrame([(0, at[0], at[1], 5), (2, at[0], at[1], 7), (2, at[1], at[2], 4)], counts)
    seen = [(b, {"arrived.places": str(n)}, 0) for b, n in ((0, 5), (1, 3), (2, 8), (3, 0))]
    book = spark.createDataFrame(seen, "batch bigint, observed map<string,string>, dropped_groups bigint")
    got = sorted((r.batch, r.asked, r.late) for r in ledger.late_places(book, versions).collect())
    assert got == [(0, 5, 0), (1, 3, 3), (2, 8, 2)]
    with pytest.raises(ValueError):
        ledger.with_arrivals(spark.range(1).withColumn("t", F.now()), windows.WindowPlan(7, 5), "t")


def test_periods_of_closed_windows_agree_with_the_batch(spark):
    rows = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1, 0, m), float(m % 3 == 0)) for m in (1, 2, 3, 17, 40, 59)], "event_timestamp timestamp, prediction double"
    )
    plan = windows.WindowPlan(600, 600, 60)
    got = chained.closed_stats(rows, plan, "1 hour").collect()
    assert [(r.windows, round(r.peak_event_rate * 600)) for r in got] == [(4, 3)]


def test_a_training_task_reads_a_bounded_number_of_rows(spark):
    contract = FlowContract(numeric=("a",), features=("a",), attacks=("X",))
    rows = spark.range(0, 10_000, 1, 2).select(F.col("id").cast("double").alias("a"))
    train = clean.add_vector(rows, contract).select("features", (F.col("a") >= 5000).cast("double").alias("binary_label"))
    dealt = forest.in_tasks(train, scratch(spark, "training-rows"), 700)
    held = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 10_000 and max(held) <= 700
    model = forest.fit_forest(train, contract)
    assert forest.score(train, model).where("prediction <> binary_label").count() == 0


def test_buckets_grow_with_the_rows():
    assert example_store.buckets_for(1_000, 8) == 8
    assert example_store.buckets_for(216_000_000, 8) * example_store.BUCKET_ROWS >= 216_000_000


def test_first_lines_of_files_of_several_splits(spark):
    path = scratch(spark, "lines")
    spark.range(30_000).select(F.format_string("%07d", "id")).repartitionByRange(3, "format_string(%07d, id)").write.text(f"{path}")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        lines = spark.read.text(path).select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
        )
        assert lines.select("file", "block").distinct().count() > 3
        got = files.first_lines(lines, 2500).select("file", "position", F.col("value").cast("int").alias("v")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    of = {}
    for r in got:
        of.setdefault(r.file, []).append((r.position, r.v))
    assert len(of) == 3
    for found in of.values():
        first = min(v for _, v in found)
        assert sorted(found) == [(k + 1, first + k) for k in range(2500)]


def test_rows_to_be_inserted_are_computed_once(spark):
    root, seen = scratch(spark, "history"), spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    from pyspark.sql.types import LongType

    noted = F.udf(count, LongType()).asNondeterministic()
    events = spark.createDataFrame([(k,) for k in range(100)], "k bigint").select(noted("k").alias("k"))
    batch = events.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("k").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("event_timestamp"),
    )
    missing = [f.split() for f in history.PREDICTIONS.schema.split(", ")]
    batch = batch.select("*", *[F.lit(None).cast(t).alias(n) for n, t in missing if n not in batch.columns])
    history.initialize(spark, root)
    history.insert_absent(batch, root, history.PREDICTIONS, run="r", batch_id=0)
    assert history.read_table(spark, root, history.PREDICTIONS).count() == 100
    assert seen.value == 100


def test_only_the_model_that_is_asked_for_is_fitted(spark, sf_dir, monkeypatch):
    fitted, fit = [], models.forest.fit_forest
    monkeypatch.setattr(models.forest, "fit_forest", lambda train, contract, weight=None: fitted.append(weight) or fit(train, contract, weight))
    models._model.cache_clear()
    models.model(spark, sf_dir, "baseline")
    assert fitted == [None]


def test_the_verification_job_stores_its_input_only(spark, sf_dir, monkeypatch):
    stored, write = [], models.written
    monkeypatch.setattr(models, "written", lambda df, purpose: stored.append(purpose) or write(df, purpose))
    assert QUERIES["q_verify_job"](spark, sf_dir).count() == 7
    assert stored == ["flows"]


def test_runs_on_the_same_files_share_their_examples(spark, sf_dir, monkeypatch):
    scans, scan = [], training.files.strict_scan
    monkeypatch.setattr(training.files, "strict_scan", lambda s, path, contract: scans.append(path) or scan(s, path, contract))
    got = {r.candidate: r.decision for r in QUERIES["q_training_candidate"](spark, sf_dir).collect()}
    assert got == {"better": "promote", "no better": "keep_baseline"}
    assert len(scans) == len(set(scans)) == 2


def test_examples_are_fitted_where_they_are_stored(spark, monkeypatch):
    contract = FlowContract(numeric=("a",), features=("a",), attacks=("X",))
    monkeypatch.setattr(forest, "TASK_ROWS", 500)
    raw = spark.range(0, 6000, 1, 2).select(
        F.col("id").cast("string").alias("a"), F.when(F.col("id") >= 3000, "X").otherwise(" benign ").alias("Label")
    )
    path = training.store_examples(raw.unionByName(raw.limit(7)).unionByName(raw.limit(1).withColumn("a", F.lit("x"))), contract)
    assert training.clean.funnel_counts(spark.read.parquet(path)).first().asDict() == {
        "raw_rows": 6008, "ready_rows": 6007, "unique_rows": 6000
    }
    train = training.read_split(spark, path, "train", contract)
    held = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    assert max(held) <= 500 and sum(held) == spark.read.parquet(path).where("split = 'train'").count()
    monkeypatch.setattr(forest, "in_tasks", lambda *args: pytest.fail("stored twice"))
    model = forest.fit_forest(train, contract, stored=True)
    # The rule's threshold lies within one of 32 bins.
    assert forest.score(train, model).where(f"prediction <> {contract.target}").count() < 6000 / 32


def test_splits_follow_the_points_of_their_keys(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"))
    for shares in (keys.SPLIT_SHARES, (("a", 0.3), ("b", 0.7), ("c", 0.0)), (("a", 0.0), ("b", 1.0))):
        upper, want = 0.0, F.lit(None).cast("string")
        for name, share in shares[:-1]:
            upper += share
            want = F.coalesce(want, F.when(keys.hash_point(["k"]) < int(round(upper, 9) * 2**32), name))
        want = F.coalesce(want, F.lit(shares[-1][0]))
        assert rows.where(keys.split_name(["k"], shares) != want).count() == 0


def test_vectors_are_made_of_the_rows_that_are_judged(spark, sf_dir):
    plan = models.ruled(spark, sf_dir, models.ATTACKS, "validation")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    assert [k for k, x in enumerate(lines) if "Filter" in x][0] > [k for k, x in enumerate(lines) if "UDF" in x][0]


def test_few_cells_are_judged_like_many(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("1", "2"), ("1", None), ("x", "2"), ("NaN", "1"), (None, "x"), ("1", "-Infinity"), ("NaN", None)], "a string, b string"
    )
    few = [r.v for r in rows.select(cells.all_finite(["a", "b"]).alias("v")).collect()]
    monkeypatch.setattr(cells, "FEW", 1)
    assert few == [r.v for r in rows.select(cells.all_finite(["a", "b"]).alias("v")).collect()] == [True] + [False] * 6


def test_records_are_judged_in_generated_code(spark, sf_dir):
    plan = streams.ingest.judge(i.log_records(i.table(spark, sf_dir, "events")), i.EVENTS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert any("invalid_reason" in x and "Generate explode" in x and "*(" in x for x in text.splitlines())
