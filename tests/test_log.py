"""Small logs with the shapes that the library has to get right."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from topicflow.functions.codec import decode, encode_int32, encode_int32_little, int32, int32_little, nothing, utf8
from topicflow.operators import offsets, partitioned, policy, produce, summary
from topicflow.sources import log as logs
from topicflow.sources import readers
from topicflow.sources.subscribe import Subscription, assignment, assignment_from, kafka_reader_options, kafka_writer_options, topic_pattern, topics
from topicflow.streaming import jobs, monitor


def numbers(spark, n=100, topic="t", partitions=1, first=1):
    """A log of the numbers first.. as text, dealt over partitions in turn."""
    rows = spark.range(n).select(
        F.lit(topic).alias("topic"), (F.col("id") % partitions).cast("int").alias("partition"), F.floor(F.col("id") / partitions).cast("long").alias("offset"),
        F.lit(None).cast("binary").alias("key"), (F.col("id") + first).cast("string").cast("binary").alias("value"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("timestamp"), F.lit(None).cast("long").alias("txn_id"),
    )
    return rows


def values(df):
    return [int(bytes(r["value"]).decode()) for r in df.orderBy("topic", "partition", "offset").collect()]


def test_one_partition_in_order(spark):
    assert values(readers.plain_source(numbers(spark), assignment(("t", 0)))) == list(range(1, 101))


def test_from_offset_is_inclusive(spark):
    assert values(readers.plain_source(numbers(spark, first=0), assignment_from(("t", 0, 50)))) == list(range(50, 100))


def test_start_filter_is_pushed_down(spark, tmp_path):
    logs.write_log(numbers(spark, 300, partitions=3), str(tmp_path / "log"))
    plan = readers.plain_source(logs.read_log(spark, str(tmp_path / "log")), assignment_from(("t", 1, 40)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "OrEqual(offset,40)]" in text and "ReadSchema" in text
    assert plan.count() == 60


def test_dense_offsets_in_buckets_equal_one_window(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7).alias("o"))
    a = logs.dense_offsets(rows, ["g"], ["o"]).orderBy("o").collect()
    b = logs.dense_offsets(rows, ["g"], ["o"], F.floor(F.col("o") / 100)).orderBy("o").collect()
    assert [r["offset"] for r in a] == [r["offset"] for r in b]


def test_two_assignments_over_one_scan(spark):
    log = numbers(spark, 20, partitions=2)
    both = spark.createDataFrame([(1, "t", 0, None), (2, "t", 1, None)], "assign_id int, topic string, partition int, start bigint")
    assert {r["assign_id"]: r["count"] for r in readers.multi_assignment_source(log, both).groupBy("assign_id").count().collect()} == {1: 10, 2: 10}


def test_skipping_one_record_leaves_99(spark):
    skip = lambda parts: parts.select("topic", "partition", F.when(F.col("partition") == 0, 1).cast("long").alias("start"))
    found = readers.manual_offset_source(numbers(spark, 100, partitions=3), topics("t"), skip)
    assert found.select("value").distinct().count() == 99


def test_resume_and_other_groups(spark):
    log = numbers(spark)
    commits = readers.committable(log.filter("offset < 25"), "g1").select("commit.*")
    journal = offsets.journal_rows(offsets.fold_offsets(commits, F.col("offset")), F.lit("s"), F.lit(0))
    assert values(offsets.resume(log, journal, "g1")) == list(range(26, 101))
    assert values(offsets.resume(log, journal, "g2")) == list(range(1, 101))


def test_last_arrival_wins_but_transactions_take_the_highest(spark):
    rows = spark.createDataFrame([("g", "t", 0, o, "", s) for s, o in enumerate([5, 9, 7])], "group_id string, topic string, partition int, offset long, metadata string, seq int")
    batch = offsets.fold_offsets(rows, F.col("seq")).first()
    assert (batch["offset"], batch["batch_size"]) == (7, 3)
    assert offsets.fold_transaction(rows).first()["next_offset"] == 10


def test_batches_of_two_hold_ten(spark):
    rows = offsets.grouped_within(numbers(spark, 10), ["topic", "partition"], F.col("timestamp"), "1 hour", ["offset"], 2)
    sizes = [r["count"] for r in rows.groupBy("window_start", "batch").count().collect()]
    assert sizes == [2] * 5


def test_one_source_per_group(spark):
    rows = spark.createDataFrame([("g", 1), ("g", 2), ("h", 1)], "group_id string, source_id int")
    assert [r["group_id"] for r in offsets.groups_of_many_sources(rows).collect()] == ["g"]
    with pytest.raises(PySparkException, match="more than one source"):
        offsets.guarded(rows).collect()
    assert offsets.guarded(rows.filter("group_id = 'h'")).count() == 1


def test_start_policy_and_seek(spark):
    log, none = numbers(spark, 10), spark.createDataFrame([], "topic string, partition int, next_offset long")
    assert readers.start_positions(log, none, "latest").first()["start"] == 10
    assert readers.start_positions(log, none, "earliest").first()["start"] == 0
    with pytest.raises(ValueError):
        readers.start_positions(log, none, "middle")
    starts = readers.seek(spark.createDataFrame([("t", 0, 3)], "topic string, partition int, start long"), spark.createDataFrame([("t", 0, 8)], "topic string, partition int, start long"))
    assert values(readers.from_starts(log, starts)) == [9, 10]


def test_missing_topic(spark):
    log = numbers(spark, 5)
    assert logs.topic_or_empty(log, ["absent"]).count() == 0
    with pytest.raises(ValueError, match="absent"):
        logs.topic_or_empty(log, ["t", "absent"], auto_create=False)


def test_codecs(spark):
    nums = [0, 1, -1, -2, 2**31 - 1, -(2**31)]
    df = spark.createDataFrame([(n,) for n in nums], "n int")
    for enc, dec in ((encode_int32, int32), (encode_int32_little, int32_little)):
        assert [r[0] for r in df.select(dec(enc(F.col("n")))).collect()] == nums
    assert bytes(df.select(encode_int32_little(F.col("n"))).collect()[1][0]) == b"\x01\0\0\0"
    bad = spark.createDataFrame([(bytearray(b"\xffA"),), (bytearray(b"ok"),), (None,)], "b binary")
    assert [r[0] for r in bad.select(utf8(F.col("b"))).collect()] == [None, "ok", None]


def text_as_ints(spark):
    return decode(numbers(spark, 10), key=nothing, value=int32)


def test_text_read_as_int32(spark):
    with pytest.raises(PySparkException, match="VALUE_DESERIALIZATION"):
        policy.apply_policy(text_as_ints(spark))[0].collect()
    good, letters = policy.apply_policy(text_as_ints(spark), {"VALUE_DESERIALIZATION": "resume"})
    assert good.count() == 0 and letters.count() == 10
    kept, seen = policy.counted_drop(text_as_ints(spark))
    assert kept.count() == 0 and seen.get["dropped"] == 10


def test_fixed_directives(spark):
    with pytest.raises(ValueError):
        policy.policy({"FATAL": "resume"})
    with pytest.raises(ValueError):
        policy.policy({"CONSUME": "perhaps"})


def test_restart_replays_from_the_start(spark):
    seen = []

    def job(attempt):
        for n in range(1, 11):
            if n == 5 and attempt == 0:
                raise RuntimeError("once")
            seen.append(n)
        return seen

    assert policy.restarting(job) == [1, 2, 3, 4, *range(1, 11)]
    with pytest.raises(RuntimeError):
        policy.restarting(lambda attempt: (_ for _ in ()).throw(RuntimeError("always")), retries=1)


def test_fan_out_ten_in_ten_out(spark):
    rows = spark.range(1, 11).select(F.col("id").alias("envelope_id"), F.col("id").cast("string").alias("v"))
    to = lambda t: produce.record(F.lit(t), F.lit(None), F.col("v"))
    records = F.when(F.col("v") == "1", produce.multi(to("b"), to("c"))).when(F.col("v") == "2", produce.pass_through()).otherwise(produce.single(to("d")))
    sent, done = produce.produce(rows.select("envelope_id", records.alias("records"), F.struct("envelope_id").alias("pass_through")), 3)
    assert sent.count() == 10 and done.count() == 10
    kinds = {r["envelope_id"]: (r["kind"], len(r["parts"])) for r in done.collect()}
    assert kinds[1] == ("multi", 2) and kinds[2] == ("passthrough", 0) and kinds[3] == ("single", 1)
    assert summary.delivery_audit(sent, sent).filter("gaps > 0 or missing > 0").count() == 0


def test_equal_records_of_a_multi_are_sent_once(spark):
    r = produce.record(F.lit("b"), F.lit("k"), F.lit("v"))
    rows = spark.range(1).select(F.col("id").alias("envelope_id"), produce.multi(r, r).alias("records"))
    assert produce.explode_records(rows, 3).count() == 1


def test_invalid_records_raise(spark):
    rows = spark.createDataFrame([(None, 0)], "topic string, partition int").withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    with pytest.raises(PySparkException, match="INVALID_TOPIC"):
        produce.valid_or_raise(rows).collect()


def test_chunks_segments_take_while(spark):
    log = numbers(spark, 105, partitions=3)
    assert partitioned.chunks(log, 10).groupBy("partition", "chunk").count().agg(F.sum("count")).first()[0] == 105
    marked = partitioned.segments(log, F.col("value").cast("string").cast("int") % 10 == 0)
    assert sorted(values(marked)) == list(range(1, 106))
    one = numbers(spark, 20)
    good = F.col("value").cast("string").cast("int") < 7
    assert values(partitioned.take_while(one, good)) == list(range(1, 7))
    assert values(partitioned.take_while(one, good, inclusive=True)) == list(range(1, 8))


def test_summary_median_of_even_sample(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = summary.sample_summary(rows, F.col("x")).first()
    assert (r["mean"], r["median"], r["max"]) == (4.0, 2.5, 10.0)


def test_audit_finds_gaps_repeats_and_strangers(spark):
    log = numbers(spark, 10)
    out = log.filter("offset not in (3, 4)").unionByName(log.filter("offset = 7")).unionByName(log.filter("offset = 9").withColumn("offset", F.lit(30).cast("long")))
    r = summary.delivery_audit(log, out).first()
    assert (r["missing"], r["repeated"], r["unknown"], r["gaps"]) == (2, 1, 1, 2)


def test_kafka_options():
    assert kafka_reader_options(topics("a", "b"), {"x": "1"}, {"x": "2"})["kafka.x"] == "2"
    assert topic_pattern("a.*").kafka_options()["subscribePattern"] == "a.*"
    o = assignment_from(("a", 0, 5), ("a", 1, 6)).kafka_options()
    assert o == {"assign": '{"a": [0, 1]}', "startingOffsets": '{"a": {"0": 5, "1": 6}}'}
    assert assignment(("a", 0)).kafka_options("earliest")["startingOffsets"] == '{"a": {"0": -2}}'
    o = kafka_reader_options(topics("a"), timestamp_starts={("a", 0): 7}, committed_only=True, fail_on_data_loss=False, max_offsets=10)
    assert o["kafka.isolation.level"] == "read_committed" and o["failOnDataLoss"] == "false" and o["maxOffsetsPerTrigger"] == "10" and "startingOffsets" not in o
    assert kafka_writer_options(transactional_id="t")["kafka.enable.idempotence"] == "true"
    for bad in (lambda: kafka_writer_options(transactional_id=""), topics):
        with pytest.raises(ValueError):
            bad()
    assert isinstance(topics("a"), Subscription)


class Once:
    """Fails the first time a step of a batch begins."""

    def __init__(self, step, batch):
        self.at, self.failed = (step, batch), False

    def __call__(self, step, batch):
        if (step, batch) == self.at and not self.failed:
            self.failed = True
            raise RuntimeError("injected")


def run(spark, tmp_path, job, hook, **more):
    """Runs a job to its failure and again; returns what it put out and its journal's path."""
    path = lambda name: str(tmp_path / name)
    logs.write_log(numbers(spark, 60, partitions=6), path("log"))
    step = lambda b: b.select("topic", "partition", "offset")
    start = lambda: job(logs.stream_log(spark, path("log"), 2), step, "g", path("out"), path("journal"), **more, checkpoint=path("cp"), hook=hook)
    with pytest.raises(Exception, match="injected"):
        jobs.drain(start())
    jobs.drain(start())
    return jobs.read_batches(spark, path("out"), "topic string, partition int, offset long, source_id string, commit_seq long, txn_id long"), path


def test_at_least_once_loses_nothing(spark, tmp_path):
    out, path = run(spark, tmp_path, jobs.at_least_once, Once("commit", 1))
    audit = summary.delivery_audit(numbers(spark, 60, partitions=6), out)
    assert audit.filter("missing > 0 or repeated > 0").count() == 0
    seen = jobs.read_visible(spark, path("out"), "topic string, partition int, offset long, source_id string, commit_seq long", path("journal"))
    assert seen.count() == 60
    positions = offsets.current_positions(spark.read.schema(jobs.JOURNAL_SCHEMA).option("recursiveFileLookup", "true").parquet(path("journal")))
    assert {r["next_offset"] for r in positions.collect()} == {10}


def test_at_most_once_repeats_nothing(spark, tmp_path):
    out, _ = run(spark, tmp_path, jobs.at_most_once, Once("output", 1))
    audit = summary.delivery_audit(numbers(spark, 60, partitions=6), out)
    assert audit.filter("repeated > 0").count() == 0
    assert audit.agg(F.sum("missing")).first()[0] == 20  # the failed batch


def test_transactions_are_seen_whole(spark, tmp_path):
    out, path = run(spark, tmp_path, jobs.transactional, Once("transaction", 1), committed=str(tmp_path / "done"), transactional_id="t")
    done = jobs.read_batches(spark, path("done"), jobs.TXN_SCHEMA)
    seen = readers.committed_records(out, done)
    assert seen.count() == 60 and seen.distinct().count() == 60
    with pytest.raises(ValueError):
        jobs.transactional(out, lambda b: b, "g", "o", "j", "c", "cp", "")


def test_listener_reports_progress_and_end(spark, tmp_path):
    logs.write_log(numbers(spark, 10), str(tmp_path / "log"))
    reports, ends = [], []
    listener = monitor.StatisticsListener(reports.append, lambda query, error: ends.append(error))
    spark.streams.addListener(listener)
    try:
        q = jobs.at_least_once(logs.stream_log(spark, str(tmp_path / "log")), lambda b: b, "g", str(tmp_path / "o"), str(tmp_path / "j"), str(tmp_path / "c"), once=False, interval="1 second")
        jobs.stop_after_all(q)
        for _ in range(50):
            if ends:
                break
            __import__("time").sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert reports and ends == [None]


def test_null_partitions_are_numbered_too(spark):
    rows = spark.createDataFrame([("a", None, 1), (None, 0, 2), (None, 0, 70_000), ("a", None, 3)], "topic string, partition int, n long")
    for bucket in (None, F.floor(F.col("n") / 65_536)):
        found = logs.dense_offsets(rows, ["topic", "partition"], ["n"], bucket)
        assert sorted((r["n"], r["offset"]) for r in found.collect()) == [(1, 0), (2, 0), (3, 1), (70_000, 1)]


def test_ranges_along_a_hot_partition(spark, monkeypatch):
    from topicflow.operators import partitioned

    rows = spark.range(40).select(F.lit("a").alias("topic"), F.lit(None).cast("int").alias("partition"), (F.col("id") * 3).alias("offset"), (F.col("id") % 9 == 8).alias("mark"))
    monkeypatch.setattr(partitioned, "RANGE", 16)
    got = lambda df, c: [r[c] for r in df.orderBy("offset").collect()]
    assert got(partitioned.running_count(rows), "n") == list(range(1, 41))
    for n in (0, 1, 7, 16, 39, 40, 99):
        assert got(partitioned.take(rows, n), "offset") == [3 * i for i in range(min(n, 40))]
    assert got(partitioned.chunks(rows, 6), "chunk") == [i // 6 for i in range(40)]
    assert got(partitioned.segments(rows, F.col("mark")), "segment") == [i // 9 for i in range(40)]
    for inclusive in (False, True):
        assert got(partitioned.take_while(rows, ~F.col("mark"), inclusive), "offset") == [3 * i for i in range(8 + inclusive)]
    none = rows.limit(0)
    for f in (partitioned.running_count(none), partitioned.segments(none, F.col("mark")), partitioned.take_while(none, F.col("mark"))):
        assert f.count() == 0


def test_commits_of_two_jobs_follow_time(spark, tmp_path):
    """An older job's batch 57 does not beat a newer job's batch 3; a name may not be taken twice."""
    rows = numbers(spark, 20)
    for source, batch, offset in (("old", 57, 5), ("new", 3, 9)):
        jobs.commit_batch(readers.committable(rows.filter(F.col("offset") == offset), "g"), str(tmp_path / "j"), source, batch)
    journal = jobs.read_batches(spark, str(tmp_path / "j"), jobs.JOURNAL_SCHEMA)
    assert {r["next_offset"] for r in offsets.current_positions(journal).collect()} == {10}
    assert offsets.compact_journal(journal).first()["source_id"] == "new"
    logs.write_log(rows, str(tmp_path / "log"))
    with pytest.raises(ValueError, match="another job"):
        jobs.at_least_once(logs.stream_log(spark, str(tmp_path / "log")), lambda b: b, "g", str(tmp_path / "o"), str(tmp_path / "j"), str(tmp_path / "c"), source_id="old")


def test_refused_envelopes_have_a_result(spark):
    row = lambda topic, part: (topic, part, None, b"k", b"v")
    made = [(0, [row("a", 0)], "p0"), (1, [row("a", 0), row(None, 1)], "p1"), (2, [row("a", -7)], "p2"), (3, [], "p3"), (4, None, "p4"), (5, [row("a", 0), row("b", None)], "p5")]
    schema = "envelope_id long, records array<struct<topic:string,partition:int,timestamp:timestamp_ntz,key:binary,value:binary>>, pass_through string"
    sent, done = produce.produce(spark.createDataFrame(made, schema), 3)
    assert sorted((r["envelope_id"], r["topic"], r["offset"]) for r in sent.collect()) == [(0, "a", 0), (5, "a", 1), (5, "b", 0)]
    found = {r["envelope_id"]: (r["kind"], len(r["parts"]), r["pass_through"], r["error_code"]) for r in done.collect()}
    assert found == {0: ("single", 1, "p0", None), 1: ("refused", 0, "p1", "INVALID_TOPIC"), 2: ("refused", 0, "p2", "INVALID_PARTITION"), 3: ("passthrough", 0, "p3", None), 4: ("passthrough", 0, "p4", None), 5: ("multi", 2, "p5", None)}


def test_each_result_reaches_the_action(spark, tmp_path):
    logs.write_log(numbers(spark, 10), str(tmp_path / "log"))
    seen = []
    jobs.drain(jobs.for_each_result(logs.stream_log(spark, str(tmp_path / "log")), lambda rows, batch: seen.append(rows.count()), str(tmp_path / "c")))
    assert sum(seen) == 10


def test_dense_offsets_count_without_a_shuffle(spark):
    log = numbers(spark, 90, partitions=3).filter("offset >= 4")
    for f in (lambda **k: partitioned.running_count(log, **k), lambda **k: partitioned.take(log, 5, **k), lambda **k: partitioned.chunks(log, 7, **k)):
        fast = f(first=F.lit(4))
        assert sorted(map(str, fast.collect())) == sorted(map(str, f().select(*fast.columns).collect()))
        assert "Exchange" not in fast._jdf.queryExecution().executedPlan().toString()


def test_records_without_a_time_keep_their_place(spark):
    rows = spark.createDataFrame([("a", 0, i, t, "x", 9) for i, t in enumerate(["2024-01-01 00:00:01", None, "2024-01-01 05:00:00", None, None, "2024-01-02 00:00:00"])], "topic string, partition int, offset long, t string, window_start string, batch int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    found = offsets.grouped_within(rows, ["topic", "partition"], F.col("t"), "1 day", ["offset"], 2).orderBy("offset").collect()
    assert [(str(r["window_start"])[:10], r["batch"]) for r in found] == [("2024-01-01", 0), ("None", 0), ("2024-01-01", 0), ("None", 0), ("None", 1), ("2024-01-02", 0)]
    assert offsets.grouped_within(rows.limit(0), ["topic"], F.col("t"), "1 day", ["offset"], 2).count() == 0


def test_exact_medians_of_groups_that_span_ranges(spark):
    import random
    import statistics

    rng = random.Random(2)
    rows = [("hot", float(rng.randint(0, 60))) for _ in range(5000)] + [("odd", float(i)) for i in range(7)] + [("two", 1.0), ("two", 4.0), (None, 5.0), (None, None), ("none", None), ("same", 2.0), ("same", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    found = {r["g"]: r["median"] for r in summary.exact_median(df, F.col("x"), "g").collect()}
    assert found == {g: statistics.median([x for h, x in rows if h == g and x is not None]) for g in ("hot", "odd", "two", None, "same")}
    both = summary.sample_summary(df, F.col("x"), "g")
    assert {r["g"]: r["median"] for r in both.collect()} == {**found, "none": None}
    assert "percentile" not in both._jdf.queryExecution().executedPlan().toString().lower()
    assert summary.sample_summary(df.limit(0), F.col("x")).first()["median"] is None and summary.exact_median(df.limit(0), F.col("x"), "g").count() == 0


def test_audits_over_ranges_equal_a_plain_count(spark, monkeypatch):
    import random

    monkeypatch.setattr(summary, "RANGE", 8)
    rng = random.Random(5)
    for _ in range(3):
        want = [(p, o) for p in (0, None) for o in range(rng.randint(0, 60))]
        came = [k for k in want + [(0, 90), (1, 3)] for _ in range(rng.choice([0, 1, 1, 1, 2]))]
        frame = lambda rows: spark.createDataFrame([("t", p, o) for p, o in rows], "topic string, partition int, offset long")
        found = {r["partition"]: tuple(r[c] for c in ("expected", "delivered", "missing", "repeated", "unknown", "gaps")) for r in summary.delivery_audit(frame(want), frame(came)).collect()}
        for p in {k[0] for k in want + came}:
            w, c = {o for q, o in want if q == p}, [o for q, o in came if q == p]
            runs = sum(o - 1 not in c for o in set(c))
            assert found[p] == (len(w), len(c), len(w - set(c)), sum(c.count(o) > 1 for o in set(c)), len(set(c) - w), max(0, runs - 1))


def test_queries_scan_the_written_log_once(spark):
    from topicflow.plans.queries import QUERIES

    for name in ("gapless_chunks", "running_count", "take_per_partition", "assignment_from_offset", "topics_subscription"):
        text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan parquet") == 1 and "events-log" in text, name
    assert "PartitionFilters: [isnotnull(topic" in text or "PartitionFilters: [topic" in text
    assert "PushedFilters: [IsNotNull(offset), LessThan(offset,10)]" in QUERIES["take_per_partition"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from topicflow.workdir import work_path

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_path(cluster, "x")


def test_calls_in_flight_are_bounded_ordered_and_faster(spark):
    import time

    rows = spark.range(0, 64, 1, 1)

    def slow(b):
        import threading

        held = getattr(slow, "held", None) or threading.Semaphore(4)
        slow.held = held
        assert held.acquire(blocking=False), "more than four calls at once"
        try:
            time.sleep(0.05 * (1 + b.column("id")[0].as_py() % 3))  # later ones end before earlier ones
        finally:
            held.release()
        return b

    def seconds(n):
        start = time.time()
        found = [r["id"] for r in partitioned.map_in_flight(rows, slow, "id long", in_flight=n).collect()]
        assert found == list(range(64))
        return time.time() - start

    seconds(4)
    assert seconds(4) < 0.8 * seconds(1)
    assert partitioned.map_in_flight(rows.limit(0), slow, "id long").count() == 0
    with pytest.raises(ValueError):
        partitioned.map_in_flight(rows, slow, "id long", in_flight=0)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        partitioned.map_in_flight(rows, lambda b: 1 // 0, "id long").collect()


def test_ranges_of_numbers(spark):
    got = lambda *a: [r[0] for r in logs.element_range(spark, *a).collect()]
    assert got(1, 5) == [1, 2, 3, 4, 5] and got(5, 1) == [] and got(5, 1, -2) == [5, 3, 1] and got(1, 6, 2) == [1, 3, 5]
    with pytest.raises(ValueError):
        logs.element_range(spark, 1, 2, 0)


def test_single_commits(spark):
    rows = readers.committable(numbers(spark, 5), "g").select("commit.*")
    made = offsets.commit_one(rows.union(rows.filter("offset = 2").withColumn("offset", F.lit(None).cast("long"))), F.lit("s"), F.col("offset"))
    assert [(r["next_offset"], r["batch_size"]) for r in made.orderBy("next_offset").collect()] == [(i, 1) for i in range(1, 6)]
