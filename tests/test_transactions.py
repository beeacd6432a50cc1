"""Transactions of several jobs and several batches, leases, and merged journals."""

import threading

import pytest
from pyspark.sql import functions as F

from topicflow.operators import produce
from topicflow.sources import log as logs
from topicflow.sources import readers
from topicflow.streaming import jobs
from topicflow.streaming import transactions as tx
from topicflow.streaming.lease import Fenced, Lease

from .test_log import Once, numbers

OUT = "topic string, partition int, offset bigint, value binary, source_id string, commit_seq bigint, txn_id bigint"
DONE = "envelope_id bigint, kind string, source_id string, commit_seq bigint, txn_id bigint"


def copies(batch):
    """Each record to one partition of another topic."""
    sent = produce.single(produce.record(F.lit("copy"), F.lit("k"), F.col("value"), F.lit(0)))
    return batch.select((F.col("offset") * 10 + F.col("partition")).alias("envelope_id"), sent.alias("records"), F.col("commit").alias("pass_through"))


@pytest.fixture
def log(spark, tmp_path):
    logs.write_log(numbers(spark, 60, partitions=6), str(tmp_path / "log"))
    return lambda files=2: logs.stream_log(spark, str(tmp_path / "log"), files)


def job(spark, tmp_path, name, interval=10**9, hook=None, clock=None):
    more = {} if clock is None else {"clock": clock}
    return tx.TransactionalJob(spark, name, "g", str(tmp_path / "tx"), interval, hook, **more)


def seen(spark, tmp_path):
    rows = tx.visible_records(spark, str(tmp_path / "tx"), OUT).collect()
    assert len({r["offset"] for r in rows}) == len(rows)
    return {s: sorted(int(bytes(r["value"])) for r in rows if r["source_id"] == s) for s in {r["source_id"] for r in rows}}


def test_one_jobs_commit_does_not_show_anothers_rows(spark, tmp_path, log):
    path = lambda n: str(tmp_path / n)
    step = lambda b: b.select("topic", "partition", "offset")
    start = lambda name, hook=None: jobs.transactional(log(9), step, f"g-{name}", path("out"), path("journal"), path("done"), path(f"cp-{name}"), name, hook=hook)
    jobs.drain(start("t1"))
    with pytest.raises(Exception, match="injected"):
        jobs.drain(start("t2", Once("transaction", 0)))
    out = jobs.read_batches(spark, path("out"), "topic string, partition int, offset bigint, source_id string, txn_id bigint")
    visible = readers.committed_records(out, jobs.read_batches(spark, path("done"), jobs.TXN_SCHEMA))
    assert out.count() == 120 and [r[0] for r in visible.select("source_id").distinct().collect()] == ["t1"] and visible.count() == 60


def test_no_reader_passes_an_open_transaction(spark, tmp_path, log):
    """t1 commits, t2 stays open, t3 commits behind it: only t1's records are stable until t2 has ended."""
    everything = list(range(1, 61))
    for name in ("t1", "t2", "t3"):
        j = job(spark, tmp_path, name)
        jobs.drain(j.start(log(9), copies, 3, str(tmp_path / f"cp-{name}")))
        if name != "t2":
            j.finish()
    assert seen(spark, tmp_path) == {"t1": everything}
    job(spark, tmp_path, "t2").finish("aborted")
    assert seen(spark, tmp_path) == {"t1": everything, "t3": everything}
    with pytest.raises(ValueError):
        job(spark, tmp_path, "")


def test_several_batches_in_one_transaction_over_a_crash(spark, tmp_path, log):
    root = str(tmp_path / "tx")
    j = job(spark, tmp_path, "t", hook=Once("positions", 1))
    with pytest.raises(Exception, match="injected"):
        jobs.drain(j.start(log(), copies, 3, str(tmp_path / "cp")))
    again = job(spark, tmp_path, "t")
    query = again.start(log(), copies, 3, str(tmp_path / "cp"))
    jobs.drain(query)
    assert seen(spark, tmp_path) == {} and tx.positions(spark, root).count() == 0 and tx.visible_results(spark, root, DONE).count() == 0
    again.finish()
    again.finish()  # nothing is open
    assert seen(spark, tmp_path) == {"t": list(range(1, 61))}
    records = tx.visible_records(spark, root, OUT)
    assert sorted(r["offset"] for r in records.collect()) == list(range(60)) and records.select("commit_seq").distinct().count() == 3
    assert tx.visible_results(spark, root, DONE).select("envelope_id").distinct().count() == 60
    assert {(r["partition"], r["next_offset"]) for r in tx.positions(spark, root).collect()} == {(p, 10) for p in range(6)}
    assert tx.markers(spark, root).count() == 1


def test_transactions_end_with_their_interval(spark, tmp_path, log):
    now = iter([1000, 1040, 1050, 1120, 1130, 1140, 1150, 2000, 2001, 2002])
    j = job(spark, tmp_path, "t", 100, clock=lambda: next(now))
    # opened at 1000; after batch 0: 1040, batch 1: 1050, batch 2: 1120 (ends it, at 1130)
    j.drain(j.start(log(), copies, 3, str(tmp_path / "cp")))
    assert [(r["txn_id"], r["state"]) for r in tx.markers(spark, str(tmp_path / "tx")).collect()] == [(0, "committed")]
    logs.write_log(numbers(spark, 66, partitions=6).filter("offset = 10"), str(tmp_path / "log"))
    j.drain(j.start(log(9), copies, 3, str(tmp_path / "cp")))
    assert tx.markers(spark, str(tmp_path / "tx")).count() == 2 and len(seen(spark, tmp_path)["t"]) == 66


def test_the_older_holder_is_fenced(spark, tmp_path):
    assert Lease(spark, f"file://{tmp_path}/a folder", "g").take().epoch == 0
    one = Lease(spark, str(tmp_path), "g").take()
    one.check()
    two = Lease(spark, str(tmp_path), "g").take()
    assert two.epoch == one.epoch + 1
    two.check()
    Lease(spark, str(tmp_path), "other").take()
    two.check()
    with pytest.raises(Fenced):
        one.check()
    with pytest.raises(Fenced):
        Lease(spark, str(tmp_path), "h").check()
    for _ in range(9):
        last = Lease(spark, str(tmp_path), "g").take()
    assert last.epoch == 10 and one.take().epoch == 11
    with pytest.raises(ValueError):
        Lease(spark, str(tmp_path), "a/b")


def test_of_many_that_ask_at_once_each_gets_its_epoch(spark, tmp_path):
    found = []
    ask = [threading.Thread(target=lambda: found.append(Lease(spark, str(tmp_path), "g").take().epoch)) for _ in range(8)]
    [t.start() for t in ask]
    [t.join() for t in ask]
    assert sorted(found) == list(range(8))


def test_two_jobs_of_one_group_the_older_one_fails(spark, tmp_path, log):
    path = lambda n: str(tmp_path / n)
    start = lambda name, hook=None: jobs.pipeline(log(), copies, 3, "g", path(f"out-{name}"), path(f"res-{name}"), path("journal"), path(f"cp-{name}"), name)
    taken = []

    def take_over(step, batch):
        if not taken:
            taken.append(Lease(spark, path("journal-leases"), "g").take())

    with pytest.raises(Exception, match="Fenced|held by a later job"):
        jobs.drain(jobs.at_least_once(log(), lambda b: b, "g", path("out"), path("journal"), path("cp"), "old", hook=take_over))
    assert jobs.read_batches(spark, path("journal"), jobs.JOURNAL_SCHEMA).count() == 0
    jobs.drain(start("new"))
    assert jobs.read_batches(spark, path("journal"), jobs.JOURNAL_SCHEMA).agg(F.sum("batch_size")).first()[0] == 60


def test_journals_of_many_batches_are_few_folders(spark, tmp_path):
    path, schema = str(tmp_path / "j"), "n bigint"
    for b in range(131):
        jobs._put(spark.range(b, b + 1).withColumnRenamed("id", "n").coalesce(1), path, "s", b)
        jobs.merge_batches(spark, path, "s", b, schema, every=5)
        if b % 26 == 0 or b > 124:
            assert sorted(r["n"] for r in jobs.read_batches(spark, path, schema).collect()) == list(range(b + 1))
            assert len(jobs.batch_folders(spark, path)) <= 5 + 4 + 4 + 1
    assert jobs.read_batches(spark, str(tmp_path / "none"), schema).count() == 0


def test_a_merge_that_was_cut_short_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "j"), "n bigint"
    for b in range(5):
        jobs._put(spark.range(b, b + 1).withColumnRenamed("id", "n"), path, "s", b)
    merged = tmp_path / "j" / "source=s" / "span=0-4"
    spark.range(5).withColumnRenamed("id", "n").write.parquet(str(merged))  # written, and nothing removed yet
    read = lambda: sorted(r["n"] for r in jobs.read_batches(spark, path, schema).collect())
    assert read() == list(range(5))
    (merged / "_SUCCESS").unlink()  # not written in full
    assert read() == list(range(5))


def test_a_policy_stops_the_pipeline(spark, tmp_path, log):
    from topicflow.operators.policy import policy

    def wrong(batch):
        sent = produce.single(produce.record(F.lit("copy"), F.lit("k"), F.col("value"), F.lit(-1)))
        return batch.select(F.col("offset").alias("envelope_id"), sent.alias("records"), F.col("commit").alias("pass_through"))

    path = lambda n: str(tmp_path / n)
    start = lambda p: jobs.pipeline(log(), wrong, 3, "g", path("out"), path("res"), path("journal"), path("cp"), policy=p)
    with pytest.raises(Exception, match="INVALID_PARTITION"):
        jobs.drain(start(policy()))
    assert jobs.read_batches(spark, path("journal"), jobs.JOURNAL_SCHEMA).count() == 0
    jobs.drain(start(policy({"INVALID_PARTITION": "resume"})))
    assert jobs.read_batches(spark, path("journal"), jobs.JOURNAL_SCHEMA).agg(F.sum("batch_size")).first()[0] == 60


def test_records_are_numbered_once_in_a_batch(spark, tmp_path, monkeypatch, log):
    """Results and positions are made from the records that were written: numbering is not done again for each of them."""
    calls, assign = spark.sparkContext.accumulator(0), produce.assign_offsets

    @F.udf("long")
    def counted(offset):
        calls.add(1)
        return offset

    monkeypatch.setattr(produce, "assign_offsets", lambda records, ends=None: assign(records, ends).withColumn("offset", counted.asNondeterministic()("offset")))
    j = job(spark, tmp_path, "t1")
    j.drain(j.start(log(), copies, 3, str(tmp_path / "cp")))
    assert calls.value == 60 and list(map(len, seen(spark, tmp_path).values())) == [60]
