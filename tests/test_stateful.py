"""Stateful jobs over several micro-batches and a restart, beside the same over all records at once."""

import os
import random

import pytest
from pyspark.sql import functions as F

from topicflow.operators import offsets, partitioned
from topicflow.sources import log as logs
from topicflow.sources import readers
from topicflow.streaming import jobs, stateful

from .test_log import numbers

SCHEMA = "topic string, partition int, offset long, value string, at timestamp_ntz, bytes binary, x double"


def files(spark, tmp_path, batches):
    """One file a micro-batch, in turn, of (topic, partition, offset) rows."""
    folder = tmp_path / "in"
    os.makedirs(folder, exist_ok=True)
    for rows in batches:
        i = len(os.listdir(folder))
        df = spark.createDataFrame([(t, p, o) for t, p, o in rows], "topic string, partition int, offset long")
        whole = df.select("topic", "partition", "offset", F.concat(F.lit("v"), F.col("offset").cast("string")).alias("value"), F.lit("2024-01-02 03:04:05.123456").cast("timestamp_ntz").alias("at"), F.col("topic").cast("binary").alias("bytes"), F.when(F.col("offset") % 2 == 0, F.lit(float("nan"))).alias("x"))
        staged = str(tmp_path / f"s{i}")
        whole.coalesce(1).write.parquet(staged)
        part = next(f for f in os.listdir(staged) if f.endswith(".parquet"))
        os.rename(f"{staged}/{part}", folder / f"{i:03d}.parquet")
        os.utime(folder / f"{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_in_order_equals_the_batch_form(spark, tmp_path):
    """Five micro-batches, two of them after a restart, with records that come early, late and twice."""
    rng = random.Random(1)
    rows = [("a", 0, o) for o in range(60)] + [("a", None, o) for o in range(25)] + [("b", 1, o) for o in range(7)] + [("c", 2, o) for o in range(40)]
    late = sorted(rows, key=lambda r: r[2] + rng.uniform(-12, 12))
    batches = [late[i::5] if i == 9 else late[i * len(late) // 5 : (i + 1) * len(late) // 5] for i in range(5)]
    batches[2] = batches[2] + batches[1][:9] + batches[2][:4]
    rng.shuffle(batches[3])
    marker, stop = F.col("offset") % 9 == 8, F.col("offset") == 21

    def run(stream):
        jobs.drain(stateful.write_in_order(stream, str(tmp_path / "out"), str(tmp_path / "cp"), chunk=6, marker=marker, stop=stop))

    run(files(spark, tmp_path, batches[:3]))
    run(files(spark, tmp_path, batches[3:]))
    found = spark.read.parquet(str(tmp_path / "out"))
    log = spark.createDataFrame(rows, "topic string, partition int, offset long")
    want = partitioned.segments(partitioned.chunks(partitioned.running_count(log), 6), marker)
    inside = partitioned.take_while(log, ~stop).withColumn("inside", F.lit(True))
    ends = partitioned.take_while(log, ~stop, inclusive=True).filter(stop)
    cols = ("topic", "partition", "offset", "n", "chunk", "segment")
    key = lambda r: (r["topic"], str(r["partition"]), r["offset"])
    assert sorted([tuple(r) for r in found.select(*cols).collect()], key=str) == sorted([tuple(r) for r in want.select(*cols).collect()], key=str)
    assert {key(r) for r in found.filter("inside").collect()} == {key(r) for r in inside.collect()}
    assert {key(r) for r in found.filter("ends").collect()} == {key(r) for r in ends.collect()}
    one = found.filter("topic = 'a' and partition = 0 and offset in (4, 5)").orderBy("offset").collect()
    assert [(r["value"], str(r["at"]), bytes(r["bytes"]), str(r["x"])) for r in one] == [("v4", "2024-01-02 03:04:05.123456", b"a", "nan"), ("v5", "2024-01-02 03:04:05.123456", b"a", "None")]


def test_records_wait_for_their_predecessors(spark, tmp_path):
    run = lambda s: jobs.drain(stateful.write_in_order(s, str(tmp_path / "out"), str(tmp_path / "cp"), first=F.lit(5)))
    out = lambda: sorted(r["offset"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    run(files(spark, tmp_path, [[("t", 0, 3), ("t", 0, 5), ("t", 0, 7)]]))
    assert out() == [5]
    run(files(spark, tmp_path, [[("t", 0, 6), ("t", 0, None)]]))
    assert out() == [5, 6, 7]


def commits(stream):
    return readers.committable(stream, "g", F.concat(F.lit("m"), F.col("offset").cast("string")))


def test_batches_close_by_count_or_clock_over_a_crash(spark, tmp_path, monkeypatch):
    path = lambda n: str(tmp_path / n)
    batches = [[("t", 0, o) for o in range(25)], [("t", 0, o) for o in range(25, 37)], [("u", 1, 0)]]
    stream = files(spark, tmp_path, batches)
    read = lambda: jobs.read_batches(spark, path("batches"), stateful.BATCH_SCHEMA)
    closed = lambda: os.path.exists(path("batches")) and read().agg(F.sum("batch_size")).first()[0] == 38
    put, failed = stateful._put, []

    def once(df, where, source, number):
        if where == path("batches") and not failed:
            failed.append(number)
            raise RuntimeError("injected")  # after the journal, before the batches
        put(df, where, source, number)

    monkeypatch.setattr(stateful, "_put", once)
    start = lambda wait: stateful.commit_in_batches(commits(stream), path("journal"), path("batches"), path("cp"), 10, wait, interval="200 milliseconds")
    with pytest.raises(Exception, match="injected"):
        stateful.run_until(start(1500), closed)
    stateful.run_until(start(1500), closed)
    rows = [(r["topic"], r["batch"], r["first_offset"], r["offset"], r["metadata"], r["batch_size"], r["closed_by"]) for r in read().orderBy("topic", "batch").collect()]
    by_count = [("t", i, 10 * i, 10 * i + 9, f"m{10 * i + 9}", 10, "count") for i in range(3)]
    late = rows[3:-1]  # where the clock came between the first two files or not, no commit is lost or repeated
    assert rows[:2] == by_count[:2] and rows[-1] == ("u", 0, 0, 0, "m0", 1, "clock") and late[-1][6] == "clock"
    spans = [(a, b) for t, _, a, b, *_ in rows if t == "t"]
    assert [a for a, _ in spans] == [0, *[b + 1 for _, b in spans[:-1]]] and spans[-1][1] == 36
    journal = jobs.read_batches(spark, path("journal"), jobs.JOURNAL_SCHEMA)
    assert {(r["topic"], r["next_offset"], r["metadata"]) for r in offsets.current_positions(journal).collect()} == {("t", 37, "m36"), ("u", 1, "m0")}
    assert journal.agg(F.sum("batch_size")).first()[0] == 38


def test_batches_of_one_and_refusals(spark, tmp_path):
    with pytest.raises(ValueError):
        stateful.closed_batches(spark.createDataFrame([], "group_id string, topic string, partition int, offset long, metadata string"), 0, 10)


def test_partitions_are_assigned_revoked_and_the_job_stops(spark, tmp_path):
    out = str(tmp_path / "out")
    logs.write_log(numbers(spark, 30, partitions=3), str(tmp_path / "log"))
    read = lambda: jobs.read_batches(spark, out, stateful.EVENT_SCHEMA)
    revoked = lambda n: os.path.exists(out) and read().filter("event = 'revoke'").count() == n
    start = lambda: stateful.partition_events(logs.stream_log(spark, str(tmp_path / "log")), 1000, out, str(tmp_path / "cp"), interval="200 milliseconds")
    stateful.stop_with_event(start(), spark, out, lambda: revoked(3))
    more = numbers(spark, 33, partitions=3).filter("offset = 10 and partition = 1")
    logs.write_log(more, str(tmp_path / "log"))
    stateful.stop_with_event(start(), spark, out, lambda: revoked(4))
    events = [(r["partition"], r["event"], r["times"], r["next_offset"]) for r in read().filter("partition = 1").orderBy("commit_seq").collect()]
    assert events == [(1, "assign", 1, 0), (1, "revoke", 1, 10), (1, "assign", 2, 10), (1, "revoke", 2, 11)]
    assert read().filter("event = 'stop'").count() == 2 and read().filter("partition = 0").count() == 2
    order = [r["event"] for r in read().orderBy("commit_seq").collect()]
    assert order[-1] == "stop"


def test_the_sessions_state_store_comes_back(spark):
    before = spark.conf.get(stateful._PROVIDER)
    with stateful.rocksdb(spark):
        assert "RocksDB" in spark.conf.get(stateful._PROVIDER)
    assert spark.conf.get(stateful._PROVIDER) == before


def test_sets_of_offsets():
    import numpy as np

    rng = random.Random(4)
    for _ in range(200):
        a, b = ({rng.randint(0, 25) for _ in range(rng.randint(0, 20))} for _ in range(2))
        x, y = (stateful.Offsets.of(np.array(sorted(s), np.int64)) for s in (a, b))
        both = x | y
        members = lambda s: {o for i, j in zip(s.starts.tolist(), s.ends.tolist(), strict=True) for o in range(i, j)}
        assert members(x) == a and members(both) == a | b and len(both) == len(a | b) and x.shared(y) == len(a & b)
        assert all(j < i for j, i in zip(both.ends[:-1], both.starts[1:], strict=True))
        assert [o in a for o in range(-1, 28)] == x.has(np.arange(-1, 28)).tolist()


def test_a_running_audit_equals_the_batch_form(spark, tmp_path):
    """Several batches of both sides, out of order, with a restart; records come late, twice, thrice or never."""
    from topicflow.operators import summary

    rng = random.Random(6)
    want = [("t", p, o) for p in (0, None) for o in range(40)]
    came = [k for k in [*want, ("t", 0, 77), ("u", 1, 0)] for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))]
    rng.shuffle(came)
    (tmp_path / "w").mkdir(), (tmp_path / "c").mkdir()
    cut = lambda rows, i: rows[i * len(rows) // 4 : (i + 1) * len(rows) // 4]
    read = lambda: stateful.last_audit(jobs.read_batches(spark, str(tmp_path / "out"), stateful.AUDIT_SCHEMA))
    for part in ((0, 1), (2, 3)):
        log, out = (files(spark, tmp_path / d, [cut(rows, i) for i in part]) for d, rows in (("w", want), ("c", came)))
        jobs.drain(stateful.running_audit(log, out, str(tmp_path / "out"), str(tmp_path / "cp")))
    frame = lambda rows: spark.createDataFrame(rows, "topic string, partition int, offset long")
    batch = summary.delivery_audit(frame(want), frame(came))
    assert sorted(map(str, read().collect())) == sorted(map(str, batch.select(*read().columns).collect()))


def test_state_has_no_more_parts_than_cores(spark, tmp_path):
    """Each part is opened and committed in every micro-batch; the session's own number comes back."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        jobs.drain(stateful.write_in_order(files(spark, tmp_path, [[("t", 0, 0), ("t", 1, 0)]]), str(tmp_path / "out"), str(tmp_path / "cp")))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len([d for d in os.listdir(tmp_path / "cp" / "state" / "0") if d.isdigit()]) == spark.sparkContext.defaultParallelism
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_runs_are_kept_as_one_value():
    import numpy as np

    for s in ([], [4], [0, 1, 2, 9, 11, 12]):
        kept = stateful.Offsets.parse(stateful.Offsets.of(np.array(s, np.int64)).bytes())
        assert [(a, b) for a, b in zip(kept.starts.tolist(), kept.ends.tolist(), strict=True)] == {0: [], 1: [(4, 5)], 6: [(0, 3), (9, 10), (11, 13)]}[len(s)]
