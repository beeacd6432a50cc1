"""The log as a data source: offsets of many tasks, appends that fail, repeat or meet, and bounded intake."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from topicflow.sources import topiclog
from topicflow.sources.subscribe import assignment_from, topics
from topicflow.streaming import jobs

from .test_log import numbers


@pytest.fixture(scope="module", autouse=True)
def known(spark):
    topiclog.register(spark)


def append(df, path):
    df.write.format("topiclog").option("path", path).mode("append").save()


def load(spark, path, **options):
    return spark.read.format("topiclog").options(path=path, **options).load()


def dense(df):
    """Offsets of each partition from 0 without a hole."""
    rows = df.groupBy("topic", "partition").agg(F.sort_array(F.collect_list("offset")).alias("o")).collect()
    return all(r["o"] == list(range(len(r["o"]))) for r in rows)


def test_many_tasks_append_to_one_partition(spark, tmp_path):
    path = str(tmp_path / "log")
    append(numbers(spark, 1000).repartition(8), path)
    append(numbers(spark, 500, partitions=3).drop("timestamp", "txn_id", "offset").repartition(4), path)
    found = load(spark, path)
    assert found.count() == 1500 and dense(found)
    assert found.filter("partition = 0").count() == 1167
    assert len(glob.glob(f"{path}/data/*.parquet")) == 12
    values = lambda df: sorted((r["partition"], r["offset"], bytes(r["value"])) for r in df.collect())
    assert values(found) == values(topiclog.log_table(spark, path))
    done = topiclog.appended(spark, path).orderBy("number", "partition").collect()
    assert [(r["number"], r["partition"], r["first"], r["next"]) for r in done] == [(0, 0, 0, 1000), (1, 0, 1000, 1167), (1, 1, 0, 167), (1, 2, 0, 166)]


def test_a_tasks_records_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "log")
    append(numbers(spark, 30_000, partitions=2).repartitionByRange(4, "partition", "offset").sortWithinPartitions("partition", "offset"), path)
    wrong = load(spark, path).filter(F.col("value").cast("string").cast("long") != F.col("offset") * 2 + F.col("partition") + 1)
    assert wrong.count() == 0


def test_tables_scan_only_what_is_asked_for(spark, tmp_path):
    path = str(tmp_path / "log")
    for t in ("a", "b", "c"):
        append(numbers(spark, 50, topic=t, partitions=2), path)
    some = topiclog.log_table(spark, path, topics("b"))
    assert len(some.inputFiles()) < len(topiclog.log_table(spark, path).inputFiles())
    assert some.select("topic").distinct().collect()[0][0] == "b" and some.count() == 50
    ranged = topiclog.log_table(spark, path, assignment_from(("c", 1, 20)))
    assert sorted(r["offset"] for r in ranged.collect()) == list(range(20, 25))
    text = ranged.select("offset")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and "value" not in text.split("ReadSchema")[1]
    assert load(spark, path, topics="a,c", startingOffsets='{"a/0": 24, "c/1": 25}').count() == 1 + 25 + 25
    assert load(spark, path, startingOffsets="latest").count() == 0
    assert {r["topic"] for r in load(spark, path, topicPattern="^[bc]").select("topic").distinct().collect()} == {"b", "c"}
    with pytest.raises(Exception, match="not both"):
        load(spark, path, topics="a", topicPattern="b").count()


def test_an_empty_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert load(spark, path).count() == 0 and topiclog.log_table(spark, path).count() == 0 and topiclog.appended(spark, path).count() == 0
    append(numbers(spark, 0), path)
    assert topiclog.Store(path).last() == -1


@pytest.mark.parametrize("column, reason", [("topic", "INVALID_TOPIC"), ("partition", "INVALID_PARTITION")])
def test_a_failed_append_leaves_no_trace(spark, tmp_path, column, reason):
    path = str(tmp_path / "log")
    bad = numbers(spark, 100).repartition(4).withColumn(column, F.when(F.col("value") != b"77", F.col(column)))
    with pytest.raises(Exception, match=reason):
        append(bad, path)
    assert load(spark, path).count() == 0
    topiclog.Store(path).sweep()
    assert not glob.glob(f"{path}/data/*")
    with pytest.raises(Exception, match="INVALID_PARTITION"):
        append(numbers(spark, 3).withColumn("partition", F.lit(-1)), path)
    append(numbers(spark, 5), path)
    open(f"{path}/data/orphan.parquet", "w").close()
    assert topiclog.Store(path).sweep() == ["orphan.parquet"] and load(spark, path).count() == 5


def test_snapshots_hold_all_before_them(tmp_path, monkeypatch):
    monkeypatch.setattr(topiclog, "SNAPSHOT", 4)
    store = topiclog.Store(str(tmp_path / "log"))
    for i in range(11):
        store.append([(f"f{i}", [("t", i % 2, 10)])])
    assert sorted(os.listdir(tmp_path / "log" / "snapshots")) == ["00000000000000000003.parquet", "00000000000000000007.parquet"]
    want = [("t", i % 2, i // 2 * 10, 10, f"f{i}") for i in range(11)]
    as_rows = lambda s: [(x.topic, x.partition, x.base, x.count, x.file) for x in s]
    assert as_rows(store.segments(10)) == want and as_rows(store.segments(8)) == want[:9]
    os.unlink(tmp_path / "log" / "snapshots" / "00000000000000000007.parquet")
    assert as_rows(store.segments(10)) == want
    assert store.last() == 10 and store.last(3) == 10 and store.last(10) == 10


def test_two_writers_take_different_numbers(tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    one, two = topiclog.Store(path), topiclog.Store(path)
    one.append([("a", [("t", 0, 5)])])
    late = iter([0])  # the second writer has looked before the first one wrote
    monkeypatch.setattr(two, "last", lambda known=-1: next(late, None) if known == -1 else topiclog.Store.last(two, known))
    one.append([("b", [("t", 0, 7)])])
    assert two.append([("c", [("t", 0, 2)])]) == 2
    assert [(s.file, s.base) for s in one.segments(2)] == [("a", 0), ("b", 5), ("c", 12)]


def test_a_batch_is_published_once(tmp_path):
    store = topiclog.Store(str(tmp_path / "log"))
    assert store.append([("a", [("t", 0, 5)])], "w", 0) == 0
    assert store.append([("b", [("t", 0, 5)])], "w", 0) is None and store.append([("b", [("t", 0, 5)])], "other", 0) == 1
    assert store.append([], "w", 1) == 2 and store.manifest(2).ends == {("t", 0): 10}


def test_plans_split_and_fill_tasks():
    s = [topiclog.Segment("t", 0, 0, 100, "a"), topiclog.Segment("t", 0, 100, 5, "b"), topiclog.Segment("t", 1, 0, 7, "b")]
    tasks = topiclog.plan(s, {("t", 0): 10}, {("t", 0): 105, ("t", 1): 6}, 40)
    assert [[(p.file, lo, hi) for p, lo, hi in t.pieces] for t in tasks] == [[("a", 10, 50)], [("a", 50, 90)], [("a", 90, 100), ("b", 100, 105), ("b", 0, 6)]]
    assert topiclog.plan(s, {}, {}, 40) == []


def test_options_are_checked(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(Exception, match="path"):
        spark.read.format("topiclog").load().count()
    with pytest.raises(Exception, match="positions"):
        jobs.drain(spark.readStream.format("topiclog").options(path=path, maxRecordsPerPartition=5).load().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start())
    with pytest.raises(Exception, match="appended to"):
        numbers(spark, 3).write.format("topiclog").option("path", path).mode("overwrite").save()


def copy(spark, tmp_path, **options):
    """Copies one log to another as a stream; the second time it goes on from its checkpoint."""
    source = spark.readStream.format("topiclog").options(path=str(tmp_path / "log"), **options).load()
    writer = source.writeStream.format("topiclog").options(path=str(tmp_path / "copy"), writer="copier", checkpointLocation=str(tmp_path / "cp"))
    jobs.drain(writer.trigger(availableNow=True).start())


def test_a_stream_appends_once_whatever_is_repeated(spark, tmp_path):
    append(numbers(spark, 200, partitions=2).repartition(3), str(tmp_path / "log"))
    copy(spark, tmp_path)
    append(numbers(spark, 100, partitions=2).repartition(3), str(tmp_path / "log"))
    copy(spark, tmp_path)
    copied = lambda: load(spark, str(tmp_path / "copy"))
    assert copied().count() == 300 and dense(copied())
    last = max(int(f) for f in os.listdir(tmp_path / "cp" / "commits") if f.isdigit())
    for f in (f"{last}", f".{last}.crc"):  # as if the driver had died between the sink's commit and its own
        if (tmp_path / "cp" / "commits" / f).exists():
            os.unlink(tmp_path / "cp" / "commits" / f)
    copy(spark, tmp_path)
    assert copied().count() == 300 and dense(copied())
    append(numbers(spark, 50, partitions=2), str(tmp_path / "log"))
    copy(spark, tmp_path)
    assert copied().count() == 350 and dense(copied())
    named = topiclog.Store(str(tmp_path / "copy"))
    assert len(os.listdir(tmp_path / "copy" / "data")) == len({s.file for s in named.segments(named.last())})  # what was repeated is gone


def test_no_batch_takes_more_than_its_bound(spark, tmp_path):
    path = str(tmp_path / "log")
    append(numbers(spark, 95, partitions=2).filter("partition = 0 or offset < 12").repartition(3), path)
    seen = []

    def run(seconds):
        source = spark.readStream.format("topiclog").options(path=path, maxRecordsPerPartition=10, positions=str(tmp_path / "positions")).load()
        each = lambda b, i: seen.append((i, sorted((r["partition"], r["offset"]) for r in b.collect())))
        q = source.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="0 seconds").start()
        until = time.time() + seconds
        while time.time() < until and len(seen) < 3:
            time.sleep(0.05)
        if len(seen) >= 3 and seconds > 60:
            jobs.stop_after_all(q)
        else:
            q.stop()

    run(60)  # stopped somewhere in the middle
    run(61)
    append(numbers(spark, 4, partitions=2), path)
    run(61)
    batches = dict(seen)  # a batch that was stopped is read again
    rows = [r for b in batches.values() for r in b]
    assert len(rows) == len(set(rows)) == load(spark, path).count()
    for b in batches.values():
        for p in (0, 1):
            offsets = [o for q, o in b if q == p]
            assert len(offsets) <= 10 and offsets == list(range(min(offsets, default=0), min(offsets, default=0) + len(offsets)))


def test_positions_as_starting_offsets(spark):
    rows = spark.createDataFrame([("a/b", 0, 7), ("a/b", 0, 5), ("a", 1, None), (None, 1, 2)], "topic string, partition int, next_offset long")
    assert topiclog.starting_offsets(rows) == '{"a/b/0": 5}' and topiclog.starting_offsets(rows.limit(0)) == "{}"
    assert topiclog._Options({"path": "x", "startingoffsets": topiclog.starting_offsets(rows)}).starts({}) == {("a/b", 0): 5}


def test_waiting_batches_are_taken_together_and_numbered(spark, tmp_path):
    """A backlog of twenty bounded batches takes six micro-batches, one of them repeated after a stop; each is as bounded as before."""
    path = str(tmp_path / "log")
    rows = numbers(spark, 300, partitions=2)  # 150 records of each partition
    append(rows.filter("partition = 0 or offset < 45").repartitionByRange(3, "partition", "offset"), path)
    seen = {}

    def run(most):
        options = {"path": path, "maxRecordsPerPartition": 10, "maxBatchesAtOnce": 4, "numberBatches": True, "positions": str(tmp_path / "positions")}
        def each(b, i):
            if len(seen) >= most:
                raise RuntimeError("stopped")
            seen[i] = [(r["partition"], r["offset"], r["batch"]) for r in b.collect()]
        writer = spark.readStream.format("topiclog").options(**options).load().writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "cp"))
        jobs.stop_after_all(writer.trigger(processingTime="0 seconds").start())

    with pytest.raises(Exception, match="stopped"):
        run(3)  # fails in the middle of its work
    run(99)
    assert [len({b for _, _, b in seen[i]}) for i in sorted(seen)] == [1, 1, 2, 4, 4, 3]
    append(spark.createDataFrame([(1, "x")] * 12, "partition int, value string").selectExpr("'t' as topic", "partition", "cast(value as binary) as value"), path)
    run(99)
    found = [r for b in seen.values() for r in b]
    assert len({r[:2] for r in found}) == len(found) == load(spark, path).count()
    late = {o - 45: b for p, o, b in found if p == 1 and o >= 45}
    assert all(b == o // 10 for p, o, b in found if p == 0 or o < 45) and late == {o: 15 + o // 10 for o in range(12)}


def test_batches_at_once_need_bounds(spark, tmp_path):
    for options in ({"maxBatchesAtOnce": 2}, {"numberBatches": "true"}, {"maxRecordsPerPartition": 5, "positions": "p", "maxBatchesAtOnce": 0}):
        with pytest.raises(ValueError, match="maxBatchesAtOnce"):
            topiclog._Options({"path": "x"} | {k.lower(): v for k, v in options.items()})
