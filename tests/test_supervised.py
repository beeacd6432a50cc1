"""The policy table in a running job: stop, dead letters, and 1-4 then 1-10."""

import pytest
from pyspark.sql import functions as F

from topicflow.functions.codec import decode, int32
from topicflow.operators import offsets
from topicflow.sources import log as logs
from topicflow.streaming import jobs, supervised

from .test_log import numbers

OUT = "topic string, partition int, offset bigint, value int, source_id string, commit_seq bigint"


def ints(bad):
    """Numbers as four bytes; the text of those that are bad."""

    def payload(batch, epoch):
        n = F.col("value").cast("string").cast("int")
        made = F.unhex(F.lpad(F.hex(n), 8, "0"))
        return decode(batch.withColumn("value", F.when(bad(n, epoch), F.lit("text!").cast("binary")).otherwise(made)), value=int32).select("topic", "partition", "offset", "value", "raw_key", "raw_value", "error_code")

    return payload


@pytest.fixture
def ten(spark, tmp_path):
    logs.write_log(numbers(spark, 10), str(tmp_path / "log"))
    run = lambda bad, **more: supervised.supervised(lambda: logs.stream_log(spark, str(tmp_path / "log")), ints(bad), "g", str(tmp_path / "job"), **more)
    out = lambda: [(r["epoch"], r["value"]) for r in supervised.with_epoch(jobs.read_batches(spark, str(tmp_path / "job" / "out"), OUT)).orderBy("epoch", "offset").collect()]
    return run, out


def position(spark, tmp_path):
    return offsets.current_positions(jobs.read_batches(spark, str(tmp_path / "job" / "journal"), jobs.JOURNAL_SCHEMA)).first()["next_offset"]


def test_a_restart_reads_from_the_start_again(spark, tmp_path, ten):
    run, out = ten
    assert run(lambda n, epoch: (n == 5) & F.lit(epoch == 0), overrides={"VALUE_DESERIALIZATION": "restart"}) == 1
    assert out() == [(0, n) for n in range(1, 5)] + [(1, n) for n in range(1, 11)]
    last = supervised.last_epoch(spark, str(tmp_path / "job"), OUT)
    assert sorted(r["value"] for r in last.collect()) == list(range(1, 11)) and position(spark, tmp_path) == 10


def test_restarts_come_to_an_end(spark, tmp_path, ten):
    run, out = ten
    with pytest.raises(supervised.Stopped, match="restart"):
        run(lambda n, epoch: n == 5, overrides={"VALUE_DESERIALIZATION": "restart"}, retries=2)
    assert out() == [(e, n) for e in range(3) for n in range(1, 5)]


def test_a_stop_keeps_what_came_before(spark, tmp_path, ten):
    run, out = ten
    with pytest.raises(supervised.Stopped, match="VALUE_DESERIALIZATION, stop"):
        run(lambda n, epoch: n.isin(5, 8))
    assert out() == [(0, n) for n in range(1, 5)] and position(spark, tmp_path) == 4
    assert run(lambda n, epoch: n == 8, overrides={"VALUE_DESERIALIZATION": "resume"}) == 0  # the same batch again
    assert out() == [(0, n) for n in range(1, 11) if n != 8] and position(spark, tmp_path) == 10


def test_dead_letters_hold_the_bytes(spark, tmp_path, ten):
    run, out = ten
    run(lambda n, epoch: n % 3 == 0, overrides={"VALUE_DESERIALIZATION": "resume"})
    assert out() == [(0, n) for n in range(1, 11) if n % 3]
    letters = jobs.read_batches(spark, str(tmp_path / "job" / "letters"), supervised.LETTER_SCHEMA).orderBy("offset").collect()
    assert [(r["offset"], bytes(r["raw_value"]), r["error_code"], r["directive"], r["commit_seq"]) for r in letters] == [(o, b"text!", "VALUE_DESERIALIZATION", "resume", 0) for o in (2, 5, 8)]


def test_other_errors_are_raised_and_the_epoch_goes_on(spark, tmp_path, ten):
    run, out = ten

    def broken(n, epoch):
        raise RuntimeError("not a record's fault")

    with pytest.raises(Exception, match="not a record's fault"):
        run(broken)
    assert run(lambda n, epoch: F.lit(False)) == 0 and len(out()) == 10
