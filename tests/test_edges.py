"""Nulls, ties, repeated rows, empty tables and clashing names in what reads, folds and decodes."""

import pytest
from pyspark.sql import functions as F

from topicflow.functions.codec import decode, encode_int32, int32, utf8
from topicflow.operators import offsets, policy, produce, summary
from topicflow.sources import readers
from topicflow.sources.subscribe import assignment, topics

SCHEMA = "topic string, partition int, offset long, key binary, value binary, timestamp timestamp_ntz, txn_id long, commit string, element string, start long, raw_key int, error_code int, directive string, batch long, source_id string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [("a", 0, 0), ("a", 0, 1), ("a", 0, 1), ("a", 0, 2), (None, 0, 0), ("a", None, 5), (None, None, None), ("a", 0, None)]
    return spark.createDataFrame([(*r, None, b"\xff" if i % 2 else b"1234", None, None, "x", "y", 99, 1, 2, "z", 3, "w") for i, r in enumerate(rows)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def places(df):
    return sorted(((r["topic"], r["partition"], r["offset"]) for r in df.collect()), key=str)


STARTS = "topic string, partition int, start long"


def test_starts(spark, odd, none):
    starts = spark.createDataFrame([("a", 0, 2), ("a", 0, 1), ("a", None, 9), (None, 0, None)], STARTS)
    assert places(readers.from_starts(odd, starts)) == sorted([("a", 0, 1), ("a", 0, 1), ("a", 0, 2), (None, 0, 0), ("a", None, 5)], key=str)
    assert readers.from_starts(odd, starts).columns == odd.columns and readers.from_starts(none, starts).count() == 0
    assert places(readers.plain_source(odd, assignment(("a", 0)))) == sorted([("a", 0, 0), ("a", 0, 1), ("a", 0, 1), ("a", 0, 2), ("a", 0, None)], key=str)
    assert readers.plain_source(odd, topics("a")).count() == 6
    moved = readers.seek(starts, spark.createDataFrame([("a", 0, None), ("b", 1, 4)], STARTS))
    assert ("b", 1, 4) in [tuple(r) for r in moved.collect()]


def test_commits_and_contexts(odd, none):
    made = readers.committable(odd, "g", F.lit(None).cast("string"))
    assert made.count() == odd.count() and made.schema["commit"].dataType.fieldNames() == ["group_id", "topic", "partition", "offset", "metadata"]
    element = readers.map_element(readers.with_offset_context(made), F.lit(None))
    assert element.columns == ["element", "commit"] and element.count() == odd.count()
    assert readers.committable(none, "g").count() == 0


def test_ends_lags_and_metadata(spark, odd, none):
    ends = {(r["topic"], r["partition"]): r["end"] for r in readers.end_offsets(odd).collect()}
    assert ends == {("a", 0): 3, (None, 0): 1, ("a", None): 6, (None, None): None}
    known = spark.createDataFrame([("a", 0, 7)], "topic string, partition int, next_offset long")
    lags = {(r["topic"], r["partition"]): r["lag"] for r in readers.consumer_lag(odd, known).collect()}
    assert lags[("a", 0)] == -4 and lags[(None, 0)] == 1
    for f in (readers.end_offsets, readers.topic_metadata, lambda d: readers.consumer_lag(d, known), lambda d: readers.offsets_for_time(d, F.lit("2024-01-01").cast("timestamp_ntz"))):
        assert f(none).count() == 0
    assert all(r["start"] is None for r in readers.offsets_for_time(odd, F.lit("2024-01-01").cast("timestamp_ntz")).collect())


def test_folds(odd, none):
    commits = readers.committable(odd, "g").select("commit.*", F.lit(1).alias("seq"))
    for _ in range(2):
        folded = {(r["topic"], r["partition"]): (r["offset"], r["batch_size"]) for r in offsets.fold_offsets(commits.repartition(4), F.col("seq")).collect()}
        assert folded == {("a", 0): (2, 5), (None, 0): (0, 1), ("a", None): (5, 1), (None, None): (None, 1)}
    journal = offsets.journal_rows(offsets.fold_offsets(commits, F.col("seq")), F.lit("s"), F.lit(0))
    assert {(r["topic"], r["partition"]): r["next_offset"] for r in offsets.current_positions(journal).collect()}[("a", 0)] == 3
    empty = readers.committable(none, "g").select("commit.*", F.lit(1).alias("seq"))
    assert offsets.fold_offsets(empty, F.col("seq")).count() == 0 and offsets.fold_transaction(empty).count() == 0


def test_decoding_and_policies(odd, none):
    made = decode(odd, value=utf8)
    codes = made.groupBy("error_code").count().collect()
    assert {r["error_code"]: r["count"] for r in codes} == {None: 4, "VALUE_DESERIALIZATION": 4} and made.columns.count("raw_key") == 1
    good, letters = policy.apply_policy(made, {"VALUE_DESERIALIZATION": "resume"})
    assert good.count() == 4 and letters.count() == 4 and "directive" not in good.columns
    assert decode(none, key=int32, value=utf8).count() == 0
    both = decode(odd.withColumn("key", F.lit(b"x")), key=int32, value=utf8)
    assert both.filter("error_code = 'KEY_DESERIALIZATION'").count() == odd.count()
    row = odd.sparkSession.range(1).select(int32(F.lit(b"")), utf8(F.lit(b"")), encode_int32(F.lit(None).cast("int"))).first()
    assert tuple(row) == (None, "", None)


def test_audits_of_odd_rows(odd, none):
    audit = {(r["topic"], r["partition"]): r for r in summary.delivery_audit(odd, odd).collect()}
    assert audit[("a", 0)]["expected"] == 5 and audit[("a", 0)]["repeated"] == 1 and audit[("a", 0)]["gaps"] == 0
    assert summary.delivery_audit(none, none).count() == 0 and summary.delivery_audit(none, odd).agg(F.sum("unknown")).first()[0] == 7


def test_envelopes_without_records(spark):
    empty = spark.createDataFrame([], "envelope_id long, records array<struct<topic:string,partition:int,timestamp:timestamp_ntz,key:binary,value:binary>>, pass_through string")
    sent, done = produce.produce(empty, 3)
    assert sent.count() == 0 and done.count() == 0
