"""Registered queries on transactions and on jobs under the policy table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codec import decode, int32
from ..operators import offsets, policy
from ..sources import log as logs
from ..sources import readers
from ..streaming import jobs, supervised, transactions
from .queries import _envelopes_of_copies, _Job, _payloads, streaming

_RECORDS = "topic string, partition int, offset bigint, key binary, source_id string, commit_seq bigint, txn_id bigint"
_DONE = "kind string, error_code string, pass_through struct<topic: string, partition: int, offset: bigint>, source_id string, commit_seq bigint, txn_id bigint"
#: An interval that does not end while the job runs: all its batches are one transaction.
_LONG = 10**9


def _transaction(job: _Job, name: str, commit: bool = True, interval: int = _LONG) -> str:
    j = transactions.TransactionalJob(job.spark, name, "g1", job.path("tx"), interval)
    query = j.start(job.stream, _envelopes_of_copies, 3, job.path(f"checkpoint-{name}"))
    j.drain(query) if commit else jobs.drain(query)
    return job.path("tx")


_SUMS = """select 'copy-' || topic as topic, cast((('0x' || substr(md5(k), 1, 8))::bigint) % 3 as int) as part, count(*) as n, count(*) as distinct_offsets,
  0 as lo, count(*) - 1 as hi from log where off % 11 <> 5 group by 1, 2"""


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("topic", F.col("partition").alias("part")).agg(F.count("*").alias("n"), F.count_distinct("offset").alias("distinct_offsets"), F.min("offset").cast("int").alias("lo"), F.max("offset").alias("hi"))


@streaming(_SUMS)
def transaction_records(job: _Job) -> DataFrame:
    """Several micro-batches in one transaction: all records are there once it is committed."""
    return _sums(transactions.visible_records(job.spark, _transaction(job, "t1"), _RECORDS))


@streaming("select topic, part, off, case when off % 11 = 5 then 'refused' else 'single' end as kind, case when off % 11 = 5 then 'INVALID_PARTITION' end as error_code from log")
def transaction_results(job: _Job) -> DataFrame:
    """A transaction for each micro-batch, with a result for each envelope."""
    rows = transactions.visible_results(job.spark, _transaction(job, "t1", interval=0), _DONE)
    return rows.select("pass_through.topic", F.col("pass_through.partition").alias("part"), F.col("pass_through.offset").alias("off"), "kind", "error_code")


@streaming("select 'g1' as group_id, topic, part, max(off) + 1 as next_offset from log group by topic, part")
def transaction_positions(job: _Job) -> DataFrame:
    return transactions.positions(job.spark, _transaction(job, "t1", interval=0)).drop("metadata").withColumnRenamed("partition", "part")


@streaming(_SUMS)
def last_stable_offset(job: _Job) -> DataFrame:
    """Of three jobs that append one after the other the second has not ended: what the third has committed is not seen yet."""
    for name in ("t1", "t2", "t3"):
        root = _transaction(job, name, commit=name != "t2")
    return _sums(transactions.visible_records(job.spark, root, _RECORDS))


@streaming("select distinct topic, part, 0 as behind from log")
def stable_lag(job: _Job) -> DataFrame:
    """How far each partition's committed position is behind its end: nothing, after a transaction has ended."""
    known = transactions.positions(job.spark, _transaction(job, "t1"))
    return readers.consumer_lag(job.log, known).select("topic", F.col("partition").alias("part"), F.col("lag").alias("behind"))


# -- under the policy table --------------------------------------------------------------------


def _supervised(job: _Job, decoded, **more) -> str:
    """One micro-batch for all files: what is put out before a failure does not depend on their order."""
    supervised.supervised(lambda: logs.stream_log(job.spark, job.path("log")), decoded, "g1", job.path("supervised"), **more)
    return job.path("supervised")


def _numbers(bad):
    """The offset as four bytes; text instead where it is bad."""

    def decoded(batch: DataFrame, epoch: int) -> DataFrame:
        rows = batch.withColumn("event_id", F.col("offset") * 10 + F.when(bad(epoch), 5).otherwise(0))
        return decode(_payloads(rows), value=int32).drop("event_id")

    return decoded


_OUT = "topic string, partition int, offset bigint, value int, source_id string, commit_seq bigint"


@streaming("select topic, part, off, 0 as epoch from log where off < 40 union all select topic, part, off, 1 from log")
def supervised_restart(job: _Job) -> DataFrame:
    """Record 40 of each partition fails once: what is before it comes out, then all from the start."""
    failing = _numbers(lambda epoch: (F.col("offset") == 40) & F.lit(epoch == 0))
    root = _supervised(job, failing, overrides={"VALUE_DESERIALIZATION": policy.RESTART})
    rows = supervised.with_epoch(jobs.read_batches(job.spark, f"{root}/out", _OUT))
    return rows.select("topic", F.col("partition").alias("part"), F.col("offset").alias("off"), "epoch")


@streaming("select topic, part, off, 'bad-' || (off * 10 + 5) as raw, 'VALUE_DESERIALIZATION' as error_code, 'resume' as directive from log where off % 7 = 3")
def supervised_letters(job: _Job) -> DataFrame:
    """Bad records go to the dead letters, bytes and all, and the job goes on."""
    root = _supervised(job, _numbers(lambda epoch: F.col("offset") % 7 == 3), overrides={"VALUE_DESERIALIZATION": policy.RESUME})
    rows = jobs.read_batches(job.spark, f"{root}/letters", supervised.LETTER_SCHEMA)
    return rows.select("topic", F.col("partition").alias("part"), F.col("offset").alias("off"), F.col("raw_value").cast("string").alias("raw"), "error_code", "directive")


@streaming("select 'g1' as group_id, topic, part, least(max(off) + 1, 23) as next_offset from log group by topic, part")
def supervised_stop(job: _Job) -> DataFrame:
    """Record 23 of each partition stops the job: the group stands before it."""
    try:
        _supervised(job, _numbers(lambda epoch: F.col("offset") == 23))
    except supervised.Stopped:
        pass
    journal = jobs.read_batches(job.spark, job.path("supervised/journal"), jobs.JOURNAL_SCHEMA)
    return offsets.current_positions(journal).drop("metadata").withColumnRenamed("partition", "part")
