"""Transactions over several micro-batches: records, results and positions become visible with one marker.

A coordinator's table has one row for each micro-batch, which says to what transaction it
belongs, and one marker for each transaction that has ended. The marker of a committed one holds its
positions, so there is no moment at which one is visible without the other. Offsets of records
are given when they are written, so a log may hold records of open and aborted transactions:
``readers.stable_records`` passes the latter over and never passes the former.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.offsets import fold_transaction
from ..operators.produce import results as results_of
from ..operators.produce import sent_records
from ..sources.readers import committable, committed_records, stable_records
from .jobs import Hook, Step, _children, _exists, _folder, _held, _put, _read_back, _start, _tagged, drain, ends_before, put_ends, read_batches
from .lease import Lease

#: A micro-batch's place: the transaction it is part of, the first batch of that, and when it was opened (milliseconds).
_PLACE = "source_id string, commit_seq bigint, txn_id bigint, first_batch bigint, opened_at bigint"
#: The end of a transaction: a row for each position that it commits, or one without a topic.
MARKER_SCHEMA = "source_id string, txn_id bigint, state string, epoch bigint, ended_at bigint, group_id string, topic string, partition int, next_offset bigint, metadata string, batch_size bigint"


class TransactionalJob:
    """Consume, transform, produce and commit in transactions of ``commit_interval_ms``.

    A transaction takes in every micro-batch that begins before the interval is over, and ends with
    the first one after that; ``drain`` ends the last one. A job that was stopped or
    failed inside a transaction goes on with it: what its batches have written stays, as Spark
    has them behind it, and a batch that is repeated overwrites itself. The job
    takes a lease on its transactional id, and an earlier one of the same id fails at its next step.
    """

    def __init__(self, spark: SparkSession, transactional_id: str, group_id: str, root: str, commit_interval_ms: int = 100, hook: Hook | None = None, clock: Callable[[], int] = lambda: int(time.time() * 1000)):
        if not transactional_id:
            raise ValueError("a transactional id must not be empty")
        self.spark, self.id, self.group, self.root = spark, transactional_id, group_id, root
        self.interval, self.hook, self.clock = commit_interval_ms, hook or (lambda name, batch: None), clock
        self.lease = Lease(spark, f"{root}/leases", transactional_id)

    def path(self, name: str) -> str:
        """out, results, positions, batches (of the coordinator), markers."""
        return f"{self.root}/{name}"

    def _place(self, batch: int) -> tuple[int, int, int] | None:
        """Transaction, its first batch, and when it was opened."""
        where = _folder(self.path("batches"), self.id, batch)
        if batch < 0 or not _exists(self.spark, where):
            return None
        r = self.spark.read.schema(_PLACE).parquet(where).first()
        return r["txn_id"], r["first_batch"], r["opened_at"]

    def ended(self, txn: int) -> bool:
        return _exists(self.spark, _folder(self.path("markers"), self.id, txn))

    def _enter(self, batch: int) -> tuple[int, int, int]:
        """The batch's place, which stays when it is repeated: in the open transaction, or a new one."""
        place = self._place(batch)
        if place is None:
            before = self._place(batch - 1)
            if before is not None and not self.ended(before[0]):
                place = before
            else:
                place = (batch if before is None else before[0] + 1, batch, self.clock())
            row = self.spark.range(1).select(F.lit(self.id).alias("source_id"), *[F.lit(v).cast("long").alias(c) for c, v in zip(("commit_seq", "txn_id", "first_batch", "opened_at"), (batch, *place), strict=True)])
            _put(row.coalesce(1), self.path("batches"), self.id, batch)
        return place

    def end(self, txn: int, first: int, last: int, state: str) -> None:
        """Ends a transaction of the batches from first to last: as committed, with the highest position of each partition, or as aborted."""
        self.lease.check()
        tags = [F.lit(self.id).alias("source_id"), F.lit(txn).cast("long").alias("txn_id"), F.lit(state).alias("state"), F.lit(self.lease.epoch).cast("long").alias("epoch"), F.lit(self.clock()).cast("long").alias("ended_at")]
        names = ("group_id", "topic", "partition", "next_offset", "metadata", "batch_size")
        folders = [f for f in (_folder(self.path("positions"), self.id, b) for b in range(first, last + 1)) if _exists(self.spark, f)]
        rows = self.spark.range(1).select(*tags, *[F.lit(None).alias(n) for n in names])
        if state == "committed" and folders:
            commits = self.spark.read.schema("group_id string, topic string, partition int, offset bigint, metadata string").parquet(*folders)
            made = fold_transaction(commits).join(commits.groupBy("group_id", "topic", "partition").agg(F.max_by("metadata", "offset").alias("metadata")), ["group_id", "topic", "partition"])
            rows = made.select(*tags, *names).unionByName(rows)
        columns = [F.col(c.split()[0]).cast(c.split()[1]) for c in MARKER_SCHEMA.split(", ")]
        _put(rows.select(*columns).coalesce(1), self.path("markers"), self.id, txn)

    def start(self, stream: DataFrame, envelopes: Step, partitions: int, checkpoint: str, once: bool = True, interval: str = "100 milliseconds") -> StreamingQuery:
        """``envelopes`` makes (envelope_id, records, pass_through) of a batch; pass_through is ``commit``."""

        def each(batch: DataFrame, number: int, lease: Lease) -> None:
            self.lease.check()
            txn, first, opened = self._enter(number)
            tagged = lambda df: _tagged(df, self.id, number).withColumn("txn_id", F.lit(txn).cast("long"))
            with _held(batch) as rows:
                self.hook("output", number)
                before = ends_before(self.spark, self.path("out"), self.id, number)
                made = envelopes(committable(rows, self.group))
                _put(tagged(sent_records(made, partitions, before)), self.path("out"), self.id, number)
                put_ends(self.spark, before, self.path("out"), self.id, number)
                done = results_of(made, _read_back(self.spark, self.path("out"), self.id, number))
                _put(tagged(done), self.path("results"), self.id, number)
                self.hook("positions", number)
                done = _read_back(self.spark, self.path("results"), self.id, number)
                _put(done.select("pass_through.*"), self.path("positions"), self.id, number)
            self.hook("transaction", number)
            if self.clock() - opened >= self.interval and not self.ended(txn):
                self.end(txn, first, number, "committed")

        query = _start(stream, each, checkpoint, once, interval, self.path("positions"), self.id, self.group, merge=False)
        self.lease.take()
        return query

    def last_batch(self) -> int:
        return max((int(n[6:]) for n in _children(self.spark, f"{self.path('batches')}/source={self.id}") if n.startswith("batch=")), default=-1)

    def finish(self, state: str = "committed") -> None:
        """Ends the open transaction, if there is one, of a job that does not run: commits it, or aborts it."""
        if self.lease.epoch < 0:
            self.lease.take()
        last = self.last_batch()
        place = self._place(last)
        if place is not None and not self.ended(place[0]):
            self.end(place[0], place[1], last, state)

    def drain(self, query: StreamingQuery, timeout: float | None = None) -> None:
        """Processes what there is, then commits the transaction that is open."""
        drain(query, timeout)
        self.finish()


def markers(spark: SparkSession, root: str) -> DataFrame:
    """(source_id, txn_id, state) of all transactions that have ended."""
    return read_batches(spark, f"{root}/markers", MARKER_SCHEMA).select("source_id", "txn_id", "state").distinct()


def visible_records(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Records up to the last stable offset; ``schema`` is to have topic, partition, offset, source_id and txn_id."""
    return stable_records(read_batches(spark, f"{root}/out", schema), markers(spark, root))


def visible_results(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Results of committed transactions; ``schema`` is to have source_id and txn_id."""
    return committed_records(read_batches(spark, f"{root}/results", schema), markers(spark, root).filter("state = 'committed'"))


def positions(spark: SparkSession, root: str) -> DataFrame:
    """Where each group stands after the committed transactions: (group_id, topic, partition, next_offset, metadata)."""
    rows = read_batches(spark, f"{root}/markers", MARKER_SCHEMA).filter("state = 'committed' and topic is not null")
    last = F.max_by(F.struct("next_offset", "metadata"), F.struct("ended_at", "txn_id"))
    return rows.groupBy("group_id", "topic", "partition").agg(last.alias("last")).select("group_id", "topic", "partition", "last.next_offset", "last.metadata")
