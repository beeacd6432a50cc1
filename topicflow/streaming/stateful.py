"""Operators that keep state by key along a stream: batches by count or clock, records in offset order, partition events.

State is Spark's (``transformWithStateInPandas`` on RocksDB): it is checkpointed with the stream's
position, so that a job that fails goes on as if it had not. A key's records of one micro-batch
are held together; bound the intake (``maxRecordsPerPartition``) to bound them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators.offsets import GROUP
from ..sources.log import PARTITION
from .jobs import _put, _start
from .lease import Lease

#: Commits of a batch, and milliseconds after which it closes without them.
MOST, WAIT = 1000, 10_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTS = "spark.sql.shuffle.partitions"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which stateful processors need. The session's own settings come back.

    The keys are topic partitions, and each part of the state is opened and committed in every
    micro-batch: so there are no more parts than cores, where the session has more shuffle
    partitions. A query that goes on from its checkpoint keeps the number that it began with.
    """
    parts = min(int(spark.conf.get(_PARTS)), max(1, spark.sparkContext.defaultParallelism))
    before = {name: spark.conf.get(name, None) for name in (_PROVIDER, _PARTS)}
    spark.conf.set(_PROVIDER, _ROCKS)
    spark.conf.set(_PARTS, parts)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_until(query: StreamingQuery, done: Callable[[], bool], timeout: float = 120.0) -> None:
    """Lets a running query go on until ``done()``, then stops it; raises what it failed with, or that time is up.

    For jobs with clocks, which have a batch to run for ever and so never come to an end of what is available.
    """
    until = time.time() + timeout
    try:
        while query.isActive and not done():
            if time.time() > until:
                raise TimeoutError("the query is not done")
            time.sleep(0.2)
        error = query.exception()
    finally:
        query.stop()
    if error is not None:
        raise error


# -- batches by count or clock -----------------------------------------------------------------


class _Batches(StatefulProcessor):
    """The open batch of a key: how many commits it holds, its first and last offset, and when it is due."""

    def __init__(self, most: int, wait: int):
        self.most, self.wait = most, wait

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "batch long, n long, first long, last long, metadata string, due long")

    @staticmethod
    def _row(key: tuple, batch: int, first: int, last: int, metadata: str | None, n: int, by: str) -> tuple:
        return (*key, batch, first, last, metadata, n, by)

    def _frame(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows, columns=[*GROUP, "batch", "first_offset", "offset", "metadata", "batch_size", "closed_by"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = pd.concat(list(rows)).sort_values("offset", kind="stable")
        offsets, metadata = frames["offset"].tolist(), frames["metadata"].tolist()
        batch, held, first, last, last_meta, due = self.open.get() if self.open.exists() else (0, 0, None, None, None, None)
        made, at = [], 0
        while held + len(offsets) - at >= self.most:
            n = self.most - held
            made.append(self._row(key, batch, offsets[at] if first is None else first, offsets[at + n - 1], metadata[at + n - 1], self.most, "count"))
            batch, held, first, at = batch + 1, 0, None, at + n
            if due is not None:
                self.handle.deleteTimer(due)
                due = None
        if at < len(offsets):
            if first is None:
                first = offsets[at]
                due = timerValues.getCurrentProcessingTimeInMs() + self.wait
                self.handle.registerTimer(due)
            held, last, last_meta = held + len(offsets) - at, offsets[-1], metadata[-1]
        elif held == 0:
            last = last_meta = None
        self.open.update((batch, held, first, last, last_meta, due))
        yield from self._frame(made)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        batch, held, first, last, metadata, due = self.open.get()
        if not held or due != expiredTimerInfo.getExpiryTimeInMs():
            return  # its batch was closed by count
        self.open.update((batch + 1, 0, None, None, None, None))
        yield from self._frame([self._row(key, batch, first, last, metadata, held, "clock")])

    def close(self) -> None:
        pass


def closed_batches(commits: DataFrame, most: int = MOST, wait_ms: int = WAIT) -> DataFrame:
    """A stream of ``commit``'s columns as batches: group_id, topic, partition, batch, first_offset, offset, metadata, batch_size, closed_by.

    A batch of a group's partition closes with its ``most``-th commit, or ``wait_ms`` after its first
    one by the clock, whichever is first; batches are numbered from 0. Within a micro-batch
    commits are taken by offset; a repeated one counts again. Metadata is the last one's.
    One that is still open when the job stops is kept, and closes in a later run. Commits with a
    null group, topic or partition make groups of their own; null offsets are refused.
    """
    if most < 1:
        raise ValueError("a batch holds one commit at least")
    schema = "group_id string, topic string, partition int, batch long, first_offset long, offset long, metadata string, batch_size long, closed_by string"
    checked = commits.select(*GROUP, F.when(F.col("offset").isNull(), F.raise_error(F.lit("a commit without an offset"))).otherwise(F.col("offset")).cast("long").alias("offset"), "metadata")
    return checked.groupBy(*GROUP).transformWithStateInPandas(_Batches(most, wait_ms), schema, "Append", "ProcessingTime")


def commit_in_batches(stream: DataFrame, journal: str, batches: str, checkpoint: str, most: int = MOST, wait_ms: int = WAIT, source_id: str = "job", interval: str = "1 second") -> StreamingQuery:
    """Commits the ``commit`` column of a stream by count or clock, and puts out every batch that it has committed.

    The batches come out under ``batches`` (``closed_batches``' columns, source_id and commit_seq), after
    their positions are in the journal. The job runs until it is stopped: see ``run_until``.
    """
    closed = closed_batches(stream.select("commit.*"), most, wait_ms)

    def each(rows: DataFrame, number: int, lease: Lease) -> None:
        rows = rows.persist()
        try:
            if rows.isEmpty():
                return
            at = F.lit(int(time.time() * 1000)).cast("long")
            tags = {"source_id": F.lit(source_id), "commit_seq": F.lit(number).cast("long")}
            lines = rows.withColumns(tags).select(*GROUP, (F.col("offset") + 1).alias("next_offset"), "metadata", "batch_size", "source_id", "commit_seq", at.alias("committed_at"))
            lease.check()
            _put(lines, journal, source_id, number)
            _put(rows.withColumns(tags), batches, source_id, number)
        finally:
            rows.unpersist()

    with rocksdb(stream.sparkSession):
        return _start(closed, each, checkpoint, False, interval, journal, source_id, source_id)


BATCH_SCHEMA = "group_id string, topic string, partition int, batch long, first_offset long, offset long, metadata string, batch_size long, closed_by string, source_id string, commit_seq long"


# -- records in the order of their offsets -----------------------------------------------------


class _InOrder(StatefulProcessor):
    """Where a partition stands: its next offset, records so far, segment, whether it has ended; and what came too early."""

    def __init__(self, chunk: int):
        self.chunk = chunk

    def init(self, handle) -> None:
        self.at = handle.getValueState("at", "next long, n long, segment long, ended boolean")
        self.early = handle.getListState("early", "offset long, mark boolean, stop boolean, row string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))
        next_offset, n, segment, ended = self.at.get() if self.at.exists() else (int(came["first"].iloc[0]), 0, 0, False)
        columns = ["offset", "mark", "stop", "row"]
        held = list(self.early.get()) if self.early.exists() else []
        if held:
            came = pd.concat([pd.DataFrame(held, columns=columns), came[columns]])
        came = came[columns].drop_duplicates("offset").sort_values("offset")
        came = came[came["offset"] >= next_offset]
        offsets = came["offset"].to_numpy(np.int64)
        ready = int((offsets == next_offset + np.arange(len(offsets))).sum())  # sorted and distinct: a prefix
        early = came.iloc[ready:]
        if len(early):
            self.early.put([(int(o), bool(m), bool(s), r) for o, m, s, r in early.itertuples(index=False)])
        elif held:
            self.early.clear()
        now = came.iloc[:ready]
        marks, stops = now["mark"].to_numpy(bool), now["stop"].to_numpy(bool)
        ends = int(stops.argmax()) if stops.any() and not ended else ready
        inside = np.full(ready, not ended) & (np.arange(ready) < ends)
        count = n + 1 + np.arange(ready)
        if ready:
            yield pd.DataFrame({
                "topic": [key[0]] * ready, "partition": pd.array([key[1]] * ready, "Int32"), "offset": offsets[:ready], "n": count, "chunk": (count - 1) // self.chunk,
                "segment": segment + np.concatenate([[0], np.cumsum(marks)[:-1]]).astype(np.int64), "inside": inside, "ends": (np.arange(ready) == ends) & (not ended), "row": now["row"].to_numpy(),
            })
        self.at.update((next_offset + ready, n + ready, segment + int(marks.sum()), bool(ended or stops.any())))

    def close(self) -> None:
        pass


_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def in_order(stream: DataFrame, chunk: int = 10, marker: Column | None = None, stop: Column | None = None, first: Column | None = None) -> DataFrame:
    """A stream's records in the order of their offsets within each partition, with what runs along it.

    Added columns: n (the running count, this one included), chunk (of ``chunk`` records), segment
    (a record with the ``marker`` ends its own), inside (before the first record that says ``stop``)
    and ends (that record). They equal those of ``operators.partitioned`` over all records at once,
    in however many micro-batches, and in whatever order, the records come: one that comes
    before its predecessors waits for them, one that comes again is dropped. So offsets are to be
    dense from ``first`` on (0; a column that is the same all over a partition).

    A null marker or stop is false; a null partition is one of its own. Records with a null offset
    are dropped. Columns of the added names are replaced.
    """
    added = ("n", "chunk", "segment", "inside", "ends")
    kept = [c for c in stream.columns if c not in (*added, *PARTITION, "offset")]
    body = F.to_json(F.struct(*kept), _FORMATS) if kept else F.lit("{}")
    flags = [F.coalesce(F.lit(False) if c is None else c, F.lit(False)).alias(name) for c, name in ((marker, "mark"), (stop, "stop"))]
    rows = stream.filter(F.col("offset").isNotNull()).select(*PARTITION, F.col("offset").cast("long").alias("offset"), *flags, (F.lit(0) if first is None else first).cast("long").alias("first"), body.alias("row"))
    schema = "topic string, partition int, offset long, n long, chunk long, segment long, inside boolean, ends boolean, row string"
    numbered = rows.groupBy(*PARTITION).transformWithStateInPandas(_InOrder(chunk), schema, "Append", "None")
    types = "struct<" + ",".join(f"`{c}`:{stream.schema[c].dataType.simpleString()}" for c in kept) + ">"
    parsed = numbered.withColumn("row", F.from_json("row", types, _FORMATS)) if kept else numbered
    return parsed.select(*PARTITION, "offset", *[F.col(f"row.`{c}`").alias(c) for c in kept], *added)


def write_in_order(stream: DataFrame, out: str, checkpoint: str, once: bool = True, **more) -> StreamingQuery:
    """``in_order`` as a job that writes Parquet files."""
    with rocksdb(stream.sparkSession):
        writer = in_order(stream, **more).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="0 seconds")).start()


# -- partition events --------------------------------------------------------------------------


class _Events(StatefulProcessor):
    """Since when a partition is assigned, how often it has been, and when it will have been silent for too long."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "times long, next long, due long")

    def _frame(self, key: tuple, event: str, times: int, next_offset: int) -> pd.DataFrame:
        return pd.DataFrame([(*key, event, times, next_offset)], columns=[*PARTITION, "event", "times", "next_offset"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        high = max(int(f["offset"].max()) for f in rows) + 1
        times, next_offset, due = self.seen.get() if self.seen.exists() else (0, 0, None)
        if due is None:
            times += 1
            yield self._frame(key, "assign", times, min(high, next_offset) if next_offset else 0)
        else:
            self.handle.deleteTimer(due)
        due = timerValues.getCurrentProcessingTimeInMs() + self.idle
        self.handle.registerTimer(due)
        self.seen.update((times, max(next_offset, high), due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        times, next_offset, due = self.seen.get()
        if due == expiredTimerInfo.getExpiryTimeInMs():
            self.seen.update((times, next_offset, None))
            yield self._frame(key, "revoke", times, next_offset)

    def close(self) -> None:
        pass


EVENT_SCHEMA = "topic string, partition int, event string, times long, next_offset long, source_id string, commit_seq long"


def partition_events(stream: DataFrame, idle_ms: int, out: str, checkpoint: str, source_id: str = "events", interval: str = "1 second") -> StreamingQuery:
    """Assign and revoke events: a partition is assigned with its first record, and revoked after ``idle_ms`` without one.

    ``times`` counts its assignments; next_offset is where it begins, or where it was left. Records
    with a null offset don't count. The job runs until it is stopped, by ``stop_with_event``.
    """
    rows = stream.filter(F.col("offset").isNotNull()).select(*PARTITION, F.col("offset").cast("long").alias("offset"))
    events = rows.groupBy(*PARTITION).transformWithStateInPandas(_Events(idle_ms), "topic string, partition int, event string, times long, next_offset long", "Append", "ProcessingTime")

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                _put(batch.withColumns({"source_id": F.lit(source_id), "commit_seq": F.lit(number).cast("long")}), out, source_id, number)
        finally:
            batch.unpersist()

    with rocksdb(stream.sparkSession):
        writer = events.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", checkpoint)
        return writer.trigger(processingTime=interval).start()


def stop_with_event(query: StreamingQuery, spark: SparkSession, out: str, done: Callable[[], bool], source_id: str = "events", timeout: float = 120.0) -> None:
    """Stops a job of partition events and puts a stop event behind those that it has put out, whether it failed or not."""
    try:
        run_until(query, done, timeout)
    finally:
        last = query.lastProgress
        number = int(last["batchId"]) + 1 if last else 0
        row = spark.createDataFrame([(None, None, "stop", None, None, source_id, number)], EVENT_SCHEMA)
        _put(row.coalesce(1), out, f"{source_id}-stop", number)


# -- the audit of a running job ----------------------------------------------------------------


class Offsets:
    """A set of offsets as runs: sorted, apart from each other, ends exclusive. Its size is that of its gaps, not of its members."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray):
        self.starts, self.ends = starts, ends

    @staticmethod
    def of(offsets: np.ndarray) -> Offsets:
        o = np.unique(np.asarray(offsets, np.int64))
        cut = np.flatnonzero(np.diff(o) > 1)
        return Offsets(o[np.concatenate([[0], cut + 1])] if len(o) else o, o[np.concatenate([cut, [len(o) - 1]])] + 1 if len(o) else o)

    @staticmethod
    def parse(raw: bytes) -> Offsets:
        return Offsets(*np.frombuffer(raw, "<i8").reshape(2, -1))

    def bytes(self) -> bytes:
        """One value for all runs: row by row they would cost more than the records."""
        return np.concatenate([self.starts, self.ends]).astype("<i8").tobytes()

    def __len__(self) -> int:
        return int((self.ends - self.starts).sum())

    def __or__(self, other: Offsets) -> Offsets:
        starts, ends = np.concatenate([self.starts, other.starts]), np.concatenate([self.ends, other.ends])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(order) else ends
        new = np.append(True, starts[1:] > ends[:-1]) if len(starts) else np.zeros(0, bool)
        last = np.append(new[1:], True) if len(starts) else new
        return Offsets(starts[new], ends[last])

    def has(self, offsets: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.starts, offsets, "right") - 1
        return (at >= 0) & (offsets < np.append(self.ends, 0)[at])

    def shared(self, other: Offsets) -> int:
        return len(self) + len(other) - len(self | other)


class _Audit(StatefulProcessor):
    """Of each partition the offsets that the log has, that came, and that came again, as runs; and the records of either side."""

    def init(self, handle) -> None:
        self.sets = {name: handle.getValueState(name, "runs binary") for name in ("want", "got", "again")}
        self.counts = handle.getValueState("counts", "expected long, delivered long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = {name: Offsets.parse(s.get()[0]) if s.exists() else Offsets.of([]) for name, s in self.sets.items()}
        before = dict(held)
        expected, delivered = self.counts.get() if self.counts.exists() else (0, 0)
        for frame in rows:
            o, came = frame["offset"].to_numpy(np.int64), frame["came"].to_numpy(bool)
            expected, delivered = expected + int((~came).sum()), delivered + int(came.sum())
            if not came.all():
                held["want"] = held["want"] | Offsets.of(o[~came])
            if came.any():
                once, n = np.unique(o[came], return_counts=True)
                held["again"] = held["again"] | Offsets.of(once[(n > 1) | held["got"].has(once)])
                held["got"] = held["got"] | Offsets.of(once)
        for name, s in self.sets.items():
            if held[name] is not before[name]:
                s.update((held[name].bytes(),))
        self.counts.update((expected, delivered))
        want, got, both = held["want"], held["got"], held["want"].shared(held["got"])
        row = (*key, expected, delivered, len(want) - both, len(held["again"]), len(got) - both, max(0, len(got.starts) - 1))
        yield pd.DataFrame([row], columns=[*PARTITION, "expected", "delivered", "missing", "repeated", "unknown", "gaps"])

    def close(self) -> None:
        pass


AUDIT_SCHEMA = "topic string, partition int, expected long, delivered long, missing long, repeated long, unknown long, gaps long, source_id string, commit_seq long"


def running_audit(log: DataFrame, output: DataFrame, out: str, checkpoint: str, source_id: str = "audit", once: bool = True, interval: str = "10 seconds") -> StreamingQuery:
    """``operators.summary.delivery_audit`` of two streams as they come: each micro-batch puts out the partitions it touched.

    State is runs of offsets, which grow with the gaps there are at the time and not with the
    records. The last row of a partition (``last_audit``) is the audit of all that has come,
    in whatever order; what is under way counts as missing. Records with a null offset are left out; a null topic or
    partition is one of its own.
    """
    side = lambda df, came: df.filter(F.col("offset").isNotNull()).select(*PARTITION, F.col("offset").cast("long").alias("offset"), F.lit(came).alias("came"))
    rows = side(log, False).unionByName(side(output, True))
    schema = AUDIT_SCHEMA.removesuffix(", source_id string, commit_seq long")
    audits = rows.groupBy(*PARTITION).transformWithStateInPandas(_Audit(), schema, "Update", "None")
    each = lambda batch, number: _put(batch.withColumns({"source_id": F.lit(source_id), "commit_seq": F.lit(number).cast("long")}), out, source_id, number)
    with rocksdb(log.sparkSession):
        writer = audits.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def last_audit(audits: DataFrame) -> DataFrame:
    """The last row of each partition."""
    names = [c for c in audits.columns if c not in (*PARTITION, "source_id", "commit_seq")]
    last = F.max_by(F.struct(*names), F.col("commit_seq")).alias("last")
    return audits.groupBy(*PARTITION).agg(last).select(*PARTITION, *[F.col(f"last.{c}").alias(c) for c in names])
