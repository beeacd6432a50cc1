"""A topic log on shared storage as a Spark data source: ``format("topiclog")``, in batches and as a stream.

Tasks write data files; what they hold becomes part of the log with one manifest, which the
driver's side of the commit publishes under the next free number. Only then have its records
offsets: each partition goes on from its end in the manifest before, file by file. So any number
of tasks append to one partition, several writers may append at once (the later one takes the
next number), a failed append leaves no trace in the log, and a streaming batch that Spark
repeats is known by its writer's name and number.

Files: ``data/<id>.parquet`` (records by topic and partition, with their place in the file's
share of the partition), ``manifests/<number>.json``, and for every SNAPSHOT manifests
``snapshots/<number>.parquet`` with all segments up to it, so that planning reads one snapshot
and a bounded tail. Paths are what pyarrow's file systems can open from executors and driver.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

from .log import LOG_SCHEMA, PARTITION
from .subscribe import Subscription

#: Manifests between two snapshots; records that one task reads.
SNAPSHOT, RANGE_RECORDS = 64, 1 << 16
_STORED = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("position", pa.int64()), ("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us")), ("txn_id", pa.int64())])
_READ = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us")), ("txn_id", pa.int64())])
Key = tuple[str, int]


@dataclass(frozen=True)
class Segment:
    """Records of one partition in one file: offsets from base on."""

    topic: str
    partition: int
    base: int
    count: int
    file: str

    @property
    def key(self) -> Key:
        return self.topic, self.partition

    @property
    def end(self) -> int:
        return self.base + self.count


@dataclass(frozen=True)
class Manifest:
    """One append: its segments, every partition's end after it, and the last batch of each streaming writer."""

    segments: tuple[Segment, ...]
    ends: dict[Key, int]
    writers: dict[str, int]

    def text(self) -> str:
        rows = [[s.topic, s.partition, s.base, s.count, s.file] for s in self.segments]
        return json.dumps({"segments": rows, "ends": [[*k, v] for k, v in self.ends.items()], "writers": self.writers})

    @staticmethod
    def parse(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(tuple(Segment(*s) for s in raw["segments"]), {(t, p): e for t, p, e in raw["ends"]}, raw["writers"])


class Store:
    """The files of one log."""

    def __init__(self, path: str):
        self.path = path
        self.fs, self.root = pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), os.path.abspath(path))
        self.root = self.root.rstrip("/")

    def data(self, name: str) -> str:
        return f"{self.root}/data/{name}"

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:020d}.json"

    def _snapshot(self, number: int) -> str:
        return f"{self.root}/snapshots/{number:020d}.parquet"

    def exists(self, path: str) -> bool:
        return self.fs.get_file_info(path).type == pafs.FileType.File

    def last(self, known: int = -1) -> int:
        """The number of the last manifest: -1 if there is none. Numbers have no holes, so few have to be tried."""
        step, low = 1, known
        while self.exists(self._manifest(low + step)):
            low += step
            step *= 2
        while step > 1:
            step //= 2
            if self.exists(self._manifest(low + step)):
                low += step
        return low

    def manifest(self, number: int) -> Manifest:
        return _read_manifest(self.path, number) if number >= 0 else Manifest((), {}, {})

    def put(self, path: str, body: bytes, replace: bool = False) -> bool:
        """Writes a file in one step; False where it is there already and may not be replaced."""
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        staged = f"{path}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(staged) as out:
            out.write(body)
        if isinstance(self.fs, pafs.LocalFileSystem) and not replace:
            try:
                os.link(staged, path)  # of several writers one wins
            except FileExistsError:
                return False
            finally:
                os.unlink(staged)
            return True
        if not replace and self.exists(path):
            self.fs.delete_file(staged)
            return False
        self.fs.move(staged, path)
        return True

    def append(self, files: Sequence[tuple[str, list[tuple[str, int, int]]]], writer: str = "", batch: int = -1) -> int | None:
        """Publishes files, each with (topic, partition, records), as one manifest: its number.

        None where the writer's batch has been published before: nothing is added then.
        """
        number = self.last()
        while True:
            before = self.manifest(number)
            if writer and before.writers.get(writer, -1) >= batch:
                return None
            ends, segments = dict(before.ends), []
            for file, counts in files:
                for topic, partition, n in counts:
                    base = ends.get((topic, partition), 0)
                    segments.append(Segment(topic, partition, base, n, file))
                    ends[topic, partition] = base + n
            writers = before.writers | ({writer: batch} if writer else {})
            if self.put(self._manifest(number + 1), Manifest(tuple(segments), ends, writers).text().encode()):
                break
            number = self.last(number)  # another writer took the number: go on from its ends
        if (number + 2) % SNAPSHOT == 0:
            self._write_snapshot(number + 1)
        return number + 1

    def _write_snapshot(self, number: int) -> None:
        rows = self.segments(number)
        table = pa.table({"topic": [s.topic for s in rows], "partition": pa.array([s.partition for s in rows], pa.int32()), "base": [s.base for s in rows], "count": [s.count for s in rows], "file": [s.file for s in rows]})
        out = pa.BufferOutputStream()
        pq.write_table(table, out)
        self.put(self._snapshot(number), out.getvalue().to_pybytes())

    def segments(self, last: int, first: int = 0) -> list[Segment]:
        """The segments of the manifests from ``first`` to ``last``."""
        found, begin = [], first
        if first == 0:
            number = (last + 1) // SNAPSHOT * SNAPSHOT - 1
            while number >= 0 and not self.exists(self._snapshot(number)):  # its writer may have died before it
                number -= SNAPSHOT
            if number >= 0:
                t = pq.read_table(self._snapshot(number), filesystem=self.fs).to_pydict()
                found, begin = [Segment(*v) for v in zip(t["topic"], t["partition"], t["base"], t["count"], t["file"], strict=True)], number + 1
        for number in range(begin, last + 1):
            found += self.manifest(number).segments
        return found

    def sweep(self, keep: Iterable[str] = ()) -> list[str]:
        """Removes data files that no manifest names, as tasks leave them that were lost: for when nothing is being written."""
        named = {s.file for s in self.segments(self.last())} | set(keep)
        there = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/data", allow_not_found=True))
        gone = [f.base_name for f in there if f.base_name not in named]
        for name in gone:
            self.fs.delete_file(self.data(name))
        return gone


@lru_cache(maxsize=4096)
def _read_manifest(path: str, number: int) -> Manifest:
    """Manifests never change once they are published."""
    store = Store(path)
    with store.fs.open_input_stream(store._manifest(number)) as f:
        return Manifest.parse(f.read().decode())


# -- writing ---------------------------------------------------------------------------------


@dataclass
class Staged(WriterCommitMessage):
    """What a task has written: a file, and how many records of each partition it holds. No records, no file."""

    file: str
    counts: list[tuple[str, int, int]]


def _stored(b: pa.RecordBatch) -> pa.Table:
    names = set(b.schema.names)
    columns = [b.column(f.name).cast(f.type) if f.name in names else pa.nulls(len(b), f.type) for f in _STORED]
    t = pa.Table.from_arrays(columns, schema=_STORED)
    if t["topic"].null_count:
        raise ValueError("record refused: INVALID_TOPIC")
    if t["partition"].null_count or len(t) and pc.min(t["partition"]).as_py() < 0:
        raise ValueError("record refused: INVALID_PARTITION")
    return t.take(pc.sort_indices(t, [("topic", "ascending"), ("partition", "ascending")]))  # stable


class _Writer:
    def __init__(self, path: str):
        self.path = path

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        """One file of a task, a row group for each batch, which is all that is held at a time."""
        store, name = Store(self.path), f"{uuid.uuid4().hex}.parquet"
        counts: dict[Key, int] = {}
        out = None
        try:
            for b in batches:
                if not len(b):
                    continue
                t = _stored(b)
                topics, partitions = t["topic"].combine_chunks().dictionary_encode(), t["partition"].to_numpy()
                codes = topics.indices.to_numpy()
                new = np.append(True, (codes[1:] != codes[:-1]) | (partitions[1:] != partitions[:-1]))
                begins = np.flatnonzero(new)
                sizes = np.diff(begins, append=len(t))
                keys = [(topics[int(i)].as_py(), int(partitions[i])) for i in begins]
                first = np.array([counts.get(k, 0) for k in keys])
                place = np.arange(len(t)) + np.repeat(first - begins, sizes)
                for k, n in zip(keys, sizes.tolist(), strict=True):
                    counts[k] = counts.get(k, 0) + n
                t = t.set_column(t.schema.get_field_index("position"), "position", pa.array(place))
                if out is None:
                    store.fs.create_dir(f"{store.root}/data", recursive=True)
                    out = pq.ParquetWriter(store.data(name), _STORED, filesystem=store.fs)
                out.write_table(t)
        except BaseException:
            if out is not None:
                out.close()
                store.fs.delete_file(store.data(name))
            raise
        if out is None:
            return Staged("", [])
        out.close()
        return Staged(name, [(*k, n) for k, n in counts.items()])

    def publish(self, messages: Sequence[WriterCommitMessage | None], writer: str = "", batch: int = -1) -> None:
        staged = [m for m in messages if isinstance(m, Staged) and m.counts]
        # a batch without records is published too: its writer's number counts
        if (staged or writer) and Store(self.path).append([(m.file, m.counts) for m in staged], writer, batch) is None:
            self.drop(messages)

    def drop(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        store = Store(self.path)
        for m in messages:
            if isinstance(m, Staged) and m.counts and store.exists(store.data(m.file)):
                store.fs.delete_file(store.data(m.file))


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.writer = _Writer(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.writer.stage(iterator)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.writer.publish(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.writer.drop(messages)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, name: str):
        self.writer, self.name = _Writer(path), name

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.writer.stage(iterator)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.writer.publish(messages, self.name, batchId)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.writer.drop(messages)


# -- reading ---------------------------------------------------------------------------------


@dataclass
class Ranges(InputPartition):
    """What one task reads: (segment, from, to), offsets with the end exclusive; for numbered streams each partition's start, and the bounded batch that begins there."""

    pieces: list[tuple[Segment, int, int]]
    starts: dict[Key, int] | None = None
    batch: int = 0


def plan(segments: Iterable[Segment], starts: dict[Key, int], ends: dict[Key, int], most: int) -> list[Ranges]:
    """The records from starts to ends as tasks of ``most`` records: a hot partition is many of them."""
    tasks: list[Ranges] = []
    pieces: list[tuple[Segment, int, int]] = []
    room = most
    for s in sorted(segments, key=lambda s: (s.topic, s.partition, s.base)):
        low, high = max(s.base, starts.get(s.key, 0)), min(s.end, ends.get(s.key, 0))
        while low < high:
            n = min(high - low, room)
            pieces.append((s, low, low + n))
            low, room = low + n, room - n
            if not room:
                tasks.append(Ranges(pieces))
                pieces, room = [], most
    return [*tasks, Ranges(pieces)] if pieces else tasks


def read_ranges(path: str, ranges: Ranges, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The records; with ``starts`` also the bounded batch of each, which holds ``most`` of a partition."""
    store = Store(path)
    for s, low, high in ranges.pieces:
        wanted = [("topic", "=", s.topic), ("partition", "=", s.partition), ("position", ">=", low - s.base), ("position", "<", high - s.base)]
        t = pq.read_table(store.data(s.file), filesystem=store.fs, filters=wanted)
        offset = pc.add(t["position"], pa.scalar(s.base, pa.int64()))
        columns = [offset if f.name == "offset" else t[f.name] for f in _READ]
        found = pa.Table.from_arrays(columns, schema=_READ)
        if ranges.starts is not None:
            place = offset.to_numpy() - ranges.starts.get(s.key, 0)
            found = found.append_column("batch", pa.array(ranges.batch + place // most, pa.int64()))
        yield from found.to_batches(max_chunksize=10_000)


class _Options:
    """path; topics (comma-separated) or topicPattern (a regular expression that is found in the name); startingOffsets: earliest, latest, or JSON {"topic/partition": offset}; rangeRecords;
    for streams maxRecordsPerPartition and positions, the folder that keeps how far the stream has been planned;
    with these maxBatchesAtOnce (1), so many bounded batches may be one micro-batch, and numberBatches (false), which adds a column batch."""

    def __init__(self, options: dict[str, str]):
        self.path = options.get("path", "")
        if not self.path:
            raise ValueError("topiclog needs a path")
        self.topics = {t for t in options.get("topics", "").split(",") if t}
        pattern = options.get("topicpattern", "")
        if self.topics and pattern:
            raise ValueError("topics or topicPattern, not both")
        self.pattern = re.compile(pattern) if pattern else None
        self.starting = options.get("startingoffsets", "earliest")
        self.range_records = int(options.get("rangerecords", RANGE_RECORDS))
        most = options.get("maxrecordsperpartition")
        self.most, self.positions = int(most) if most else None, options.get("positions", "")
        if self.most is not None and (self.most <= 0 or not self.positions):
            raise ValueError("maxRecordsPerPartition is to be positive, and needs positions: a folder of the stream's own")
        self.at_once = int(options.get("maxbatchesatonce", "1"))
        self.numbered = options.get("numberbatches", "false").lower() == "true"
        if self.at_once < 1 or self.most is None and (self.at_once > 1 or self.numbered):
            raise ValueError("maxBatchesAtOnce is to be positive; it and numberBatches need maxRecordsPerPartition")

    def wanted(self, ends: dict[Key, int]) -> dict[Key, int]:
        chosen = self.pattern.search if self.pattern else self.topics.__contains__ if self.topics else lambda topic: True
        return {k: v for k, v in ends.items() if chosen(k[0])}

    def starts(self, ends: dict[Key, int]) -> dict[Key, int]:
        if self.starting == "earliest":
            return {}
        if self.starting == "latest":
            return self.wanted(ends)
        named = json.loads(self.starting)
        return {(k.rpartition("/")[0], int(k.rpartition("/")[2])): v for k, v in named.items()}


class BatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = _Options(options)

    def partitions(self) -> list[InputPartition]:
        store = Store(self.options.path)
        last = store.last()
        ends = store.manifest(last).ends
        return plan(store.segments(last), self.options.starts(ends), self.options.wanted(ends), self.options.range_records)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_ranges(self.options.path, partition) if isinstance(partition, Ranges) else iter(())


class StreamReader(DataSourceStreamReader):
    """A stream's offset: the next offset of each partition, the first manifest of which something is unread, and the bounded batches so far.

    With maxRecordsPerPartition no batch reads more records than that of any partition. A micro-batch is
    one such batch, or with maxBatchesAtOnce several that wait already: as many as all before it together
    (so 1, 1, 2, 4 ...), up to that number. A backlog then takes few micro-batches, whose cost is
    mostly their own, and a stream that keeps up takes one bounded batch at a time. What
    Spark asks for is the end of the next batch, without saying where that begins; so each
    planned end is kept in ``positions``. Spark plans every batch that it has logged, again
    after a failure, before it asks for the next: the file is never behind or ahead.
    A run over what is available (``availableNow``) asks once, so it takes one bounded batch.
    """

    def __init__(self, options: dict[str, str]):
        self.options = _Options(options)
        self.store = Store(self.options.path)

    @staticmethod
    def _offset(manifest: int, ends: dict[Key, int], batch: int = 0) -> dict:
        return {"manifest": manifest, "next": {f"{t}/{p}": e for (t, p), e in sorted(ends.items())}, "batch": batch}

    @staticmethod
    def _ends(offset: dict) -> dict[Key, int]:
        return {(k.rpartition("/")[0], int(k.rpartition("/")[2])): v for k, v in offset["next"].items()}

    def initialOffset(self) -> dict:
        ends = self.store.manifest(self.store.last()).ends
        return self._offset(0, self.options.starts(ends))

    @property
    def _file(self) -> str:
        return Store(self.options.positions).root + "/planned.json"

    def _planned(self) -> dict:
        store = Store(self.options.positions)
        if not store.exists(self._file):
            store.put(self._file, json.dumps(self.initialOffset()).encode())
        with store.fs.open_input_stream(self._file) as f:
            return json.loads(f.read().decode())

    def latestOffset(self) -> dict:
        if self.options.most is None:
            last = self.store.last()
            return self._offset(max(0, last + 1), self.options.wanted(self.store.manifest(last).ends))
        planned = self._planned()
        last = self.store.last(planned["manifest"] - 1)
        known, ends = self._ends(planned), self.options.wanted(self.store.manifest(last).ends)
        taken = planned.get("batch", 0)
        room = self.options.most * min(self.options.at_once, max(1, taken))
        until = {k: max(known.get(k, 0), min(e, known.get(k, 0) + room)) for k, e in ends.items()}
        taken += max((-((known.get(k, 0) - e) // self.options.most) for k, e in until.items()), default=0)
        until = known | until
        unread = planned["manifest"]
        while unread <= last and all(s.key not in ends or s.end <= until[s.key] for s in self.store.manifest(unread).segments):
            unread += 1
        return self._offset(unread, until, taken)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.options.most is not None:
            Store(self.options.positions).put(self._file, json.dumps(end).encode(), replace=True)
        ends = self._ends(end)
        last = self.store.last(end["manifest"] - 1)
        starts = self._ends(start)
        tasks = plan(self.store.segments(last, start["manifest"]), starts, ends, self.options.range_records)
        if self.options.numbered:
            for task in tasks:
                task.starts, task.batch = {s.key: starts.get(s.key, 0) for s, _, _ in task.pieces}, start.get("batch", 0)
        return tasks

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_ranges(self.options.path, partition, self.options.most) if isinstance(partition, Ranges) else iter(())

    def commit(self, end: dict) -> None:
        pass


class TopicLog(DataSource):
    """Reads have the columns of LOG_SCHEMA. Writes need topic (not null) and partition (0 or more); offset is given
    by the log, key, value, timestamp and txn_id are null where the rows have no such column, others are not kept.
    A stream with numberBatches has the column batch too: the number of the bounded batch that a record is in."""

    @classmethod
    def name(cls) -> str:
        return "topiclog"

    def schema(self) -> T.StructType:
        numbered = self.options.get("numberBatches", "false").lower() == "true"
        return T.StructType([*LOG_SCHEMA.fields, T.StructField("batch", T.LongType())]) if numbered else LOG_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return BatchReader(dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return StreamReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a log is appended to, not overwritten")
        return BatchWriter(_Options(dict(self.options)).path)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        """``writer`` names the stream: its batches are published once, however often Spark repeats them."""
        name = self.options.get("writer", "")
        if not name:
            raise ValueError("a stream that writes to a topiclog needs a writer: a name of its own")
        return StreamWriter(_Options(dict(self.options)).path, name)


def register(spark: SparkSession) -> None:
    """Makes ``format("topiclog")`` known to a session."""
    spark.dataSource.register(TopicLog)


def log_table(spark: SparkSession, path: str, subscription: Subscription | None = None) -> DataFrame:
    """The log's records as a table that Spark's own Parquet reader scans: columns and filters reach the files.

    Only files with segments of the subscription are read; the segments' bases, one row for
    each file and partition, are joined to their records. A log without records is empty.
    """
    store = Store(path)
    last = store.last()
    segments = store.segments(last)
    if subscription is not None and subscription.topics:
        segments = [s for s in segments if s.topic in subscription.topics]
    elif subscription is not None and subscription.partitions:
        segments = [s for s in segments if s.key in subscription.partitions and s.end > (subscription.partitions[s.key] or 0)]
    if not segments:
        return spark.createDataFrame([], LOG_SCHEMA)
    base = path.rstrip("/") if ":" in path.split("/")[0] else f"file://{store.root}"
    schema = "topic string, partition int, position bigint, key binary, value binary, timestamp timestamp_ntz, txn_id bigint"
    files = spark.read.schema(schema).parquet(*[f"{base}/data/{f}" for f in sorted({s.file for s in segments})])
    known = spark.createDataFrame([(s.topic, s.partition, s.file, s.base) for s in segments], "topic string, partition int, __file string, __base bigint")
    joined = files.withColumn("__file", F.col("_metadata.file_name")).join(known, [*PARTITION, "__file"])
    found = joined.withColumn("offset", F.col("__base") + F.col("position")).select(*LOG_SCHEMA.names)
    return found if subscription is None else found.filter(subscription.predicate)


def starting_offsets(positions: DataFrame) -> str:
    """A group's positions ``(topic, partition, next_offset)`` as the option startingOffsets: a stream then goes on where the group stands.

    One row for each partition comes to the driver. Rows with nulls are left out, so their partitions begin at 0; of
    several rows of a partition the least counts. A stream that has a checkpoint goes on from that instead.
    """
    rows = positions.dropna(subset=["topic", "partition", "next_offset"]).groupBy(*PARTITION).agg(F.min("next_offset").alias("next_offset")).collect()
    return json.dumps({f"{r['topic']}/{r['partition']}": r["next_offset"] for r in rows}, sort_keys=True)


def appended(spark: SparkSession, path: str, writer: str | None = None) -> DataFrame:
    """What each append did: (number, writer, batch, topic, partition, first, next): a sink's completion result.

    ``writer`` and ``batch`` are null for appends that no stream made; a batch without records has no row.
    """
    store, rows = Store(path), []
    before: dict[str, int] = {}
    for number in range(store.last() + 1):
        m = store.manifest(number)
        made = [(w, b) for w, b in m.writers.items() if before.get(w, -1) != b]
        before = m.writers
        who, batch = made[0] if made else (None, None)
        spans: dict[Key, tuple[int, int]] = {}
        for s in m.segments:
            low, high = spans.get(s.key, (s.base, s.end))
            spans[s.key] = (min(low, s.base), max(high, s.end))
        rows += [(number, who, batch, *k, *v) for k, v in spans.items() if writer is None or who == writer]
    return spark.createDataFrame(rows, "number bigint, writer string, batch bigint, topic string, partition int, first bigint, next bigint")
