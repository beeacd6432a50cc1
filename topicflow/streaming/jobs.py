"""Streaming jobs over a log: what is written when, and so what a failure may lose or repeat.

A batch's output and its commits are folders of their own, named by the job's source_id and
the batch id, and overwritten when Spark replays the batch. Output gets the columns source_id and commit_seq (or
txn_id), in place of columns of these names. Batches without records are written too. Records with a null topic, partition
or offset are put out like others; positions follow ``operators.offsets``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.offsets import fold_offsets, journal_rows
from ..operators.policy import directive
from ..operators.produce import results as results_of
from ..operators.produce import sent_records
from ..sources.readers import committable, end_offsets
from .lease import Lease

JOURNAL_SCHEMA = "group_id string, topic string, partition int, next_offset bigint, metadata string, batch_size bigint, source_id string, commit_seq bigint, committed_at bigint"
ENDS_SCHEMA = "topic string, partition int, end bigint"
TXN_SCHEMA = "txn_id bigint, source_id string"
Step = Callable[[DataFrame], DataFrame]
#: Called before each step of a batch with the step's name and the batch id; tests raise in it.
Hook = Callable[[str, int], None]


def _folder(path: str, source_id: str, batch: int) -> str:
    return f"{path}/source={source_id}/batch={batch}"


def _put(df: DataFrame, path: str, source_id: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(_folder(path, source_id, batch))


def _read_back(spark: SparkSession, path: str, source_id: str, batch: int) -> DataFrame:
    """What ``_put`` has written: later steps read it, where they would number the records once more."""
    return spark.read.parquet(_folder(path, source_id, batch))


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a batch's folder was written in full."""
    return _there(spark, path + "/_SUCCESS")


def _there(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none where there is no folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def batch_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold all batches of all sources: a batch's own, or the widest one that it was merged into."""
    found = []
    for source in _children(spark, path):
        names = [n for n in _children(spark, f"{path}/{source}") if source.startswith("source=")]
        spans = [tuple(map(int, n[5:].split("-"))) for n in names if n.startswith("span=") and _exists(spark, f"{path}/{source}/{n}")]
        widest = [s for s in spans if not any(t != s and t[0] <= s[0] and s[1] <= t[1] for t in spans)]
        found += [f"{path}/{source}/span={a}-{b}" for a, b in widest]
        batches = [int(n[6:]) for n in names if n.startswith("batch=")]
        found += [f"{path}/{source}/batch={b}" for b in batches if not any(a <= b <= z for a, z in widest)]
    return found


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All batches of all sources written under a path, each once, merged or not. No batches give no rows."""
    folders = batch_folders(spark, path)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge_batches(spark: SparkSession, path: str, source_id: str, batch: int, schema: T.StructType | str, every: int = 100) -> None:
    """Merges a source's finished batches, those before ``batch``, so that few folders are left to read.

    Each ``every`` batches become one folder, and so do each ``every`` of these: of n batches no more than
    ``every`` folders are left at each of log(n) widths. The newest batch stays, as Spark may
    repeat it. A merged folder counts from when it is written in full; what it replaces goes afterwards.
    """
    if batch % every:
        return
    width = every
    while batch % width == 0 and batch:
        a, b = batch - width, batch - 1
        inside = [f for f in batch_folders(spark, f"{path}") if f.startswith(f"{path}/source={source_id}/") and _within(f, a, b)]
        if inside:
            spark.read.schema(schema).parquet(*inside).coalesce(1).write.mode("overwrite").parquet(f"{path}/source={source_id}/span={a}-{b}")
            for f in inside:
                _remove(spark, f)
        width *= every


def _within(folder: str, a: int, b: int) -> bool:
    kind, _, span = folder.rpartition("/")[2].partition("=")
    low, _, high = span.partition("-")
    return a <= int(low) and int(high or low) <= b and (kind, int(low), int(high or low)) != ("span", a, b)


def read_visible(spark: SparkSession, path: str, schema: T.StructType | str, journal_path: str) -> DataFrame:
    """Output whose batch has been committed: rows carry source_id and commit_seq."""
    done = read_batches(spark, journal_path, JOURNAL_SCHEMA).select("source_id", "commit_seq").distinct()
    return read_batches(spark, path, schema).join(done, ["source_id", "commit_seq"], "left_semi")


@contextmanager
def _held(batch: DataFrame) -> Iterator[DataFrame]:
    """The batch kept for as long as its steps run: each of them reads it."""
    batch = batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def commit_batch(batch: DataFrame, journal_path: str, source_id: str, batch_id: int) -> None:
    """Folds the batch's ``commit`` columns and writes them as the batch's journal."""
    folded = fold_offsets(batch.select("commit.*"), F.col("offset"))
    _put(journal_rows(folded, F.lit(source_id), F.lit(batch_id), int(time.time() * 1000)), journal_path, source_id, batch_id)


def _tagged(df: DataFrame, source_id: str, batch_id: int) -> DataFrame:
    return df.withColumns({"source_id": F.lit(source_id), "commit_seq": F.lit(batch_id).cast("long")})


def _start(stream: DataFrame, each: Callable[[DataFrame, int, Lease], None], checkpoint: str, once: bool, interval: str, journal: str, source_id: str, group: str, merge: bool = True) -> StreamingQuery:
    """Starts a job, which takes the group's lease: an earlier job of the group fails at its next step.

    One that is new may not take the name of another: it would overwrite its batches. Journals
    are merged every hundred batches.
    """
    spark = stream.sparkSession
    if _there(spark, f"{journal}/source={source_id}") and not _there(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"the journal has batches of another job called {source_id}")
    lease = Lease(spark, f"{journal}-leases", group).take()

    def fenced(batch: DataFrame, batch_id: int) -> None:
        lease.check()
        each(batch, batch_id, lease)
        if merge:
            merge_batches(batch.sparkSession, journal, source_id, batch_id, JOURNAL_SCHEMA)

    writer = stream.writeStream.foreachBatch(fenced).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def at_least_once(stream: DataFrame, step: Step, group_id: str, out: str, journal: str, checkpoint: str, source_id: str = "job", once: bool = True, interval: str = "10 seconds", hook: Hook | None = None) -> StreamingQuery:
    """Output, then commit: a failure between the two repeats the batch, which overwrites itself."""
    hook = hook or (lambda name, batch: None)

    def each(batch: DataFrame, batch_id: int, lease: Lease) -> None:
        with _held(batch) as rows:
            hook("output", batch_id)
            _put(_tagged(step(rows), source_id, batch_id), out, source_id, batch_id)
            hook("commit", batch_id)
            lease.check()
            commit_batch(committable(rows, group_id), journal, source_id, batch_id)

    return _start(stream, each, checkpoint, once, interval, journal, source_id, group_id)


#: Both are keyed by batch, and readers use ``read_visible``: so what is seen is exactly once.
exactly_once = at_least_once


def at_most_once(stream: DataFrame, step: Step, group_id: str, out: str, journal: str, checkpoint: str, source_id: str = "job", once: bool = True, interval: str = "10 seconds", hook: Hook | None = None) -> StreamingQuery:
    """Commit, then output: a batch that is in the journal already is not put out again."""
    hook = hook or (lambda name, batch: None)

    def each(batch: DataFrame, batch_id: int, lease: Lease) -> None:
        if _exists(batch.sparkSession, _folder(journal, source_id, batch_id)):
            return
        with _held(batch) as rows:
            hook("commit", batch_id)
            lease.check()
            commit_batch(committable(rows, group_id), journal, source_id, batch_id)
            hook("output", batch_id)
            _put(_tagged(step(rows), source_id, batch_id), out, source_id, batch_id)

    return _start(stream, each, checkpoint, once, interval, journal, source_id, group_id)


def transactional(stream: DataFrame, step: Step, group_id: str, out: str, journal: str, committed: str, checkpoint: str, transactional_id: str, once: bool = True, interval: str = "100 milliseconds", hook: Hook | None = None) -> StreamingQuery:
    """Records and positions become visible together: with the batch's row in ``committed``.

    Output carries source_id, the transactional id, and txn_id, the batch's: two jobs number their
    own. Readers take ``committed_records``. See ``transactions`` for several batches in one.
    """
    if not transactional_id:
        raise ValueError("a transactional id must not be empty")
    hook = hook or (lambda name, batch: None)

    def each(batch: DataFrame, batch_id: int, lease: Lease) -> None:
        with _held(batch) as rows:
            hook("output", batch_id)
            _put(step(rows).withColumns({"source_id": F.lit(transactional_id), "txn_id": F.lit(batch_id).cast("long")}), out, transactional_id, batch_id)
            hook("commit", batch_id)
            lease.check()
            commit_batch(committable(rows, group_id), journal, transactional_id, batch_id)
        hook("transaction", batch_id)
        lease.check()
        row = batch.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("txn_id"), F.lit(transactional_id).alias("source_id"))
        _put(row.coalesce(1), committed, transactional_id, batch_id)

    return _start(stream, each, checkpoint, once, interval, journal, transactional_id, group_id)


def ends_before(spark: SparkSession, out: str, source_id: str, batch_id: int) -> DataFrame:
    """Each partition's next offset in ``out`` before a batch: (topic, partition, end).

    A batch leaves the ends of all partitions, so a job reads those of its own last batch; only
    its first one reads what other jobs have left.
    """
    own = [int(n[6:]) for n in _children(spark, f"{out}-ends/source={source_id}") if n.startswith("batch=") and int(n[6:]) < batch_id]
    whole = [b for b in sorted(own, reverse=True)[:2] if _exists(spark, _folder(f"{out}-ends", source_id, b))]
    if whole:
        return spark.read.schema(ENDS_SCHEMA).parquet(_folder(f"{out}-ends", source_id, whole[0]))
    newest = {}
    for f in batch_folders(spark, f"{out}-ends"):
        source, _, batch = f.rpartition("/")
        if source != f"{out}-ends/source={source_id}":
            newest[source] = max(newest.get(source, -1), int(batch[6:]))
    if not newest:
        return spark.createDataFrame([], ENDS_SCHEMA)
    return spark.read.schema(ENDS_SCHEMA).parquet(*[f"{s}/batch={b}" for s, b in newest.items()]).groupBy("topic", "partition").agg(F.max("end").alias("end"))


def put_ends(spark: SparkSession, before: DataFrame, out: str, source_id: str, batch_id: int) -> None:
    """Keeps the ends of all partitions after a batch that has been written; those of the batch before the last are no longer needed."""
    written = end_offsets(spark.read.parquet(_folder(out, source_id, batch_id)))
    after = before.select("topic", "partition", "end").unionByName(written).groupBy("topic", "partition").agg(F.max("end").alias("end"))
    _put(after.coalesce(1), f"{out}-ends", source_id, batch_id)
    if batch_id >= 2:
        _remove(spark, _folder(f"{out}-ends", source_id, batch_id - 2))


def refused_by(results: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """The results; reading them raises at a refused envelope whose error stops the job, or has it start again."""
    found = directive(F.col("error_code"), policy)
    message = F.concat(F.lit("record refused: "), F.col("error_code"))
    return results.filter(F.when(found.isin("stop", "restart"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def pipeline(stream: DataFrame, envelopes: Step, partitions: int, group_id: str, out: str, results: str, journal: str, checkpoint: str, source_id: str = "job", once: bool = True, interval: str = "10 seconds", policy: Mapping[str, str] | None = None) -> StreamingQuery:
    """Consume, transform, produce, commit, with two outputs from one stream: records and results.

    ``envelopes`` makes (envelope_id, records, pass_through) of a batch; pass_through is ``commit``.
    Offsets go on from those of the batches before: the next ones are kept beside ``out``. A refused
    envelope is a result like others, unless a ``policy`` says that its error stops the job.
    """

    def each(batch: DataFrame, batch_id: int, lease: Lease) -> None:
        with _held(batch) as rows:
            made = envelopes(committable(rows, group_id))
            before = ends_before(batch.sparkSession, out, source_id, batch_id)
            _put(_tagged(sent_records(made, partitions, before), source_id, batch_id), out, source_id, batch_id)
            put_ends(batch.sparkSession, before, out, source_id, batch_id)
            done = _tagged(results_of(made, _read_back(batch.sparkSession, out, source_id, batch_id)), source_id, batch_id)
            _put(done if policy is None else refused_by(done, policy), results, source_id, batch_id)
            lease.check()
            done = _read_back(batch.sparkSession, results, source_id, batch_id)
            commit_batch(done.select(F.col("pass_through").alias("commit")), journal, source_id, batch_id)

    return _start(stream, each, checkpoint, once, interval, journal, source_id, group_id)


def commit_with_context(stream: DataFrame, journal: str, checkpoint: str, source_id: str = "job", once: bool = True, interval: str = "10 seconds") -> StreamingQuery:
    """Commits the positions of ``(element, commit)`` rows; elements are dropped."""
    return _start(stream, lambda batch, batch_id, lease: commit_batch(batch.select("commit"), journal, source_id, batch_id), checkpoint, once, interval, journal, source_id, source_id)


def for_each_result(results: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, interval: str = "10 seconds") -> StreamingQuery:
    """Calls ``action(rows, batch id)`` for every batch of a stream, such as a job's results.

    A batch that fails is given again: an action that must not repeat keeps the batch id.
    """
    writer = results.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def drain(query: StreamingQuery, timeout: float | None = None, once: bool = True) -> None:
    """Lets a query finish what there is to read, stops it in any case, and raises what it failed with.

    A job started with ``once`` ends by itself; give ``once=False`` for one that would run on.
    After ``timeout`` seconds it is stopped where it stands: its next run goes on from there.
    """
    try:
        if query.isActive and not once and timeout is None:
            query.processAllAvailable()
        elif query.isActive:
            query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    except StreamingQueryException:
        pass  # raised below
    finally:
        error = query.exception()
        query.stop()
    if error is not None:
        raise error


def stop_after_all(query: StreamingQuery) -> None:
    """For a query that would run on: all that is there is processed, then it stops."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def stop_now(query: StreamingQuery) -> None:
    """Stops where it stands: a batch under way is given up, and begun again by the next run."""
    query.stop()


def paced(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, interval: str = "1 second") -> StreamingQuery:
    """A batch for each interval and no sooner. With a source that bounds its batches (``maxRecordsPerPartition``,
    ``maxFilesPerTrigger``) that is so many records an interval at most."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def first_sights(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Partition events: one row when a topic's partition is first seen."""
    seen = stream.select("topic", "partition").dropDuplicates(["topic", "partition"])
    return seen.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The count of each partition so far, as state: each batch puts out the partitions it touched."""
    counts = stream.groupBy("topic", "partition").agg(F.count("*").alias("n"))
    each = lambda batch, batch_id: _put(_tagged(batch, "counts", batch_id), out, "counts", batch_id)
    return counts.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
