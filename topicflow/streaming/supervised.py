"""A job that does what the policy table says of bad records: stops, drops them into a dead-letter folder, or starts again."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.policy import RESTART, RESUME, STOP, directive, policy
from ..sources.log import PARTITION
from ..sources.readers import committable
from .jobs import _children, _put, _start, _tagged, commit_batch, drain, read_batches
from .lease import Lease

#: What is kept of a record that was dropped.
LETTER_SCHEMA = "topic string, partition int, offset bigint, raw_key binary, raw_value binary, error_code string, directive string, source_id string, commit_seq bigint"


class Stopped(RuntimeError):
    """A record whose error stops the job, or one restart too many."""


def _decide(rows: DataFrame, table: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Records before the first one of their partition that fails the job, with ``directive``; and these first ones."""
    marked = rows.withColumn("directive", directive(F.col("error_code"), table))
    fails = marked.filter(F.col("directive").isin(STOP, RESTART))
    first = fails.groupBy(*PARTITION).agg(F.min("offset").alias("__until"), F.min_by(F.struct("directive", "error_code"), "offset").alias("__why"))
    ends = first.select(*[F.col(c).alias(f"__{c}") for c in PARTITION], "__until")
    joined = marked.join(ends, [marked[c].eqNullSafe(ends[f"__{c}"]) for c in PARTITION], "left")
    return joined.filter("__until is null or offset < __until").select(*marked.columns), first


def supervised(stream: Callable[[], DataFrame], decode: Callable[[DataFrame, int], DataFrame], group_id: str, root: str, source_id: str = "job", overrides: Mapping[str, str] | None = None, retries: int = 3, interval: str = "10 seconds", once: bool = True) -> int:
    """Runs a job under the policy table until its input is read; the number of its last epoch.

    ``decode(batch, epoch)`` adds error_code (null: good), and raw_key and raw_value where a dead letter is
    to hold them. Under ``root``: out (good records, their source_id naming the epoch), letters
    (LETTER_SCHEMA), journal, and a checkpoint for each epoch.

    - resume: the record goes to the letters of its batch, and the job goes on.
    - stop: the records before it in its partition are put out and committed, then ``Stopped`` is raised. The next
      run begins with the same batch.
    - restart: what comes before is put out and committed likewise; then a new epoch reads from the stream's start position
      again, ``retries`` times at most. ``last_epoch`` has what the last one has put out.

    Other errors are raised as they are; the next run goes on with the last epoch. Null topics or partitions make partitions
    of their own. Offsets order the records of a partition; they are not to be null.
    """
    table = policy(overrides)
    spark = stream().sparkSession
    known = [int(n[6:]) for n in _children(spark, f"{root}/checkpoints") if n.startswith("epoch=")]
    epoch = max(known, default=0)
    for left in range(retries, -1, -1):
        why: list[tuple[str, str]] = []

        def each(batch: DataFrame, number: int, lease: Lease, epoch: int = epoch, why: list[tuple[str, str]] = why) -> None:
            name = f"{source_id}-{epoch}"
            rows = decode(batch, epoch).persist()
            try:
                before, first = _decide(rows, table)
                good = before.filter("error_code is null").drop("error_code", "directive", "raw_key", "raw_value")
                _put(_tagged(good, name, number), f"{root}/out", name, number)
                letters = before.filter(F.col("directive") == RESUME)
                kept = [F.col(c) if c in before.columns else F.lit(None).cast("binary").alias(c) for c in ("topic", "partition", "offset", "raw_key", "raw_value", "error_code", "directive")]
                _put(_tagged(letters.select(*kept), name, number), f"{root}/letters", name, number)
                lease.check()
                commit_batch(committable(before.select(*PARTITION, "offset"), group_id), f"{root}/journal", name, number)
                # one row for each partition that failed: a stop among them counts
                worst = first.select("__why.*").orderBy(F.col("directive") != STOP, "error_code").first()
            finally:
                rows.unpersist()
            if worst is not None:
                why.append((worst["directive"], worst["error_code"]))
                raise Stopped(f"record failed: {worst['error_code']}, {worst['directive']}")

        try:
            drain(_start(stream(), each, f"{root}/checkpoints/epoch={epoch}", once, interval, f"{root}/journal", f"{source_id}-{epoch}", group_id), once=once)
            return epoch
        except StreamingQueryException:
            if not why:
                raise
            if why[-1][0] == STOP or not left:
                raise Stopped(f"record failed: {why[-1][1]}, {why[-1][0]}") from None
            epoch += 1
    raise AssertionError("unreachable")


def with_epoch(rows: DataFrame) -> DataFrame:
    """Adds ``epoch``, which the source's name ends with."""
    return rows.withColumn("epoch", F.regexp_extract("source_id", "-([0-9]+)$", 1).cast("int"))


def last_epoch(spark: SparkSession, root: str, schema: str, source_id: str = "job") -> DataFrame:
    """What the last epoch of a job has put out, once: earlier epochs are as if they had not been."""
    rows = read_batches(spark, f"{root}/out", schema)
    epochs = [int(n.rpartition("-")[2]) for n in _children(spark, f"{root}/out") if n.startswith(f"source={source_id}-")]
    return rows.filter(F.col("source_id") == f"{source_id}-{max(epochs, default=0)}")
