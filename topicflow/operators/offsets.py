"""Positions of consumer groups: folding offsets, batching commits, the offset journal.

A null group, topic or partition is one of its own. Null offsets lose against any other, and make a
null position where there is nothing else. Empty tables give none. Columns beside those named are dropped
by folds and kept by what adds columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.readers import from_starts

GROUP = ("group_id", "topic", "partition")


def fold_offsets(commits: DataFrame, seq: Column, *more: str) -> DataFrame:
    """One batch per group, topic and partition (and ``more``): the last arrival wins, whatever its offset.

    ``commits`` has the columns of ``commit``; ``seq`` is the order of arrival. batch_size
    counts what was folded. Of commits with one ``seq`` the one with the larger offset counts, then the larger metadata; a null ``seq``
    counts in no batch that has others.
    """
    last = F.max_by(F.struct("offset", "metadata"), F.struct(seq.alias("seq"), "offset", "metadata"))
    return commits.groupBy(*more, *GROUP).agg(last.alias("last"), F.count("*").alias("batch_size")).select(*more, *GROUP, "last.offset", "last.metadata", "batch_size")


def merge_batches(batches: DataFrame, batch_seq: str) -> DataFrame:
    """Batches into one: of each partition the later batch's offset, and the sum of the sizes. Ties as in ``fold_offsets``."""
    last = F.max_by(F.struct("offset", "metadata"), F.struct(F.col(batch_seq).alias("seq"), "offset", "metadata"))
    return batches.groupBy(*GROUP).agg(last.alias("last"), F.sum("batch_size").alias("batch_size")).select(*GROUP, "last.offset", "last.metadata", "batch_size")


def fold_transaction(commits: DataFrame, *more: str) -> DataFrame:
    """The next offset after a transaction: here the highest offset counts. Null offsets don't."""
    return commits.groupBy(*more, *GROUP).agg((F.max("offset") + 1).alias("next_offset"), F.count("*").alias("batch_size"))


def grouped_within(records: DataFrame, by: list[str], time: Column, interval: str, order: list[str], most: int) -> DataFrame:
    """Adds window_start and batch: up to ``most`` records in a row within one interval.

    Intervals are of the records' own time, in fixed steps, where a running job would use the
    clock (``streaming.stateful.closed_batches``). A batch is numbered within its window. Records
    without a time share a window of their own, whose start is null; null keys make groups of their own, ties in
    ``order`` are numbered in no fixed order, and columns called window_start and batch are
    replaced. An empty table gives none.
    """
    # F.window alone would drop records without a time
    start = F.window(F.coalesce(time, F.lit("1970-01-01").cast("timestamp_ntz")), interval).getField("start")
    timed = records.withColumn("__none", time.isNull()).withColumn("window_start", start)
    timed = timed.withColumn("window_start", F.when(~F.col("__none"), F.col("window_start"))).drop("__none")
    place = F.row_number().over(Window.partitionBy(*by, "window_start").orderBy(*order)) - 1
    return timed.withColumn("batch", F.floor(place / most).cast("long"))


def journal_rows(batches: DataFrame, source_id: Column, commit_seq: Column, committed_at: int | None = None) -> DataFrame:
    """Batches as rows of the journal. What is committed is the next offset to read.

    ``committed_at`` (milliseconds) orders the commits of different jobs, which number their own.
    """
    at = F.lit(committed_at).cast("long").alias("committed_at")
    return batches.select(*GROUP, (F.col("offset") + 1).alias("next_offset"), "metadata", "batch_size", source_id.alias("source_id"), commit_seq.cast("long").alias("commit_seq"), at)


def commit_one(commits: DataFrame, source_id: Column, commit_seq: Column) -> DataFrame:
    """Every commit as a batch of its own, in the journal's form: for consumers that commit record by record.

    Null offsets commit nothing and are left out; repeated commits are repeated rows.
    """
    single = commits.filter(F.col("offset").isNotNull()).select(*GROUP, "offset", "metadata", F.lit(1).cast("long").alias("batch_size"))
    return journal_rows(single, source_id, commit_seq)


def _arrival(journal: DataFrame) -> Column:
    """The order of commits: by time where the journal has it (a null one comes first), then by number, source and offset."""
    at = F.coalesce("committed_at", F.lit(-1)) if "committed_at" in journal.columns else F.lit(-1)
    return F.struct(at.cast("long").alias("at"), "commit_seq", "source_id", "next_offset")


def current_positions(journal: DataFrame) -> DataFrame:
    """The latest commit of each group, topic and partition."""
    last = F.max_by(F.struct("next_offset", "metadata"), _arrival(journal))
    return journal.groupBy(*GROUP).agg(last.alias("last")).select(*GROUP, "last.next_offset", "last.metadata")


def compact_journal(journal: DataFrame) -> DataFrame:
    """One row a position, with all that were folded into it."""
    last = F.max_by(F.struct("next_offset", "metadata", "source_id", "commit_seq"), _arrival(journal))
    folded = journal.groupBy(*GROUP).agg(last.alias("last"), F.sum("batch_size").alias("batch_size"))
    return folded.select(*GROUP, "last.next_offset", "last.metadata", "batch_size", "last.source_id", "last.commit_seq")


def resume(log: DataFrame, journal: DataFrame, group_id: str) -> DataFrame:
    """The log from where a group left off; other groups' commits do not count."""
    starts = current_positions(journal.filter(F.col("group_id") == group_id)).select("topic", "partition", F.col("next_offset").alias("start"))
    return from_starts(log, starts)


def groups_of_many_sources(commits: DataFrame) -> DataFrame:
    """Groups whose commits come from more than one source, which a batch may not hold."""
    pairs = commits.select("group_id", "source_id").distinct()
    return pairs.groupBy("group_id").agg(F.count("*").alias("sources")).filter("sources > 1")


def guarded(commits: DataFrame) -> DataFrame:
    """The commits; reading them raises if a group has more than one source."""
    ok = commits.groupBy("group_id").agg(F.min("source_id").alias("__a"), F.max("source_id").alias("__b"))
    joined = commits.join(ok, "group_id")
    message = F.concat(F.lit("more than one source commits for group "), F.col("group_id"))
    return joined.filter(F.when(F.col("__a") == F.col("__b"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).drop("__a", "__b")
