"""Sources: slices of a log, alone or with the position that is to be committed.

A null topic or partition makes a partition of its own, which no subscription, assignment or start names; it begins at the
default. A null offset is before every start: such a record is read only where no start applies. Repeated
records are records like others, empty logs give empty results. A column that a function adds
takes the place of one of its name: ``commit``, ``element``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .log import PARTITION
from .subscribe import Subscription


def plain_source(log: DataFrame, subscription: Subscription) -> DataFrame:
    """The records of a subscription; positions are the caller's business."""
    return log.filter(subscription.predicate)


def multi_assignment_source(log: DataFrame, assignments: DataFrame) -> DataFrame:
    """Several manual assignments ``(assign_id, topic, partition, start)`` served by one scan.

    A row for each assignment that covers it. A null start is 0; a null topic or partition
    matches nothing.
    """
    assigned = assignments.withColumnRenamed("start", "__start")
    return log.join(assigned, list(PARTITION)).filter(F.col("offset") >= F.coalesce("__start", F.lit(0))).drop("__start")


def committable(records: DataFrame, group_id: str, metadata: Column | None = None) -> DataFrame:
    """Adds ``commit``: the position that a group commits once the record is done."""
    metadata = F.lit("") if metadata is None else metadata
    return records.withColumn("commit", F.struct(F.lit(group_id).alias("group_id"), "topic", "partition", "offset", metadata.alias("metadata")))


def committable_source(log: DataFrame, subscription: Subscription, group_id: str, metadata: Column | None = None) -> DataFrame:
    """The records of a subscription, each with its position in ``commit``; null metadata stays null."""
    return committable(plain_source(log, subscription), group_id, metadata)


def committable_multi_assignment_source(log: DataFrame, assignments: DataFrame, group_id: str) -> DataFrame:
    """``multi_assignment_source`` with ``commit``: a record that several assignments cover has it in each row."""
    return committable(multi_assignment_source(log, assignments), group_id)


def with_offset_context(records: DataFrame) -> DataFrame:
    """Only ``element`` and ``commit``: the element may be mapped while the position rides along."""
    return records.select(F.struct(*[c for c in records.columns if c != "commit"]).alias("element"), "commit")


def map_element(contextual: DataFrame, element: Column) -> DataFrame:
    """Another element with the same position; a null one keeps its position too, so that it is committed."""
    return contextual.withColumn("element", element)


def partitioned_source(records: DataFrame) -> DataFrame:
    """Records of a partition together and in offset order, for per-partition work: null offsets first, ties in no fixed order.

    A partition is one task's work, however hot: what runs along offsets does better with
    ``operators.partitioned``, whose tasks take ranges of them.
    """
    return records.repartition(*PARTITION).sortWithinPartitions(*PARTITION, "offset")


def from_starts(log: DataFrame, starts: DataFrame, default: Column | None = None) -> DataFrame:
    """Records from the start of their partition on: ``starts(topic, partition, start)``.

    A partition without a start, or with a null one, begins at ``default``, or else at 0. Of several
    starts of one partition the least counts.
    """
    default = F.lit(0) if default is None else default
    starts = starts.groupBy(*PARTITION).agg(F.min("start").alias("__start"))
    return log.join(starts, list(PARTITION), "left").filter(F.col("offset") >= F.coalesce("__start", default)).drop("__start")


def manual_offset_source(log: DataFrame, subscription: Subscription, offsets_on_assign: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Start offsets come from a function of the assigned partitions, which returns (topic, partition, start)."""
    records = plain_source(log, subscription)
    return from_starts(records, offsets_on_assign(records.select(*PARTITION).distinct()))


def end_offsets(log: DataFrame) -> DataFrame:
    """The next offset of each partition that has records; null where all its offsets are."""
    return log.groupBy(*PARTITION).agg((F.max("offset") + 1).alias("end"))


def offsets_for_time(log: DataFrame, timestamp: Column) -> DataFrame:
    """The first offset at or after a time in each partition; null where there is none. Records without a time are passed over."""
    return log.groupBy(*PARTITION).agg(F.min(F.when(F.col("timestamp") >= timestamp, F.col("offset"))).alias("start"))


def start_positions(log: DataFrame, positions: DataFrame, policy: str = "latest") -> DataFrame:
    """Where each partition starts: its committed position, else the log's first or next offset."""
    if policy not in ("earliest", "latest"):
        raise ValueError(f"unknown start policy: {policy}")
    ends = log.groupBy(*PARTITION).agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("end"))
    default = F.col("end") if policy == "latest" else F.col("first")
    known = positions.select(*PARTITION, F.col("next_offset").alias("known"))
    return ends.join(known, list(PARTITION), "left").select(*PARTITION, F.coalesce("known", default).alias("start"))


def seek(starts: DataFrame, overrides: DataFrame) -> DataFrame:
    """Starts with those of ``overrides(topic, partition, start)`` in their place; a null override changes nothing."""
    new = overrides.select(*PARTITION, F.col("start").alias("new"))
    return starts.join(new, list(PARTITION), "full").select(*PARTITION, F.coalesce("new", "start").alias("start"))


def _transaction(log: DataFrame, txns: DataFrame) -> list[str]:
    """What names a transaction in both: its source too, where they have it, as sources number their own."""
    return [c for c in ("source_id", "txn_id") if c in log.columns and c in txns.columns]


def committed_records(log: DataFrame, committed_txns: DataFrame) -> DataFrame:
    """Records outside transactions (a null txn_id), and those of committed ones: ``(txn_id)`` or ``(source_id, txn_id)``.

    Rows of one transaction that are given twice count once. Where transactions of several sources are
    in one log, both tables are to have source_id.
    """
    keys = _transaction(log, committed_txns)
    done = committed_txns.select(*[F.col(c).alias(f"__{c}") for c in keys]).distinct()
    joined = log.join(done, [log[c] == done[f"__{c}"] for c in keys], "left")
    return joined.filter("txn_id is null or __txn_id is not null").drop(*[f"__{c}" for c in keys])


def stable_ends(log: DataFrame, txns: DataFrame) -> DataFrame:
    """The last stable offset of each partition that has one: the first record of a transaction that is still open.

    ``txns``: (source_id, txn_id, state), state committed or aborted; a transaction of which
    neither is known is open.
    """
    keys = _transaction(log, txns)
    ended = txns.filter(F.col("state").isin("committed", "aborted")).select(*keys).distinct()
    open_ones = log.filter(F.col("txn_id").isNotNull()).join(ended, keys, "left_anti")
    return open_ones.groupBy(*PARTITION).agg(F.min("offset").alias("stable_end"))


def stable_records(log: DataFrame, txns: DataFrame) -> DataFrame:
    """What a read-committed consumer may see: committed records before the first open transaction of their partition.

    So it never sees a record whose predecessor may still appear. Records of aborted
    transactions are left out without holding others up.
    """
    ends = stable_ends(log, txns)
    ends = ends.select(*[F.col(c).alias(f"__{c}") for c in PARTITION], "stable_end")
    seen = committed_records(log, txns.filter(F.col("state") == "committed"))
    bounded = seen.join(ends, [seen[c].eqNullSafe(ends[f"__{c}"]) for c in PARTITION], "left")
    return bounded.filter("stable_end is null or offset < stable_end").select(*log.columns)


def topic_metadata(log: DataFrame) -> DataFrame:
    """Each topic with its partitions, first and next offsets and records."""
    # two steps: the distinct count then needs no second copy of the log
    by_partition = log.groupBy(*PARTITION).agg(F.min("offset").alias("lo"), (F.max("offset") + 1).alias("hi"), F.count("*").alias("n"))
    return by_partition.groupBy("topic").agg(F.count("*").alias("parts"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))


def consumer_lag(log: DataFrame, positions: DataFrame) -> DataFrame:
    """How many records of each partition a group has not read: all, where it has no position. Below 0 where it is beyond the end."""
    known = positions.select(*PARTITION, "next_offset")
    lag = F.col("end") - F.coalesce("next_offset", F.lit(0))
    return end_offsets(log).join(known, list(PARTITION), "left").select(*PARTITION, F.coalesce("next_offset", F.lit(0)).alias("next_offset"), "end", lag.alias("lag"))
