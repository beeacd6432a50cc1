"""What runs along each partition in offset order.

Partitions are numbered in ranges of offsets, so that a hot one lies in many tasks. A null topic or
partition makes a partition of its own, a null offset comes first; records that share an offset follow
each other in no fixed order; an empty log gives an empty result. Columns that begin with two
underscores are the library's.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.log import PARTITION, dense_offsets


#: Offsets that are numbered in one task: a hot partition is many ranges of so many.
RANGE = 1 << 16


def running_count(records: DataFrame, name: str = "n", first: Column | None = None) -> DataFrame:
    """How many of the partition have come, this one included. A column called ``name`` is replaced.

    Give ``first`` where offsets are dense from it on, as in a log that is read from there: the
    count then follows from the offset, and nothing is shuffled.
    """
    if first is not None:
        return records.withColumn(name, (F.col("offset") - first + 1).cast("long"))
    numbered = dense_offsets(records, PARTITION, ["offset"], F.floor(F.col("offset") / RANGE), "__n")
    return numbered.withColumn(name, F.col("__n") + 1).drop("__n") if name != "__n" else numbered


def take(records: DataFrame, n: int, first: Column | None = None) -> DataFrame:
    """The first n of each partition. With ``first`` (see ``running_count``) that is a filter on offsets, which reaches the files.

    Else the records of each range of offsets are counted, and only ranges in which the first n
    can lie are numbered.
    """
    if first is not None:
        return records.filter(F.col("offset") < first + n)
    where = F.coalesce(F.floor(F.col("offset") / RANGE), F.lit(-1))
    counts = records.groupBy(*PARTITION, where.alias("__range")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*PARTITION).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    last = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).filter(F.col("__before") < n).groupBy(*PARTITION).agg(F.max("__range").alias("__last"))
    last = last.select(F.col("topic").alias("__topic"), F.col("partition").alias("__partition"), "__last")
    some = records.join(last, [records[c].eqNullSafe(F.col(f"__{c}")) for c in PARTITION]).filter(where <= F.col("__last")).select(*records.columns)
    return running_count(some, "__count").filter(F.col("__count") <= n).drop("__count")


def take_first(records: DataFrame, n: int, order: str = "offset") -> DataFrame:
    """The first n of one stream."""
    return records.orderBy(order).limit(n)


def chunks(records: DataFrame, n: int, name: str = "chunk", first: Column | None = None) -> DataFrame:
    """Consecutive chunks of n: together they hold every record once. ``first``: see ``running_count``."""
    return running_count(records, "__count", first).withColumn(name, F.floor((F.col("__count") - 1) / n).cast("long")).drop("__count")


def segments(records: DataFrame, marker: Column, name: str = "segment") -> DataFrame:
    """Numbers the stretches between failures: a record with the marker ends its segment."""
    marked = records.withColumns({"__mark": F.coalesce(marker.cast("int"), F.lit(0)), "__range": F.floor(F.col("offset") / RANGE)})
    sums = marked.groupBy(*PARTITION, "__range").agg(F.sum("__mark").alias("__in"))
    earlier = Window.partitionBy(*PARTITION).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"__{c}") for c in (*PARTITION, "__range")], F.coalesce(F.sum("__in").over(earlier), F.lit(0)).alias("__base"))
    before = Window.partitionBy(*PARTITION, "__range").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    here = marked.withColumn("__before", F.coalesce(F.sum("__mark").over(before), F.lit(0)))
    same = [here[c].eqNullSafe(F.col(f"__{c}")) for c in (*PARTITION, "__range")]
    return here.join(sums, same).withColumn(name, (F.col("__base") + F.col("__before")).cast("long")).select(*[c for c in records.columns if c != name], name)


def take_while(records: DataFrame, good: Column, inclusive: bool = False) -> DataFrame:
    """Each partition up to its first record that is not good (or null); with that record if inclusive."""
    ends = records.filter(~F.coalesce(good, F.lit(False))).groupBy(*PARTITION).agg(F.min("offset").alias("__end"))
    ends = ends.select(F.col("topic").alias("__topic"), F.col("partition").alias("__partition"), "__end")
    joined = records.join(ends, [records[c].eqNullSafe(F.col(f"__{c}")) for c in PARTITION], "left")
    inside = F.col("offset") <= F.col("__end") if inclusive else F.col("offset") < F.col("__end")
    return joined.filter(F.col("__end").isNull() | inside).drop("__end", "__topic", "__partition")


def merge(*streams: DataFrame) -> DataFrame:
    """Sub-streams as one; order holds inside partitions only."""
    out, *rest = streams
    for s in rest:
        out = out.unionByName(s)
    return out


def map_batches(records: DataFrame, function: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """An arbitrary function over Arrow batches, for what columns cannot express."""
    return records.mapInArrow(function, schema)


def map_in_flight(records: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, in_flight: int = 8, rows: int = 1) -> DataFrame:
    """A function that waits, such as a remote call, over ``rows`` records at a time; the results keep the records' order.

    In each task up to ``in_flight`` calls run at once, in threads of its own, and no further one
    begins before the first of them has been passed on: so results wait for those before them, and what
    a task holds is bounded. An error of a call fails its task, which Spark repeats: calls are to bear being made again.
    An empty table makes no call.
    """
    if in_flight < 1 or rows < 1:
        raise ValueError("at least one call, of one record")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque = deque()
        with ThreadPoolExecutor(in_flight) as pool:
            try:
                for b in batches:
                    for i in range(0, len(b), rows):
                        if len(waiting) == in_flight:
                            yield waiting.popleft().result()
                        waiting.append(pool.submit(function, b.slice(i, rows)))
                while waiting:
                    yield waiting.popleft().result()
            finally:
                for call in waiting:
                    call.cancel()

    return records.mapInArrow(run, schema)


def last_count_total(records: DataFrame) -> DataFrame:
    """Each partition's last running count, and the running sum of these over the partitions."""
    counts = records.groupBy(*PARTITION).agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy(*PARTITION).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.withColumn("total", running)  # one row per partition
