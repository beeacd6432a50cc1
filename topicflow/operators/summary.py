"""Aggregates over a log, and audits of what was delivered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.log import PARTITION
from ..workdir import work_path
from .partitioned import RANGE


def partition_totals(records: DataFrame) -> DataFrame:
    """Records of each partition, each topic and in all (null: any)."""
    return records.rollup(*PARTITION).agg(F.count("*").alias("n"))


def all_hold(records: DataFrame, condition: Column, *by: str) -> DataFrame:
    return records.groupBy(*by).agg(F.every(condition).alias("ok"), F.count("*").alias("n"))


def exact_median(records: DataFrame, x: Column, *by: str) -> DataFrame:
    """The median of each group, ``(by..., median)``: of an even number of values the mean of the middle two.

    Values are counted, then sorted in ranges over all groups, so that a group of any size is many
    tasks: the sums of the ranges before it tell each where its ranks begin, and the one
    or two values at the middle are picked. No task holds a group. Nulls don't count, NaN is
    the largest; a group without values has none, and no row; null keys make a group of their own.
    """
    keys = [f"__by{i}" for i in range(len(by))]
    counted = records.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], x.cast("double").alias("__x")).filter("__x is not null").groupBy(*keys, "__x").agg(F.count("*").alias("__n"))
    # the ranges are written down: read twice, they have to be the same
    spark, path = records.sparkSession, work_path(records.sparkSession, "ranges")
    counted.repartitionByRange(*keys, "__x").withColumn("__range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema(counted.withColumn("__range", F.lit(0)).schema).parquet(path)
    same = lambda a, b: [a[k].eqNullSafe(b[f"{k}_"]) for k in keys]
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*keys, "__range").agg(F.sum("__n").alias("__sum"))  # a row for each range, and one more for each group in it
    sums = sums.select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("__range").alias("__range_"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"), F.sum("__sum").over(Window.partitionBy(*keys)).alias("__all"), "__sum")
    low, high = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    sums = sums.filter((F.col("__base") < high) & (F.col("__base") + F.col("__sum") >= low))  # ranges with a middle rank
    middle = ranged.join(sums, [*same(ranged, sums), ranged["__range"] == sums["__range_"]])
    upto = F.col("__base") + F.sum("__n").over(Window.partitionBy(*keys, "__range").orderBy("__x"))
    placed = middle.withColumn("__upto", upto)
    hit = lambda rank: (F.col("__upto") - F.col("__n") < rank) & (rank <= F.col("__upto"))
    picked = placed.groupBy(*keys).agg(F.max(F.when(hit(low), F.col("__x"))).alias("__low"), F.max(F.when(hit(high), F.col("__x"))).alias("__high"))
    return picked.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], ((F.col("__low") + F.col("__high")) / 2).alias("median"))


def sample_summary(records: DataFrame, x: Column, *by: str) -> DataFrame:
    """Mean, standard error (population deviation over the root of n), deviation, exact median, maximum.

    Nulls don't count; a group of nulls only has nulls. No group has no row, but over all
    records there is always one.
    """
    sums = records.groupBy(*by).agg(F.avg(x).alias("mean"), (F.stddev_pop(x) / F.sqrt(F.count(x))).alias("std_error"), F.stddev_pop(x).alias("std_dev"), F.max(x).alias("max"))
    medians = exact_median(records, x, *by)
    medians = medians.select(*[F.col(c).alias(f"__{c}") for c in by], "median")
    joined = sums.join(medians, [sums[c].eqNullSafe(medians[f"__{c}"]) for c in by] or F.lit(True), "left")
    return joined.select(*by, "mean", "std_error", "std_dev", "median", "max")


def delivery_audit(log: DataFrame, output: DataFrame) -> DataFrame:
    """Per partition: records expected, delivered, missing, repeated and not in the log; gaps in what came.

    Both sides are dealt by ranges of offsets, so that a hot partition is many tasks, and counted
    there in one shuffle; a run of what came that begins where the one before it does not end
    makes a gap, which between ranges is seen from their first and last offsets. A null topic or
    partition is one of its own. Null offsets are counted, as one value, without gaps.
    """
    key = [*PARTITION, "offset"]
    rows = log.select(*key, F.lit(1).alias("want"), F.lit(0).alias("got")).unionAll(output.select(*key, F.lit(0), F.lit(1)))
    rows = rows.withColumn("__range", F.floor(F.col("offset") / RANGE)).repartition(*PARTITION, "__range")
    each = rows.groupBy(*PARTITION, "__range", "offset").agg(F.sum("want").alias("want"), F.sum("got").alias("got"))
    came = F.when(F.col("got") > 0, F.col("offset"))
    before = F.last(came, ignorenulls=True).over(Window.partitionBy(*PARTITION, "__range").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("run", (came.isNotNull() & (before.isNull() | (before != F.col("offset") - 1))).cast("long"))
    ranges = each.groupBy(*PARTITION, "__range").agg(
        F.sum("want").alias("expected"), F.sum("got").alias("delivered"),
        F.sum(((F.col("want") > 0) & (F.col("got") == 0)).cast("long")).alias("missing"), F.sum((F.col("got") > 1).cast("long")).alias("repeated"),
        F.sum(((F.col("want") == 0) & (F.col("got") > 0)).cast("long")).alias("unknown"), F.sum("run").alias("runs"), F.min(came).alias("low"), F.max(came).alias("high"),
    )
    # a row for each range from here on; one that begins where the last one ends goes on with its run
    last = F.last("high", ignorenulls=True).over(Window.partitionBy(*PARTITION).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("runs", F.col("runs") - F.coalesce((last == F.col("low") - 1).cast("long"), F.lit(0)))
    sums = [F.sum(c).alias(c) for c in ("expected", "delivered", "missing", "repeated", "unknown")]
    return ranges.groupBy(*PARTITION).agg(*sums, F.greatest(F.sum("runs") - 1, F.lit(0)).alias("gaps"))
