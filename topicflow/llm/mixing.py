"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """``(source, source_size)``, one row per source, with ``target`` added.

    Sources in code point order, null last, get the weights in turn. They share the total by
    weight; a target stops at ``most`` times its source's size and the excess is shared again.
    That fixed point is found directly: with sources sorted by most * size / weight, the ones
    that stop are a prefix. One row per source; sources are few against documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    by_ratio = Window.orderBy(F.col("ratio"), F.col("rank"))
    whole = Window.partitionBy(F.lit(1))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("weight", weight)
        .withColumn("ratio", cap / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("all_weight", F.sum("weight").over(whole))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        # the first source whose share lies under its cap sets the level of all after it
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(whole)["level"])
        .withColumn("target", F.least(cap, F.coalesce(F.col("level") * F.col("weight"), cap)))
        .select("source", "source_size", "target")
    )


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, seed: str = "mix", carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken (and ``carry``).

    Within a source documents are in the order of a hash of seed and id. A source whose target
    is e times its size and a rest gives every document e times, and once more those before the
    point where the prefix sum of sizes crosses the rest (the one on it if its middle lies
    before it). So a source misses its target by half a document at most, and reruns agree.

    Range-sorted by (source, key, id), so a hot source lies in many partitions; each partition's
    sums per source are added up over partitions, and running sums stay inside a partition.
    Null text: size 0. Null source: a source of its own, last. Rows that repeat an id follow
    each other and count each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = docs.select(
        "doc_id", *carry, F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("__source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("__key"),
    )
    sized = stored(sized, "sizes")  # the range sort samples it, and texts are read once
    by = ["no_source", "__source"]
    totals = sized.groupBy(*by).agg(F.sum("size").alias("source_size"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        sized.repartitionByRange(n, *by, "__key", "doc_id", "size").sortWithinPartitions(*by, "__key", "doc_id", "size").withColumn("part", F.spark_partition_id()),
        "ranged",
    )
    targets = source_targets(totals.select(F.when(~F.col("no_source"), F.col("__source")).alias("source"), "source_size"), weights, most)
    targets = targets.select(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("__source"), "source_size", "target")
    parts = ranged.groupBy("part", *by).agg(F.sum("size").alias("in_part"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("base", F.coalesce(F.sum("in_part").over(earlier), F.lit(0))).join(targets, by)
    parts = stored(parts.drop("in_part"), "parts")
    here = Window.partitionBy("part", *by).orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("__before", F.coalesce(F.sum("size").over(here), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    rest = F.col("target") - epochs * F.col("source_size")
    extra = (F.col("base") + F.col("__before") + F.col("size") / 2 <= rest) & (F.col("source_size") > 0) & (rest > 0)
    copies = (epochs + extra.cast("int")).cast("long")
    return (
        local.join(parts, ["part", *by])
        .withColumn("copies", copies)
        .select("doc_id", *carry, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
