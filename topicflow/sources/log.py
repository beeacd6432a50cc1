"""The topic log: a table of records in partitions, each in dense offset order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("txn_id", T.LongType()),
    ]
)
PARTITION = ("topic", "partition")


def dense_offsets(df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column | None = None, name: str = "offset") -> DataFrame:
    """Adds 0, 1, 2 ... in ``order`` within each ``by``.

    Without ``bucket`` this is one window per group. ``bucket`` must not decrease along
    ``order``: rows are then numbered inside (by, bucket), where the work is spread out, and the
    counts of earlier buckets are added - one small row per (by, bucket). Nulls in ``by`` make a
    group of their own, nulls in ``bucket`` come first; ties in ``order`` are numbered in no
    fixed order. A column called ``name`` is replaced. An empty table gives none.
    """
    if bucket is None:
        return df.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long"))
    df = df.withColumn("__bucket", bucket)
    counts = df.groupBy(*by, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*by, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy(*by, "__bucket").orderBy(*order)) - 1
    numbered, keys = df.withColumn("__inside", inside), [*by, "__bucket"]
    counts = counts.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(keys)], "__base")
    same = [numbered[c].eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(keys)]
    joined = numbered.join(counts, same).withColumn(name, (F.col("__base") + F.col("__inside")).cast("long"))
    return joined.drop("__bucket", "__inside", "__base", *[f"__{i}" for i in range(len(keys))])


def log_of_events(events: DataFrame, partitions: int = 3, bucket_rows: int = 1 << 16) -> DataFrame:
    """The log of an event table: topic by type, partition by user, offset by event_id.

    Keeps event_id, user_id and amount beside the log's own columns.
    """
    rows = events.select(
        F.col("event_type").alias("topic"), F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("user_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"),
        F.col("ts").alias("timestamp"), "event_id", "user_id", F.col("value").alias("amount"),
    )
    numbered = dense_offsets(rows, PARTITION, ["event_id"], F.floor(F.col("event_id") / bucket_rows))
    return numbered.select("topic", "partition", "offset", "key", "value", "timestamp", "event_id", "user_id", "amount")


def write_log(records: DataFrame, path: str, mode: str = "append", ranges: bool = False) -> None:
    """Appends records to a log's files: folders for topics and partitions, sorted by offset.

    One file for each partition and append, whose rows a stream then reads in order: several
    could reach it in any order. So what is appended at once to a hot partition is one task's
    work. With ``ranges`` tasks take ranges of offsets, for logs that are read in batches. Streams of hot
    partitions read a ``topiclog`` instead. One writer per topic: next offsets come from what the log holds.
    """
    dealt = records.repartitionByRange(*PARTITION, "offset") if ranges else records.repartition(*PARTITION)
    dealt.sortWithinPartitions(*PARTITION, "offset").write.mode(mode).partitionBy(*PARTITION).parquet(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_log(spark: SparkSession, path: str, files_per_batch: int | None = None, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """The log as a stream; ``files_per_batch`` bounds the intake of one micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def topic_or_empty(log: DataFrame, topics: Sequence[str], auto_create: bool = True) -> DataFrame:
    """The log's records of the topics. One that does not exist is empty, or an error without ``auto_create``."""
    found = log.filter(F.col("topic").isin(*topics))
    if auto_create:
        return found
    have = {r[0] for r in found.select("topic").distinct().limit(len(topics)).collect()}
    missing = sorted(set(topics) - have)
    if missing:
        raise ValueError(f"unknown topics: {', '.join(missing)}")
    return found


def element_range(spark: SparkSession, first: int, last: int, step: int = 1, name: str = "element") -> DataFrame:
    """The numbers from first to last, both included, dealt over tasks. None where first is beyond last."""
    if not step:
        raise ValueError("a range needs a step")
    return spark.range(first, last + (1 if step > 0 else -1), step).withColumnRenamed("id", name)


def cycle(df: DataFrame, number: str, n: int, name: str = "element") -> DataFrame:
    """An endless 1..n, dealt out by a running number."""
    return df.withColumn(name, (F.pmod(F.col(number), F.lit(n)) + 1).cast("long"))
