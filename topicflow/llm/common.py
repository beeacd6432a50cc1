"""What the operators share: the shared work folder, stored tables, word rules, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workdir import work_path as workspace

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; null is the empty string."""
    return F.translate(F.coalesce(c, F.lit("")), _UPPER, _LOWER)


def id_remainder(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def give_back() -> None:
    """Returns memory that is free in this process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def lean(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function over batches, so that what a task has held goes back to the system at its end.

    Python workers live on from task to task beside those of other stages, and an allocator that
    keeps its peak would take the room of an executor's other processes.
    """

    @wraps(f)
    def run(batches: Any) -> Iterator:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = workspace(spark, name)
    schema = df.schema
    df.write.parquet(path)
    if _scratch:
        _scratch[-1].append(path)
    return spark.read.schema(schema).parquet(path)


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Inside, the paths of the tables that ``stored`` writes are listed; those still in the list at the end are removed.

    For results that are written before the end. What is to stay is taken from the list.
    """
    made: list[str] = []
    _scratch.append(made)
    try:
        yield made
    finally:
        _scratch.pop()
        _delete(spark, made)


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for folder in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``stored`` wrote and nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, {f.rpartition("/")[0] for f in df.inputFiles()})


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, component)`` per node on an edge.

    The component is the smallest node id in it. Alternating large-star and small-star rounds;
    each step is a pre-aggregated minimum and a join whose two sides both come from stored
    tables, so that the adaptive skew join can split a hot centre. A round's tables are removed
    once the next one's edges are written. Self loops and repeats are ignored; no edges give no rows.
    """
    e = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges"
    )
    before = None
    while True:  # settles in a number of rounds that grows with the logarithm of the nodes
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        # every larger neighbour v of u is linked to the smallest of u's neighbourhood
        large = stored(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large")
        least = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        moved = large.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        old, e = e, stored(moved.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        discard(old, low, large, least)
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
