"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: Size of the table of crowded groups: 2**26 bits in at most 2**20 rows of one long each.
BITS, WORD_BITS = 1 << 26, 64


def _crowded(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """The groups of more than one row, as a bitmap of at most BITS / WORD_BITS rows (slot, bits)."""
    groups = rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    bit = F.pmod(F.xxhash64(*key), F.lit(BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % WORD_BITS).cast("int"))
    bits = groups.select(F.shiftright(bit, 6).alias("slot"), one.alias("one"))
    return stored(bits.groupBy("slot").agg(F.bit_or("one").alias("bits")), name)


def _mark(rows: DataFrame, key: list[str], bitmap: DataFrame, flag: str) -> DataFrame:
    """Adds ``flag``: false only if the row is certainly alone in its group."""
    bit = F.pmod(F.xxhash64(*key), F.lit(BITS))
    small = F.broadcast(bitmap.withColumnRenamed("slot", "__slot"))  # at most 2**20 rows, whatever the input
    hit = F.call_function("shiftright", F.col("bits"), F.col("__bit").cast("int")).bitwiseAND(F.lit(1)) == 1
    return (
        rows.withColumns({"__slot": F.shiftright(bit, 6), "__bit": bit % WORD_BITS})
        .join(small, "__slot", "left")
        .withColumn(flag, F.coalesce(hit, F.lit(False)))
        .drop("__slot", "__bit", "bits")
    )


def exact_dedup(docs: DataFrame, carry: Sequence[str] = (), text: Column | None = None, prefix_bytes: int = 256) -> DataFrame:
    """One row per row of ``docs``: doc_id, the columns in ``carry``, keep_id, group_size, kept.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal
    texts the largest doc_id stays. Three passes: rows that share their length with another,
    among these the ones that share length and prefix hash, and only for these the SHA-256 of
    the whole text. What a pass has left over is known to the next one as a bitmap of fixed
    size, so no text is shuffled and a false hit only costs one more hash. Rows that repeat a
    doc_id with its text count as rows of the group, and all of them are kept; a null doc_id
    stays only when its group has no other. An empty table gives no rows.
    """
    text = F.col("text") if text is None else text
    rows = docs.select("doc_id", *carry, F.coalesce(text, F.lit("")).alias("__text"))
    rows = rows.withColumn("__n", F.octet_length("__text"))
    by_length = _crowded(rows.select("__n"), ["__n"], "lengths")
    prefix = F.xxhash64(ascii_lower(F.substring("__text", 1, prefix_bytes)))
    near = _mark(rows, ["__n"], by_length, "__a").withColumn("__p", F.when(F.col("__a"), prefix))
    by_prefix = _crowded(near.filter("__a").select("__n", "__p"), ["__n", "__p"], "prefixes")
    full = F.sha2(ascii_lower(F.col("__text")), 256)
    last = _mark(near, ["__n", "__p"], by_prefix, "__b").withColumn("__h", F.when(F.col("__a") & F.col("__b"), full))
    key = ["__n", "__p", "__h"]
    last = last.select("doc_id", *carry, *key)
    groups = stored(
        last.filter("__h is not null").groupBy(*key).agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id")), "groups"
    )
    alone = last.filter("__h is null").select("doc_id", *carry, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    shared = last.filter("__h is not null").join(groups, key).select("doc_id", *carry, "keep_id", "group_size")
    return alone.union(shared).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
