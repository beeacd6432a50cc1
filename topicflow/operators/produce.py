"""Producing: envelopes of 0, 1 or N records, their partitions and offsets, and a result each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.log import PARTITION, dense_offsets


def record(topic: Column, key: Column, value: Column, partition: Column | None = None, timestamp: Column | None = None) -> Column:
    """A record to be appended; a null partition is chosen by key, a null timestamp is the time of writing."""
    return F.struct(
        topic.cast("string").alias("topic"), (F.lit(None) if partition is None else partition).cast("int").alias("partition"),
        (F.lit(None) if timestamp is None else timestamp).cast("timestamp_ntz").alias("timestamp"), key.cast("binary").alias("key"), value.cast("binary").alias("value"),
    )


_RECORDS = "array<struct<topic:string,partition:int,timestamp:timestamp_ntz,key:binary,value:binary>>"


def single(r: Column) -> Column:
    return F.array(r).cast(_RECORDS)


def multi(*records: Column) -> Column:
    """A set: equal records are sent once."""
    return F.array_distinct(F.array(*records)).cast(_RECORDS)


def pass_through() -> Column:
    """No records; the result still comes, so that its position can be committed."""
    return F.array().cast(_RECORDS)


def key_partition(key: Column, envelope: Column, ordinal: Column, partitions: int) -> Column:
    """The partition of a key; records without one are spread by their place."""
    by_key = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.when(key.isNull(), F.pmod(F.xxhash64(envelope, ordinal), F.lit(partitions))).otherwise(F.pmod(by_key, F.lit(partitions))).cast("int")


def invalid_reason(topic: Column, partition: Column, epoch_ms: Column) -> Column:
    """Why a record may not be sent: null if it may."""
    return F.when(topic.isNull(), "INVALID_TOPIC").when(partition < 0, "INVALID_PARTITION").when(epoch_ms < 0, "INVALID_TIMESTAMP")


def _reason(topic: Column, partition: Column, timestamp: Column) -> Column:
    return invalid_reason(topic, partition, F.unix_millis(timestamp.cast("timestamp")))


def refusal(records: Column) -> Column:
    """The first error code among an envelope's records: null if all may be sent."""
    reasons = F.transform(records, lambda r: _reason(r["topic"], r["partition"], r["timestamp"]))
    return F.try_element_at(F.filter(reasons, lambda c: c.isNotNull()), F.lit(1))


def valid_or_raise(records: DataFrame) -> DataFrame:
    reason = _reason(F.col("topic"), F.col("partition"), F.col("timestamp"))
    return records.filter(F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("record refused: "), reason)).cast("boolean")).otherwise(F.lit(True)))


def explode_records(envelopes: DataFrame, partitions: int) -> DataFrame:
    """A row for each record of ``envelopes(envelope_id, records, ...)``: envelope_id, ordinal and the record."""
    rows = envelopes.select("envelope_id", F.posexplode("records").alias("ordinal", "record")).select("envelope_id", "ordinal", "record.*")
    chosen = F.coalesce("partition", key_partition(F.col("key"), F.col("envelope_id"), F.col("ordinal"), partitions))
    return rows.withColumn("partition", chosen)


def assign_offsets(records: DataFrame, ends: DataFrame | None = None, bucket_rows: int | None = 1 << 16) -> DataFrame:
    """Offsets for records to append, from each partition's next one on, in (envelope_id, ordinal) order.

    ``ends(topic, partition, end)`` are the log's next offsets; a partition not in it starts at 0.
    """
    bucket = F.floor(F.col("envelope_id") / bucket_rows) if bucket_rows else None
    numbered = dense_offsets(records, PARTITION, ["envelope_id", "ordinal"], bucket)
    if ends is None:
        return numbered
    return numbered.join(ends.select(*PARTITION, "end"), list(PARTITION), "left").withColumn("offset", F.col("offset") + F.coalesce("end", F.lit(0))).drop("end")


def results(envelopes: DataFrame, sent: DataFrame) -> DataFrame:
    """One result per envelope: kind, parts (topic, partition, offset, in order), its pass_through and error_code.

    An envelope with a record that may not be sent is refused: it has no parts, and the first
    record's error code.
    """
    parts = sent.groupBy("envelope_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "topic", "partition", "offset"))).alias("parts"))
    joined = envelopes.select("envelope_id", "pass_through", F.coalesce(F.size("records"), F.lit(0)).alias("asked"), refusal(F.col("records")).alias("error_code")).join(parts, "envelope_id", "left")
    kind = F.when(F.col("error_code").isNotNull(), "refused").when(F.col("asked") <= 0, "passthrough").when(F.col("asked") == 1, "single").otherwise("multi")
    return joined.select("envelope_id", kind.alias("kind"), F.coalesce("parts", F.array().cast("array<struct<ordinal:int,topic:string,partition:int,offset:bigint>>")).alias("parts"), "pass_through", "error_code")


def sent_records(envelopes: DataFrame, partitions: int, ends: DataFrame | None = None) -> DataFrame:
    """The records of all envelopes that may be sent, with partition and offset, in the order of envelope_id."""
    return assign_offsets(explode_records(envelopes.filter(refusal(F.col("records")).isNull()), partitions), ends)


def produce(envelopes: DataFrame, partitions: int, ends: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The records with partition and offset, and the results: as many as envelopes.

    Records follow each other in the order of envelope_id, which is to be unique and not null.
    Envelopes that hold an invalid record are refused whole; null or empty records pass through.
    Jobs that write both make the results from the records that they have written.
    """
    sent = sent_records(envelopes, partitions, ends)
    return sent, results(envelopes, sent)
