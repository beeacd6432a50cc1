"""The registered queries on the event log, with the same in SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode, encode_int32, encode_int32_little, int32, int32_little
from ..operators import offsets, partitioned, policy, produce, summary
from ..sources import log as logs
from ..sources import readers
from ..sources.subscribe import assignment, assignment_from, topic_pattern, topics
from ..streaming import jobs, monitor
from ..workdir import work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The log of the event table, as the SQL of every query begins.
_LOG = """with log as (
  select event_type as topic, cast(user_id % 3 as int) as part,
         row_number() over (partition by event_type, user_id % 3 order by event_id) - 1 as off,
         cast(user_id as varchar) as k, props as v, ts, event_id, user_id, value as amount
  from events)
"""


def query(sql: str | None = None) -> Callable[[Callable[[DataFrame], DataFrame]], Callable[[DataFrame], DataFrame]]:
    """Registers a query on the log under the function's name."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(_events_log(spark, sf_dir))
        if sql:
            SQL[f.__name__] = _LOG + sql
        return f

    return register


#: The log of each session and table: numbered and written once, then scanned by all queries.
_written: dict[tuple[str, str], str] = {}


def _events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    made = logs.log_of_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    if key not in _written:
        path = work_path(spark, "events-log")
        logs.write_log(made, path, ranges=True)
        _written[key] = path
    return logs.read_log(spark, _written[key], made.schema)


def _short(records: DataFrame, *more) -> DataFrame:
    return records.select("topic", F.col("partition").alias("part"), F.col("offset").alias("off"), *more)


def _rows(log: DataFrame, schema: str, *rows: tuple) -> DataFrame:
    return log.sparkSession.createDataFrame(list(rows), schema)


_START = "topic string, partition int, start bigint"
_RESUME = (("click", 1, 100), ("view", 0, 50))


# -- sources ---------------------------------------------------------------------------------


@query("select topic, count(distinct part) as parts, min(off) as lo, max(off) + 1 as hi, count(*) as n from log group by topic")
def topic_metadata(log):
    return readers.topic_metadata(log)


@query("select topic, part, off, event_id from log where topic in ('click', 'view')")
def topics_subscription(log):
    return _short(readers.plain_source(log, topics("click", "view")), "event_id")


@query("select topic, part, off, event_id from log where regexp_matches(topic, '^(cl|vi)')")
def pattern_subscription(log):
    return _short(readers.plain_source(log, topic_pattern("^(cl|vi)")), "event_id")


@query("select topic, part, off, event_id from log where (topic = 'click' and part = 1) or (topic = 'view' and part = 0)")
def assignment_subscription(log):
    return _short(readers.plain_source(log, assignment(("click", 1), ("view", 0))), "event_id")


@query("select topic, part, off, event_id from log where (topic = 'click' and part = 1 and off >= 100) or (topic = 'view' and part = 0 and off >= 50)")
def assignment_from_offset(log):
    return _short(readers.plain_source(log, assignment_from(("click", 1, 100), ("view", 0, 50))), "event_id")


@query("""select topic, part, off, event_id from log
where topic in ('click', 'view') and off >= case when topic = 'click' and part = 1 then 100 when topic = 'view' and part = 0 then 50 else 0 end""")
def resume_from_offsets(log):
    schema = "group_id string, topic string, partition int, next_offset bigint, metadata string, batch_size bigint, source_id string, commit_seq bigint"
    journal = _rows(log, schema, ("g1", "click", 1, 40, "", 40, "s", 0), ("g1", "click", 1, 100, "", 60, "s", 1), ("g1", "view", 0, 50, "", 50, "s", 1), ("g2", "view", 1, 7, "", 7, "s", 0))
    return _short(offsets.resume(readers.plain_source(log, topics("click", "view")), journal, "g1"), "event_id")


@query("""select topic, part, case when topic = 'click' and part = 1 then 100 when topic = 'view' and part = 0 then 50 else max(off) + 1 end as start
from log group by topic, part""")
def start_latest(log):
    known = _rows(log, "topic string, partition int, next_offset bigint", *_RESUME)
    return readers.start_positions(log, known, "latest").select("topic", F.col("partition").alias("part"), "start")


@query("select topic, part, min(off) filter (where ts >= timestamp '2024-01-15 00:00:00') as start from log group by topic, part")
def offsets_for_timestamp(log):
    found = readers.offsets_for_time(log, F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return found.select("topic", F.col("partition").alias("part"), "start")


@query("""select topic, part, next_offset, hi as "end", hi - next_offset as lag from (
  select topic, part, max(off) + 1 as hi, case when topic = 'click' and part = 1 then 100 when topic = 'view' and part = 0 then 50 else 0 end as next_offset
  from log group by topic, part)""")
def consumer_lag(log):
    known = _rows(log, "topic string, partition int, next_offset bigint", *_RESUME)
    return readers.consumer_lag(log, known).withColumnRenamed("partition", "part")


@query("""select topic, part, min(off) as first_read from log
where off >= case when topic = 'click' and part = 0 then 20 when topic = 'click' and part = 1 then 100 when topic = 'view' and part = 0 then 5 else 0 end group by topic, part""")
def seek_positions(log):
    starts = readers.seek(_rows(log, _START, *_RESUME), _rows(log, _START, ("click", 0, 20), ("view", 0, 5)))
    return readers.from_starts(log, starts).groupBy("topic", F.col("partition").alias("part")).agg(F.min("offset").alias("first_read"))


_ASSIGNED = ((1, "click", 0, None), (1, "click", 1, 10), (2, "click", 0, 5), (2, "view", 2, 2))
_ASSIGNED_SQL = "(values (1, 'click', 0, 0), (1, 'click', 1, 10), (2, 'click', 0, 5), (2, 'view', 2, 2)) as a(assign_id, topic, part, start)"


@query(f"select assign_id, log.topic, log.part, off, event_id from log join {_ASSIGNED_SQL} on log.topic = a.topic and log.part = a.part and off >= start")
def multi_assignment(log):
    assigned = _rows(log, "assign_id int, topic string, partition int, start bigint", *_ASSIGNED)
    return _short(readers.multi_assignment_source(log, assigned), "assign_id", "event_id")


@query(f"select assign_id, log.topic, log.part, off, 'g1' as group_id, off as commit_offset, '' as metadata from log join {_ASSIGNED_SQL} on log.topic = a.topic and log.part = a.part and off >= start")
def multi_assignment_committable(log):
    assigned = _rows(log, "assign_id int, topic string, partition int, start bigint", *_ASSIGNED)
    found = readers.committable_multi_assignment_source(log, assigned, "g1")
    return _short(found, "assign_id", "commit.group_id", F.col("commit.offset").alias("commit_offset"), "commit.metadata")


@query("select topic, part, off, 'g1' as group_id, topic as commit_topic, off as commit_offset, '' as metadata from log where topic = 'purchase'")
def committable(log):
    found = readers.committable_source(log, topics("purchase"), "g1")
    return _short(found, "commit.group_id", F.col("commit.topic").alias("commit_topic"), F.col("commit.offset").alias("commit_offset"), "commit.metadata")


@query("select topic, part, off, cast(off as varchar) as metadata from log where topic = 'purchase'")
def commit_metadata(log):
    return _short(readers.committable_source(log, topics("purchase"), "g1", F.col("offset").cast("string")), "commit.metadata")


@query("select k || '!' as element, part, off, 'g1' as group_id from log where topic = 'signup'")
def offset_context(log):
    found = readers.with_offset_context(readers.committable_source(log, topics("signup"), "g1"))
    mapped = readers.map_element(found, F.concat(F.col("element.key").cast("string"), F.lit("!")))
    return mapped.select("element", F.col("commit.partition").alias("part"), F.col("commit.offset").alias("off"), "commit.group_id")


@query("select topic, part, off, off + 1 as n, 'g1' as group_id, 'm' || off as metadata from log where topic in ('click', 'error')")
def partitioned_committable(log):
    records = readers.partitioned_source(readers.committable_source(log, topics("click", "error"), "g1", F.concat(F.lit("m"), F.col("offset").cast("string"))))
    return _short(partitioned.running_count(records, first=F.lit(0)), "n", "commit.group_id", "commit.metadata")


@query("select topic, part, off, event_id from log where off >= case when topic = 'click' and part = 0 then 1 else 0 end")
def manual_offset_source(log):
    skip_one = lambda assigned: assigned.select("topic", "partition", F.when((F.col("topic") == "click") & (F.col("partition") == 0), 1).cast("bigint").alias("start"))
    return _short(readers.manual_offset_source(log, topic_pattern("."), skip_one), "event_id")


_TXN = "case when event_id % 7 = 0 then null else cast(floor(event_id / 50) as bigint) end"


@query(f"select topic, part, off, txn_id from (select *, {_TXN} as txn_id from log) where txn_id is null or txn_id % 4 <> 3")
def committed_read(log):
    txn = F.floor(F.col("event_id") / 50)
    marked = log.withColumn("txn_id", F.when(F.col("event_id") % 7 != 0, txn))
    done = log.select(txn.alias("txn_id")).distinct().filter("txn_id % 4 <> 3")
    return _short(readers.committed_records(marked, done), "txn_id")


@query("select event_id, event_id % 100 + 1 as element from log")
def element_cycle(log):
    return logs.cycle(log, "event_id", 100).select("event_id", "element")


@query("select unnest(generate_series(1, 2 * count(*), 2)) as element from log")
def element_range(log):
    return logs.element_range(log.sparkSession, 1, 2 * log.count(), 2)


@query("select topic, part, off from log where false or topic = 'click'")
def missing_topic(log):
    return _short(logs.topic_or_empty(log, ["click", "no-such-topic"]))


# -- commits ---------------------------------------------------------------------------------


def _commits(log, group="g1"):
    return readers.committable(log, group).select("commit.*", "event_id", "user_id")


@query("""select 'g1' as group_id, topic, part, off // 1000 as batch, arg_max(off, (event_id * 7919) % 10007 * 1000000000 + event_id) as "offset",
  count(*) as batch_size from log group by topic, part, off // 1000""")
def commit_batches(log):
    seq = (F.col("event_id") * 7919) % 10007 * 1000000000 + F.col("event_id")
    rows = _commits(log).withColumn("batch", F.floor(F.col("offset") / 1000))
    return offsets.fold_offsets(rows, seq, "batch").drop("metadata").withColumnRenamed("partition", "part")


@query("""select 'g1' as group_id, topic, part, max(off) filter (where b = last_b) as "offset", count(*) as batch_size from (
  select *, event_id % 4 as b, max(event_id % 4) over (partition by topic, part) as last_b from log) group by topic, part""")
def batch_merge(log):
    batches = offsets.fold_offsets(_commits(log).withColumn("b", F.col("event_id") % 4), F.col("offset"), "b")
    return offsets.merge_batches(batches, "b").drop("metadata").withColumnRenamed("partition", "part")


@query("select cast(floor(event_id / 500) as bigint) as txn, 'g1' as group_id, topic, part, max(off) + 1 as next_offset, count(*) as batch_size from log group by all")
def txn_fold(log):
    return offsets.fold_transaction(_commits(log).withColumn("txn", F.floor(F.col("event_id") / 500)), "txn").withColumnRenamed("partition", "part")


@query("select 'g' || (event_id % 3) as group_id, topic, part, max(off) + 1 as next_offset, count(*) as batch_size from log group by all")
def commit_by_group(log):
    rows = _commits(log).withColumn("group_id", F.concat(F.lit("g"), (F.col("event_id") % 3).cast("string")))
    folded = offsets.journal_rows(offsets.fold_offsets(rows, F.col("offset")), F.lit("s"), F.lit(0))
    return folded.select("group_id", "topic", F.col("partition").alias("part"), "next_offset", "batch_size")


@query("""select topic, part, day, (rn - 1) // 5 as batch, count(*) as n, max(off) as last_off from (
  select topic, part, off, strftime(ts, '%Y-%m-%d') as day, row_number() over (partition by topic, part, date_trunc('day', ts) order by off) as rn from log)
group by topic, part, day, (rn - 1) // 5""")
def grouped_within(log):
    rows = offsets.grouped_within(log, ["topic", "partition"], F.col("timestamp"), "1 day", ["offset"], 5)
    day = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    return rows.groupBy("topic", F.col("partition").alias("part"), day, "batch").agg(F.count("*").alias("n"), F.max("offset").alias("last_off"))


def _journal(log):
    """A commit after every hundredth record of a partition."""
    rows = _commits(log).filter(F.col("offset") % 100 == 99).withColumn("batch_size", F.lit(100).cast("long")).withColumn("metadata", F.concat(F.lit("at "), F.col("offset").cast("string")))
    return offsets.journal_rows(rows, F.lit("s"), F.col("offset"))


@query("select 'g1' as group_id, topic, part, max(off) + 1 as next_offset, 'at ' || max(off) as metadata from log where off % 100 = 99 group by topic, part")
def current_positions(log):
    return offsets.current_positions(_journal(log)).withColumnRenamed("partition", "part")


@query("select 'g1' as group_id, topic, part, off + 1 as next_offset, 1 as batch_size from log where topic = 'signup'")
def commit_one(log):
    rows = offsets.commit_one(_commits(log).filter("topic = 'signup'"), F.lit("s"), F.col("offset"))
    return rows.select("group_id", "topic", F.col("partition").alias("part"), "next_offset", "batch_size")


@query("""select 'g1' as group_id, topic, part, max(off) + 1 as next_offset, count(*) * 100 as batch_size, max(off) as commit_seq
from log where off % 100 = 99 group by topic, part""")
def compact_journal(log):
    found = offsets.compact_journal(_journal(log))
    return found.select("group_id", "topic", F.col("partition").alias("part"), "next_offset", "batch_size", "commit_seq")


@query("select count(*) as violating from (select event_id % 3 from log group by event_id % 3 having count(distinct user_id % 2) > 1)")
def single_commit_guard(log):
    rows = log.select((F.col("event_id") % 3).cast("string").alias("group_id"), (F.col("user_id") % 2).alias("source_id"))
    return offsets.groups_of_many_sources(rows).agg(F.count("*").alias("violating"))


@query("""select topic, part, sum(n) as batch_size from (
  select topic, part, day, (rn - 1) // 5 as batch, count(*) as n from (
    select topic, part, date_trunc('day', ts) as day, row_number() over (partition by topic, part, date_trunc('day', ts) order by off) as rn from log)
  group by all) group by topic, part""")
def batch_size_sum(log):
    rows = offsets.grouped_within(log, ["topic", "partition"], F.col("timestamp"), "1 day", ["offset"], 5)
    sizes = rows.groupBy("topic", F.col("partition").alias("part"), "window_start", "batch").agg(F.count("*").alias("n"))
    return sizes.groupBy("topic", "part").agg(F.sum("n").alias("batch_size"))


# -- producing -------------------------------------------------------------------------------

_PARTS = 3
_KEY_PART = "cast((('0x' || substr(md5(k), 1, 8))::bigint) % 3 as int)"
#: Key "1" goes to two topics, "2" to none, others to one.
_SENT = f"""sent as (
  select event_id as envelope_id, o as ordinal, t as topic, {_KEY_PART} as part, event_id from (
    select event_id, k, 0 as o, case when k = '1' then 'out-2' else 'out-4' end as t from log where k <> '2'
    union all select event_id, k, 1, 'out-3' from log where k = '1')),
placed as (select *, row_number() over (partition by topic, part order by envelope_id, ordinal) - 1 as "offset" from sent)
"""


def _envelopes(log):
    key, value = F.col("key"), F.col("value")
    text = key.cast("string")
    to = lambda name: produce.record(F.lit(name), key, value)
    records = F.when(text == "1", produce.multi(to("out-2"), to("out-3"))).when(text == "2", produce.pass_through()).otherwise(produce.single(to("out-4")))
    return readers.committable(log, "g1").select(F.col("event_id").alias("envelope_id"), records.alias("records"), F.col("commit").alias("pass_through"))


@query(", " + _SENT + "select envelope_id, ordinal, topic, part from sent")
def route_single_multi_pass(log):
    return produce.explode_records(_envelopes(log), _PARTS).select("envelope_id", F.col("ordinal").cast("int"), "topic", F.col("partition").alias("part"))


@query(", " + _SENT + """select log.event_id as envelope_id, case when k = '1' then 'multi' when k = '2' then 'passthrough' else 'single' end as kind,
  count(p.topic) as n_parts, min(p."offset") as min_off, max(p."offset") as max_off, log.off as commit_offset
from log left join placed p on p.envelope_id = log.event_id group by log.event_id, k, log.off""")
def produce_results(log):
    _, done = produce.produce(_envelopes(log), _PARTS)
    low, high = F.array_min(F.col("parts.offset")), F.array_max(F.col("parts.offset"))
    return done.select("envelope_id", "kind", F.size("parts").cast("long").alias("n_parts"), low.alias("min_off"), high.alias("max_off"), F.col("pass_through.offset").alias("commit_offset"))


@query(", " + _SENT + 'select topic, part, 10 + min("offset") as lo, 10 + max("offset") as hi, count(*) as n from placed group by topic, part')
def assign_after_end(log):
    sent = produce.explode_records(_envelopes(log), _PARTS)
    ends = sent.select("topic", "partition").distinct().withColumn("end", F.lit(10).cast("long"))
    placed = produce.assign_offsets(sent, ends)
    return placed.groupBy("topic", F.col("partition").alias("part")).agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count("*").alias("n"))


@query("select k, cast((('0x' || substr(md5(k), 1, 8))::bigint) % 7 as int) as part, count(*) as n from log group by all")
def partitioner(log):
    part = produce.key_partition(F.col("key"), F.col("event_id"), F.lit(0), 7)
    return log.groupBy(F.col("key").cast("string").alias("k"), part.alias("part")).agg(F.count("*").alias("n"))


@query("""select case when event_id % 11 = 0 then 'INVALID_TOPIC' when event_id % 13 = 0 then 'INVALID_PARTITION' when event_id % 17 = 0 then 'INVALID_TIMESTAMP' end as reason,
  count(*) as n from log group by 1""")
def record_validation(log):
    e = F.col("event_id")
    reason = produce.invalid_reason(F.when(e % 11 != 0, F.col("topic")), F.when(e % 13 == 0, -1).otherwise(F.col("partition")), F.when(e % 17 == 0, F.lit(-5)).otherwise(e))
    return log.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


# -- decoding and policies -------------------------------------------------------------------


def _payloads(log, little=False):
    """Four bytes of the event's number; text instead where it ends in 5."""
    made = (encode_int32_little if little else encode_int32)(F.col("event_id") - 2000)
    return log.withColumn("value", F.when(F.col("event_id") % 10 == 5, F.concat(F.lit("bad-"), F.col("event_id").cast("string")).cast("binary")).otherwise(made))


@query("select topic, part, off, cast(event_id - 2000 as int) as number from log where event_id % 10 <> 5")
def decode_resume(log):
    good, _ = policy.counted_drop(decode(_payloads(log), value=int32))
    return _short(good, F.col("value").alias("number"))


@query("select topic, part, off, cast(event_id - 2000 as int) as number from log where event_id % 10 <> 5")
def decode_little_endian(log):
    return _short(decode(_payloads(log, little=True), value=int32_little).filter("error_code is null"), F.col("value").alias("number"))


@query("select topic, part, off, 'bad-' || event_id as raw, 'VALUE_DESERIALIZATION' as error_code, 'resume' as directive from log where event_id % 10 = 5")
def decode_errors(log):
    _, letters = policy.apply_policy(decode(_payloads(log), value=int32), {"VALUE_DESERIALIZATION": policy.RESUME})
    return _short(letters, F.col("raw_value").cast("string").alias("raw"), "error_code", "directive")


_CODES = ("FATAL", "RETRIABLE", "VALUE_DESERIALIZATION", "KEY_DESERIALIZATION", "CONSUME", "OTHER")


@query("""select code, case when code is null then null when code in ('RETRIABLE', 'CONSUME', 'VALUE_DESERIALIZATION') then 'resume' else 'stop' end as directive, count(*) as n
from (select ['FATAL', 'RETRIABLE', 'VALUE_DESERIALIZATION', 'KEY_DESERIALIZATION', 'CONSUME', 'OTHER', null][(event_id % 7 + 1)::int] as code from log) group by 1, 2""")
def policy_directives(log):
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES], F.lit(None).cast("string")), (F.col("event_id") % 7 + 1).cast("int"))
    found = policy.directive(F.col("code"), policy.policy({"VALUE_DESERIALIZATION": policy.RESUME}))
    return log.select(code.alias("code")).withColumn("directive", found).groupBy("code", "directive").agg(F.count("*").alias("n"))


@query("select event_id, cast(floor(1000 / (event_id % 5)) as bigint) as result from log where event_id % 5 <> 0")
def divide_resume(log):
    made = log.withColumn("result", F.floor(F.try_divide(F.lit(1000), F.col("event_id") % 5)).cast("long"))
    return made.filter("result is not null").select("event_id", "result")


# -- along partitions ------------------------------------------------------------------------


@query("select topic, part, off, off + 1 as n from log")
def running_count(log):
    return _short(partitioned.running_count(log, first=F.lit(0)), "n")


@query("select topic, part, off, event_id from log where off < 10")
def take_per_partition(log):
    return _short(partitioned.take(log, 10, first=F.lit(0)), "event_id")


@query("select off, event_id from log where topic = 'click' and part = 1 order by off limit 25")
def take_first(log):
    return partitioned.take_first(readers.plain_source(log, assignment(("click", 1))), 25).select(F.col("offset").alias("off"), "event_id")


@query("select topic, part, off from log where off <= 36")
def take_while_inclusive(log):
    return _short(partitioned.take_while(log, F.col("offset") % 37 != 36, inclusive=True))


@query("select topic, part, off // 10 as chunk, count(*) as n, min(off) as lo, max(off) as hi from log group by all")
def gapless_chunks(log):
    found = partitioned.chunks(log, 10, first=F.lit(0))
    return found.groupBy("topic", F.col("partition").alias("part"), "chunk").agg(F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"))


@query("""select topic, part, segment, count(*) as n from (
  select topic, part, coalesce(sum(case when k like '%0' then 1 else 0 end) over (partition by topic, part order by off rows between unbounded preceding and 1 preceding), 0) as segment
  from log) group by all""")
def fail_segments(log):
    found = partitioned.segments(log, F.col("key").cast("string").endswith("0"))
    return found.groupBy("topic", F.col("partition").alias("part"), "segment").agg(F.count("*").alias("n"))


@query("select topic, part, off from log where topic in ('click', 'view', 'error')")
def merge_substreams(log):
    return _short(partitioned.merge(*[readers.plain_source(log, topics(t)) for t in ("click", "view", "error")]))


@query("select event_id, length(v) as size from log")
def map_in_arrow(log):
    def sizes(batches):
        import pyarrow.compute as pc

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("event_id"), pc.cast(pc.binary_length(b.column("value")), pa.int64())], names=["event_id", "size"])

    return partitioned.map_batches(log.select("event_id", "value"), sizes, "event_id long, size long")


@query("select event_id, sha256(v) as digest from log")
def map_in_flight(log):
    """Eight calls at once in each task, of 64 records each; a call may wait for something outside."""

    def digests(b):
        made = [hashlib.sha256(v).hexdigest() for v in b.column("value").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column("event_id"), pa.array(made, pa.string())], names=["event_id", "digest"])

    return partitioned.map_in_flight(log.select("event_id", "value"), digests, "event_id long, digest string", in_flight=8, rows=64)


@query("select topic, part, n, sum(n) over (order by topic, part) as total from (select topic, part, count(*) as n from log group by topic, part)")
def last_count_total(log):
    return partitioned.last_count_total(log).withColumnRenamed("partition", "part")


# -- aggregates ------------------------------------------------------------------------------


@query("select topic, part, count(*) as n from log group by rollup (topic, part)")
def partition_totals(log):
    return summary.partition_totals(log).withColumnRenamed("partition", "part")


@query("select topic, part, bool_and(user_id % 3 = part) as ok, count(*) as n from log group by topic, part")
def substream_check(log):
    return summary.all_hold(log, F.pmod("user_id", F.lit(3)) == F.col("partition"), "topic", "partition").withColumnRenamed("partition", "part")


@query("select topic, count(distinct k) as keys from log group by topic")
def distinct_values(log):
    return log.select("topic", "key").distinct().groupBy("topic").agg(F.count("*").alias("keys"))


@query("select distinct k from log order by k")
def sorted_values(log):
    return log.select(F.col("key").cast("string").alias("k")).distinct().orderBy("k")


@query("""select topic, round(avg(amount), 6) as mean, round(stddev_pop(amount) / sqrt(count(amount)), 6) as std_error, round(stddev_pop(amount), 6) as std_dev,
  round(median(amount), 6) as median, max(amount) as max from log group by topic""")
def sample_summary(log):
    found = summary.sample_summary(log, F.col("amount"), "topic")
    return found.select("topic", *[F.round(c, 6).alias(c) for c in ("mean", "std_error", "std_dev", "median")], "max")


@query("""select topic, part, count(*) as expected, count(*) - sum(case when event_id % 97 = 0 then 1 else 0 end) + sum(case when event_id % 89 = 0 and event_id % 97 <> 0 then 1 else 0 end) as delivered,
  sum(case when event_id % 97 = 0 then 1 else 0 end) as missing, sum(case when event_id % 89 = 0 and event_id % 97 <> 0 then 1 else 0 end) as repeated, 0 as unknown,
  sum(case when event_id % 97 <> 0 and next_got - off > 1 then 1 else 0 end) as gaps
from (select *, min(case when event_id % 97 <> 0 then off end) over (partition by topic, part order by off rows between 1 following and unbounded following) as next_got from log) group by topic, part""")
def delivery_audit(log):
    came = log.filter("event_id % 97 <> 0")
    return summary.delivery_audit(log, came.unionByName(came.filter("event_id % 89 = 0"))).withColumnRenamed("partition", "part")


# -- streaming -------------------------------------------------------------------------------


class _Job:
    """A log written to files, and folders for what a job puts out."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.root = spark, work_path(spark, "stream")
        logs.write_log(_events_log(spark, sf_dir).select("topic", "partition", "offset", "key", "value", "timestamp", F.lit(None).cast("long").alias("txn_id")), self.path("log"))
        self.log = logs.read_log(spark, self.path("log"))
        self.stream = logs.stream_log(spark, self.path("log"), 5)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: str) -> DataFrame:
        return jobs.read_batches(self.spark, self.path(name), schema)


_OUT = "topic string, partition int, offset bigint, key string"
_TAGS = ", source_id string, commit_seq bigint"
_COPY = "select topic, part, off, k from log"


def _step(batch: DataFrame) -> DataFrame:
    return batch.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"))


def streaming(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(_Job(spark, sf_dir))
        if sql:
            SQL[f.__name__] = _LOG + sql
        return f

    return register


@streaming(_COPY)
def stream_at_least_once(job):
    jobs.drain(jobs.at_least_once(job.stream, _step, "g1", job.path("out"), job.path("journal"), job.path("checkpoint")))
    return _short(job.read("out", _OUT), F.col("key").alias("k"))


@streaming(_COPY)
def stream_at_most_once(job):
    jobs.drain(jobs.at_most_once(job.stream, _step, "g1", job.path("out"), job.path("journal"), job.path("checkpoint")))
    return _short(job.read("out", _OUT), F.col("key").alias("k"))


@streaming(_COPY)
def stream_exactly_once(job):
    jobs.drain(jobs.exactly_once(job.stream, _step, "g1", job.path("out"), job.path("journal"), job.path("checkpoint")))
    return _short(jobs.read_visible(job.spark, job.path("out"), _OUT + _TAGS, job.path("journal")), F.col("key").alias("k"))


@streaming(_COPY)
def stream_transactional(job):
    jobs.drain(jobs.transactional(job.stream, _step, "g1", job.path("out"), job.path("journal"), job.path("committed"), job.path("checkpoint"), "t1"))
    seen = readers.committed_records(job.read("out", _OUT + ", source_id string, txn_id bigint"), job.read("committed", jobs.TXN_SCHEMA))
    return _short(seen, F.col("key").alias("k"))


_COPIED = "topic string, partition int, offset bigint, key binary"


def _envelopes_of_copies(batch: DataFrame) -> DataFrame:
    """Copies every record to another topic, in the order of its offsets; every eleventh has a partition that is refused."""
    known = F.array(*map(F.lit, ("click", "error", "purchase", "signup", "view")))
    number = F.col("offset") * 16 + F.array_position(known, F.col("topic")) * 3 + F.col("partition")
    wrong = F.when(F.col("offset") % 11 == 5, F.lit(-7))
    sent = produce.single(produce.record(F.concat(F.lit("copy-"), F.col("topic")), F.col("key"), F.col("value"), wrong))
    return batch.select(number.cast("long").alias("envelope_id"), sent.alias("records"), F.col("commit").alias("pass_through"))


def _copied(job) -> None:
    jobs.drain(jobs.pipeline(job.stream, _envelopes_of_copies, 3, "g1", job.path("out"), job.path("results"), job.path("journal"), job.path("checkpoint")))


@streaming("""select 'copy-' || topic as topic, cast((('0x' || substr(md5(k), 1, 8))::bigint) % 3 as int) as part, count(*) as n, count(*) as distinct_offsets,
  0 as lo, count(*) - 1 as hi from log where off % 11 <> 5 group by 1, 2""")
def stream_pipeline_records(job):
    _copied(job)
    rows = job.read("out", _COPIED)
    return rows.groupBy("topic", F.col("partition").alias("part")).agg(F.count("*").alias("n"), F.count_distinct("offset").alias("distinct_offsets"), F.min("offset").cast("int").alias("lo"), F.max("offset").alias("hi"))


@streaming("select topic, part, off, case when off % 11 = 5 then 'refused' else 'single' end as kind, case when off % 11 = 5 then 'INVALID_PARTITION' end as error_code from log")
def stream_pipeline_results(job):
    _copied(job)
    rows = job.read("results", "kind string, error_code string, pass_through struct<topic: string, partition: int, offset: bigint>")
    return rows.select("pass_through.topic", F.col("pass_through.partition").alias("part"), F.col("pass_through.offset").alias("off"), "kind", "error_code")


@streaming("select 'g1' as group_id, topic, part, max(off) + 1 as next_offset, count(*) as committed from log group by topic, part")
def stream_pipeline(job):
    _copied(job)
    journal = job.read("journal", jobs.JOURNAL_SCHEMA)
    sizes = journal.groupBy("group_id", "topic", "partition").agg(F.sum("batch_size").alias("committed"))
    return offsets.current_positions(journal).drop("metadata").join(sizes, ["group_id", "topic", "partition"]).withColumnRenamed("partition", "part")


@streaming("select 'g1' as group_id, topic, part, max(off) + 1 as next_offset from log group by topic, part")
def stream_commit_context(job):
    context = readers.with_offset_context(readers.committable(job.stream, "g1"))
    jobs.drain(jobs.commit_with_context(context, job.path("journal"), job.path("checkpoint")))
    return offsets.current_positions(job.read("journal", jobs.JOURNAL_SCHEMA)).drop("metadata").withColumnRenamed("partition", "part")


@streaming("select topic, part, count(*) as n from log group by topic, part")
def stream_running_count(job):
    jobs.drain(jobs.running_counts(job.stream, job.path("out"), job.path("checkpoint")))
    rows = job.read("out", "topic string, partition int, n bigint" + _TAGS)
    return rows.groupBy("topic", F.col("partition").alias("part")).agg(F.max_by("n", "commit_seq").alias("n"))


@streaming("select distinct topic, part from log")
def partition_events(job):
    jobs.drain(jobs.first_sights(job.stream, job.path("out"), job.path("checkpoint")))
    return job.spark.read.schema("topic string, partition int").parquet(job.path("out")).withColumnRenamed("partition", "part")


@streaming("select count(*) as input_rows from log")
def stream_progress(job):
    with monitor.all_progress(job.spark) as reports:
        query = jobs.at_least_once(job.stream, _step, "g1", job.path("out"), job.path("journal"), job.path("checkpoint"))
        jobs.drain(query)
        rows = reports(query)
    return rows.agg(F.sum("input_rows").alias("input_rows"))

