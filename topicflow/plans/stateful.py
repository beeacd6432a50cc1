"""Registered queries on jobs that keep state by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import offsets
from ..sources import readers
from ..streaming import jobs, stateful
from .queries import _Job, streaming
from .store import _Stored, stored

#: Commits of a batch, and milliseconds after which an open one is closed.
BATCH, WAIT = 100, 1000


def _written(job: _Job | _Stored, name: str) -> bool:
    return jobs._there(job.spark, job.path(name))


def _committed(job: _Job) -> None:
    stream = readers.committable(job.stream, "g1", F.col("offset").cast("string"))
    query = stateful.commit_in_batches(stream, job.path("journal"), job.path("batches"), job.path("checkpoint"), BATCH, WAIT)
    total = job.log.count()
    held = lambda: jobs.read_batches(job.spark, job.path("batches"), stateful.BATCH_SCHEMA).agg(F.sum("batch_size")).first()[0]
    stateful.run_until(query, lambda: not total or _written(job, "batches") and held() == total, 300)


@streaming(f"""select 'g1' as group_id, topic, part, off // {BATCH} as batch, min(off) as first_off, max(off) as last_off, cast(max(off) as varchar) as metadata, count(*) as n,
  case when count(*) = {BATCH} then 'count' else 'clock' end as closed_by from log group by all""")
def stream_commit_batches(job: _Job) -> DataFrame:
    """Commits by count or clock; the job puts out each batch that it has committed."""
    _committed(job)
    found = jobs.read_batches(job.spark, job.path("batches"), stateful.BATCH_SCHEMA)
    return found.select("group_id", "topic", F.col("partition").alias("part"), "batch", F.col("first_offset").alias("first_off"), F.col("offset").alias("last_off"), "metadata", F.col("batch_size").alias("n"), "closed_by")


@streaming("select 'g1' as group_id, topic, part, max(off) + 1 as next_offset, cast(max(off) as varchar) as metadata from log group by topic, part")
def stream_batch_positions(job: _Job) -> DataFrame:
    """Where the group stands after the same job."""
    _committed(job)
    return offsets.current_positions(jobs.read_batches(job.spark, job.path("journal"), jobs.JOURNAL_SCHEMA)).withColumnRenamed("partition", "part")


@stored("""select topic, part, off, k, off + 1 as n, off // 10 as chunk, off <= 36 as inside_or_end, off = 36 as ends,
  coalesce(sum(case when k like '%0' then 1 else 0 end) over (partition by topic, part order by off rows between unbounded preceding and 1 preceding), 0) as segment from log""")
def stream_in_order(store: _Stored) -> DataFrame:
    """Running count, chunks, segments and take-while along a bounded stream: many micro-batches, one result."""
    source = store.bounded.load()
    marker, stop = F.col("key").cast("string").endswith("0"), F.col("offset") % 37 == 36
    jobs.stop_after_all(stateful.write_in_order(source, store.path("out"), store.path("checkpoint"), once=False, marker=marker, stop=stop))
    found = store.spark.read.parquet(store.path("out"))
    inside = (F.col("inside") | F.col("ends")).alias("inside_or_end")
    return found.select("topic", F.col("partition").alias("part"), F.col("offset").alias("off"), F.col("key").cast("string").alias("k"), "n", "chunk", inside, "ends", "segment")


@streaming("""select topic, part, event, next_off from (
  select topic, part, 'assign' as event, 0 as next_off from log group by topic, part union all select topic, part, 'revoke', max(off) + 1 from log group by topic, part union all select null, null, 'stop', null)""")
def partition_lifecycle(job: _Job) -> DataFrame:
    """Each partition is assigned with its first records and revoked when no more come; then the job stops."""
    query = stateful.partition_events(job.stream, WAIT, job.path("events"), job.path("checkpoint"))
    parts = job.log.select("topic", "partition").distinct().count()
    read = lambda: jobs.read_batches(job.spark, job.path("events"), stateful.EVENT_SCHEMA)
    stateful.stop_with_event(query, job.spark, job.path("events"), lambda: not parts or _written(job, "events") and read().filter("event = 'revoke'").count() == parts, timeout=300)
    return read().select("topic", F.col("partition").alias("part"), "event", F.col("next_offset").alias("next_off"))


_AUDIT_SQL = """select topic, part, count(*) as expected, count(*) - sum(case when off % 97 = 0 then 1 else 0 end) + sum(case when off % 89 = 0 and off % 97 <> 0 then 1 else 0 end) as delivered,
  sum(case when off % 97 = 0 then 1 else 0 end) as missing, sum(case when off % 89 = 0 and off % 97 <> 0 then 1 else 0 end) as repeated, 0 as unknown,
  sum(case when off % 97 <> 0 and next_got - off > 1 then 1 else 0 end) as gaps
from (select *, min(case when off % 97 <> 0 then off end) over (partition by topic, part order by off rows between 1 following and unbounded following) as next_got from log) group by topic, part"""


@stored(_AUDIT_SQL)
def stream_audit(store: _Stored) -> DataFrame:
    """The audit of a job that loses and repeats records, kept up batch by batch while both sides come in bounded batches."""
    came = store.stream.load().filter("offset % 97 <> 0")
    twice = came.withColumn("again", F.explode(F.when(F.col("offset") % 89 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    source = store.bounded.load()
    query = stateful.running_audit(source, twice, store.path("audit"), store.path("checkpoint"), once=False, interval="0 seconds")
    jobs.stop_after_all(query)
    return stateful.last_audit(jobs.read_batches(store.spark, store.path("audit"), stateful.AUDIT_SCHEMA)).withColumnRenamed("partition", "part")
