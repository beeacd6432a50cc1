"""Subscriptions: which topics and partitions are read, and from where."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Subscription:
    """A set of topics, a pattern, or (topic, partition) with start offsets (None: the default)."""

    topics: tuple[str, ...] = ()
    pattern: str | None = None
    partitions: Mapping[tuple[str, int], int | None] = field(default_factory=dict)

    @property
    def predicate(self) -> Column:
        """A filter of literals only, so that folders and row groups are pruned. Null topics and partitions are in none; no partitions match nothing."""
        if self.pattern is not None:
            return F.col("topic").rlike(self.pattern)
        if self.topics:
            return F.col("topic").isin(*self.topics)
        any_of = F.lit(False)
        for (topic, partition), start in self.partitions.items():
            one = (F.col("topic") == topic) & (F.col("partition") == partition)
            any_of = any_of | (one if start is None else one & (F.col("offset") >= start))
        return any_of

    def kafka_options(self, default: str = "latest") -> dict[str, str]:
        """The same subscription as options of Spark's Kafka source."""
        if self.pattern is not None:
            return {"subscribePattern": self.pattern, "startingOffsets": default}
        if self.topics:
            return {"subscribe": ",".join(self.topics), "startingOffsets": default}
        named: dict[str, list[int]] = {}
        starts: dict[str, dict[str, int]] = {}
        for (topic, partition), start in sorted(self.partitions.items()):
            named.setdefault(topic, []).append(partition)
            starts.setdefault(topic, {})[str(partition)] = start if start is not None else {"earliest": -2, "latest": -1}[default]
        return {"assign": json.dumps(named, sort_keys=True), "startingOffsets": json.dumps(starts, sort_keys=True)}


def topics(*names: str) -> Subscription:
    if not names:
        raise ValueError("at least one topic is needed")
    return Subscription(topics=tuple(names))


def topic_pattern(pattern: str) -> Subscription:
    return Subscription(pattern=pattern)


def assignment(*partitions: tuple[str, int]) -> Subscription:
    return Subscription(partitions={p: None for p in partitions})


def assignment_from(*starts: tuple[str, int, int]) -> Subscription:
    """Start offsets are included."""
    return Subscription(partitions={(t, p): o for t, p, o in starts})


def kafka_reader_options(subscription: Subscription, client: Mapping[str, str] | None = None, *more: Mapping[str, str], timestamp_starts: Mapping[tuple[str, int], int] | None = None, fail_on_data_loss: bool = True, max_offsets: int | None = None, committed_only: bool = False, default: str = "latest") -> dict[str, str]:
    """All options of a Kafka read. Client properties get the ``kafka.`` prefix; later ones win."""
    out = subscription.kafka_options(default)
    if timestamp_starts:
        by_topic: dict[str, dict[str, int]] = {}
        for (topic, partition), ms in sorted(timestamp_starts.items()):
            by_topic.setdefault(topic, {})[str(partition)] = ms
        out["startingOffsetsByTimestamp"] = json.dumps(by_topic, sort_keys=True)
        out.pop("startingOffsets", None)
    for properties in (client or {}, *more):
        out |= {f"kafka.{k}": str(v) for k, v in properties.items()}
    if committed_only:
        out["kafka.isolation.level"] = "read_committed"
    out["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_offsets is not None:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    return out


def kafka_writer_options(client: Mapping[str, str] | None = None, *more: Mapping[str, str], transactional_id: str | None = None) -> dict[str, str]:
    out = {f"kafka.{k}": str(v) for properties in (client or {}, *more) for k, v in properties.items()}
    if transactional_id is not None:
        if not transactional_id:
            raise ValueError("a transactional id must not be empty")
        out |= {"kafka.enable.idempotence": "true", "kafka.transactional.id": transactional_id, "kafka.max.in.flight.requests.per.connection": "1"}
    return out
