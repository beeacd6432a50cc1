"""What a running query says about itself."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class StatisticsListener(StreamingQueryListener):
    """Hands every progress report, as JSON, to a function; and a query's end to another."""

    def __init__(self, on_statistics: Callable[[str], None], on_stop: Callable[[str, str | None], None] | None = None):
        self.on_statistics, self.on_stop = on_statistics, on_stop

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.on_statistics(event.progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.on_stop:
            self.on_stop(str(event.id), event.exception)


@contextmanager
def all_progress(spark: SparkSession, wait: float = 30.0) -> Iterator[Callable[[StreamingQuery], DataFrame]]:
    """Inside, collects every report of the queries that are started; the function it gives makes rows of an ended query's.

    A query itself holds its last hundred reports only.
    """
    reports: list[dict] = []
    ended: set[str] = set()
    listener = StatisticsListener(lambda text: reports.append(json.loads(text)), lambda name, error: ended.add(name))
    spark.streams.addListener(listener)

    def rows(query: StreamingQuery) -> DataFrame:
        until = time.time() + wait
        while str(query.id) not in ended:  # events come after the fact
            if time.time() > until:
                raise TimeoutError("the query has not ended")
            time.sleep(0.05)
        found = [(int(p["batchId"]), int(p["numInputRows"])) for p in reports if p["id"] == str(query.id)]
        return spark.createDataFrame(found, "batch_id long, input_rows long")

    try:
        yield rows
    finally:
        spark.streams.removeListener(listener)

