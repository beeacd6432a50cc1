"""What a bad record does: stop, be dropped, or have the job start again.

Rows are judged one by one: repeated ones alike, null values by their error_code alone, and empty
tables give none. ``directive`` replaces a column of that name; ``streaming.supervised`` is the same in a job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

STOP, RESUME, RESTART = "stop", "resume", "restart"
#: The first two cannot be changed.
FIXED = {"FATAL": STOP, "RETRIABLE": RESUME}
DEFAULTS = {
    "KEY_DESERIALIZATION": STOP, "VALUE_DESERIALIZATION": STOP, "KEY_SERIALIZATION": STOP, "VALUE_SERIALIZATION": STOP,
    "INVALID_TOPIC": STOP, "INVALID_PARTITION": STOP, "INVALID_TIMESTAMP": STOP, "CONSUME": RESUME,
}
T = TypeVar("T")


def policy(overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """The directive of each error code. Unknown codes stop."""
    bad = set(overrides or {}) & set(FIXED)
    if bad:
        raise ValueError(f"fixed: {', '.join(sorted(bad))}")
    wrong = set((overrides or {}).values()) - {STOP, RESUME, RESTART}
    if wrong:
        raise ValueError(f"unknown directives: {', '.join(sorted(wrong))}")
    return DEFAULTS | dict(overrides or {}) | FIXED


def directive(code: Column, table: Mapping[str, str]) -> Column:
    """The directive of a row: null where it has no error."""
    out = F.when(code.isNull(), F.lit(None).cast("string"))
    for k, v in table.items():
        out = out.when(code == k, F.lit(v))
    return out.otherwise(F.lit(STOP))


def apply_policy(decoded: DataFrame, overrides: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the dead letters of those whose directive is to resume.

    A row that must stop the job, or restart it, raises as it is read. Good rows have neither
    ``directive`` nor ``error_code``; letters keep those of topic, partition, offset, raw_key, raw_value, error_code and directive that there are.
    """
    marked = decoded.withColumn("directive", directive(F.col("error_code"), policy(overrides)))
    fails = F.col("directive").isin(STOP, RESTART)
    message = F.concat(F.lit("record failed: "), F.col("error_code"), F.lit(", "), F.col("directive"))
    good = marked.filter(F.when(fails, F.raise_error(message).cast("boolean")).otherwise(F.col("error_code").isNull()))
    letters = marked.filter(F.col("directive") == RESUME)
    kept = [c for c in ("topic", "partition", "offset", "raw_key", "raw_value", "error_code", "directive") if c in marked.columns]
    return good.drop("directive", "error_code"), letters.select(*kept)


def counted_drop(decoded: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows without an error; the observation has ``dropped`` once they have been read."""
    seen = Observation("dropped")
    counted = decoded.observe(seen, F.count(F.when(F.col("error_code").isNotNull(), 1)).alias("dropped"))
    return counted.filter("error_code is null"), seen


def restarting(job: Callable[[int], T], retries: int = 3) -> T:
    """Runs ``job(attempt)`` again from its start position after a failure; raises the last one."""
    for attempt in range(retries + 1):
        try:
            return job(attempt)
        except Exception:
            if attempt == retries:
                raise
    raise AssertionError("unreachable")
