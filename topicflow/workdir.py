"""Where jobs keep tables between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: The temporary folder of each application that names no shared one.
_local: dict[str, str] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share: ``spark.checkpoint.dir``.

    Only where that is unset in local mode (tests) a local temporary folder takes its place: on a
    cluster each executor would write to its own, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is to name a folder that driver and executors share")
    if not base:
        base = _local.setdefault(spark.sparkContext.applicationId, "")
        if not base:
            base = _local[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="topicflow-")
    return f"{base.rstrip('/')}/topicflow/{name}-{uuid.uuid4().hex}"
