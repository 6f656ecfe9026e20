"""Tables written in between, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a folder is made only where that is unset and all runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _own.get(context.applicationId) or _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="scratch-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written and read again: what follows starts from the files."""
    path = scratch(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.parquet(path)
