"""Small helpers that the operators share: columns that pass through, and shared storage."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def with_columns(schema: T.StructType, added: list[tuple[str, T.DataType]]) -> T.StructType:
    """Input fields followed by added ones; an input field with an added name gives way to it."""
    names = {n.lower() for n, _ in added}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + [T.StructField(n, t, True) for n, t in added])


def extend(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with added columns at its end, in the order of :func:`with_columns`."""
    names = {n.lower() for n in added}
    keep = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n.lower() not in names]
    return pa.RecordBatch.from_arrays([*(c for _, c in keep), *added.values()], names=[*(n for n, _ in keep), *added])


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; one is made only where the session names none and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = _own.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="shared-")
        _own[context.applicationId] = found
    return found


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Take away a folder that was written for a step in between."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(frame: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder: lineage ends here, and a lost executor loses nothing."""
    spark = frame.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return frame.checkpoint(eager=True)


def written(frame: DataFrame, path: str) -> DataFrame:
    """The frame written to the shared folder and read again: a checkpoint of narrow rows in a tenth of the space."""
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.parquet(path)


def dealt(frame: DataFrame, parts: int, key: str) -> DataFrame:
    """Checkpoint of the frame dealt by a key; later joins on the key move the other side only.

    Adaptive execution is off while it is planned, as it would hide how the rows are dealt.
    """
    conf, name = frame.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return cut(frame.repartition(parts, key))
    finally:
        conf.set(name, before)


def tidy(run):
    """A batch function that gives memory back when its partition ends; workers outlive their tasks."""

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped
