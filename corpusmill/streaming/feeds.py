"""Streams over files: the job log's state, a change feed, and dropped files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import runs, snapshots


def follow(spark: SparkSession, path: str, schema, state: str, checkpoint: str, step) -> None:
    """Run ``step(batch, state folder)`` over what is new below a folder, then stop."""
    stream = spark.readStream.schema(schema).parquet(path)
    query = stream.writeStream.foreachBatch(lambda batch, _: step(batch, state)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _versions(spark: SparkSession, state: str) -> DataFrame | None:
    try:
        rows = spark.read.parquet(state)
    except Exception as error:  # nothing written yet
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0]).drop("batch")


def latest_runs(batch: DataFrame, state: str) -> None:
    """Keep the latest run of every stage, as a new version of the state."""
    spark = batch.sparkSession
    old = _versions(spark, state)
    every = batch if old is None else batch.unionByName(old)
    number = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    runs.last_per_stage(every).write.parquet(f"{state}/batch={number}")


def changes(batch: DataFrame, state: str) -> None:
    """Merge a batch of entries (id, revision, hash, size, namespace) into the snapshot."""
    spark = batch.sparkSession
    newest = snapshots.first_seen(batch, "id", [F.desc("revision")])
    old = _versions(spark, state)
    number = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    (newest if old is None else snapshots.merge(old, newest)).write.parquet(f"{state}/batch={number}")


def current(spark: SparkSession, state: str) -> DataFrame | None:
    return _versions(spark, state)
