"""The job log: latest, active, retained runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_per_stage(runs: DataFrame) -> DataFrame:
    order = Window.partitionBy("stage").orderBy(F.desc("started_at"), F.desc("job_id"))
    return runs.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")


def active(runs: DataFrame) -> DataFrame:
    """The latest running job, at most one row."""
    return runs.where("status = 'running'").orderBy(F.desc("started_at"), F.desc("job_id")).limit(1)


def upsert(runs: DataFrame, updates: DataFrame, most: int = 100) -> DataFrame:
    """Updates replace runs of the same id; the newest ``most`` stay."""
    every = runs.withColumn("p", F.lit(1)).unionByName(updates.withColumn("p", F.lit(0)))
    latest = every.withColumn("n", F.row_number().over(Window.partitionBy("job_id").orderBy("p"))).where("n = 1").drop("n", "p")
    return latest.orderBy(F.desc("started_at"), F.desc("job_id")).limit(most)


def status_summary(runs: DataFrame) -> DataFrame:
    """Per stage: runs, failures, the last status and mean seconds."""
    last = last_per_stage(runs).select("stage", F.col("status").alias("last_status"), F.col("job_id").alias("last_job"))
    return runs.groupBy("stage").agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "failed").alias("failed"), F.round(F.avg("seconds"), 6).alias("mean_seconds")).join(last, "stage")
