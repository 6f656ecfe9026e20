"""A session with the settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "corpusmill", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins, Arrow transfer; anything else by ``conf``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return builder.config(map=fixed | {k.replace("_", "."): v for k, v in conf.items()}).getOrCreate()
