"""Strategy configuration: categories with their ids, turned into one row for each id."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "page_id string, content_type string, method string, size int, action string"
KNOWN = ("KNOWLEDGE", "NEWS", "PORTAL", "FORM", "TABLE_DATA", "ARCHIVED", "EMPTY", "IGNORED")


def from_yaml(spark: SparkSession, text: str) -> DataFrame:
    """Rows of a configuration text: ``categories: {NAME: {method, size, action, include_ids, overrides}}``."""
    rows = []
    for name, settings in (yaml.safe_load(text) or {}).get("categories", {}).items():
        kind = name.upper() if name.upper() in KNOWN else "KNOWLEDGE"
        overrides = settings.get("overrides", {})
        for page in settings.get("include_ids", []):
            own = settings | overrides.get(page, {})
            rows.append((page, kind, own.get("method", "semantic"), int(own.get("size", 512)), own.get("action", "process")))
    return spark.createDataFrame(rows, SCHEMA)


def from_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the older form: a list of pages with their type and chunk size; unknown types are KNOWLEDGE."""
    rows = spark.read.schema("page_id string, content_type string, recommended_chunk_size int").option("multiLine", "true").json(path).where("coalesce(page_id, '') <> ''")
    kind = F.upper("content_type")
    return rows.select("page_id", F.when(kind.isin(*KNOWN), kind).otherwise("KNOWLEDGE").alias("content_type"), F.lit("semantic").alias("method"), F.coalesce("recommended_chunk_size", F.lit(512)).alias("size"), F.lit("process").alias("action"))


def media_strategy(media: DataFrame, strategies: DataFrame) -> DataFrame:
    """Media files with the action stated for their name, else to be captioned."""
    return media.join(strategies.select("name", "action"), "name", "left").withColumn("action", F.coalesce("action", F.lit("process")))
