"""Namespaces, media and the link graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids


def namespaces(pages: DataFrame) -> DataFrame:
    """Per parent namespace: pages, depth, and whether it has a start page."""
    ns = F.when(ids.parent_namespace(F.col("page_id")) == "", "root").otherwise(ids.parent_namespace(F.col("page_id")))
    return pages.groupBy(ns.alias("namespace")).agg(F.count("*").alias("pages"), F.max(ids.depth(F.col("page_id"))).alias("max_depth"), F.coalesce(F.bool_or(F.col("page_id").endswith("start")), F.lit(False)).alias("has_start"))


def depth_histogram(pages: DataFrame) -> DataFrame:
    return pages.groupBy(ids.depth(F.col("page_id")).alias("depth")).agg(F.count("*").alias("pages"))


def namespace_prefixes(pages: DataFrame, most: int = 3) -> DataFrame:
    """Every namespace above a page down to a depth, and the root."""
    found = pages.select(F.explode(ids.prefixes(F.col("page_id"), most)).alias("namespace")).distinct()
    return found.unionByName(pages.sparkSession.createDataFrame([("",)], "namespace string")).distinct()


def rollup(pages: DataFrame, by: Column, name: str) -> DataFrame:
    """Count, characters and mean (floored) by a key."""
    return pages.groupBy(by.alias(name)).agg(F.count("*").alias("pages"), F.sum("n_chars").cast("long").alias("chars"), F.floor(F.sum("n_chars") / F.count("*")).cast("long").alias("mean_chars"))


def media_inventory(media: DataFrame) -> DataFrame:
    ext = ids.extension(F.col("media_id"))
    first = lambda f, other: f(F.col("media_id"), F.struct("size", other))
    return media.groupBy(ext.alias("extension")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), first(F.min_by, "media_id").alias("smallest"), first(F.max_by, "media_id").alias("largest"))


def size_buckets(pages: DataFrame, bucket: Column) -> DataFrame:
    return pages.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("pages"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))


def extremes(pages: DataFrame) -> DataFrame:
    """One row: the largest and the smallest page with their bytes; ties by id."""
    size = F.octet_length("text")
    at = lambda f, sign: f(F.struct("page_id", size.alias("bytes")), F.struct(size * sign, F.col("page_id")))
    both = pages.agg(at(F.min_by, -1).alias("a"), at(F.min_by, 1).alias("z"))
    return both.select(F.col("a.page_id").alias("largest"), F.col("a.bytes").cast("long").alias("largest_bytes"), F.col("z.page_id").alias("smallest"), F.col("z.bytes").cast("long").alias("smallest_bytes"))


def top_targets(links: DataFrame, kind: str, n: int = 20) -> DataFrame:
    counts = links.where(F.col("kind") == kind).groupBy("target").agg(F.count("*").alias("links"))
    return counts.orderBy(F.desc("links"), "target").limit(n)


def top_domains(links: DataFrame, n: int = 20) -> DataFrame:
    domain = F.regexp_extract("target", "^[a-z]+://([^/]+)", 1)
    return links.where("kind = 'external'").groupBy(domain.alias("domain")).agg(F.count("*").alias("links")).orderBy(F.desc("links"), "domain").limit(n)


def link_statistics(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Totals by kind and means per page; 0 where there are no pages."""
    kinds = [F.count_if(F.col("kind") == k).alias(f"{k}_links") for k in ("internal", "external", "media")]
    total = links.agg(F.count("*").alias("links"), *kinds)
    mean = F.coalesce(F.try_divide(F.col("links").cast("double"), F.col("pages")), F.lit(0.0))
    return total.crossJoin(pages.agg(F.count("*").alias("pages"))).withColumn("links_per_page", F.round(mean, 6))


def orphans(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Pages that no internal link points to; the start page is none."""
    targets = links.where("kind = 'internal'").select(F.col("target").alias("page_id")).distinct()
    return pages.where("page_id <> 'start'").join(targets, "page_id", "left_anti")


def broken_links(links: DataFrame) -> DataFrame:
    """Per page the targets that do not exist; links count as existing where nothing is said."""
    gone = links.where((F.col("kind") == "internal") & ~F.coalesce(F.col("exists"), F.lit(True)))
    return gone.groupBy("page_id").agg(F.count("*").alias("broken"), F.array_join(F.sort_array(F.collect_set("target")), ",").alias("targets"))


def media_usage(media: DataFrame, links: DataFrame) -> DataFrame:
    """References (with repeats) and distinct referring pages of every listed file."""
    used = links.where("kind = 'media'").groupBy(F.col("target").alias("media_id")).agg(F.count("*").alias("references"), F.count_distinct("page_id").alias("pages"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return media.join(used, "media_id", "left").select("media_id", "type", "size", zero("references"), zero("pages"))


def unused_media(media: DataFrame, links: DataFrame) -> DataFrame:
    return media.join(links.where("kind = 'media'").select(F.col("target").alias("media_id")).distinct(), "media_id", "left_anti")


# Why a referenced file is missing; the first that holds.
MISSING = [
    ("EXTERNAL", "External URL, not hosted on wiki"),
    ("ARCHIVED", "In archive namespace, may be intentionally removed"),
    ("REPLACED", "Likely replaced by newer version"),
    ("DELETED", "Temporary/test file, likely intentionally removed"),
    ("MISSING", "Referenced but not available for download"),
]


def missing_media(media: DataFrame, links: DataFrame) -> DataFrame:
    """(media_id, status, reason) of referenced files that are not listed."""
    wanted = links.where("kind = 'media'").select(F.col("target").alias("media_id")).distinct().join(media, "media_id", "left_anti")
    m, low = F.col("media_id"), F.lower("media_id")
    any_of = lambda *marks: F.greatest(*(F.contains(low, F.lit(x)) for x in marks))
    rules = (m.startswith("http") | F.contains(m, F.lit("%")), F.contains(m, F.lit(":archive:")) | m.startswith("archive:"), any_of("_v1", "_v2", "_old", "_backup"), any_of("draft", "temp", "test"), F.lit(True))
    found = F.coalesce(*(F.when(rule, F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))) for rule, (status, reason) in zip(rules, MISSING, strict=True)))
    return wanted.select("media_id", found.alias("x")).select("media_id", "x.status", "x.reason")


def summary(pages: DataFrame, media: DataFrame, links: DataFrame) -> DataFrame:
    """One row of totals."""
    one = pages.agg(F.count("*").alias("pages"), F.sum("n_chars").cast("long").alias("chars"), F.count_distinct(ids.top_namespace(F.col("page_id"))).alias("namespaces"))
    return one.crossJoin(media.agg(F.count("*").alias("media"), F.sum("size").alias("media_bytes"))).crossJoin(links.agg(F.count("*").alias("links")))


def deepest(pages: DataFrame, n: int = 10) -> DataFrame:
    return pages.select("page_id", ids.depth(F.col("page_id")).alias("depth")).orderBy(F.desc("depth"), "page_id").limit(n)


def recent(pages: DataFrame, n: int = 50) -> DataFrame:
    return pages.orderBy(F.desc("modified"), "page_id").limit(n)


def distinct_targets(links: DataFrame) -> DataFrame:
    """Per kind: how many different pages, files or (of outside links) domains, and the first of them."""
    to = F.when(F.col("kind") == "external", F.regexp_extract("target", "https?://([^/]+)", 1)).otherwise(F.col("target"))
    return links.where(F.coalesce(to, F.lit("")) != "").groupBy("kind").agg(F.count_distinct(to).alias("targets"), F.min(to).alias("first"))
