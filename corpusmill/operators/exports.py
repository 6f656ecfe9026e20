"""What leaves the corpus: front matter, metadata of chunks, manifests; and the lookups and filters that feed it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from . import pages as P

#: Defaults of exported fields.
PAGE_DEFAULTS = {"title": "", "namespace": "", "source": "", "page_id": "", "access_level": "public", "content_type": "KNOWLEDGE", "freshness_score": 0.5, "freshness_category": "recent", "chunking_method": "semantic", "last_modified": "", "author": ""}
MEDIA_DEFAULTS = {"title": "", "namespace": "", "source": "", "media_id": "", "access_level": "public", "content_type": "DOCUMENT", "freshness_score": 0.5, "freshness_category": "recent", "chunking_method": "metadata_only", "last_modified": "", "author": ""}
SCHEMA_VERSION = "2.0"
#: Metadata of a chunk, in their order; those of the second line are left out where they are empty.
CHUNK_FIELDS = ("source", "collection", "title", "namespace", "page_id", "media_id", "access_level", "content_type", "freshness_score", "freshness_category", "chunk_index", "total_chunks", "original_length", "embedding_model", "embedding_dimensions", "created_at", "links_to", "linked_from", "media_refs", "referenced_by")
IF_SET = ("page_id", "media_id", "freshness_score", "freshness_category", "links_to", "linked_from", "media_refs", "referenced_by")


def export_fields(rows: DataFrame, defaults: dict, body: str = "body") -> DataFrame:
    """Exported fields with their defaults, a digest of the body, and links in both directions (none where not given)."""
    lists = {c: (F.coalesce(c, F.array().cast("array<string>")) if c in rows.columns else F.array().cast("array<string>")) for c in ("links_to", "linked_from")}
    fields = {c: (F.coalesce(F.col(c).cast("double" if isinstance(v, float) else "string"), F.lit(v)) if c in rows.columns else F.lit(v)) for c, v in defaults.items()}
    return rows.select(*(c.alias(n) for n, c in fields.items()), F.md5(body).alias("content_hash"), *(c.alias(n) for n, c in lists.items()), body)


def export_manifest(pages: DataFrame, media: DataFrame, exported_at: Column, config_hash: str = "n/a", code_version: str = "1.0.0") -> DataFrame:
    """One row: when, how much, and of which schema, configuration and code."""
    counts = pages.agg(F.count("*").alias("pages_count")).crossJoin(media.agg(F.count("*").alias("media_count")))
    return counts.select(exported_at.alias("exported_at"), "pages_count", "media_count", (F.col("pages_count") + F.col("media_count")).alias("total_count"), F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(config_hash).alias("config_hash"), F.lit(code_version).alias("code_version"))


def chunk_metadata(chunks: DataFrame, include: dict[str, bool] | None = None) -> Column:
    """Metadata of a chunk as JSON: the fields that are not switched off and that the chunks have."""
    chosen = [f for f in CHUNK_FIELDS if f in chunks.columns and (include or {}).get(f, True)]
    kinds = dict(chunks.dtypes)
    value = lambda f: F.nullif(F.col(f), F.lit("")).alias(f) if f in IF_SET and kinds[f] == "string" else F.col(f)
    return F.to_json(F.struct(*(value(f) for f in chosen)))


def title_case(text: Column) -> Column:
    """Every run of letters with its first in upper case and the others in lower case."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0)), F.initcap), "")


def page_front_matter(pages: DataFrame, base_url: str, most: int = 20) -> DataFrame:
    """Fields of a page's front matter.

    Input: page_id, title, permission, flagged, and lists links_to, media_refs, external, linked_from.
    A page without a title has that of its last segment; more than reading is for teachers.
    """
    page = F.translate("page_id", "_", ":")
    last = F.substring_index("page_id", ":", -1)
    size = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>")))
    head = lambda c: F.slice(F.coalesce(c, F.array().cast("array<string>")), 1, most)
    return pages.select(
        F.coalesce(F.nullif("title", F.lit("")), title_case(F.translate(last, "_", " "))).alias("title"), page.alias("page_id"), F.translate(ids.parent_namespace(F.col("page_id")), "_", ":").alias("namespace"), F.concat(F.lit(base_url), page).alias("source"),
        F.when(F.coalesce("permission", F.lit(1)) > 1, "teacher_only").otherwise("public").alias("access_level"), head("links_to").alias("links_to"), head("media_refs").alias("media_refs"),
        F.struct(size("links_to").alias("internal"), size("external").alias("external"), size("media_refs").alias("media")).alias("link_summary"), F.coalesce("linked_from", F.array().cast("array<string>")).alias("linked_from"),
        F.when(F.coalesce("flagged", F.lit(False)), "review_needed").alias("quality_flag"), P.content_type(F.col("page_id"), ids.parent_namespace(F.col("page_id"))).alias("content_type"),
    )


def media_front_matter(media: DataFrame, base_url: str = "") -> DataFrame:
    """Fields of a media file's front matter: media_id, and optionally those with defaults."""
    name = F.substring_index("media_id", ":", -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    source = F.concat(F.lit(base_url + "lib/exe/fetch.php?media="), "media_id") if base_url else F.lit("")
    kind = P.media_type(ids.extension(name))
    given = lambda c, other: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), other) if c in media.columns else other
    return media.select(
        title_case(F.translate(stem, "_", " ")).alias("title"), ids.parent_namespace(F.col("media_id")).alias("namespace"), source.alias("source"), "media_id", P.media_access(F.col("media_id")).alias("access_level"), given("content_type", kind).alias("content_type"),
        (F.coalesce("freshness_score", F.lit(0.5)) if "freshness_score" in media.columns else F.lit(0.5)).alias("freshness_score"), given("freshness_category", F.lit("recent")).alias("freshness_category"), given("chunking_method", F.lit("metadata_only")).alias("chunking_method"),
        given("last_modified", F.lit("")).alias("last_modified"), given("author", F.lit("")).alias("author"),
    )


def media_of_href(href: Column) -> Column:
    """Media id of a link: its media parameter, that of a detail page, else the link itself."""
    media, detail = F.regexp_extract(href, "media=([^&]+)", 1), F.regexp_extract(href, "id=([^&]+)", 1)
    return F.when(media != "", media).when((detail != "") & F.contains(href, F.lit("/detail.php")), detail).otherwise(href)


def media_of_src(src: Column) -> Column:
    """Media id of an image; empty without one."""
    return F.regexp_extract(src, "media=([^&]+)", 1)


def looked_up(files: DataFrame, side: DataFrame, key: str, other: str) -> DataFrame:
    """Left lookup by ``key`` and, where that is not found, by ``other``; ``side`` is (id, value)."""
    of = lambda name: side.select(F.col("id").alias(name), F.col("value").alias(f"by_{name}"))
    joined = files.join(of(key), key, "left").join(of(other), other, "left")
    return joined.withColumn("value", F.coalesce(f"by_{key}", f"by_{other}")).drop(f"by_{key}", f"by_{other}")


def type_included(name: Column, include: list[str], exclude: list[str]) -> Column:
    """Is the suffix among those wanted (all, where none is named) and not among those unwanted?"""
    ext = ids.extension(name)
    inside = ext.isin(*include) if include else F.lit(True)
    return inside & ~(ext.isin(*exclude) if exclude else F.lit(False))


def without_ignored(pages: DataFrame, ignored: DataFrame, key: str = "page_id") -> DataFrame:
    return pages.join(ignored.select(key), key, "left_anti")


def failed(errors: DataFrame, kind: str) -> DataFrame:
    """(id, kind): what an error log (type, page_id, media_id) says could not be fetched; kind is page or media."""
    mark, column = ("page_fetch", "page_id") if kind == "page" else ("media", "media_id")
    return errors.where(F.contains("type", F.lit(mark)) & (F.coalesce(column, F.lit("")) != "")).select(F.col(column).alias("id"), F.lit(kind).alias("kind")).distinct()


def retried(log: DataFrame, errors: DataFrame, fetch) -> DataFrame:
    """Items of the log with those that failed fetched again by ``fetch``."""
    again = log.join(failed(errors, "page").unionByName(failed(errors, "media")).select("id").distinct(), "id", "left_semi")
    return log.join(again.select("id"), "id", "left_anti").unionByName(fetch(again).select(*log.columns))


def discovered_media(links: DataFrame, listed: DataFrame) -> DataFrame:
    """(media_id, source_page) of valid files that pages refer to and the listing lacks; the first page by id tells of it."""
    wanted = links.where((F.col("kind") == "media") & ids.valid_media(F.col("target")))
    return wanted.groupBy(F.col("target").alias("media_id")).agg(F.min("page_id").alias("source_page")).join(listed.select("media_id"), "media_id", "left_anti")


def invalid_references(links: DataFrame) -> DataFrame:
    return links.where((F.col("kind") == "media") & ~ids.valid_media(F.col("target"))).agg(F.count("*").alias("invalid"))


def cache_plan(wanted: DataFrame, index: DataFrame) -> DataFrame:
    """(media_id, state) of wanted files (media_id, hash): hit, or miss where no copy is cached or its content is another."""
    joined = wanted.join(index.select("media_id", F.col("hash").alias("expected"), F.col("content_hash").alias("found"), "size"), "media_id", "left")
    sound = F.coalesce(F.col("expected"), F.lit("")) == ""
    hit = F.col("found").isNotNull() & (sound | (F.col("expected") == F.col("found")))
    return joined.select("media_id", F.when(hit, "hit").otherwise("miss").alias("state"), F.when(hit, F.col("size")).otherwise(0).alias("bytes_saved"))


def with_flags(pages: DataFrame, flagged: DataFrame, overall: Column | None = None) -> DataFrame:
    """Pages with whether they, or their name with underscores, are flagged, and an overall quality (0.5 where unknown)."""
    marks = flagged.select(F.translate("page_id", "_", ":").alias("key")).distinct().withColumn("is_flagged", F.lit(True))
    joined = pages.withColumn("key", F.translate("page_id", "_", ":")).join(marks, "key", "left").drop("key")
    return joined.withColumns({"is_flagged": F.coalesce("is_flagged", F.lit(False)), "overall_quality": F.coalesce(overall, F.lit(0.5)) if overall is not None else F.lit(0.5)})


def document_stats(docs: DataFrame) -> DataFrame:
    """Documents, their collection, access and mean length by content type; a missing type is unknown."""
    kind = F.coalesce(F.nullif("content_type", F.lit("")), F.lit("UNKNOWN"))
    of = lambda column, value: F.count_if(F.col(column) == value)
    return docs.groupBy(kind.alias("content_type")).agg(F.count("*").alias("documents"), of("collection", "pages").alias("pages"), of("collection", "media").alias("media"), of("access_level", "public").alias("public"), of("access_level", "teacher_only").alias("teacher_only"), F.round(F.avg(F.length("content")), 6).alias("mean_length"))


def classification_rollup(pages: DataFrame) -> DataFrame:
    """Per namespace: pages, characters, words, media references, floored mean, restricted, archived."""
    return pages.groupBy("namespace").agg(
        F.count("*").alias("pages"), F.sum("char_count").alias("chars"), F.sum("word_count").alias("words"), F.sum("media_count").alias("media_refs"), F.floor(F.sum("char_count") / F.count("*")).cast("long").alias("mean_chars"),
        F.count_if("restricted").alias("restricted"), F.count_if(~F.col("restricted")).alias("public"), F.count_if("archived").alias("archived"),
    )


def throughput(runs: DataFrame) -> DataFrame:
    """Runs (model, chunks, seconds) with chunks a second; null where no time passed."""
    return runs.withColumn("per_second", F.try_divide(F.col("chunks").cast("double"), F.col("seconds")))
