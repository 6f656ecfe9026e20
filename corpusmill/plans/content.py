"""Page quality, freshness, readiness and classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fresh, ids
from ..operators import pages as P
from . import inputs as I

_AGE = f"(epoch(TIMESTAMP '{I.AS_OF}') - epoch(modified)) / 86400.0e0"
_NS = "CASE WHEN contains(page_id, ':') THEN regexp_replace(page_id, ':[^:]*$', '') ELSE '' END"
_YEARS = "list_sort(list_distinct(list_transform(regexp_extract_all(text, '\\b20[0-9]{2}\\b'), lambda y: CAST(y AS INT))))"


def _as_of() -> Column:
    return F.lit(I.AS_OF).cast("timestamp")


def _lit(text: str, mark: str) -> str:
    return f"CAST((length({text}) - length(replace({text}, '{mark}', ''))) / {len(mark)} AS BIGINT)"


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page evaluation of the wiki pages with their links."""
    links = I.links(spark, sf_dir)
    counts = links.groupBy("page_id").agg(F.count("*").alias("link_count"), F.count_if((F.col("kind") == "internal") & ~F.col("exists")).alias("broken_count"))
    targets = links.where("kind = 'internal'").select(F.col("target").alias("page_id")).distinct().withColumn("linked", F.lit(True))
    pages = I.wiki(spark, sf_dir).join(counts, "page_id", "left").join(targets, "page_id", "left")
    pages = pages.withColumns({"link_count": F.coalesce("link_count", F.lit(0)), "broken_count": F.coalesce("broken_count", F.lit(0)), "linked": F.coalesce("linked", F.lit(False)), "freshness": fresh.by_steps(fresh.age_days(F.col("modified"), _as_of()))})
    return P.evaluate(pages)


_EVALUATED = f"""
    WITH links AS ({I.LINKS}),
    counts AS (SELECT page_id, count(*) AS link_count, count(*) FILTER (WHERE kind = 'internal' AND NOT exists_) AS broken_count FROM links GROUP BY page_id),
    targets AS (SELECT DISTINCT target AS page_id FROM links WHERE kind = 'internal'),
    base AS (SELECT w.page_id, content, coalesce(link_count, 0) AS link_count, coalesce(broken_count, 0) AS broken_count, t.page_id IS NOT NULL AS linked,
        CASE WHEN modified IS NULL THEN 0.5e0 WHEN {_AGE} < 30 THEN 1.0e0 WHEN {_AGE} < 180 THEN 0.8e0 WHEN {_AGE} < 365 THEN 0.6e0 WHEN {_AGE} < 730 THEN 0.4e0 ELSE 0.2e0 END AS freshness,
        length(content) AS char_count, len(regexp_extract_all(content, '[^\\s]+')) AS word_count,
        {_lit('content', '====')} + {_lit('content', '===')} + {_lit('content', '==')} AS heading_count,
        {_lit('content', '<code>')} + {_lit('content', '<file>')} AS code_block_count, {_lit('content', '^')} // 2 AS table_count,
        length(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(content, '{{{{', ''), '}}}}', ''), '[[', ''), ']]', ''), '====', ''), '===', ''), '==', ''), '  *', ''), '  -', ''), '^\\s+|\\s+$', '', 'g')) < 50 AS is_template_only
        FROM ({I.WIKI}) w LEFT JOIN counts USING (page_id) LEFT JOIN targets t ON t.page_id = w.page_id),
    parts AS (SELECT *, char_count < 50 AS is_empty, char_count >= 50 AND char_count < 200 AS is_stub, NOT linked AND page_id <> 'start' AS is_orphan,
        CASE WHEN char_count < 50 THEN 0e0 ELSE least(1e0,
            CASE WHEN char_count > 2000 THEN 0.4e0 WHEN char_count > 1000 THEN 0.3e0 WHEN char_count > 500 THEN 0.2e0 ELSE 0.1e0 END
            + CASE WHEN word_count = 0 THEN 0e0 WHEN CAST(char_count AS DOUBLE) / word_count BETWEEN 4 AND 8 THEN 0.3e0 ELSE 0.1e0 END
            + CASE WHEN heading_count > 0 OR code_block_count > 0 OR table_count > 0 THEN 0.3e0 WHEN char_count > 500 THEN 0.1e0 ELSE 0e0 END) END AS content_quality,
        CASE WHEN heading_count >= 3 THEN 0.4e0 WHEN heading_count >= 1 THEN 0.2e0 ELSE 0e0 END + CASE WHEN code_block_count > 0 THEN 0.3e0 ELSE 0e0 END + CASE WHEN table_count > 0 THEN 0.3e0 ELSE 0e0 END AS structure_quality,
        greatest(0e0, least(1e0, 0.5e0 + CASE WHEN link_count > 0 THEN 0.2e0 ELSE 0e0 END + CASE WHEN linked OR page_id = 'start' THEN 0.2e0 ELSE 0e0 END - CASE WHEN broken_count > 0 THEN 0.3e0 ELSE 0e0 END)) AS link_quality FROM base),
    scored AS (SELECT *, round(content_quality * 0.4e0 + structure_quality * 0.2e0 + link_quality * 0.2e0 + freshness * 0.2e0, 6) AS quality_score FROM parts),
    e AS (SELECT *, CASE WHEN quality_score < 0.5e0 OR is_empty THEN 'exclude' WHEN quality_score < 0.7e0 OR is_stub THEN 'review' ELSE 'include' END AS recommendation,
        concat_ws(',', CASE WHEN is_empty THEN 'empty' END, CASE WHEN is_stub THEN 'stub' END, CASE WHEN is_template_only THEN 'template' END, CASE WHEN broken_count > 0 THEN 'broken_links' END, CASE WHEN is_orphan THEN 'orphan' END) AS flags FROM scored)
"""


def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluated(spark, sf_dir).select("page_id", "char_count", "word_count", "heading_count", "code_block_count", "table_count", *(F.round(c, 6).alias(c) for c in ("content_quality", "structure_quality", "link_quality", "freshness")), "quality_score", "recommendation", F.array_join("flags", ",").alias("flags"))


def quality_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quality_summary(evaluated(spark, sf_dir))


def flagged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.flagged(evaluated(spark, sf_dir)).select("page_id", F.array_join("flags", ",").alias("flags"))


def pages_to_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.recommended(evaluated(spark, sf_dir), "include").select("page_id", "quality_score")


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    # some texts name a year
    pages = I.pages(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" Stand "), (F.col("doc_id") % 26 + 2001).cast("string"), F.lit("/"), (F.col("doc_id") % 7 + 2018).cast("string"))).otherwise(F.col("text")))
    return pages.withColumns({"days": fresh.whole_days(F.col("modified"), _as_of()), "archived": F.col("page_id").startswith("archive"), "years": fresh.years(F.col("text")), "ns": ids.parent_namespace(F.col("page_id"))})


_DATED = f"(SELECT *, floor({_AGE}) AS days, starts_with(page_id, 'archive') AS archived, {_YEARS} AS years, {_NS} AS ns FROM (SELECT * REPLACE (CASE WHEN doc_id % 4 = 0 THEN text || ' Stand ' || (doc_id % 26 + 2001) || '/' || (doc_id % 7 + 2018) ELSE text END AS text) FROM ({I.PAGES})))"


def freshness_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, newest = _dated(spark, sf_dir), F.array_max("years")
    days, ns, old = F.col("days"), F.col("ns"), F.col("archived")
    return d.select(
        "page_id", F.round(fresh.by_steps(fresh.age_days(F.col("modified"), _as_of())), 6).alias("by_steps"),
        F.round(fresh.linear_score(days, old, newest, I.YEAR), 6).alias("linear_score"), fresh.linear_category(days, old, newest, I.YEAR).alias("linear_category"),
        F.round(fresh.loose_score(days, ns), 6).alias("loose_score"), fresh.loose_category(days, ns).alias("loose_category"), fresh.plain_category(days).alias("plain_category"),
    )


def rag_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _dated(spark, sf_dir)
    category = fresh.linear_category(F.col("days"), F.col("archived"), F.array_max("years"), I.YEAR)
    return d.select("page_id", F.array_join("years", ",").alias("years"), fresh.has_outdated(F.col("years"), I.YEAR).alias("outdated"), fresh.rag_weight(category, F.col("archived"), fresh.has_outdated(F.col("years"), I.YEAR)).alias("weight"))


def temporal_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and mean score of each freshness category."""
    d = _dated(spark, sf_dir)
    args = (F.col("days"), F.col("archived"), F.array_max("years"), I.YEAR)
    return d.groupBy(fresh.linear_category(*args).alias("category")).agg(F.count("*").alias("pages"), F.round(F.avg(fresh.linear_score(*args)), 6).alias("mean_score"))


def year_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir).select(F.explode("years").alias("year")).groupBy("year").agg(F.count("*").alias("pages"))


_LINEAR = "CASE WHEN archived THEN 0.3e0 WHEN days IS NOT NULL THEN CASE WHEN days <= 90 THEN 1e0 WHEN days <= 365 THEN 1e0 - (days - 90) / 275.0e0 * 0.3e0 WHEN days <= 730 THEN 0.7e0 - (days - 365) / 365.0e0 * 0.3e0 ELSE 0.3e0 END WHEN list_max(years) >= 2025 THEN 0.8e0 WHEN list_max(years) >= 2024 THEN 0.6e0 WHEN list_max(years) IS NOT NULL THEN 0.4e0 ELSE 0.5e0 END"
_CATEGORY = "CASE WHEN archived THEN 'archived' WHEN days IS NOT NULL THEN CASE WHEN days <= 90 THEN 'current' WHEN days <= 365 THEN 'recent' ELSE 'outdated' END WHEN list_max(years) >= 2025 THEN 'current' WHEN list_max(years) >= 2024 THEN 'recent' WHEN list_max(years) IS NOT NULL THEN 'outdated' ELSE 'unknown' END"

TYPES = [("form", "(?i)form|license"), ("list", "[|]"), ("news", "(?i)20[0-9]{2}")]
BY_NAMESPACE = {"teaching": ["teacher"], "past": ["archive"], "general": ["ns0", "ns1"]}


def content_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.pages(spark, sf_dir)
    page, ns = F.col("page_id"), ids.parent_namespace(F.col("page_id"))
    return pages.select(
        "page_id", P.content_type(page, ns).alias("content_type"), P.access_level(ns).alias("access_level"), P.media_access(page).alias("media_access"),
        P.page_type(page, F.col("text"), TYPES).alias("page_type"), P.by_membership(ids.top_namespace(page), BY_NAMESPACE).alias("namespace_type"),
        P.time_sensitive(page, F.col("text"), ["(?i)termin", "20[0-9]{2}"]).alias("time_sensitive"), P.size_class(F.col("n_chars")).alias("size_class"),
    )


def classification_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_classify(spark, sf_dir).groupBy("content_type", "access_level").agg(F.count("*").alias("pages"))


def _ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.readiness(I.wiki(spark, sf_dir))


_COUNTED = ("headlines", "lists", "tables", "links", "media_refs", "code_blocks")


def rag_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = ("structure_score", "noise_score", "chunking_score", "metadata_score")
    return _ready(spark, sf_dir).select("page_id", *(f"n_{c}" for c in _COUNTED), *(F.round(c, 6).alias(c) for c in scores), "readiness")


def readiness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.readiness_summary(_ready(spark, sf_dir))


def readiness_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advice on plain texts of which nothing else is known."""
    bare = I.pages(spark, sf_dir).select("page_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("timestamp").alias("modified"), F.col("text").alias("content"))
    return P.recommendations(P.readiness_summary(P.readiness(bare)))


_COUNTS_SQL = ", ".join(f"len(regexp_extract_all(content, '{P.STRUCTURE[c]}')) AS n_{c}" for c in _COUNTED)
_SYNTAX_SQL = " + ".join(_lit("content", s) for s in P.SYNTAX)
_REMOVABLE_SQL = " + ".join(f"len(regexp_extract_all(content, '{p}'))" for p in P.REMOVABLE)
_STRIPPED = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_READY = f"""
    WITH a AS (SELECT page_id, source, lang, modified, content, length(content) AS chars, {_COUNTS_SQL}, {_lit('content', chr(10) + chr(10))} + 1 AS n_paragraphs,
        list_transform(string_split(content, chr(10)), lambda x: {_STRIPPED.format('x')}) AS lines,
        list_filter(list_transform(string_split(content, chr(10) || chr(10)), lambda x: {_STRIPPED.format('x')}), lambda x: x <> '') AS blocks,
        {_REMOVABLE_SQL} AS removable, {_SYNTAX_SQL} AS syntax FROM ({I.WIKI})),
    b AS (SELECT *, len(list_filter(lines, lambda x: x <> '')) AS filled, len(list_filter(lines, lambda x: x <> '' AND length(x) < 20)) AS short,
        len(blocks) AS n_blocks, len(list_filter(blocks, lambda x: length(x) BETWEEN 100 AND 500)) AS fitting FROM a),
    c AS (SELECT *, least(1e0, CASE WHEN n_headlines > 0 THEN 0.4e0 WHEN n_paragraphs > 3 THEN 0.2e0 ELSE 0e0 END + CASE WHEN n_lists > 0 THEN 0.2e0 ELSE 0e0 END
            + CASE WHEN chars BETWEEN 500 AND 10000 THEN 0.3e0 WHEN chars > 100 THEN 0.2e0 ELSE 0e0 END + CASE WHEN n_tables > 0 THEN 0.1e0 ELSE 0e0 END) AS structure_score,
        CASE WHEN chars = 0 THEN 0e0 ELSE least(1e0, least(removable * 0.05e0, 0.2e0) + CASE WHEN 1 - CAST(filled AS DOUBLE) / len(lines) > 0.3e0 THEN 0.1e0 ELSE 0e0 END
            + CASE WHEN CAST(short AS DOUBLE) / nullif(filled, 0) > 0.5e0 THEN 0.1e0 ELSE 0e0 END + least(CAST(syntax AS DOUBLE) / greatest(chars, 1) * 2, 0.3e0)) END AS noise_score,
        least(1e0, CASE WHEN n_headlines > 0 THEN 0.4e0 ELSE 0e0 END + coalesce(CAST(fitting AS DOUBLE) / nullif(n_blocks, 0), 0e0) * 0.4e0 + CASE WHEN n_blocks BETWEEN 3 AND 20 THEN 0.2e0 WHEN n_blocks > 0 THEN 0.1e0 ELSE 0e0 END) AS chunking_score,
        (CASE WHEN page_id IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN source IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN modified IS NOT NULL THEN 1 ELSE 0 END) / 3.0e0 * 0.7e0 + CASE WHEN lang IS NOT NULL THEN 0.3e0 ELSE 0e0 END AS metadata_score FROM b),
    r AS (SELECT *, round(0.25e0 * structure_score + 0.30e0 * (1 - noise_score) + 0.30e0 * chunking_score + 0.15e0 * metadata_score, 6) AS readiness FROM c)
"""

QUERIES = {f.__name__: f for f in (page_quality, quality_distribution, flagged_pages, pages_to_embed, freshness_scales, rag_weight, temporal_rollup, year_histogram, content_classify, classification_counts, rag_readiness, readiness_summary, readiness_advice)}

_CLASSIFY = f"""SELECT page_id,
    CASE WHEN contains(lower(page_id), 'forms') OR contains(lower(ns), 'form') THEN 'FORM_COLLECTION' WHEN lower(page_id) LIKE '%:start' OR lower(page_id) LIKE '%\\_start' ESCAPE '\\' OR lower(page_id) = 'start' THEN 'PORTAL'
        WHEN contains(lower(ns), 'competitions') OR contains(lower(ns), 'wocheninfo') THEN 'NEWS' WHEN contains(lower(ns), 'archive') THEN 'ARCHIVE' WHEN contains(lower(ns), 'tutorial') THEN 'TUTORIAL'
        WHEN lower(ns) IN ('it', 'software', 'wiki') THEN 'TECHNICAL' WHEN contains(lower(ns), 'teacher') THEN 'TEACHER_ONLY' WHEN contains(lower(ns), 'departm') THEN 'DEPARTMENT'
        WHEN contains(lower(ns), 'exams') THEN 'EXAM_INFO' WHEN contains(lower(ns), 'org') THEN 'ORGANIZATION' ELSE 'KNOWLEDGE' END AS content_type,
    CASE WHEN starts_with(lower(ns), 'teacher:') OR starts_with(lower(ns), 'lehrer:') OR lower(ns) IN ('teacher', 'lehrer') THEN 'teacher_only' ELSE 'public' END AS access_level,
    CASE WHEN contains(page_id, ':') AND lower(split_part(page_id, ':', 1)) IN ('teacher', 'lehrer') THEN 'teacher_only' ELSE 'public' END AS media_access,
    CASE WHEN regexp_matches(page_id, '(?i)form|license') OR regexp_matches(substr(text, 1, 1000), '(?i)form|license') THEN 'form' WHEN regexp_matches(page_id, '[|]') OR regexp_matches(substr(text, 1, 1000), '[|]') THEN 'list'
        WHEN regexp_matches(page_id, '(?i)20[0-9]{{2}}') OR regexp_matches(substr(text, 1, 1000), '(?i)20[0-9]{{2}}') THEN 'news' ELSE 'content' END AS page_type,
    CASE split_part(page_id, ':', 1) WHEN 'teacher' THEN 'teaching' WHEN 'archive' THEN 'past' WHEN 'ns0' THEN 'general' WHEN 'ns1' THEN 'general' ELSE 'other' END AS namespace_type,
    regexp_matches(page_id, '(?i)termin') OR regexp_matches(substr(text, 1, 500), '(?i)termin') OR regexp_matches(page_id, '20[0-9]{{2}}') OR regexp_matches(substr(text, 1, 500), '20[0-9]{{2}}') AS time_sensitive,
    CASE WHEN n_chars < 1 THEN 'empty' WHEN n_chars < 50 THEN 'tiny' WHEN n_chars < 1000 THEN 'small' WHEN n_chars < 5000 THEN 'medium' ELSE 'large' END AS size_class
    FROM (SELECT *, {_NS} AS ns FROM ({I.PAGES}))"""
_SUMMARY = "SELECT count(*) AS pages, round(avg(readiness), 6) AS mean_readiness, count(*) FILTER (WHERE readiness >= 0.7) AS ready, count(*) FILTER (WHERE readiness >= 0.4 AND readiness < 0.7) AS partly, count(*) FILTER (WHERE readiness < 0.4) AS not_ready, round(avg(noise_score), 6) AS mean_noise, round(max(noise_score), 6) AS max_noise FROM r"

ORACLE_SQL = {
    "page_quality": f"{_EVALUATED} SELECT page_id, char_count, word_count, heading_count, code_block_count, table_count, round(content_quality, 6) AS content_quality, round(structure_quality, 6) AS structure_quality, round(link_quality, 6) AS link_quality, round(freshness, 6) AS freshness, quality_score, recommendation, flags FROM e",
    "quality_distribution": f"""{_EVALUATED} SELECT count(*) AS pages, round(avg(quality_score), 6) AS overall_quality, count(*) FILTER (WHERE recommendation = 'include') AS pages_to_include, count(*) FILTER (WHERE recommendation = 'review') AS pages_to_review,
        count(*) FILTER (WHERE recommendation = 'exclude') AS pages_to_exclude, count(*) FILTER (WHERE is_empty) AS empty_pages, count(*) FILTER (WHERE is_stub) AS stub_pages, count(*) FILTER (WHERE is_orphan) AS orphan_pages, CAST(sum(broken_count) AS BIGINT) AS broken_links,
        count(*) FILTER (WHERE quality_score >= 0.9) AS excellent, count(*) FILTER (WHERE quality_score >= 0.7 AND quality_score < 0.9) AS good, count(*) FILTER (WHERE quality_score >= 0.5 AND quality_score < 0.7) AS fair,
        count(*) FILTER (WHERE quality_score >= 0.3 AND quality_score < 0.5) AS poor, count(*) FILTER (WHERE quality_score < 0.3) AS very_poor FROM e""",
    "flagged_pages": f"{_EVALUATED} SELECT page_id, flags FROM e WHERE flags <> ''",
    "pages_to_embed": f"{_EVALUATED} SELECT page_id, quality_score FROM e WHERE recommendation = 'include'",
    "freshness_scales": f"""SELECT page_id, CASE WHEN modified IS NULL THEN 0.5e0 WHEN {_AGE} < 30 THEN 1.0e0 WHEN {_AGE} < 180 THEN 0.8e0 WHEN {_AGE} < 365 THEN 0.6e0 WHEN {_AGE} < 730 THEN 0.4e0 ELSE 0.2e0 END AS by_steps,
        round({_LINEAR}, 6) AS linear_score, {_CATEGORY} AS linear_category,
        CASE WHEN starts_with(lower(trim(ns)), 'archive') THEN 0.2e0 WHEN days IS NULL THEN 0.5e0 WHEN days < 90 THEN 1e0 WHEN days < 365 THEN 0.85e0 WHEN days < 730 THEN 0.7e0 WHEN days < 1460 THEN 0.5e0 ELSE 0.3e0 END AS loose_score,
        CASE WHEN starts_with(lower(trim(ns)), 'archive') THEN 'archived' WHEN days IS NULL THEN 'unknown' WHEN days < 365 THEN 'fresh' WHEN days < 730 THEN 'recent' WHEN days < 1460 THEN 'outdated' ELSE 'stale' END AS loose_category,
        CASE WHEN days IS NULL THEN 'unknown' WHEN days < 365 THEN 'fresh' WHEN days < 730 THEN 'recent' WHEN days < 1460 THEN 'outdated' ELSE 'archived' END AS plain_category FROM {_DATED}""",
    "rag_weight": f"""SELECT page_id, array_to_string(years, ',') AS years, len(list_filter(years, lambda y: y < 2023)) > 0 AS outdated,
        round(CASE WHEN len(list_filter(years, lambda y: y < 2023)) > 0 THEN 0.9e0 ELSE 1e0 END * CASE WHEN archived THEN 0.5e0 ELSE w END, 2) AS weight
        FROM (SELECT *, CASE {_CATEGORY} WHEN 'current' THEN 1e0 WHEN 'recent' THEN 0.9e0 WHEN 'outdated' THEN 0.7e0 ELSE 0.5e0 END AS w FROM {_DATED})""",
    "temporal_rollup": f"SELECT category, count(*) AS pages, round(avg(score), 6) AS mean_score FROM (SELECT {_CATEGORY} AS category, {_LINEAR} AS score FROM {_DATED}) GROUP BY category",
    "year_histogram": f"SELECT year, count(*) AS pages FROM (SELECT unnest(years) AS year FROM {_DATED}) GROUP BY year",
    "content_classify": _CLASSIFY,
    "classification_counts": f"SELECT content_type, access_level, count(*) AS pages FROM ({_CLASSIFY}) GROUP BY content_type, access_level",
    "rag_readiness": f"{_READY} SELECT page_id, {', '.join(f'n_{c}' for c in _COUNTED)}, round(structure_score, 6) AS structure_score, round(noise_score, 6) AS noise_score, round(chunking_score, 6) AS chunking_score, round(metadata_score, 6) AS metadata_score, readiness FROM r",
    "readiness_summary": f"{_READY} {_SUMMARY}",
    "readiness_advice": f"{_READY.replace(I.WIKI, f'SELECT page_id, NULL AS source, NULL AS lang, NULL AS modified, text AS content FROM ({I.PAGES})')} SELECT unnest(list_filter([CASE WHEN not_ready * 3 > pages THEN 'many pages are not ready' END, CASE WHEN mean_noise > 0.3 THEN 'noise is high' END, CASE WHEN mean_readiness < 0.6 THEN 'mean readiness is low' END], lambda x: x IS NOT NULL)) AS advice FROM ({_SUMMARY})",
}

