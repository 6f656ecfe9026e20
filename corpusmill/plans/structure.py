"""Namespaces, media, links, snapshots and the job log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..operators import inventory as V
from ..operators import pages as P
from ..operators import runs as R
from ..operators import snapshots as S
from . import inputs as I

_NS = "CASE WHEN contains(page_id, ':') THEN regexp_replace(page_id, ':[^:]*$', '') ELSE '' END"
_DEPTH = "length(page_id) - length(replace(page_id, ':', ''))"
_EXT = "CASE WHEN contains({0}, '.') THEN lower(list_last(string_split({0}, '.'))) ELSE '' END"
_TOP = "CASE WHEN contains(page_id, ':') THEN split_part(page_id, ':', 1) ELSE 'root' END"


def namespace_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.rollup(I.pages(spark, sf_dir), ids.top_namespace(F.col("page_id")), "namespace")


def namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.namespaces(I.pages(spark, sf_dir))


def namespace_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.namespace_prefixes(I.pages(spark, sf_dir), 2)


def depth_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.depth_histogram(I.pages(spark, sf_dir))


def size_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.size_buckets(I.pages(spark, sf_dir), P.size_bucket(F.octet_length("text")))


def filtered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages inside the wanted namespaces and outside the unwanted ones; pages of the root pass."""
    pages = I.pages(spark, sf_dir)
    ns = ids.parent_namespace(F.col("page_id"))
    return pages.where((ns == "") | ids.included(ns, ["archive", "ns1", "ns2", "teacher"], ["teacher:n1"])).where(~F.col("page_id").isin("archive:n0:p63")).select("page_id")


def media_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.media_inventory(I.media(spark, sf_dir))


def media_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.media_usage(I.media(spark, sf_dir), I.links(spark, sf_dir))


def unused_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.unused_media(I.media(spark, sf_dir), I.links(spark, sf_dir)).select("media_id")


def missing_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referenced files beyond a listing of some; names of several kinds are among them."""
    key, target = F.col("doc_id") % 6, F.col("target")
    named = F.when(key == 1, F.concat(F.lit("http://other.example/"), target)).when(key == 2, F.concat(F.lit("archive:"), target)).when(key == 3, F.replace(target, F.lit("."), F.lit("_V1."))).when(key == 4, F.replace(target, F.lit("media:"), F.lit("media:Draft"))).otherwise(target)
    return V.missing_media(I.media(spark, sf_dir).where("size % 3 = 0"), I.links(spark, sf_dir).withColumn("target", F.when(F.col("kind") == "media", named).otherwise(target)))


def link_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.link_statistics(I.links(spark, sf_dir), I.pages(spark, sf_dir))


def link_top_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.top_targets(I.links(spark, sf_dir), "internal")


def link_top_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.top_domains(I.links(spark, sf_dir))


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.orphans(I.pages(spark, sf_dir), I.links(spark, sf_dir)).select("page_id")


def broken_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.broken_links(I.links(spark, sf_dir))


def wiki_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.summary(I.pages(spark, sf_dir), I.media(spark, sf_dir), I.links(spark, sf_dir))


def deepest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.deepest(I.pages(spark, sf_dir))


def recent_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.recent(I.pages(spark, sf_dir).where("modified is not null")).select("page_id", F.date_format("modified", "yyyy-MM-dd").alias("day"))


def id_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    return I.pages(spark, sf_dir).select("page_id", ids.page_to_file(p).alias("file"), ids.file_to_page(F.concat(ids.page_to_file(p), F.lit(".txt"))).alias("again"), ids.content_hash(F.col("text")).alias("hash"), ids.human_bytes(F.octet_length("text") * 700).alias("size"), ids.sanitized(F.concat(p, F.lit("?/x\\y*"))).alias("safe"))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.diff(*I.snapshots(spark, sf_dir))


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).select("id", "change")


def snapshot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.summary(_changes(spark, sf_dir))


def media_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By hash where both are known, else by size."""
    before, after = I.snapshots(spark, sf_dir)
    blank = lambda d: d.withColumn("hash", F.when(F.length("id") % 2 == 0, F.col("hash")))
    return S.diff(blank(before), blank(after), by="hash").select("id", "change")


def live_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = I.snapshots(spark, sf_dir)
    return S.summary(S.diff(after.drop("hash").withColumn("hash", F.lit(None).cast("string")), before, newer_only=True))


def changes_by_ns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.by_namespace(_changes(spark, sf_dir))


def change_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.sentence(S.with_sizes(_changes(spark, sf_dir)))
    return found.select("id", "change", "size_change", "percent", "magnitude", S.age_magnitude(F.coalesce("old_revision", F.lit(0)), F.coalesce("new_revision", F.lit(0))).alias("age_magnitude"), "summary")


def merge_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.merge(*I.snapshots(spark, sf_dir)).select("id", "revision", "size")


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = I.snapshots(spark, sf_dir)
    changes = S.diff(before, after)
    fetched = after.join(S.to_fetch(changes).select("id"), "id", "left_semi")
    return S.carry_forward(before, fetched, changes).select("id", "size", "status")


def manifest_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = I.snapshots(spark, sf_dir)
    entries = before.unionByName(after).withColumn("hash", F.when(~F.col("id").endswith("7"), F.col("hash")))
    return S.problems(entries).distinct()


def line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.pages(spark, sf_dir)
    return S.line_changes(pages.select(F.col("page_id").alias("id"), F.col("text").alias("old"), F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("\nnew line"))).otherwise(F.col("text")).alias("new")))


def last_run_per_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.last_per_stage(I.job_runs(spark, sf_dir)).select("stage", "job_id", "status")


def active_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.active(I.job_runs(spark, sf_dir)).select("job_id", "stage")


def run_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = I.job_runs(spark, sf_dir)
    updates = runs.where("job_id % 7 = 0").withColumn("status", F.lit("completed"))
    return R.upsert(runs, updates, 100).select("job_id", "stage", "status")


def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.status_summary(I.job_runs(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        namespace_rollup, namespaces, namespace_prefixes, depth_histogram, size_buckets, filtered_pages, media_inventory, media_usage, unused_media, missing_media, link_statistics, link_top_targets,
        link_top_domains, orphans, broken_links, wiki_inventory, deepest_pages, recent_changes, id_functions, snapshot_diff, snapshot_summary, media_diff, live_diff, changes_by_ns, change_magnitude,
        merge_snapshots, carry_forward, manifest_problems, line_changes, last_run_per_stage, active_job, run_retention, status_summary,
    )
}

_DIFF = """SELECT coalesce(o.id, n.id) AS id, o.id AS old, n.id AS new, o.revision AS old_revision, n.revision AS new_revision, o.hash AS old_hash, n.hash AS new_hash, o.size AS old_size, n.size AS new_size, o.namespace AS old_namespace, n.namespace AS new_namespace
    FROM ({}) o FULL JOIN ({}) n ON o.id = n.id"""
_CHANGES = f"""(SELECT *, CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'deleted' WHEN old_revision <> new_revision OR old_hash <> new_hash THEN 'modified' ELSE 'unchanged' END AS change FROM ({_DIFF.format(I.BEFORE, I.AFTER)}))"""
_BLANK = "SELECT id, revision, CASE WHEN length(id) % 2 = 0 THEN hash END AS hash, size, namespace FROM ({})"
_PERCENT = "coalesce((coalesce(new_size, 0) - coalesce(old_size, 0)) * 100.0e0 / nullif(coalesce(old_size, 0), 0), 0)"
_GAP = "(coalesce(new_revision, 0) - coalesce(old_revision, 0))"
_ENTRIES = f"(SELECT id, CASE WHEN NOT ends_with(id, '7') THEN hash END AS hash, namespace FROM (SELECT * FROM ({I.BEFORE}) UNION ALL SELECT * FROM ({I.AFTER})))"
_REFERENCED = "CASE doc_id % 6 WHEN 1 THEN 'http://other.example/' || target WHEN 2 THEN 'archive:' || target WHEN 3 THEN replace(target, '.', '_V1.') WHEN 4 THEN replace(target, 'media:', 'media:Draft') ELSE target END"

ORACLE_SQL = {
    "namespace_rollup": f"SELECT {_TOP} AS namespace, count(*) AS pages, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(floor(sum(n_chars) / count(*)) AS BIGINT) AS mean_chars FROM ({I.PAGES}) GROUP BY 1",
    "namespaces": f"SELECT CASE WHEN {_NS} = '' THEN 'root' ELSE {_NS} END AS namespace, count(*) AS pages, max({_DEPTH}) AS max_depth, bool_or(page_id LIKE '%start') AS has_start FROM ({I.PAGES}) GROUP BY 1",
    "namespace_prefixes": f"SELECT DISTINCT namespace FROM (SELECT '' AS namespace UNION ALL SELECT split_part(page_id, ':', 1) FROM ({I.PAGES}) WHERE contains(page_id, ':') UNION ALL SELECT array_to_string(string_split(page_id, ':')[1:2], ':') FROM ({I.PAGES}) WHERE {_DEPTH} >= 2)",
    "depth_histogram": f"SELECT CAST({_DEPTH} AS BIGINT) AS depth, count(*) AS pages FROM ({I.PAGES}) GROUP BY 1",
    "size_buckets": f"SELECT CASE WHEN s = 0 THEN 'empty' WHEN s < 1024 THEN 'under_1k' WHEN s < 5120 THEN 'under_5k' WHEN s < 20480 THEN 'under_20k' WHEN s < 102400 THEN 'under_100k' ELSE 'large' END AS bucket, count(*) AS pages, CAST(sum(s) AS BIGINT) AS bytes FROM (SELECT octet_length(encode(text)) AS s FROM ({I.PAGES})) GROUP BY 1",
    "filtered_pages": f"SELECT page_id FROM (SELECT page_id, {_NS} AS ns FROM ({I.PAGES})) WHERE (ns = '' OR ((ns IN ('archive', 'ns1', 'ns2', 'teacher') OR starts_with(ns, 'archive:') OR starts_with(ns, 'ns1:') OR starts_with(ns, 'ns2:') OR starts_with(ns, 'teacher:')) AND NOT (ns = 'teacher:n1' OR starts_with(ns, 'teacher:n1:')))) AND page_id <> 'archive:n0:p63'",
    "media_inventory": f"SELECT {_EXT.format('media_id')} AS extension, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, min_by(media_id, (size, media_id)) AS smallest, max_by(media_id, (size, media_id)) AS largest FROM ({I.MEDIA}) GROUP BY 1",
    "media_usage": f'SELECT m.media_id, m.type, m.size, coalesce(r, 0) AS "references", coalesce(p, 0) AS pages FROM ({I.MEDIA}) m LEFT JOIN (SELECT target, count(*) AS r, count(DISTINCT page_id) AS p FROM ({I.LINKS}) WHERE kind = \'media\' GROUP BY target) u ON u.target = m.media_id',
    "unused_media": f"SELECT media_id FROM ({I.MEDIA}) WHERE media_id NOT IN (SELECT target FROM ({I.LINKS}) WHERE kind = 'media')",
    "missing_media": f"""SELECT media_id, status, CASE status WHEN 'EXTERNAL' THEN 'External URL, not hosted on wiki' WHEN 'ARCHIVED' THEN 'In archive namespace, may be intentionally removed' WHEN 'REPLACED' THEN 'Likely replaced by newer version'
            WHEN 'DELETED' THEN 'Temporary/test file, likely intentionally removed' ELSE 'Referenced but not available for download' END AS reason
        FROM (SELECT media_id, CASE WHEN starts_with(media_id, 'http') OR contains(media_id, '%') THEN 'EXTERNAL' WHEN contains(media_id, ':archive:') OR starts_with(media_id, 'archive:') THEN 'ARCHIVED'
            WHEN regexp_matches(lower(media_id), '_v1|_v2|_old|_backup') THEN 'REPLACED' WHEN regexp_matches(lower(media_id), 'draft|temp|test') THEN 'DELETED' ELSE 'MISSING' END AS status
            FROM (SELECT DISTINCT {_REFERENCED} AS media_id FROM ({I.LINKS}) WHERE kind = 'media') WHERE media_id NOT IN (SELECT media_id FROM ({I.MEDIA}) WHERE size % 3 = 0))""",
    "link_statistics": f"SELECT *, round(CAST(links AS DOUBLE) / pages, 6) AS links_per_page FROM (SELECT count(*) AS links, count(*) FILTER (WHERE kind = 'internal') AS internal_links, count(*) FILTER (WHERE kind = 'external') AS external_links, count(*) FILTER (WHERE kind = 'media') AS media_links FROM ({I.LINKS})), (SELECT count(*) AS pages FROM ({I.PAGES}))",
    "link_top_targets": f"SELECT target, count(*) AS links FROM ({I.LINKS}) WHERE kind = 'internal' GROUP BY target ORDER BY links DESC, target LIMIT 20",
    "link_top_domains": f"SELECT regexp_extract(target, '^[a-z]+://([^/]+)', 1) AS domain, count(*) AS links FROM ({I.LINKS}) WHERE kind = 'external' GROUP BY 1 ORDER BY links DESC, domain LIMIT 20",
    "orphans": f"SELECT page_id FROM ({I.PAGES}) WHERE page_id <> 'start' AND page_id NOT IN (SELECT target FROM ({I.LINKS}) WHERE kind = 'internal')",
    "broken_links": f"SELECT page_id, count(*) AS broken, string_agg(DISTINCT target, ',' ORDER BY target) AS targets FROM ({I.LINKS}) WHERE kind = 'internal' AND NOT exists_ GROUP BY page_id",
    "wiki_inventory": f"SELECT * FROM (SELECT count(*) AS pages, CAST(sum(n_chars) AS BIGINT) AS chars, count(DISTINCT {_TOP}) AS namespaces FROM ({I.PAGES})), (SELECT count(*) AS media, CAST(sum(size) AS BIGINT) AS media_bytes FROM ({I.MEDIA})), (SELECT count(*) AS links FROM ({I.LINKS}))",
    "deepest_pages": f"SELECT page_id, CAST({_DEPTH} AS BIGINT) AS depth FROM ({I.PAGES}) ORDER BY depth DESC, page_id LIMIT 10",
    "recent_changes": f"SELECT page_id, strftime(modified, '%Y-%m-%d') AS day FROM ({I.PAGES}) WHERE modified IS NOT NULL ORDER BY modified DESC, page_id LIMIT 50",
    "id_functions": f"SELECT page_id, translate(page_id, ':/', '__') AS file, translate(translate(page_id, ':/', '__'), '_', ':') AS again, 'sha256:' || sha256(text) AS hash, CASE WHEN b < 1024 THEN printf('%.2f B', b) WHEN b < 1048576 THEN printf('%.2f KB', b / 1024.0e0) WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576.0e0) ELSE printf('%.2f GB', b / 1073741824.0e0) END AS size, replace(replace(replace(page_id || '?/x\\y*', ':', '_'), '/', '_'), '\\', '_') AS safe FROM (SELECT *, CAST(octet_length(encode(text)) * 700 AS DOUBLE) AS b FROM ({I.PAGES}))",
    "snapshot_diff": f"SELECT id, change FROM {_CHANGES}",
    "snapshot_summary": f"SELECT change, count(*) AS entries FROM {_CHANGES} GROUP BY change",
    "media_diff": f"SELECT id, CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'deleted' WHEN CASE WHEN old_hash IS NOT NULL AND new_hash IS NOT NULL THEN old_hash <> new_hash ELSE old_size <> new_size END THEN 'modified' ELSE 'unchanged' END AS change FROM ({_DIFF.format(_BLANK.format(I.BEFORE), _BLANK.format(I.AFTER))})",
    "live_diff": f"SELECT CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'deleted' WHEN new_revision > old_revision THEN 'modified' ELSE 'unchanged' END AS change, count(*) AS entries FROM ({_DIFF.format(I.AFTER, I.BEFORE)}) GROUP BY 1",
    "changes_by_ns": f"SELECT coalesce(new_namespace, old_namespace) AS namespace, {', '.join(f'''count(*) FILTER (WHERE change = '{c}') AS {c}''' for c in ('added', 'deleted', 'modified', 'unchanged'))} FROM {_CHANGES} GROUP BY 1",
    "change_magnitude": f"""SELECT id, change, coalesce(new_size, 0) - coalesce(old_size, 0) AS size_change, round({_PERCENT}, 4) AS percent,
        CASE WHEN change IN ('added', 'deleted') THEN 'major' WHEN abs({_PERCENT}) > 50 THEN 'rewrite' WHEN abs({_PERCENT}) > 20 THEN 'major' ELSE 'minor' END AS magnitude,
        CASE WHEN {_GAP} < 86400 THEN 'minor' WHEN {_GAP} < 604800 THEN 'major' ELSE 'rewrite' END AS age_magnitude,
        CASE change WHEN 'added' THEN 'New page (' || new_size || ' bytes)' WHEN 'deleted' THEN 'Page removed (was ' || old_size || ' bytes)'
            WHEN 'modified' THEN CASE WHEN new_size > old_size THEN printf('Content expanded (+%d bytes, %.1f%%)', new_size - old_size, round({_PERCENT}, 4)) WHEN new_size < old_size THEN printf('Content reduced (%d bytes, %.1f%%)', new_size - old_size, round({_PERCENT}, 4)) ELSE 'Content modified (same size)' END
            ELSE '' END AS summary FROM {_CHANGES}""",
    "merge_snapshots": f"SELECT id, revision, size FROM ({I.AFTER}) UNION ALL SELECT id, revision, size FROM ({I.BEFORE}) WHERE id NOT IN (SELECT id FROM ({I.AFTER}))",
    "carry_forward": f"SELECT id, coalesce(new_size, old_size) AS size, CASE WHEN change = 'deleted' THEN 'deleted' ELSE 'active' END AS status FROM {_CHANGES}",
    "manifest_problems": f"SELECT DISTINCT id, 'missing hash' AS problem FROM {_ENTRIES} WHERE hash IS NULL UNION ALL SELECT id, 'repeated id' FROM {_ENTRIES} GROUP BY id HAVING count(*) > 1",
    "line_changes": f"""SELECT page_id AS id, CASE WHEN doc_id % 3 <> 0 THEN 0 WHEN ends_with(text, chr(10)) THEN 2 ELSE 2 END AS added, CASE WHEN doc_id % 3 <> 0 OR text = '' OR ends_with(text, chr(10)) THEN 0 ELSE 1 END AS removed,
        CASE WHEN doc_id % 3 <> 0 OR text = '' OR ends_with(text, chr(10)) THEN 0 ELSE 1 END AS changed FROM ({I.PAGES})""",
    "last_run_per_stage": f"SELECT stage, job_id, status FROM ({I.JOB_RUNS}) QUALIFY row_number() OVER (PARTITION BY stage ORDER BY started_at DESC, job_id DESC) = 1",
    "active_job": f"SELECT job_id, stage FROM ({I.JOB_RUNS}) WHERE status = 'running' ORDER BY started_at DESC, job_id DESC LIMIT 1",
    "run_retention": f"SELECT job_id, stage, CASE WHEN job_id % 7 = 0 THEN 'completed' ELSE status END AS status FROM ({I.JOB_RUNS}) ORDER BY started_at DESC, job_id DESC LIMIT 100",
    "status_summary": f"SELECT stage, count(*) AS runs, count(*) FILTER (WHERE status = 'failed') AS failed, round(avg(seconds), 6) AS mean_seconds, max_by(status, (started_at, job_id)) AS last_status, max_by(job_id, (started_at, job_id)) AS last_job FROM ({I.JOB_RUNS}) GROUP BY stage",
}
