"""Inputs derived from the shared tables, as DataFrames and as SQL text for the other engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2025-01-01 00:00:00"
YEAR = 2025


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page corpus: documents with ids in namespaces, revisions before ``AS_OF``."""
    docs = table(spark, sf_dir, "documents")
    ns = F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit("archive:n"), F.col("doc_id") % 7)).when(F.col("doc_id") % 10 == 4, F.concat(F.lit("teacher:n"), F.col("doc_id") % 7)).when(F.col("doc_id") % 10 == 5, F.lit("")).otherwise(F.concat(F.lit("ns"), F.col("doc_id") % 7))
    page = F.concat(ns, F.when(ns == "", "").otherwise(":"), F.lit("p"), F.col("doc_id"))
    modified = F.timestamp_seconds(F.unix_seconds(F.lit(AS_OF).cast("timestamp")) - F.col("doc_id") % 1700 * 86400 - 3600)
    return docs.select("doc_id", "text", "lang", "source", F.length("text").alias("n_chars"), page.alias("page_id"), F.when(F.col("doc_id") % 17 != 0, modified).alias("modified"))


PAGES = f"""
    SELECT doc_id, text, lang, source, length(text) AS n_chars,
        ns || CASE WHEN ns = '' THEN '' ELSE ':' END || 'p' || doc_id AS page_id,
        CASE WHEN doc_id % 17 <> 0 THEN TIMESTAMP '{AS_OF}' - to_seconds(doc_id % 1700 * 86400 + 3600) END AS modified
    FROM (SELECT *, CASE WHEN doc_id % 10 = 3 THEN 'archive:n' || (doc_id % 7) WHEN doc_id % 10 = 4 THEN 'teacher:n' || (doc_id % 7)
        WHEN doc_id % 10 = 5 THEN '' ELSE 'ns' || (doc_id % 7) END AS ns FROM documents)
"""


def wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as wiki markup: a heading, paragraphs for lines, a table, links, lists and code on some pages."""
    body = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    head = F.concat(F.lit("====== "), F.replace(F.substring("text", 1, 40), F.lit("\n"), F.lit(" ")), F.lit(" ======\n\n"))
    link = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\n\nSee [[ns"), F.col("doc_id") % 5, F.lit(":p"), F.col("doc_id") % 50, F.lit("|there]] and {{img"), F.col("doc_id") % 9, F.lit(".png}}."))).otherwise("")
    rows = F.when(F.col("doc_id") % 5 == 0, F.lit("\n\n^ a ^ b ^\n| 1 | 2 |\n| 3 | 4 |")).otherwise("")
    items = F.when(F.col("doc_id") % 4 == 0, F.lit("\n\n  * one\n  * two\n  - three")).otherwise("")
    code = F.when(F.col("doc_id") % 6 == 0, F.lit("\n\n<code sql>select 1</code>")).otherwise("")
    marks = F.when(F.col("doc_id") % 7 == 0, F.lit("\n\n//slanted// and __under__ ~~NOTOC~~<del>old</del> <nowiki>x</nowiki>\n\n\n\n----")).otherwise("")
    return pages(spark, sf_dir).withColumn("content", F.concat(head, body, link, rows, items, code, marks))


WIKI = f"""
    SELECT *, '====== ' || replace(substr(text, 1, 40), chr(10), ' ') || ' ======' || chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10))
        || CASE WHEN doc_id % 3 = 0 THEN chr(10) || chr(10) || 'See [[ns' || (doc_id % 5) || ':p' || (doc_id % 50) || '|there]] and {{{{img' || (doc_id % 9) || '.png}}}}.' ELSE '' END
        || CASE WHEN doc_id % 5 = 0 THEN chr(10) || chr(10) || '^ a ^ b ^' || chr(10) || '| 1 | 2 |' || chr(10) || '| 3 | 4 |' ELSE '' END
        || CASE WHEN doc_id % 4 = 0 THEN chr(10) || chr(10) || '  * one' || chr(10) || '  * two' || chr(10) || '  - three' ELSE '' END
        || CASE WHEN doc_id % 6 = 0 THEN chr(10) || chr(10) || '<code sql>select 1</code>' ELSE '' END
        || CASE WHEN doc_id % 7 = 0 THEN chr(10) || chr(10) || '//slanted// and __under__ ~~NOTOC~~<del>old</del> <nowiki>x</nowiki>' || chr(10) || chr(10) || chr(10) || chr(10) || '----' ELSE '' END AS content
    FROM ({PAGES})
"""


_STEPS = (
    (r"^====== *([^\n]*?) *======\n", r"# \1"), (r"//(.*?)//", r"*\1*"), (r"__(.*?)__", r"<u>\1</u>"), (r"<del>(.*?)</del>", r"~~\1~~"), (r"\[\[([^\]|]*)\|([^\]]*)\]\]", r"[\2](\1)"), (r"\{\{([^}]*)\}\}", r"![](\1)"),
    (r"(?m)^  \* ", "- "), (r"(?m)^  - ", "1. "), (r"\^ a \^ b \^\n", r"| a | b |\n|---|---|\n"), (r"(?m)^-{4,}\s*$", "---"), (r"<code sql>(.*?)</code>", r"```sql\n\1\n```"), (r"~~NOTOC~~", ""), (r"<nowiki>.*?</nowiki>", ""), (r"\n{3,}", r"\n\n"), (r"(?m)[ \t]+$", ""), (r"^\s+|\s+$", ""),
)


def _markdown_sql() -> str:
    """The marks of the pages above, step by step; the first line end after a heading goes with it."""
    text = "content"
    for pattern, new in _STEPS:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')".replace("\\n", "' || chr(10) || '")
    return text


MARKDOWN = f"SELECT *, {_markdown_sql()} AS markdown FROM ({WIKI})"


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, kind, target, exists): links between pages, to media and outside."""
    return _links(pages(spark, sf_dir).select("doc_id", "page_id"))


def _links(rows: DataFrame) -> DataFrame:
    n = F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 4).cast("int"))).alias("n")
    spread = rows.select("doc_id", "page_id", n)
    key = F.col("doc_id") * 7 + F.col("n") * 13
    kind = F.when(key % 5 == 0, "external").when(key % 5 == 1, "media").otherwise("internal")
    internal = F.concat(F.lit("ns"), key % 7, F.lit(":p"), key % 400)
    media = F.concat(F.lit("media:f"), key % 60, F.when(key % 2 == 0, ".png").otherwise(".pdf"))
    external = F.concat(F.lit("https://site"), key % 11, F.lit(".example/page"), key % 3)
    target = F.when(kind == "external", external).when(kind == "media", media).otherwise(internal)
    return spread.select("doc_id", "page_id", "n", kind.alias("kind"), target.alias("target"), (key % 19 != 0).alias("exists"))


LINKS = f"""
    SELECT doc_id, page_id, n, kind,
        CASE kind WHEN 'external' THEN 'https://site' || (key % 11) || '.example/page' || (key % 3)
            WHEN 'media' THEN 'media:f' || (key % 60) || CASE WHEN key % 2 = 0 THEN '.png' ELSE '.pdf' END
            ELSE 'ns' || (key % 7) || ':p' || (key % 400) END AS target,
        key % 19 <> 0 AS exists_
    FROM (SELECT *, CASE WHEN key % 5 = 0 THEN 'external' WHEN key % 5 = 1 THEN 'media' ELSE 'internal' END AS kind
        FROM (SELECT doc_id, page_id, n, doc_id * 7 + n * 13 AS key FROM (SELECT doc_id, page_id, unnest(range(0, CAST(doc_id % 4 AS INT) + 1)) AS n FROM ({PAGES}))))
"""


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of media files, one for each document."""
    i = F.col("doc_id")
    name = F.concat(F.lit("media:f"), i, F.when(i % 2 == 0, ".png").otherwise(".pdf"))
    return table(spark, sf_dir, "documents").select(name.alias("media_id"), (i * 977 % 40000 * 13).alias("size"), F.when(i % 2 == 0, "image").otherwise("document").alias("type"))


MEDIA = """
    SELECT 'media:f' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.png' ELSE '.pdf' END AS media_id, doc_id * 977 % 40000 * 13 AS size,
        CASE WHEN doc_id % 2 = 0 THEN 'image' ELSE 'document' END AS type
    FROM documents
"""


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots (id, revision, hash, size, namespace) of the pages, some of them changed, gone or new."""
    rows = pages(spark, sf_dir).select("doc_id", F.col("page_id").alias("id"), "text", "n_chars", (F.col("doc_id") * 1000).alias("revision"))
    before = rows.where("doc_id % 10 <> 0")
    changed = F.col("doc_id") % 13 == 0
    after = rows.where("doc_id % 11 <> 0").withColumn("text", F.when(changed, F.concat("text", F.lit(" more"), F.repeat(F.lit("x"), (F.col("doc_id") % 900).cast("int")))).otherwise(F.col("text")))
    after = after.withColumn("revision", F.when(F.col("doc_id") % 26 == 0, F.col("revision") + F.col("doc_id") % 900000).otherwise(F.col("revision")))
    shape = lambda d: d.select("id", "revision", F.concat(F.lit("sha256:"), F.sha2("text", 256)).alias("hash"), F.length("text").cast("long").alias("size"), F.when(F.contains("id", F.lit(":")), F.substring_index("id", ":", 1)).otherwise("root").alias("namespace"))
    return shape(before), shape(after)


_SHAPE = "SELECT id, revision, 'sha256:' || sha256(text) AS hash, CAST(length(text) AS BIGINT) AS size, CASE WHEN contains(id, ':') THEN split_part(id, ':', 1) ELSE 'root' END AS namespace FROM "
BEFORE = f"{_SHAPE} (SELECT doc_id, page_id AS id, text, doc_id * 1000 AS revision FROM ({PAGES}) WHERE doc_id % 10 <> 0)"
AFTER = f"""{_SHAPE} (SELECT doc_id, page_id AS id, CASE WHEN doc_id % 13 = 0 THEN text || ' more' || repeat('x', CAST(doc_id % 900 AS INT)) ELSE text END AS text,
    CASE WHEN doc_id % 26 = 0 THEN doc_id * 1000 + doc_id % 900000 ELSE doc_id * 1000 END AS revision FROM ({PAGES}) WHERE doc_id % 11 <> 0)"""


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job log rows: (job_id, stage, status, started_at, seconds)."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "running").otherwise("queued")
    return e.select(F.col("event_id").alias("job_id"), F.concat(F.lit("stage"), F.col("user_id") % 5).alias("stage"), status.alias("status"), F.col("ts").cast("timestamp").alias("started_at"), F.col("value").alias("seconds"))


JOB_RUNS = """
    SELECT event_id AS job_id, 'stage' || (user_id % 5) AS stage,
        CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'queued' END AS status,
        ts AS started_at, value AS seconds FROM events
"""
