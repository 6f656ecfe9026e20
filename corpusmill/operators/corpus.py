"""Strategies, samples, question sets and personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
# Words that make a page a candidate for questions about procedures.
PROCEDURAL = ("schritt", "anleitung", "wie", "ablauf", "prozess", "vorgehen", "formular", "antrag", "muss", "sollte")


def table_override(kind: Column, table_rows: Column, length: Column) -> Column:
    """TABLE_DATA where there are three rows or more and half a row or more for each 80 characters."""
    return F.when((length > 0) & (table_rows >= 3) & (table_rows / F.greatest(F.lit(1), F.floor(length / 80)) >= 0.5), "TABLE_DATA").otherwise(kind)


def clusters(pages: DataFrame, kind: str, key: str) -> DataFrame:
    """Ids of each category, in order."""
    return pages.groupBy(kind).agg(F.count_distinct(key).alias("members"), F.array_join(F.sort_array(F.collect_set(F.col(key).cast("string"))), ",").alias("ids"))


def media_split(media: DataFrame, utility: str, least: int = 6) -> DataFrame:
    return media.withColumn("strategy", F.when(F.col(utility) >= least, "caption").otherwise("skip"))


def with_strategy(pages: DataFrame, strategies: DataFrame, key: str = "page_id") -> DataFrame:
    """Strategy by id, else by category, else the default; priority by content type."""
    out = pages.join(strategies, key, "left")  # grows with the site, so Spark weighs its size
    kind = F.coalesce("content_type", F.lit("KNOWLEDGE"))
    return out.withColumns({
        "content_type": kind, "method": F.coalesce("method", F.lit("semantic")), "size": F.coalesce("size", F.lit(512)), "action": F.coalesce("action", F.lit("process")),
        "priority": F.when(kind == "ARCHIVED", "low").when(kind == "KNOWLEDGE", "high").otherwise("normal"),
    })


def processed(pages: DataFrame, strategies: DataFrame, convert) -> DataFrame:
    """Pages converted and cut as their strategy says: (page_id, content_type, priority, chunk_index, chunk); skipped pages are left out.

    ``convert`` turns the column ``content`` into a text.
    """
    from .chunks import chunk_texts

    rows = with_strategy(pages, strategies).where("action <> 'skip'").withColumn("text", convert(F.col("content")))
    rows = rows.withColumns({"overlap": F.lit(50), "least": F.lit(100)}).withColumn("chunks", chunk_texts("text", "method", "size", "overlap", "least"))
    return rows.select("page_id", "content_type", "priority", F.posexplode("chunks").alias("chunk_index", "chunk"))


def hashed(key: Column, seed: int) -> Column:
    """A number that spreads keys, the same in any engine."""
    return F.pmod((key.cast("long") + seed) * F.lit(2654435761), F.lit(1 << 32))


def stratified(rows: DataFrame, stratum: list[str], key: str, target: int, seed: int = 42) -> DataFrame:
    """One row of each stratum first, the rest at random by a seeded hash, ``target`` in all."""
    order = hashed(F.col(key), seed)
    ranked = rows.withColumn("draw", order).withColumn("n", F.row_number().over(Window.partitionBy(*stratum).orderBy("draw", key)))
    return ranked.orderBy(F.when(F.col("n") == 1, 0).otherwise(1), "draw", key).limit(target).drop("draw", "n")


def file_attributes(source: Column, name: Column) -> tuple[Column, Column]:
    """Namespace and suffix of a prepared file: what stands before its first underscore; md for pages, the suffix before it for media."""
    stem = F.regexp_replace(name, r"\.md$", "")
    suffix = F.when((source != "pages") & F.contains(stem, F.lit(".")), F.lower(F.substring_index(stem, ".", -1))).otherwise(F.lit("md"))
    return F.substring_index(stem, "_", 1), suffix


def shares(pages: int, media: int, target: int) -> tuple[int, int]:
    """How many pages and media files a sample takes: half each, as far as there are so many, and one of either at least."""
    if not pages or not media:
        return min(target, pages), min(target, media)
    first = min(pages, max(1, target // 2))
    second = min(media, target - first)
    if second < 1:
        first, second = min(pages, target - 1), 1
    return first, second


def corpus_sample(files: DataFrame, target: int, seed: int = 42) -> DataFrame:
    """A sample of (key, source, namespace, extension): pages by namespace, media by namespace and extension."""
    size = files.agg(F.count_if(F.col("source") == "pages").alias("p"), F.count_if(F.col("source") == "media").alias("m")).first()
    first, second = shares(size["p"], size["m"], target)
    return stratified(files.where("source = 'pages'"), ["namespace"], "key", first, seed).unionByName(stratified(files.where("source = 'media'"), ["namespace", "extension"], "key", second, seed))


def some_of_each(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    order = Window.partitionBy(stratum).orderBy(hashed(F.col(key), seed), key)
    return rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n).drop("n")


def emails(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))


def redacted(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL, "[EMAIL]")


def suspicious(text: Column, allowed: list[str]) -> Column:
    """Addresses outside the allowed domains."""
    return F.filter(emails(text), lambda m: ~F.lower(F.substring_index(m, "@", -1)).isin(*allowed))


def is_procedural(page_id: Column, text: Column) -> Column:
    pattern = "|".join(PROCEDURAL)
    return F.lower(page_id).rlike(pattern) | F.lower(text).rlike(pattern)


# Questions that ask nothing in particular.
GENERIC = ("welche informationen enthaelt", "welche informationen enthält", "was steht in diesem dokument", "was steht auf dieser seite", "was beinhaltet")


def qa_problem(question: Column, answer: Column, body: Column) -> Column:
    """Why a question and answer are refused; empty where they are fine.

    An answer of two long words or more must share two of them with the body, each anywhere in it.
    """
    q = strip(F.regexp_replace(strip(question), "^[\"']+|[\"']+$", ""))
    words = F.array_distinct(F.regexp_extract_all(F.lower(answer), F.lit(r"[\p{L}\p{N}_]{5,}"), F.lit(0)))
    shared = F.size(F.filter(words, lambda w: F.contains(F.lower(body), w)))
    generic = F.greatest(F.lit(False), *(F.contains(F.lower(q), F.lit(g)) for g in GENERIC))
    return (
        F.when(F.coalesce(question, F.lit("")) == "", "empty").when(F.length(q) < 15, "too short").when(F.length(q) > 200, "too long").when(~q.endswith("?"), "no question mark").when(generic, "generic")
        .when(F.length(strip(F.coalesce(answer, F.lit("")))) < 10, "no answer").when((shared < 2) & (F.size(words) >= 2), "not grounded").otherwise("")
    )


def clean_body(body: Column) -> Column:
    """Without HTML comments."""
    return strip(F.regexp_replace(body, r"(?s)<!--.*?-->", ""))


def title_from_body(body: Column) -> Column:
    """The first heading of the first level or plain line, at most 80 characters of the latter."""
    lines = F.transform(F.split(body, r"\r\n|\n|\r"), strip)
    fits = F.filter(lines, lambda x: x.startswith("# ") | ((x != "") & ~x.rlike(r"^(\||-|<!--)")))
    first = F.try_element_at(fits, F.lit(1))
    title = F.when(first.startswith("# "), strip(F.substr(first, F.lit(3)))).otherwise(strip(F.substring(first, 1, 80)))
    return F.coalesce(title, F.lit("Dokument"))


def excerpt(body: Column, most: int) -> Column:
    """At most so many characters, cut at the last line end beyond 70 % of them."""
    head = F.substring(body, 1, most)
    last = F.length(head) - F.instr(F.reverse(head), "\n")
    return F.when(F.length(body) <= most, body).when(F.contains(head, F.lit("\n")) & (last > most * 0.7), F.substr(head, F.lit(1), last)).otherwise(head)


def template_question(title: Column, namespace: Column) -> Column:
    named = (title != "") & (title != "Dokument")
    return F.when(named, F.concat(F.lit("Was muss ich ueber "), title, F.lit(" wissen?"))).otherwise(F.concat(F.lit("Was findet man im Wiki unter "), namespace, F.lit("?")))


def template_answer(body: Column) -> Column:
    """The first five lines that are no table, at most 300 characters; else the first 200 of the body."""
    clean = clean_body(body)
    lines = F.filter(F.transform(F.split(clean, r"\r\n|\n|\r"), strip), lambda x: (x != "") & ~x.startswith("|"))
    text = F.array_join(F.slice(lines, 1, 5), " ")
    text = F.when(F.length(text) > 300, F.concat(F.substring(text, 1, 297), F.lit("..."))).otherwise(text)
    return F.when(text == "", F.substring(clean, 1, 200)).otherwise(text)


def qa_pairs(turns: DataFrame) -> DataFrame:
    """User turns and the assistant turns right after them."""
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    told = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return asked.join(told, ["conv_id", "turn"])
