"""Page quality, readiness for retrieval, classification and their rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import clamp, count_literal, count_matches, matched_chars, paragraphs, share, strip, tiers, word_count

# Markup taken off, in this order, to see whether a page is template only.
TEMPLATE_MARKS = ("{{", "}}", "[[", "]]", "====", "===", "==", "  *", "  -")


def template_only(text: Column) -> Column:
    for mark in TEMPLATE_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return F.length(strip(text)) < 50


def evaluate(pages: DataFrame, least: int = 50, stub: int = 200) -> DataFrame:
    """Scores, flags and recommendation of pages.

    Needs page_id, content, link_count, broken_count, linked (is it a link target) and
    freshness (0 to 1).  Headings count the overlapping literals ``====``, ``===`` and
    ``==``; tables are carets halved.
    """
    text = F.coalesce("content", F.lit(""))
    heads = count_literal(text, "====") + count_literal(text, "===") + count_literal(text, "==")
    base = pages.withColumns({
        "char_count": F.length(text).cast("long"),
        "word_count": word_count(text),
        "heading_count": heads,
        "code_block_count": count_literal(text, "<code>") + count_literal(text, "<file>"),
        "table_count": F.floor(count_literal(text, "^") / 2).cast("long"),
        "is_template_only": template_only(text),
    })
    chars, words = F.col("char_count"), F.col("word_count")
    varied = (F.col("heading_count") > 0) | (F.col("code_block_count") > 0) | (F.col("table_count") > 0)
    mean = chars / words
    length_part = F.when(chars > 2000, 0.4).when(chars > 1000, 0.3).when(chars > 500, 0.2).otherwise(0.1)
    word_part = F.when(words == 0, 0.0).when((mean >= 4) & (mean <= 8), 0.3).otherwise(0.1)
    variety = F.when(varied, 0.3).when(chars > 500, 0.1).otherwise(0.0)
    base = base.withColumns({
        "is_empty": chars < least,
        "is_stub": (chars >= least) & (chars < stub),
        "has_broken_links": F.col("broken_count") > 0,
        "is_orphan": ~F.col("linked") & (F.col("page_id") != "start"),
        "content_quality": F.when(chars < least, 0.0).otherwise(F.least(F.lit(1.0), length_part + word_part + variety)),
        "structure_quality": F.when(F.col("heading_count") >= 3, 0.4).when(F.col("heading_count") >= 1, 0.2).otherwise(0.0) + F.when(F.col("code_block_count") > 0, 0.3).otherwise(0.0) + F.when(F.col("table_count") > 0, 0.3).otherwise(0.0),
    })
    links = F.lit(0.5) + F.when(F.col("link_count") > 0, 0.2).otherwise(0.0) + F.when(~F.col("is_orphan"), 0.2).otherwise(0.0) - F.when(F.col("has_broken_links"), 0.3).otherwise(0.0)
    base = base.withColumn("link_quality", clamp(links))
    score = F.col("content_quality") * 0.4 + F.col("structure_quality") * 0.2 + F.col("link_quality") * 0.2 + F.col("freshness") * 0.2
    base = base.withColumn("quality_score", F.round(score, 6))
    quality = F.col("quality_score")
    flag = lambda name, on: F.when(on, F.lit(name))
    return base.withColumns({
        "recommendation": F.when((quality < 0.5) | F.col("is_empty"), "exclude").when((quality < 0.7) | F.col("is_stub"), "review").otherwise("include"),
        "flags": F.array_compact(F.array(flag("empty", F.col("is_empty")), flag("stub", F.col("is_stub")), flag("template", F.col("is_template_only")), flag("broken_links", F.col("has_broken_links")), flag("orphan", F.col("is_orphan")))),
    })


def quality_summary(evaluated: DataFrame) -> DataFrame:
    q = F.col("quality_score")
    count = lambda c, name: F.count_if(c).alias(name)
    return evaluated.agg(
        F.count("*").alias("pages"), F.round(F.avg("quality_score"), 6).alias("overall_quality"),
        *(count(F.col("recommendation") == r, f"pages_to_{r}") for r in ("include", "review", "exclude")),
        count(F.col("is_empty"), "empty_pages"), count(F.col("is_stub"), "stub_pages"), count(F.col("is_orphan"), "orphan_pages"), F.sum("broken_count").alias("broken_links"),
        count(q >= 0.9, "excellent"), count((q >= 0.7) & (q < 0.9), "good"), count((q >= 0.5) & (q < 0.7), "fair"), count((q >= 0.3) & (q < 0.5), "poor"), count(q < 0.3, "very_poor"),
    )


def flagged(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.size("flags") > 0)


def recommended(evaluated: DataFrame, kind: str) -> DataFrame:
    return evaluated.where(F.col("recommendation") == kind)


# Default patterns of the structure analysis (Java and RE2 agree on them).
STRUCTURE = {
    "headlines": r"(?m)^={2,6}[^=\n]+={2,6}[ \t]*$",
    "lists": r"(?m)^ {2,}[*-] ",
    "tables": r"(?m)^[|^]",
    "links": r"\[\[[^\]]*\]\]",
    "media_refs": r"\{\{[^}]*\}\}",
    "code_blocks": r"<code",
}
REMOVABLE = (r"~~[A-Z]+~~", r"<wrap[^>]*>")
BOILERPLATE = (r"(?i)all rights reserved", r"(?i)licensed under")
SYNTAX = ("{{", "}}", "[[", "]]", "====", "===", "<code", "</code>", "<wrap", "</wrap>")


def readiness(pages: DataFrame, ideal: tuple[int, int] = (100, 500), required: tuple[str, ...] = ("page_id", "source", "modified"), optional: tuple[str, ...] = ("lang",)) -> DataFrame:
    """Structure, noise, chunking and metadata scores of a page and their weighted sum."""
    text = F.col("content")
    out = pages.withColumns({**{f"n_{k}": count_matches(text, p) for k, p in STRUCTURE.items()}, "n_paragraphs": count_literal(text, "\n\n") + 1, "n_lines": count_literal(text, "\n") + 1, "char_count": F.length(text).cast("long")})
    chars = F.col("char_count")
    structure = (
        F.when(F.col("n_headlines") > 0, 0.4).when(F.col("n_paragraphs") > 3, 0.2).otherwise(0.0)
        + F.when(F.col("n_lists") > 0, 0.2).otherwise(0.0)
        + F.when((chars >= 500) & (chars <= 10000), 0.3).when(chars > 100, 0.2).otherwise(0.0)
        + F.when(F.col("n_tables") > 0, 0.1).otherwise(0.0)
    )
    lines = F.transform(F.split(text, "\n"), strip)
    full = F.filter(lines, lambda x: x != "")
    short = F.filter(full, lambda x: F.length(x) < 20)
    removable = sum((count_matches(text, p) for p in REMOVABLE), F.lit(0).cast("long"))
    boilerplate = sum((count_matches(text, p) for p in BOILERPLATE), F.lit(0).cast("long"))
    syntax = sum((count_literal(text, s) for s in SYNTAX), F.lit(0).cast("long"))
    out = out.withColumns({"removable": removable, "boilerplate": boilerplate, "syntax": syntax, "empty_ratio": 1 - share(F.size(full), F.size(lines), 1.0), "short_ratio": share(F.size(short), F.size(full))})
    noise = F.least(F.col("removable") * 0.05, F.lit(0.2)) + F.when(F.col("empty_ratio") > 0.3, 0.1).otherwise(0.0) + F.when(F.col("short_ratio") > 0.5, 0.1).otherwise(0.0) + F.least(F.col("syntax") / F.greatest(chars, F.lit(1)) * 2, F.lit(0.3))
    sizes = F.transform(paragraphs(text), F.length)
    fitting = F.size(F.filter(sizes, lambda n: (n >= ideal[0]) & (n <= ideal[1])))
    blocks = F.size(sizes)
    chunking = F.when(F.col("n_headlines") > 0, 0.4).otherwise(0.0) + share(fitting, blocks) * 0.4 + F.when((blocks >= 3) & (blocks <= 20), 0.2).when(blocks > 0, 0.1).otherwise(0.0)
    present = lambda names: sum((F.when(F.col(n).isNotNull(), 1).otherwise(0) for n in names), F.lit(0)) / len(names)
    metadata = present(required) * 0.7 + present(optional) * 0.3
    out = out.withColumns({"structure_score": clamp(structure), "noise_score": F.when(chars == 0, 0.0).otherwise(clamp(noise)), "chunking_score": clamp(chunking), "metadata_score": metadata})
    total = 0.25 * F.col("structure_score") + 0.30 * (1 - F.col("noise_score")) + 0.30 * F.col("chunking_score") + 0.15 * F.col("metadata_score")
    return out.withColumn("readiness", F.round(total, 6))


def readiness_summary(scored: DataFrame) -> DataFrame:
    r = F.col("readiness")
    return scored.agg(F.count("*").alias("pages"), F.round(F.avg("readiness"), 6).alias("mean_readiness"), F.count_if(r >= 0.7).alias("ready"), F.count_if((r >= 0.4) & (r < 0.7)).alias("partly"), F.count_if(r < 0.4).alias("not_ready"), F.round(F.avg("noise_score"), 6).alias("mean_noise"), F.round(F.max("noise_score"), 6).alias("max_noise"))


def metadata_issues(required: tuple[str, ...] = ("page_id", "source", "modified")) -> Column:
    """Which required fields are missing."""
    return F.array_compact(F.array(*(F.when(F.col(n).isNull() | (F.col(n).cast("string") == ""), F.lit(f"missing {n}")) for n in required)))


def temporal_advice(rollup: DataFrame) -> DataFrame:
    """Advice from one row (pages, archived, outdated, time_sensitive, outdated_refs)."""
    share = F.try_divide(F.col("archived") * 100.0, F.greatest("pages", F.lit(1)))
    checks = [("keep archived pages apart or lower their weight", share > 5), ("renew outdated pages or lower their weight", F.col("outdated") > 20), ("index time-sensitive pages again and again", F.col("time_sensitive") > 10), ("tag pages that name old years", F.col("outdated_refs") > F.col("pages") * 0.2)]
    return rollup.select(F.explode(F.array_compact(F.array(*(F.when(c, F.lit(t)) for t, c in checks)))).alias("advice"))


def recommendations(summary: DataFrame) -> DataFrame:
    """Advice that holds for a one-row readiness summary."""
    checks = [("many pages are not ready", F.col("not_ready") * 3 > F.col("pages")), ("noise is high", F.col("mean_noise") > 0.3), ("mean readiness is low", F.col("mean_readiness") < 0.6)]
    return summary.select(F.explode(F.array_compact(F.array(*(F.when(c, F.lit(t)) for t, c in checks)))).alias("advice"))


def content_type(page_id: Column, namespace: Column) -> Column:
    """The first rule that holds, by page id and namespace."""
    p, n = F.lower(page_id), F.lower(namespace)
    has = lambda c, s: F.contains(c, F.lit(s))
    rules = [
        ("FORM_COLLECTION", has(p, "forms") | has(n, "form")),
        ("PORTAL", p.endswith(":start") | p.endswith("_start") | (p == "start")),
        ("NEWS", has(n, "competitions") | has(n, "wocheninfo")),
        ("ARCHIVE", has(n, "archive")),
        ("TUTORIAL", has(n, "tutorial")),
        ("TECHNICAL", n.isin("it", "software", "wiki")),
        ("TEACHER_ONLY", has(n, "teacher")),
        ("DEPARTMENT", has(n, "departm")),
        ("EXAM_INFO", has(n, "exams")),
        ("ORGANIZATION", has(n, "org")),
    ]
    out = None
    for name, rule in rules:
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return out.otherwise("KNOWLEDGE")


def access_level(namespace: Column) -> Column:
    n = F.lower(namespace)
    return F.when(n.startswith("teacher:") | n.startswith("lehrer:") | n.isin("teacher", "lehrer"), "teacher_only").otherwise("public")


def media_access(media_id: Column) -> Column:
    first = F.when(F.contains(media_id, F.lit(":")), F.lower(F.substring_index(media_id, ":", 1))).otherwise("")
    return F.when(first.isin("teacher", "lehrer"), "teacher_only").otherwise("public")


def media_type(extension: Column) -> Column:
    return F.when(F.regexp_replace(extension, r"^\.+", "").isin("jpg", "jpeg", "png", "gif", "svg", "webp"), "IMAGE").otherwise("DOCUMENT")


def by_membership(namespace: Column, types: dict[str, list[str]], otherwise: str = "other") -> Column:
    """Content type by namespace membership."""
    out = F.lit(otherwise)
    for kind, names in reversed(types.items()):
        out = F.when(namespace.isin(*names), kind).otherwise(out)
    return out


def page_type(page_id: Column, text: Column, patterns: list[tuple[str, str]], otherwise: str = "content") -> Column:
    """The first pattern found in the id or the first 1000 characters."""
    head, out = F.substring(text, 1, 1000), F.lit(otherwise)
    for kind, pattern in reversed(patterns):
        out = F.when(page_id.rlike(pattern) | head.rlike(pattern), kind).otherwise(out)
    return out


def time_sensitive(page_id: Column, text: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | page_id.rlike(p) | F.substring(text, 1, 500).rlike(p)
    return out


# File types by suffix, and what the quality of a file is judged by.
OFFICE = {"docx": "word", "xlsx": "excel", "pptx": "powerpoint", "odt": "odt"}
IMAGES = ("jpg", "jpeg", "png")
ISSUES = {"scan": "Wenig Text - vermutlich gescannt", "low": "Niedrige Auflösung", "small": "Sehr kleine Datei - möglicherweise wenig Inhalt", "large": "Große Datei - möglicherweise komplexes Layout"}
ADVICE = {"scan": "OCR empfohlen", "large": "Prüfen ob Chunking-Strategie angepasst werden muss", "svg": "SVG-Diagramm - Text-Extraktion prüfen"}


def file_quality(files: DataFrame) -> DataFrame:
    """Type, score, issues and advice of files by their suffix and what a parser tells of them.

    Input: name, size (bytes), pages, text_chars, has_images, width, height; unknown features are null.
    """
    ext, kb = ids.extension(F.col("name")), F.col("size") / 1024
    office = F.create_map(*(F.lit(x) for pair in OFFICE.items() for x in pair))
    kind = F.when(ext == "pdf", "pdf").when(ext.isin(*IMAGES), "image").when(ext.isin(*OFFICE), office[ext]).when(ext == "svg", "svg").when(ext == "", "unknown").otherwise(ext)
    text = F.coalesce("text_chars", F.lit(0))
    per_page = F.coalesce(F.try_divide(text.cast("double"), F.col("pages")), F.lit(0.0))
    scanned = (text < 100) & F.coalesce("has_images", F.lit(False))
    least = F.least("width", "height")
    pdf = F.when((text > 100) & (per_page > 500), 0.9).when(text > 100, 0.7).when(scanned, 0.3).otherwise(0.5)
    image = F.when(least.isNull(), 0.5).when(least >= 800, 0.9).when(least >= 400, 0.7).when(least >= 200, 0.5).otherwise(0.3)
    is_office = ext.isin(*OFFICE)
    score = F.when(ext == "pdf", pdf).when(ext.isin(*IMAGES), image).when(is_office, F.when(kb < 10, 0.5).otherwise(0.7)).when(ext == "svg", 0.8).otherwise(0.5)
    rules = {"scan": (ext == "pdf") & scanned, "low": ext.isin(*IMAGES) & (least < 200), "small": is_office & (kb < 10), "large": is_office & (kb > 10000), "svg": ext == "svg"}
    said = lambda texts: F.array_compact(F.array(*(F.when(rules[k], F.lit(t)) for k, t in texts.items())))
    return files.withColumns({"type": kind, "score": score, "needs_ocr": F.coalesce(rules["scan"], F.lit(False)), "ocr_candidate": F.coalesce(ext.isin(*IMAGES) & (F.col("width") >= 200) & (F.col("height") >= 100), F.lit(False)), "issues": said(ISSUES), "advice": said(ADVICE)})


def file_totals(judged: DataFrame, apart: list[str]) -> DataFrame:
    """Files, megabytes, issues and mean score by type; files named in ``apart`` are a list of their own."""
    own = F.coalesce(F.col("name").isin(*apart), F.lit(False)) if apart else F.lit(False)
    return judged.groupBy(own.alias("apart"), "type").agg(F.count("*").alias("files"), F.round(F.sum(F.col("size") / 1048576), 6).alias("megabytes"), F.count_if(F.size("issues") > 0).alias("with_issues"), F.count_if("needs_ocr").alias("needing_ocr"), F.round(F.avg("score"), 6).alias("mean_score"))


def file_summary(judged: DataFrame) -> DataFrame:
    """One row: files, mean score, and how many are of high (0.7), medium (0.4) and low quality."""
    s = F.col("score")
    return judged.agg(F.count("*").alias("files"), F.round(F.coalesce(F.avg(s), F.lit(0.0)), 6).alias("mean_score"), F.count_if(s >= 0.7).alias("high"), F.count_if((s >= 0.4) & (s < 0.7)).alias("medium"), F.count_if(s < 0.4).alias("low"))


def link_density(text: Column) -> Column:
    """Characters of links over all."""
    return share(matched_chars(text, r"\[\[.*?\]\]"), F.length(text))


def table_rows(text: Column) -> Column:
    return count_matches(text, r"(?m)^\|.*\|$")


def size_class(chars: Column) -> Column:
    return tiers(chars, [(1, "empty"), (50, "tiny"), (1000, "small"), (5000, "medium")], "large")


def size_bucket(size: Column) -> Column:
    return F.when(size == 0, "empty").otherwise(tiers(size, [(1024, "under_1k"), (5120, "under_5k"), (20480, "under_20k"), (102400, "under_100k")], "large"))
