"""Links of HTML pages in five classes, with text, title and embedded images.

A tokenizer walks a page once: markup by one pattern, attributes by another, text in
between.  It keeps the stack of open elements, so the text of a link is what stands inside
it (stripped piece by piece), however tags nest or miss their ends; comments, scripts and
styles are passed over.  What links mean (class, target, media) are Spark expressions.

Null and empty pages have no links.  A page of any length is walked whole, one at a time.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exports import media_of_href, media_of_src

# Elements without an end, elements whose content is no markup, and the classes of links.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
RAW = ("script", "style")
INTERNAL, MISSING, EXTERNAL, MEDIA, INTERWIKI, MAIL = "wikilink1", "wikilink2", "urlextern", "media", "interwiki", "mail"

_MARK = re.compile(r"""<!--(?s:.*?)(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"'][^\s=/>]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

ANCHOR = "place int, image boolean, href string, text string, title string, css_classes array<string>"


def attributes(text: str) -> dict[str, str]:
    """Names in lower case with their values, entities resolved; the last of equal names wins."""
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        found[name.lower()] = html.unescape(value)
    return found


def anchors(page: str) -> list[dict]:
    """Anchors with an href and images with a src, in the order in which they begin."""
    found: list[dict] = []
    open_: list[tuple[str, dict | None]] = []
    at, place = 0, 0

    def said(end: int) -> None:
        piece = html.unescape(page[at:end]).strip() if end > at and any(a for _, a in open_) else ""
        for _, anchor in open_ if piece else ():
            if anchor is not None:
                anchor["text"] += piece

    while mark := _MARK.search(page, at):
        said(mark.start())
        at, name = mark.end(), (mark["name"] or "").lower()
        if not name:
            continue
        if mark["end"]:
            names = [n for n, _ in open_]
            if name in names:
                del open_[len(names) - 1 - names[::-1].index(name) :]
            continue
        anchor = None
        if name in ("a", "img"):
            own = attributes(mark["rest"])
            anchor = {"place": place, "image": name == "img", "href": own.get("src" if name == "img" else "href", ""), "text": own.get("alt", "") if name == "img" else "", "title": own.get("title", ""), "css_classes": own.get("class", "").split()}
            place += 1
            if anchor["href"]:
                found.append(anchor)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not mark["rest"].rstrip().endswith("/"):
            open_.append((name, anchor))
    said(len(page))
    return found


def extracted(pages: DataFrame, key: str = "page_id", text: str = "html") -> DataFrame:
    """(key, place, image, href, text, title, css_classes) of every anchor and image of the pages."""

    def run(batches):
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in names}
            for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for anchor in anchors(page or ""):
                    rows[key].append(k)
                    for n, value in anchor.items():
                        rows[n].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in zip(names, types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    names = [key, *(field.split(" ")[0] for field in ANCHOR.split(", "))]
    types = [to_arrow_type(pages.schema[key].dataType), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string())]
    return pages.select(key, text).mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, {ANCHOR}")


def link_target(href: Column) -> Column:
    """Page id of an href: what its id says, else the path behind the script, nothing for an anchor, else the href."""
    by_id = F.regexp_extract(href, "id=([^&]+)", 1)
    path = F.regexp_replace(F.get(F.split(href, r"/doku\.php/"), F.lit(1)), r"(?s)[?#].*$", "")
    return F.when(by_id != "", by_id).when(F.contains(href, F.lit("/doku.php/")), path).when(href.startswith("#"), "").otherwise(href)


def link_kind(href: Column, classes: Column) -> Column:
    """Class of a link by its CSS classes, the first that fits; mail also by its scheme; null where none fits."""
    has = lambda c: F.array_contains(classes, c)
    return (
        F.when(has(INTERNAL) | has(MISSING), "internal").when(has(EXTERNAL), "external").when(has(MEDIA), "media")
        .when(has(INTERWIKI), "interwiki").when(has(MAIL) | href.startswith("mailto:"), "mailto")
    )


def links(pages: DataFrame, key: str = "page_id", text: str = "html") -> DataFrame:
    """(key, place, kind, type, href, text, title, css_classes, target, exists, media_id); links of no class are left out.

    Images that are fetched through the wiki are media links of type ``embedded_image``.
    """
    rows = extracted(pages, key, text)
    href, image = F.col("href"), F.col("image")
    fetched = image & F.contains(href, F.lit("/lib/exe/fetch.php")) & (media_of_src(href) != "")
    kind = F.when(image, F.when(fetched, "media")).otherwise(link_kind(href, F.col("css_classes")))
    told = rows.withColumn("kind", kind).where("kind is not null")
    internal = F.col("kind") == "internal"
    return told.select(
        key, "place", "kind", F.when(image, "embedded_image").alias("type"), "href", "text", "title", "css_classes",
        F.when(internal, link_target(href)).alias("target"), F.when(internal, F.array_contains("css_classes", INTERNAL)).alias("exists"),
        F.when(image, media_of_src(href)).when(F.col("kind") == "media", media_of_href(href)).alias("media_id"),
    )


def summary(links: DataFrame, key: str = "page_id") -> DataFrame:
    """Counts of each class of a page's links, and of all."""
    counts = [F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in ("internal", "external", "media", "interwiki", "mailto")]
    return links.groupBy(key).agg(*counts, F.count("*").alias("total_links"))
