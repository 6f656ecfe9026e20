"""Links of HTML pages, and repair of extracted text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hyperlinks, markup
from . import inputs as I


def _planted(n: Column) -> Column:
    """Links of all classes behind a page, in the ways that pages write them."""
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.concat(
        say('<p><a class="wikilink1" title="t &lt;', n, '&gt;" href="/doku.php?do=show&amp;id=ns', n % 5, ":p", n, '">Page <b> ', n, " </b>&amp; more</a>"),
        F.when(n % 2 == 0, say("<A HREF='/doku.php/ns:q", n, "?x=1#top' CLASS='x\n wikilink2'>missing<!-- not > this --></A>")).otherwise(""),
        F.when(n % 3 == 0, say('<a rel=nofollow href="https://site', n % 11, '.example/page" class="urlextern">site')).otherwise(""),
        F.when(n % 3 == 1, say("<a class=media href=/lib/exe/fetch.php?media=img:f", n, '.pdf&amp;w=5><img src="/lib/exe/fetch.php?w=9&amp;media=img:g', n, '.png" alt="pic > ', n, '" class="media left"/></a>')).otherwise(""),
        F.when(n % 3 == 2, say('<div><a class="interwiki iw_wp" href="https://de.example/', n, '">inter</div> outside')).otherwise(""),
        F.when(n % 4 == 0, say('<a class="mail" href="mailto:a', n, '@b.example">mail</a><a href="mailto:c@d.example"></a>')).otherwise(""),
        F.when(n % 4 == 1, say('<a class="mediafile" href="none">no class of ours</a><a class="urlextern">no address</a><a href="#top" class="wikilink1">top</a>')).otherwise(""),
        F.when(n % 4 == 2, F.lit('<!-- <a class="urlextern" href="hidden">x</a> --><script>var a = \'<a class="urlextern" href="code">x</a>\';</script><img src="/plain.png">')).otherwise(""),
        F.lit("</p>"),
    )


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "pages").select("page_id", F.concat("html", _planted(F.col("page_id"))).alias("html"))


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hyperlinks.links(_pages(spark, sf_dir))
    return found.select("page_id", "kind", "type", "href", "text", "title", F.array_join("css_classes", " ").alias("css"), "target", "exists", "media_id")


def html_link_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperlinks.summary(hyperlinks.links(_pages(spark, sf_dir)))


def text_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with spaced, short, empty and shaped lines among their own."""
    n = F.col("doc_id")
    spaced = F.when(n % 3 == 0, F.concat(F.lit("H T B L A  L e o n d i n g  n r  "), n, F.lit("\n"))).when(n % 3 == 1, F.lit("a b\n a  b c  Wort d e f g h i\n")).otherwise("")
    short = F.when(n % 4 == 0, F.lit("Erste.\n  Zweite Zeile \n- Punkt\nnach dem Punkt\n\n3. drei\n3.\nx\ny\n")).when(n % 4 == 1, F.lit("| a\n# Kopf\nkurz\n* Stern\n*kein Stern\n\n\nEnde\n")).otherwise("")
    text = F.concat(spaced, short, "text")
    found = I.table(spark, sf_dir, "documents").select("doc_id", markup.despaced(text).alias("spaced"))
    return found.select("doc_id", F.md5("spaced").alias("spaced"), F.md5(markup.run_together(F.col("spaced"))).alias("merged"))


QUERIES = {f.__name__: f for f in (html_links, html_link_summary, text_repair)}

_COLUMNS = "page_id, kind, type, href, text, title, css, target, exists_, media_id"
_LINKS = """
    SELECT page_id, 'internal' AS kind, NULL AS type, '/doku.php?do=show&id=ns' || (page_id % 5) || ':p' || page_id AS href, 'Page' || page_id || '& more' AS text,
        't <' || page_id || '>' AS title, 'wikilink1' AS css, 'ns' || (page_id % 5) || ':p' || page_id AS target, true AS exists_, NULL AS media_id FROM pages
    UNION ALL SELECT page_id, 'internal', NULL, '/doku.php/ns:q' || page_id || '?x=1#top', 'missing', '', 'x wikilink2', 'ns:q' || page_id, false, NULL FROM pages WHERE page_id % 2 = 0
    UNION ALL SELECT page_id, 'external', NULL, 'https://site' || (page_id % 11) || '.example/page',
        'site' || CASE page_id % 4 WHEN 0 THEN 'mail' WHEN 1 THEN 'no class of oursno addresstop' ELSE '' END, '', 'urlextern', NULL, NULL, NULL FROM pages WHERE page_id % 3 = 0
    UNION ALL SELECT page_id, 'media', NULL, '/lib/exe/fetch.php?media=img:f' || page_id || '.pdf&w=5', '', '', 'media', NULL, NULL, 'img:f' || page_id || '.pdf' FROM pages WHERE page_id % 3 = 1
    UNION ALL SELECT page_id, 'media', 'embedded_image', '/lib/exe/fetch.php?w=9&media=img:g' || page_id || '.png', 'pic > ' || page_id, '', 'media left', NULL, NULL, 'img:g' || page_id || '.png'
        FROM pages WHERE page_id % 3 = 1
    UNION ALL SELECT page_id, 'interwiki', NULL, 'https://de.example/' || page_id, 'inter', '', 'interwiki iw_wp', NULL, NULL, NULL FROM pages WHERE page_id % 3 = 2
    UNION ALL SELECT page_id, 'mailto', NULL, 'mailto:a' || page_id || '@b.example', 'mail', '', 'mail', NULL, NULL, NULL FROM pages WHERE page_id % 4 = 0
    UNION ALL SELECT page_id, 'mailto', NULL, 'mailto:c@d.example', '', '', '', NULL, NULL, NULL FROM pages WHERE page_id % 4 = 0
    UNION ALL SELECT page_id, 'internal', NULL, '#top', 'top', '', 'wikilink1', '', true, NULL FROM pages WHERE page_id % 4 = 1
"""

_WHITE = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_WORD = _WHITE.replace("[", "[^", 1) + "+"


def _bare(x: str) -> str:
    return f"regexp_replace({x}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"


def _shaped(x: str) -> str:
    return f"regexp_matches({x}, '^(#|- |[*] |\\p{{Nd}}+[.)]{_WHITE})')"


#: The lines folded one by one: what is done so far, behind one mark, ends in the line that the next one may join.
_LAST = "replace(list_last(string_split(a, chr(10))), chr(2), '')"
_FOLD = f"""CASE WHEN a = chr(2) THEN a || x WHEN x = '' OR {_shaped("x")} OR {_LAST} = '' OR length({_LAST}) >= 40 OR {_shaped(_LAST)}
    THEN a || chr(10) || x ELSE a || ' ' || x END"""

ORACLE_SQL = {
    "html_links": f'SELECT page_id, kind, type, href, text, title, css, target, exists_ AS "exists", media_id FROM ({_LINKS})',
    "html_link_summary": f"""
        SELECT page_id, count(*) FILTER (WHERE kind = 'internal') AS internal_count, count(*) FILTER (WHERE kind = 'external') AS external_count, count(*) FILTER (WHERE kind = 'media') AS media_count,
            count(*) FILTER (WHERE kind = 'interwiki') AS interwiki_count, count(*) FILTER (WHERE kind = 'mailto') AS mailto_count, count(*) AS total_links FROM ({_LINKS}) GROUP BY page_id
    """,
    "text_repair": f"""
        WITH d AS (
            SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'H T B L A  L e o n d i n g  n r  ' || doc_id || chr(10) WHEN 1 THEN 'a b' || chr(10) || ' a  b c  Wort d e f g h i' || chr(10) ELSE '' END
                || replace(CASE doc_id % 4 WHEN 0 THEN 'Erste.~  Zweite Zeile ~- Punkt~nach dem Punkt~~3. drei~3.~x~y~' WHEN 1 THEN '| a~# Kopf~kurz~* Stern~*kein Stern~~~Ende~' ELSE '' END, '~', chr(10))
                || text AS text FROM documents
        ), lines AS (
            SELECT doc_id, list_transform(string_split(text, chr(10)), lambda l: {{'l': l, 'n': len(regexp_extract_all(l, '{_WORD}')),
                's': len(list_filter(regexp_extract_all(l, '{_WORD}'), lambda w: length(w) = 1))}}) AS ls FROM d
        ), spaced AS (
            SELECT doc_id, array_to_string(list_transform(ls, lambda x: CASE WHEN x.s > 0.6 * x.n THEN array_to_string(list_transform(
                regexp_split_to_array({_bare("x.l")}, '  +'), lambda g: CASE WHEN len(list_filter(regexp_extract_all(g, '{_WORD}'), lambda w: length(w) > 1)) = 0
                    THEN regexp_replace(g, '{_WHITE}', '', 'g') ELSE g END), ' ') ELSE x.l END), chr(10)) AS text FROM lines
        )
        SELECT doc_id, md5(text) AS spaced, md5(replace(list_reduce(list_concat([chr(2)], list_transform(string_split(text, chr(10)), lambda l: {_bare("l")})), lambda a, x: {_FOLD}), chr(2), '')) AS merged
        FROM spaced
    """,
}
