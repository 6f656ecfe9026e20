"""Links of pages and repair of extracted text on the cases that they are meant for."""

import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import ids
from corpusmill.operators import hyperlinks, markup


def one(spark, page):
    return [r.asDict() for r in hyperlinks.links(spark.createDataFrame([(1, page)], "page_id long, html string")).orderBy("place").collect()]


def test_classes_of_links(spark):
    found = one(spark, """
        <A Class='wikilink1 x' HREF="/doku.php?id=ns:p&amp;rev=1" title='a &gt; "b"'> One <b>two</b>
        three </a><a href="/doku.php/ns/x:q?do=1#s" class="wikilink2">q</a><a class=wikilink1 href=#here>h</a><a class="wikilink1" href="/other">o</a>
        <a class="urlextern" href="http://x.example">x</a><a class="mediafile" href="m">m</a><a class="media" href="/lib/exe/detail.php?id=ns:d.png">d</a>
        <a class="interwiki" href="i">i</a><a href="mailto:a@b">m</a><a href="">none</a><a class="urlextern">none</a><a class="media" href="plain.pdf"/>after""")
    assert [(r["kind"], r["target"], r["exists"], r["media_id"], r["text"]) for r in found] == [
        ("internal", "ns:p", True, None, "Onetwothree"), ("internal", "ns/x:q", False, None, "q"), ("internal", "", True, None, "h"), ("internal", "/other", True, None, "o"),
        ("external", None, None, None, "x"), ("media", None, None, "ns:d.png", "d"), ("interwiki", None, None, None, "i"), ("mailto", None, None, None, "m"), ("media", None, None, "plain.pdf", ""),
    ]
    assert found[0]["title"] == 'a > "b"' and found[0]["css_classes"] == ["wikilink1", "x"]


def test_markup_that_is_not_well_formed(spark):
    page = """<!-- <a class="urlextern" href="c">c</a> --><script>"<a class='urlextern' href='s'>"</script><style>a<b</style><p>a < b <a class="urlextern" href="1">one<div>in</p>still</div>
        <a class="urlextern" href='2>3'>nested</a> rest</a> out <img src="/lib/exe/fetch.php?media=a.png" alt="A&amp;B"><img src="/x?media=a.png"><a class="urlextern" href="u" href="last">open"""
    assert [(r["kind"], r["href"], r["text"], r["type"]) for r in one(spark, page)] == [
        ("external", "1", "onein", None), ("external", "2>3", "nested", None), ("media", "/lib/exe/fetch.php?media=a.png", "A&B", "embedded_image"), ("external", "last", "open", None)
    ]
    frame = spark.createDataFrame([(1, None), (2, ""), (None, "<a class='mail' href='x'>y</a>"), (3, "<a href='" * 50), (4, "<" * 5000)], "page_id long, html string")
    assert [(r["page_id"], r["kind"]) for r in hyperlinks.links(frame).collect()] == [(None, "mailto")]
    assert hyperlinks.summary(hyperlinks.links(frame)).first()["mailto_count"] == 1 and hyperlinks.links(frame.limit(0)).count() == 0


def test_ids_of_media(spark):
    cases = {"a.png": True, "ns:a.png": True, "httpd.png": True, "a&b#c.png": True, "doku.php": False, "x?y.png": False, "x=y.png": False, "a//b.png": False, "https://a.b/c.png": False, "ns.x:file": False, "": False, None: False}
    found = spark.createDataFrame([(k,) for k in cases], "m string").select("m", ids.valid_media(F.col("m")).alias("v")).collect()
    assert {r["m"]: r["v"] for r in found} == cases


def _despaced(text):
    out = []
    for line in text.split("\n"):
        words = line.split()
        if words and sum(len(w) == 1 for w in words) / len(words) > 0.6:
            groups = [(g, g.split()) for g in re.split("  +", line.strip())]
            line = " ".join("".join(p) if all(len(x) == 1 for x in p) else g for g, p in groups)
        out.append(line)
    return "\n".join(out)


def _together(text):
    shaped = lambda s: s.startswith(("#", "- ", "* ")) or re.match(r"\d+[.)]\s", s)
    out = []
    for line in (x.strip() for x in text.split("\n")):
        if line and not shaped(line) and out and out[-1] and len(out[-1]) < 40 and not shaped(out[-1]):
            out[-1] += " " + line
        else:
            out.append(line)
    return "\n".join(out)


def test_repair_of_extracted_text(spark):
    import random

    rng = random.Random(4)
    bits = ["a", "b", " ", "  ", "   ", "Wort", "\n", "\n\n", "- ", "* ", "*x", "# ", "3. ", "12) ", "3.", "|", "Ein längerer Satz, der hier steht.", " ", "\t", "é", "Ende."]
    texts = ["H T B L A  L e o n d i n g", "A B C Test D E", "a b", "Erste.\nZweite Zeile", "", "\n", "- a\nb", "x\n\ny", "1.\nx\ny", "a\n" * 30]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in frame.select("i", markup.despaced(F.col("t")).alias("d"), markup.run_together(F.col("t")).alias("m")).collect():
        assert r["d"] == _despaced(texts[r["i"]])
        assert r["m"] == _together(texts[r["i"]])
    assert spark.createDataFrame([("H a l l o  W e l t\nund m ehr", None)], "t string, n string").select(markup.cleaned(F.col("t")).alias("c"), markup.cleaned(F.col("n")).alias("n")).first()["n"] is None


@pytest.mark.parametrize(("text", "want"), [("H T B L A  L e o n d i n g", "HTBLA Leonding"), ("kurz\nZeile", "kurz Zeile"), ("# Kopf\nText", "# Kopf\nText"), ("- Punkt\n- Punkt", "- Punkt\n- Punkt"), ("a\n\nb", "a\n\nb")])
def test_known_repairs(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(markup.cleaned(F.col("t"))).first()[0] == want
