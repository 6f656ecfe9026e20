import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import fresh, ids
from corpusmill.operators import chunks, corpus, ir, markup, pages, resample, scores, snapshots, stats


def test_metrics_of_known_lists(spark):
    ranked = spark.createDataFrame([("a", "d1", 1), ("a", "d2", 2), ("a", "d3", 3), ("b", "x", 1), ("b", "d1", 2), ("c", "x", 1), ("c", "y", 2), ("c", "d1", 3)], "query_id string, doc_id string, rank int")
    qrels = spark.createDataFrame([("a", "d1", 3), ("a", "d2", 1), ("a", "d3", 2), ("b", "d1", 1), ("c", "d1", 1), ("d", "d9", 1)], "query_id string, doc_id string, rel int")
    found = {r["query_id"]: r for r in ir.per_query(ranked, qrels, qrels, k=5, k_gain=3).collect()}
    assert [round(found[q]["rr"], 4) for q in "abcd"] == [1, 0.5, 0.3333, 0]
    assert found["a"]["ndcg"] == pytest.approx(0.972, abs=1e-3)
    assert found["b"]["p_at_k"] == pytest.approx(0.2)
    assert found["d"]["hit"] == 0
    mean = ir.means(ir.per_query(ranked, qrels, qrels.where("query_id <> 'd'"))).first()
    assert mean["mean_rr"] == pytest.approx(0.6111, abs=1e-4)


def test_empty_ranking_has_zero_metrics(spark):
    ranked = spark.createDataFrame([], "query_id string, doc_id string, rank int")
    qrels = spark.createDataFrame([("a", "d", 1)], "query_id string, doc_id string, rel int")
    assert ir.per_query(ranked, qrels, qrels).first()["rr"] == 0


def test_statistics():
    assert stats.paired_test(np.array([1.0, 2]), np.array([1.0, 2])) == ("none", 1.0)
    assert stats.paired_test(np.arange(5.0), np.arange(5.0)) == ("none", 1.0)
    assert math.isnan(stats.bootstrap(np.array([]))[0])
    assert stats.bootstrap(np.array([3.0])) == (3.0, 3.0, 3.0)
    mean, low, high = stats.bootstrap(np.arange(100.0))
    assert low < mean < high
    # known values: t(9) = 2.262 is 5 %, exact signed ranks of 1..6 all positive are 2 / 64
    assert stats.beta_share(4.5, 0.5, 9 / (9 + 2.262157**2)) == pytest.approx(0.05, abs=1e-5)
    assert stats.wilcoxon(np.arange(1.0, 7)) == pytest.approx(2 / 64)
    rng = np.random.default_rng(1)
    assert stats.shapiro_wilk(rng.normal(size=50)) > 0.05 > stats.shapiro_wilk(rng.exponential(size=50) ** 2)


def test_scalable_bootstrap_is_near_the_exact_one(spark):
    rows = spark.range(400).select(F.lit("m").alias("m"), (F.col("id") % 10).cast("double").alias("s"))
    row = resample.intervals(rows.withColumn("k", F.monotonically_increasing_id()), "m", "s", "k", rounds=60).first()
    assert 4.0 < row["low"] < 4.5 < row["high"] < 5.0


def test_snapshot_cases(spark):
    shape = "id string, revision long, hash string, size long, namespace string"
    before = spark.createDataFrame([("a", 1, "x", 1, "n"), ("b", 1, "x", 1, "n"), ("c", 1, None, 1, "n"), ("d", 2, "x", 9, "n")], shape)
    after = spark.createDataFrame([("a", 1, "x", 1, "n"), ("b", 1, "y", 1, "n"), ("c", 1, "z", 1, "n"), ("e", 1, "x", 1, "n")], shape)
    assert {r["id"]: r["change"] for r in snapshots.diff(before, after).collect()} == {"a": "unchanged", "b": "modified", "c": "unchanged", "d": "deleted", "e": "added"}
    assert snapshots.any_newer(after, before).first()[0] is False
    assert snapshots.any_newer(after, before.limit(0)).first()[0] is True
    marked = snapshots.mark_deleted(before.withColumn("status", F.lit("active")), after.where("id = 'a'"))
    assert {r["id"]: r["status"] for r in marked.collect()}["a"] == "deleted"


def test_chunkers():
    text = "One. " * 300
    assert all(len(c) <= 120 for c in chunks.naive(text, 120, 20))
    assert chunks.semantic("a\n\nb", 10, 0, 1) == ["a\n\nb"]
    assert chunks.semantic("x" * 8 + "\n\n" + "y" * 8 + "\n\nz", 10, 0, 5) == ["x" * 8, "y" * 8 + "\n\nz"]
    assert chunks.by_header("intro\n\n# A\ntext\n\n## B\nmore") == ["intro", "# A\ntext", "## B\nmore"]
    table = "| h |\n|---|\n" + "\n".join(f"| {i:03d} |" for i in range(40))
    cut = chunks.by_table("# T\n" + table, size=100)
    assert len(cut) > 3 and all(c.startswith("# T\n| h |\n|---|\n") and len(c) <= 100 for c in cut)
    assert sum(c.count("\n| ") for c in cut) == 40 + len(cut)  # each row once, and the repeated heads
    assert chunks.simple("") == [] and chunks.for_queries("short") == []
    assert chunks.naive("ab" * 10, 10, 6)[:2] == ["ab" * 5, "ab" * 5]
    with pytest.raises(ValueError):
        chunks.naive("x" * 30, 10, 10)


def converted(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, content string")
    return [r["m"] for r in rows.select("i", markup.markdown("content").alias("m")).orderBy("i").collect()]


def test_markdown(spark):
    wiki = "====== T ======\n\nA **b** //c// [[ns:P|x]] {{:Img.png?200|alt}}\n\n  * one\n    - two\n\n^ h ^ i ^\n| 1 | 2 |\n\n<code sql>//no//</code>\n----\n"
    made, glued, *rest = converted(
        spark, wiki, "<code>a</code>''b''", None, "  \n", "| a |\n^ h ^\n^ g ^\nx\n^ k", "[[wp>Cat]] [[http://A.b/C|D]] [[:A:B]] {{ x.PDF }}", "a\\\\ b\n\n\n\nc ~~NOTOC~~ <nowiki>z</nowiki>", "\ue000 <file java x>q\n</file>", "^", "//i// __u__ <del>d</del>"
    )
    assert made.startswith("# T\n")
    for part in ("*c*", "[x](ns:p)", "![alt](img.png)", "- one", "  1. two", "| h | i |\n|---|---|\n| 1 | 2 |", "```sql\n//no//\n```", "\n---"):
        assert part in made
    assert glued == "```\na\n````b`" and rest[:2] == [None, None]
    assert rest[2] == "| a |\n| h |\n|---|\n| g |\nx\n| k|\n|---|"
    assert rest[3] == "[wp>Cat](https://en.wikipedia.org/wiki/Cat) [D](http://A.b/C) [:A:B](a:b) ![](x.pdf)"
    assert rest[4] == "a\nb\n\nc" and rest[5] == "\ue000 ```java\nq\n\n```" and rest[6] == "|"
    assert rest[7] == "*i* <u>u</u> ~~d~~"


def test_normal_text_keeps_words_apart(spark):
    rows = spark.createDataFrame([("| c|d |",), ("[[a:b|Label]] x [[c]] {{p.png|}}",), ("![](u) [T](v)",), ("== H ==\n* i\n1. j\n---",), (None,)], "t string")
    assert [r[0] for r in rows.select(scores.normal(F.col("t"))).collect()] == ["c d", "label x c p.png", "u t", "h i j", None]
    assert scores.THRESHOLDS["similarity"] == 0.85


def test_lines_are_counted_in_their_order(spark):
    rows = spark.createDataFrame([(1, "a\nb\n", "b\na\n"), (2, "a", "a\nb"), (3, None, "x"), (4, "same", "same"), (5, "a\r\nb\n", "a\nb\n")], "id int, old string, new string")
    found = {r["id"]: (r["added"], r["removed"], r["changed"]) for r in snapshots.line_changes(rows).collect()}
    assert found == {1: (1, 1, 1), 2: (2, 1, 1), 3: (1, 0, 0), 4: (0, 0, 0), 5: (0, 0, 0)}


def test_bytes_with_two_digits(spark):
    sizes = [0, 1, 1023, 1024, 1536, 10 * 1024 + 512 + 5, 1024**2 - 1, 1024**2, 3 * 1024**3 // 2, 5 * 1024**5, 851149, 851200]

    def plain(n):
        size = float(n)
        for unit in ("B", "KB", "MB", "GB"):
            if size < 1024:
                return f"{size:.2f} {unit}"
            size /= 1024
        return f"{size:.2f} TB"

    rows = spark.createDataFrame([(n,) for n in sizes], "n long")
    assert [r[0] for r in rows.select(ids.human_bytes(F.col("n"))).collect()] == [plain(n) for n in sizes]
    row = spark.range(1).select(ids.sanitized(F.lit("a:b/c\\d?e")), markup.permission_name(F.lit(3)), markup.permission_name(F.lit(8))).first()
    assert list(row) == ["a_b_c_d?e", "unknown-3", "upload"]


def test_bootstrap_of_nothing_may_be_an_error():
    with pytest.raises(ValueError):
        stats.bootstrap(np.array([]), strict=True)
    assert stats.bootstrap(np.arange(9.0), statistic=np.median)[0] == 4


def test_freshness_and_ids(spark):
    row = spark.createDataFrame([("ns:sub:p", "x.PDF")], "p string, f string")
    got = row.select(ids.top_namespace(F.col("p")), ids.parent_namespace(F.col("p")), ids.depth(F.col("p")), ids.extension(F.col("f")), ids.valid_media(F.col("f")), ids.human_bytes(F.lit(2048)), fresh.by_steps(F.lit(None).cast("double")), pages.access_level(F.lit("Lehrer:x"))).first()
    assert list(got) == ["ns", "ns:sub", 2, "pdf", True, "2.00 KB", 0.5, "teacher_only"]


def test_scores_of_equal_texts(spark):
    pair = spark.createDataFrame([("a", "see http://x.y and a@b.de on 2024-01-02", "see http://x.y and a@b.de on 2024-01-02"), ("b", "", "")], "id string, source string, result string")
    found = {r["id"]: r for r in scores.scored(pair).collect()}
    assert found["a"]["entities"] == found["a"]["similarity"] == 1.0
    assert found["b"]["completeness"] == 0.0 and found["b"]["readability"] == 0.0


def test_judge_scores(spark):
    rows = spark.createDataFrame([('{"score": 0.7}',), ("Score: 8",), ("85",), ("none",), (None,)], "raw string")
    assert [r[0] for r in rows.select(F.round(stats.judge_score(F.col("raw")), 4)).collect()] == [0.7, 0.8, 0.85, None, None]


def test_stratified_sample_has_every_stratum(spark):
    rows = spark.range(100).withColumn("s", F.when(F.col("id") < 97, "big").otherwise(F.col("id").cast("string")))
    assert {r["s"] for r in corpus.stratified(rows, ["s"], "id", 10).collect()} == {"big", "97", "98", "99"}


def test_page_evaluation_of_empty_page(spark):
    page = spark.createDataFrame([("start", None, 0, 0, False, 0.5)], "page_id string, content string, link_count int, broken_count int, linked boolean, freshness double")
    row = pages.evaluate(page).first()
    assert row["recommendation"] == "exclude" and row["flags"] == ["empty", "template"]


def test_all_documents_get_all_scores(spark, sf):
    from corpusmill.plans import evaluation

    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert evaluation.seven_scores(spark, sf).select("id").distinct().count() == n
    assert {r["metric"] for r in evaluation.regression_gate(spark, sf).collect()} == set(scores.THRESHOLDS)


def test_paired_test_takes_all_pairs(spark, sf, monkeypatch):
    from corpusmill.plans import inference

    e = spark.read.parquet(f"{sf}/events.parquet").toPandas()
    e["d"] = e["value"] - (e["value"] * 0.9 + e["event_id"] % 7)
    exact = {f"stage{k}": (len(g), *stats.paired_test(g["d"].to_numpy(), np.zeros(len(g)))) for k, g in e.groupby(e["user_id"] % 5)}
    for stretches in (200, 7):
        monkeypatch.setattr(stats.order, "STRETCHES", stretches)
        for r in inference.paired_test(spark, sf).collect():
            assert (r["n"], r["test"]) == exact[r["stage"]][:2]
            assert r["p_value"] == pytest.approx(exact[r["stage"]][2], abs=1e-6)


def test_bootstrap_ci_meets_no_group_in_one_task(spark, sf):
    from corpusmill.plans import evaluation, inference

    made = inference.bootstrap_ci(spark, sf)
    assert "InPandas" not in made._jdf.queryExecution().toString()
    scores_of = evaluation._scored_runs(spark, sf).toPandas().groupby("model")["score"]
    for r in made.collect():
        x = scores_of.get_group(r["model"])
        half = 1.96 * x.std() / math.sqrt(len(x))
        assert (r["n"], r["mean"]) == (len(x), pytest.approx(x.mean()))
        assert r["low"] == pytest.approx(x.mean() - half, abs=0.3 * half) and r["high"] == pytest.approx(x.mean() + half, abs=0.3 * half)


def test_percent_is_printed_as_c_prints_it(spark):
    values = [2481.25, 7.25, 81.75, 0.15, 0.25, 0.35, -0.25, -7.35, 0.05, -0.05, 1234567.45, 99.9999, 0.0, -33.3333, 12.3456, 100.0, *(n / 20 for n in range(-400, 400))]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", snapshots.one_digit(F.col("v")).alias("said"))
    assert [(r["v"], r["said"]) for r in rows.collect()] == [(v, "%.1f" % v) for v in values]


def test_chunks_of_a_batch_are_held_in_slices(spark, monkeypatch):
    monkeypatch.setattr(chunks, "SLICE", 40)
    texts = [None, "", "a b", "c " * 60, "d", None, "e f g"]
    together = lambda t, most: [*t.split(), str(most)]
    rows = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, most int").coalesce(1)
    found = [tuple(r) for r in chunks.exploded(rows, ["doc_id"], "text", together, ("most",)).collect()]
    assert found == [(i, n, len(t.split()) + 1, c) for i, t in enumerate(texts) if t for n, c in enumerate([*t.split(), str(i)])]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(chunks._slices(batch, 1))
    assert len(parts) > 1 and pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert all(sum(len(t or "") for t in p.column(1).to_pylist()[1:]) <= 40 for p in parts)
    assert sum(p.num_rows for p in chunks._slices(batch.slice(0, 0), 1)) == 0
