import json

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import fresh
from corpusmill.operators import corpus, exports, ir, markup, models, pages, reports, scores, snapshots, stats, truth
from corpusmill.sources import files, strategies


def rows(spark, shape, *values):
    return spark.createDataFrame(list(values), shape)


def test_expected_sources(spark):
    asked = rows(spark, "query_id int, sources array<string>, source_file string", (1, ["a", "b", "a"], "x_y.md"), (2, [], "ns_my_page.md"), (3, None, None), (4, None, "plain"))
    assert {(r["query_id"], r["doc_id"]) for r in truth.qrels(asked).collect()} == {(1, "a"), (1, "b"), (2, "ns:my_page"), (4, "plain")}
    assert [(r["doc_id"], r["rank"], r["score"]) for r in truth.mock_hits(asked.where("query_id = 1")).orderBy("rank").collect()][:2] == [("a", 1, 1.0), ("b", 2, 0.5)]


def test_failed_queries_count_as_misses_of_their_own(spark):
    asked = rows(spark, "query_id int, sources array<string>, source_file string", (1, ["a"], None), (2, ["a"], None), (3, ["z"], None), (4, ["a"], None))
    ranked = rows(spark, "query_id int, doc_id string, rank int", (1, "x", 1), (1, "a", 2), (2, "a", 1), (3, "y", 1))
    errors = rows(spark, "query_id int, error string", (2, "down"))
    found = truth.keyword_baseline(asked, ranked, errors)
    assert {r["query_id"]: r["rr"] for r in found.collect()} == {1: 0.5, 2: 0.0, 3: 0.0, 4: 0.0}
    row = truth.baseline_summary(found).first()
    assert (row["hits"], row["misses"], row["errors"], row["mrr"]) == (1, 2, 1, 0.125)


def test_small_truth_helpers(spark):
    with pytest.raises(ValueError):
        truth.named_corpus({"a": None}, "b")
    assert truth.resolved_model("m", ["m:8b", "m:latest"]) == "m:latest" and truth.resolved_model("m", ["m:8b"]) == "m:8b" and truth.resolved_model("m", ["n"]) is None and truth.resolved_model(" m ", ["m"]) == "m"
    chunks, vectors = rows(spark, "chunk_id string", ("a",), ("b",)), rows(spark, "chunk_id string, vector array<double>", ("a", [1.0]), ("b", [2.0]))
    assert truth.with_vectors(chunks, vectors).count() == 2
    for wrong in (vectors.limit(1), vectors.unionByName(vectors)):
        with pytest.raises(ValueError):
            truth.with_vectors(chunks, wrong)
    text = spark.range(1).select(truth.body_after_front_matter(F.lit("---\na: 1\n---\nbody\n---\nx")), truth.body_after_front_matter(F.lit("plain")), truth.probed_page_id(F.lit("x\n media_id: 'm:1'\n"), F.lit("f")), truth.probed_page_id(F.lit(""), F.lit("a_b_c.md"))).first()
    assert list(text) == ["body\n---\nx", "plain", "m:1", "a:b_c"]
    plain = rows(spark, "m double, s struct<mean: double, std: double>", (0.5, (0.25, 0.1)))
    assert list(plain.select(*truth.metric_parts(plain, "m"), *truth.metric_parts(plain, "s")).first()) == [0.5, None, 0.25, 0.1]
    both = truth.both(rows(spark, "page_id string", ("p",)), rows(spark, "media_id string", ("m",)))
    assert {r["collection"] for r in both.collect()} == {"pages", "media"}
    assert truth.allowed(rows(spark, "access_level string", ("public",), ("teacher_only",), (None,)), ["public"]).count() == 1
    block, body = markup.split_front_matter(F.lit("---\nmedia_id: a:b\n---\n# Head\nrest"))
    found = spark.range(1).select(*(c.alias(n) for n, c in truth.document_identity(block, body, F.lit("f.md"), markup.front_matter_field).items())).first()
    assert found.asDict() == {"page_id": "a:b", "namespace": "a", "title": "Head"}


def test_files_of_many_kinds(spark):
    shape = "name string, size long, pages int, text_chars long, has_images boolean, width int, height int"
    found = {r["name"]: r for r in pages.file_quality(rows(spark, shape, ("a.PDF", 9, 1, 20, True, None, None), ("b.pdf", 9, 2, 5000, False, None, None), ("c.pdf", 9, 0, 0, False, None, None), ("d.png", 9, None, None, None, 100, 900), ("e.jpg", 9, None, None, None, 900, 900), ("f.docx", 9, None, None, None, None, None), ("g.odt", 20_000_000, None, None, None, None, None), ("h.svg", 9, None, None, None, None, None), ("noext", 9, None, None, None, None, None), ("i.png", 9, None, None, None, None, None))).collect()}
    assert {n: (r["type"], r["score"], len(r["issues"])) for n, r in found.items()} == {"a.PDF": ("pdf", 0.3, 1), "b.pdf": ("pdf", 0.9, 0), "c.pdf": ("pdf", 0.5, 0), "d.png": ("image", 0.3, 1), "e.jpg": ("image", 0.9, 0), "f.docx": ("word", 0.5, 1), "g.odt": ("odt", 0.7, 1), "h.svg": ("svg", 0.8, 0), "noext": ("unknown", 0.5, 0), "i.png": ("image", 0.5, 0)}
    assert found["a.PDF"]["needs_ocr"] and found["e.jpg"]["ocr_candidate"] and not found["d.png"]["ocr_candidate"]


def test_questions_are_refused_for_a_reason(spark):
    body = "Der Antrag wird im Sekretariat abgegeben und dort bearbeitet."
    cases = [("", "x", "empty"), ("Wo?", "x", "too short"), ("W" * 201, "x", "too long"), ("Wo wird der Antrag abgegeben", "x", "no question mark"), ("Was steht auf dieser Seite drin?", "x" * 20, "generic"), ("Wo wird der Antrag abgegeben?", "kurz", "no answer"), ("Wo wird der Antrag abgegeben?", "Irgendwo anders draussen vielleicht", "not grounded"), ('"Wo wird der Antrag abgegeben?"', "Im Sekretariat wird er bearbeitet", "")]
    frame = rows(spark, "i int, q string, a string", *((i, q, a) for i, (q, a, _) in enumerate(cases)))
    assert [r[1] for r in frame.select("i", corpus.qa_problem(F.col("q"), F.col("a"), F.lit(body))).orderBy("i").collect()] == [c[2] for c in cases]
    row = spark.range(1).select(corpus.template_question(F.lit("Dokument"), F.lit("ns")), corpus.template_question(F.lit("T"), F.lit("ns")), corpus.template_answer(F.lit("<!-- x -->\n| a |\nb\n\nc")), corpus.title_from_body(F.lit("| t |\n- x\n  line"))).first()
    assert list(row) == ["Was findet man im Wiki unter ns?", "Was muss ich ueber T wissen?", "b c", "line"]


def test_samples_take_half_of_each(spark):
    assert [corpus.shares(*c) for c in ((0, 5, 3), (5, 0, 9), (100, 100, 10), (100, 2, 10), (1, 100, 10), (9, 9, 1))] == [(0, 3), (5, 0), (5, 5), (5, 2), (1, 9), (0, 1)]
    listed = spark.range(60).select(F.col("id").alias("key"), F.when(F.col("id") < 40, "pages").otherwise("media").alias("source"), (F.col("id") % 3).cast("string").alias("namespace"), (F.col("id") % 2).cast("string").alias("extension"))
    found = corpus.corpus_sample(listed, 20)
    assert found.count() == 20 and found.where("source = 'media'").select("namespace", "extension").distinct().count() == 6


def test_exports(spark):
    page = rows(spark, "page_id string, body string, freshness_score double", ("a:b", "text", None))
    row = exports.export_fields(page, exports.PAGE_DEFAULTS).first()
    assert row["freshness_score"] == 0.5 and row["access_level"] == "public" and row["links_to"] == [] and len(row["content_hash"]) == 32
    assert spark.range(1).select(exports.title_case(F.lit("my-fILE 2nd übung"))).first()[0] == "My-File 2Nd Übung"
    chunk = rows(spark, "page_id string, media_id string, chunk_index int", ("p", "", 0))
    assert json.loads(chunk.select(exports.chunk_metadata(chunk)).first()[0]) == {"page_id": "p", "chunk_index": 0}
    assert json.loads(chunk.select(exports.chunk_metadata(chunk, {"chunk_index": False})).first()[0]) == {"page_id": "p"}
    log = rows(spark, "id string, state string", ("p1", "old"), ("p2", "old"))
    errors = rows(spark, "type string, page_id string, media_id string", ("page_fetch_x", "p1", None), ("media", None, ""), ("page_fetch", "", None))
    assert {(r["id"], r["state"]) for r in exports.retried(log, errors, lambda d: d.withColumn("state", F.lit("new"))).collect()} == {("p1", "new"), ("p2", "old")}
    flags = exports.with_flags(rows(spark, "page_id string", ("a:b",), ("c",)), rows(spark, "page_id string", ("a_b",)))
    assert {r["page_id"]: r["is_flagged"] for r in flags.collect()} == {"a:b": True, "c": False}
    assert exports.without_ignored(rows(spark, "page_id string", ("a",), ("b",)), rows(spark, "page_id string", ("a",))).count() == 1
    assert spark.range(1).select(exports.type_included(F.lit("x.PDF"), [], ["pdf"]), exports.type_included(F.lit("x"), ["md"], []), exports.media_of_src(F.lit("a?media=b&c"))).first()[:] == (False, False, "b")


def test_incremental_snapshot_without_changes_fetches_nothing(spark):
    shape = "id string, revision long, hash string, size long, namespace string"
    before = rows(spark, shape, ("a", 1, "x", 1, "n"), ("b", 1, "y", 1, "n"))
    made = snapshots.incremental(before, before, lambda wanted: wanted.withColumn("hash", F.lit("fetched")))
    assert made.where("hash = 'fetched'").count() == 0 and made.count() == 2
    history = rows(spark, "entry_id int, at timestamp", *((i, None) for i in range(1))).withColumn("at", F.lit("2024-01-01").cast("timestamp"))
    assert snapshots.expired(history, 30, F.lit("2025-01-01").cast("timestamp")).first()[0] == 1


def test_comparisons(spark):
    base = rows(spark, "query_id int, rr double, ndcg double", *((i, i / 40, 0.5) for i in range(40)))
    better = base.withColumns({"rr": F.col("rr") + 0.1 + F.col("query_id") % 3 / 100, "hit": F.lit(1)})
    found = {r["metric"]: r for r in stats.compare_configurations(base, better).collect()}
    assert set(found) == {"rr", "ndcg"} and found["rr"]["significant"] and found["ndcg"]["p_value"] == 1.0
    metrics = rows(spark, "query_id int, rr double, p_at_k double, r_at_k double, ndcg double, ap double, hit int, difficulty string", (1, 1.0, 0.0, 0.0, 0.0, 0.0, 1, "hard"), (2, 0.0, 0.0, 0.0, 0.0, 0.0, 0, "odd"), (3, 0.5, 0.0, 0.0, 0.0, 0.0, 1, "easy"))
    assert [(r["difficulty"], r["place"]) for r in ir.ordered_breakdown(metrics).orderBy("place").collect()] == [("easy", 1), ("hard", 3)]
    assert [r["config"] for r in truth.compared({"a": metrics.drop("difficulty").where("query_id = 3"), "b": metrics.drop("difficulty").where("query_id = 1")}).orderBy("place").collect()] == ["b", "a"]
    assert models.embedding_stats(rows(spark, "vector array<double>", ([1.0],), (None,))).first()[:] == (2, 1, 1)


def test_torn_words(spark):
    found = spark.range(1).select(markup.rejoined(F.lit("P rüfer PR üfung Sc hriftlich Im sommerlich m ündlich Zu kunftsplan"))).first()[0]
    assert found == "Prüfer PRüfung Schriftlich Im sommerlich mündlich Zu kunftsplan"
    frame = rows(spark, "t string", ("H e l l o\nW orld wide",), (None,))
    assert frame.select(markup.cleaned(F.col("t"))).first()[0] is not None


def test_times_of_several_names(spark):
    row = spark.range(1).select(fresh.first_time([F.lit(None).cast("string"), F.lit("31.12.2023"), F.lit("2020-01-01")]), fresh.first_time([F.lit("1700000000")])).first()
    assert str(row[0])[:10] == "2023-12-31" and str(row[1])[:10] == "2023-11-14"


def test_strategies_steer_conversion_and_size(spark):
    pages_ = rows(spark, "page_id string, content string", ("a", "====== T ======\n\n" + "Ein Satz mit Worten. " * 60), ("b", "x" * 200), ("c", "y" * 200))
    plan = rows(spark, "page_id string, content_type string, method string, size int, action string", ("a", "NEWS", "naive", 300, "process"), ("b", "EMPTY", "semantic", 512, "skip"))
    found = corpus.processed(pages_, plan, markup.markdown).collect()
    assert {r["page_id"] for r in found} == {"a", "c"} and max(len(r["chunk"]) for r in found if r["page_id"] == "a") <= 300
    assert next(r for r in found if r["page_id"] == "a")["chunk"].startswith("# T")


def test_loaders(spark, tmp_path):
    side, links = tmp_path / "side", tmp_path / "links"
    side.mkdir(), links.mkdir()
    (side / "a_info.json").write_text(json.dumps({"id": "ns:a.png", "original_metadata": {"revision": 86400, "author": "x"}}))
    (side / "b_info.json").write_text("{broken")
    (side / "c_info.json").write_text(json.dumps({"id": "", "original_metadata": None}))
    assert {r["name"] for r in files.sidecars(spark, str(side), "info", "id string").where("id <> ''").collect()} == {"a"}
    assert [tuple(r) for r in files.media_metadata(spark, str(side)).collect()] == [("ns:a.png", "1970-01-02T00:00:00Z", "x")]
    (links / "ns_p_backlinks.json").write_text('["q", "r"]')
    (links / "other.json").write_text('{"page_id": "o", "backlinks": ["q"]}')
    (links / "bad.json").write_text("nothing")
    assert {r["page_id"]: r["linked_from"] for r in files.backlinks(spark, str(links)).collect()} == {"ns:p": ["q", "r"], "o": ["q"]}
    (tmp_path / "usage.json").write_text(json.dumps({"media_usage": {"m": {"referenced_by": ["p"]}, "n": {}}}))
    assert [tuple(r) for r in files.media_usage(spark, str(tmp_path / "usage.json")).collect()] == [("m", ["p"])]
    (tmp_path / "old.json").write_text(json.dumps([{"page_id": "p", "content_type": "news", "recommended_chunk_size": 9}, {"page_id": "q", "content_type": "odd"}, {"page_id": ""}]))
    assert {r["page_id"]: (r["content_type"], r["size"]) for r in strategies.from_json(spark, str(tmp_path / "old.json")).collect()} == {"p": ("NEWS", 9), "q": ("KNOWLEDGE", 512)}
    for n in ("run_2024", "run_2025", "other"):
        (tmp_path / "runs" / n).mkdir(parents=True)
    assert files.newest_path(spark, str(tmp_path / "runs"), "run_").endswith("run_2025") and files.newest_path(spark, str(tmp_path / "none")) is None
    texts = tmp_path / "texts"
    texts.mkdir()
    for n in "cab":
        (texts / f"{n}.md").write_text(n)
    assert {r["name"] for r in files.collection(spark, str(texts), 2).collect()} == {"a", "b"}
    media = tmp_path / "media" / "sub"
    media.mkdir(parents=True)
    (media / "x.PNG").write_bytes(b"1234")
    assert [tuple(r)[1:] for r in files.media_files(spark, str(tmp_path / "media")).collect()] == [("sub:x.PNG", "x.PNG", "png", 4, "IMAGE")]
    assert strategies.media_strategy(rows(spark, "name string", ("a",), ("b",)), rows(spark, "name string, action string", ("a", "skip"))).where("action = 'process'").count() == 1


def test_drivers(spark, tmp_path):
    (tmp_path / "truth.json").write_text(json.dumps({"qa_pairs": [{"id": "q1", "question": "Q?", "ground_truth": "A", "sources": ["p"], "context_keywords": ["k"], "difficulty": "easy"}, {"id": "q2", "question": "R?", "source_file": "ns_a.md"}]}))
    asked = files.ground_truth(spark, str(tmp_path / "truth.json"))
    assert {(r["query_id"], r["doc_id"]) for r in truth.qrels(asked).collect()} == {("q1", "p"), ("q2", "ns:a")} and asked.where("size(keywords) = 1").count() == 1
    a, b = rows(spark, "id int, t string", (1, "x"), (2, None)), rows(spark, "t string, id int", (None, 2), ("x", 1))
    assert files.tables_agree(a, b).first()[:] == (2, 2, True) and files.tables_agree(a, b.limit(1)).first()["same"] is False
    shape = "id string, revision long, hash string, size long, namespace string"
    parts = snapshots.change_report(rows(spark, shape, ("a", 1, "x", 100, "n"), ("b", 1, "x", 10, "n")), rows(spark, shape, ("a", 2, "y", 150, "n"), ("c", 1, "z", 5, "m")))
    assert {r["id"]: r["summary"] for r in parts["Changes"].collect()} == {"a": "Content expanded (+50 bytes, 50.0%)", "b": "Page removed (was 10 bytes)", "c": "New page (5 bytes)"}
    assert reports.report("Changes", parts).count("## ") == 3
    text = "Ein Satz mit zehn Worten steht hier in der ersten Zeile."
    found = scores.evaluate_files(rows(spark, "name string, text string", ("a.txt", text), ("b.txt", "x")), rows(spark, "name string, text string", ("a.md", f"---\ntitle: t\n---\n{text}")))
    assert [(r["id"], r["similarity"], r["completeness"]) for r in found.collect()] == [("a", 1.0, 1.0)]
    means = rows(spark, "model string, mean_rr double, mean_p_at_k double, mean_ndcg double", ("m", 0.75, 0.5, 0.5))
    table = reports.comparison_table(means.withColumns({"mean_rr": F.lit(0.25)}), means)
    assert table.index("m &") < table.index("keyword") and reports.difficulty_table(rows(spark, "difficulty string, mean_rr double", ("easy", 0.5))).count("easy") == 1
    said = reports.evaluation_report(rows(spark, "content_type string", ("NEWS",)), rows(spark, "type string, files int", ("pdf", 1)), rows(spark, "ready int", (1,)), rows(spark, "category string, pages int", ("current", 1)))
    assert said.count("## ") == 4
    spread = stats.metric_intervals(rows(spark, "query_id int, rr double", *((i, (i % 5) / 4) for i in range(200))), ["rr"], 100).first()
    assert spread["low"] < spread["mean"] == 0.5 < spread["high"] and spread["n"] == 200
