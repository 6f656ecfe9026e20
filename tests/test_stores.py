"""Point collections, Markdown files, keyed feeds, histories and hash trees: what stands after writes, stops and failures."""

import datetime
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import hashtree, versions
from corpusmill.plans import stores
from corpusmill.sources import markdown_sink, pointstore
from corpusmill.streaming import keyed

POINTS = "id string, vector array<double>, payload string"


def points(spark, *rows):
    return spark.createDataFrame([(i, [float(len(p or ""))], p) for i, p in rows], POINTS)


def state(spark, path, number=None):
    return {r["id"]: r["payload"] for r in pointstore.current(spark, path, number).collect()}


def test_upserts_write_what_changes(spark, tmp_path):
    path = str(tmp_path / "points")
    with pytest.raises(ValueError):
        pointstore.current(spark, path)
    pointstore.upsert(points(spark, *((f"p{i}", "a") for i in range(200))), path)
    pointstore.upsert(points(spark, ("p1", "b"), ("p1", "b"), ("new", None), (None, "x")), path)
    pointstore.drop(spark.createDataFrame([("p2",), ("p2",), (None,), ("unknown",)], "id string"), path)
    assert [(k, n) for _, k, n in pointstore.rows_written(spark, path)] == [("delta", 200), ("delta", 2), ("delta", 2)]
    now = state(spark, path)
    assert len(now) == 200 and now["p1"] == "b" and now["new"] is None and "p2" not in now
    assert state(spark, path, 1)["p2"] == "a"
    number = pointstore.compact(spark, path)
    assert state(spark, path) == now and pointstore.rows_written(spark, path)[-1] == (number, "base", 200)
    pointstore.upsert(points(spark, ("p2", "back")), path)
    assert state(spark, path) == now | {"p2": "back"}
    assert pointstore.vacuum(spark, path) == 3 and state(spark, path) == now | {"p2": "back"}
    pointstore.recreate(points(spark, ("only", "c")), path)
    assert state(spark, path) == {"only": "c"}
    pointstore.recreate(spark.createDataFrame([], POINTS), path)
    assert state(spark, path) == {}


def test_an_upsert_during_a_compaction_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "points")
    pointstore.upsert(points(spark, ("a", "1"), ("b", "1")), path)
    current = pointstore.current

    def slow(spark, path, number=None):
        found = current(spark, path, number)
        if number is not None:
            monkeypatch.setattr(pointstore, "current", current)
            pointstore.upsert(points(spark, ("a", "2")), path)
        return found

    monkeypatch.setattr(pointstore, "current", slow)
    pointstore.compact(spark, path)
    assert state(spark, path) == {"a": "2", "b": "1"}


def test_columns_that_come_later(spark, tmp_path):
    path = str(tmp_path / "points")
    pointstore.recreate(points(spark, ("a", "1")), path)
    pointstore.upsert(points(spark, ("b", "2")).withColumn("extra", F.lit(5)), path)
    assert {(r["id"], r["extra"]) for r in pointstore.current(spark, path).collect()} == {("a", None), ("b", 5)}


def test_one_file_for_each_document(spark, tmp_path):
    path = str(tmp_path / "out")
    pages = spark.createDataFrame([("ns:a/b", "T: x", "Übung\nzwei", 0.75), ("ns_a:b", "other", "b", None), (None, None, None, None), ("ns:c", "1", "c", 1.0), ("ns:c", "1", "d", 1.0)], "page_id string, title string, body string, freshness_score double")
    media = spark.createDataFrame([("m:x.png", "pic")], "media_id string, body string")
    markdown_sink.export(spark, pages, media, path, "2025-01-01", config_hash="h")
    assert sorted(os.listdir(path + "/pages")) == ["ns_a_b.md", "ns_c.md", "unknown.md"] and os.listdir(path + "/media") == ["m_x.png.md"]
    told = json.load(open(path + "/manifest.json"))
    assert (told["pages_count"], told["media_count"], told["total_count"], told["config_hash"], told["schema_version"]) == (3, 1, 4, "h", "2.0")
    text = open(path + "/pages/ns_c.md", encoding="utf-8").read()
    assert text.startswith("---\ntitle: '1'\nnamespace: ''\n") and text.endswith("linked_from: []\n---\n\nd\n")
    assert "title: other" in open(path + "/pages/ns_a_b.md").read()
    before = {n: os.stat(f"{path}/pages/{n}").st_mtime_ns for n in os.listdir(path + "/pages")}
    with pytest.raises(Exception, match="out"):
        markdown_sink.export(spark, pages, media, path, "later")
    assert before == {n: os.stat(f"{path}/pages/{n}").st_mtime_ns for n in os.listdir(path + "/pages")}
    assert os.listdir(tmp_path) == ["out"]


def test_a_hash_of_digits_only_is_as_in_sql(spark, tmp_path):
    import duckdb

    # the MD5 of this text is 79614016921446533097269914920528
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(("plain", "text 4070958", "two\nlines", ""))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = stores.markdown_files(spark, str(tmp_path)).select("file", "bytes", "digest").collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(stores.ORACLE_SQL["markdown_files"]).fetchall())
    # elsewhere it is quoted, as YAML would read a number
    pages = docs.select(F.col("doc_id").cast("string").alias("page_id"), F.col("text").alias("body")).where("doc_id = 1")
    assert "\ncontent_hash: '79614016921446533097269914920528'\n" in markdown_sink.rendered(pages, "pages", "page_id", markdown_sink.PAGE_FIELDS).first()["content"]


def test_files_are_read_again_without_a_list_of_them_all(spark, tmp_path):
    path, odd = str(tmp_path / "out"), ["a b", "100%", "line\nend\r", "Übung", '"q"', "#x", "ü" * 60]
    pages = spark.createDataFrame([(n, n) for n in [*odd, *(f"p{i}" for i in range(200))]], "page_id string, body string")
    media = spark.createDataFrame([("m:x.png", None)], "media_id string, body string")
    markdown_sink.export(spark, pages, media, path, "2025-01-01")
    found = markdown_sink.read_again(spark, path)
    on_disk = {f"{folder}/{name}": open(f"{path}/{folder}/{name}", "rb").read() for folder in ("pages", "media") for name in os.listdir(f"{path}/{folder}")}
    assert len(on_disk) == 208
    assert {tuple(r) for r in found.collect()} == {(name, len(content), hashlib.md5(content).hexdigest()) for name, content in on_disk.items()}
    # what the driver lists follows the tasks, not the documents
    assert len(found.inputFiles()) <= 16
    none = str(tmp_path / "none")
    markdown_sink.export(spark, pages.limit(0), media.limit(0), none, "2025-01-01")
    assert markdown_sink.read_again(spark, none).count() == 0


def test_the_query_lists_no_files_of_documents(spark, sf):
    found = stores.markdown_files(spark, sf)
    assert len(found.inputFiles()) < found.count() / 4


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.dataSource.register(markdown_sink.MarkdownFiles)
    rows = spark.range(40).repartition(4).select(F.lit("pages").alias("folder"), F.concat(F.lit("p"), "id").alias("name"), F.when(F.col("id") == 33, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")).cast("string").alias("content"))
    with pytest.raises(Exception, match="broken"):
        rows.write.format(markdown_sink.NAME).mode("append").save(path)
    assert os.listdir(tmp_path) == []


DAY = datetime.datetime(2024, 1, 1)


def entries(spark, path, *rows):
    full = [(i, rev, h, 1 if h else None, "n" if h else None, op, DAY + datetime.timedelta(days=day)) for i, rev, h, op, day in rows]
    spark.createDataFrame(full, keyed.INPUT).coalesce(1).write.mode("append").parquet(path)


def test_keyed_feed_writes_changes_only_and_takes_up_after_a_stop(spark, tmp_path):
    one, steps = (str(tmp_path / n) for n in ("one", "steps"))
    deliveries = [
        [("a", 1, "x", "put", 0), ("b", 1, "x", "put", 0), ("c", 1, "x", "put", 0), (None, 1, "x", "put", 0), ("z", 1, None, "delete", 0)],
        [("a", 1, "x", "put", 1), ("b", 2, "y", "put", 1), ("c", 2, None, "delete", 1), ("d", None, "x", "put", 1)],
        [("c", 1, "late", "put", 2), ("b", 3, "z", "put", 2), ("b", 3, "z", "put", 2), ("c", 3, "again", "put", 2)],
    ]
    for rows in deliveries:
        entries(spark, f"{steps}/in", *rows)
        keyed.follow_entries(spark, f"{steps}/in", f"{steps}/out", f"{steps}/checkpoint")
        entries(spark, f"{one}/in", *rows)
    keyed.follow_entries(spark, f"{one}/in", f"{one}/out", f"{one}/checkpoint")
    written = spark.read.parquet(f"{steps}/out").collect()
    assert sorted((r["id"], r["change"], r["version"]) for r in written) == [("a", "added", 1), ("b", "added", 1), ("b", "modified", 2), ("b", "modified", 3), ("c", "added", 1), ("c", "added", 3), ("c", "deleted", 2), ("d", "added", 1)]
    now = lambda p: {(r["id"], r["revision"], r["hash"]) for r in keyed.current(spark, f"{p}/out").collect()}
    assert now(steps) == now(one) == {("a", 1, "x"), ("b", 3, "z"), ("c", 3, "again"), ("d", None, "x")}
    keyed.follow_entries(spark, f"{steps}/in", f"{steps}/out", f"{steps}/checkpoint")
    assert spark.read.parquet(f"{steps}/out").count() == len(written)


def test_long_revisions_beside_a_missing_one_stay_whole(spark, tmp_path):
    base, long = str(tmp_path), 2**53 + 1
    entries(spark, f"{base}/in", ("a", None, "x", "put", 0), ("a", long, "y", "put", 1))
    keyed.follow_entries(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint")
    assert [(r["revision"], r["hash"], r["version"], r["at"]) for r in spark.read.parquet(f"{base}/out").collect()] == [(long, "y", 2, DAY + datetime.timedelta(days=1))]


def test_tombstones_go_with_their_timer(spark, tmp_path):
    base = str(tmp_path)
    for rows in ([("a", 5, "x", "put", 0)], [("a", 6, None, "delete", 1)], [("k", 1, "x", "put", 100)], [("k", 2, "y", "put", 101)], [("a", 2, "old", "put", 102)]):
        entries(spark, f"{base}/in", *rows)
        keyed.follow_entries(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", keep_days=10)
    # the tombstone of revision 6 has been taken away, so an older revision counts as new
    assert {(r["id"], r["hash"]) for r in keyed.current(spark, f"{base}/out").collect() if r["id"] == "a"} <= {("a", "old"), ("a", "x")}
    kept = spark.read.parquet(f"{base}/out").where("id = 'a'").orderBy("version").collect()
    assert [r["change"] for r in kept if r["hash"] == "old"] == ["added"]


def test_latest_runs_of_a_log(spark, tmp_path):
    base = str(tmp_path)
    rows = [(1, "s", "ok", DAY, 1.0), (2, "s", "ok", DAY, 2.0), (3, "t", None, DAY, 3.0)]
    later = [(9, "s", "failed", DAY - datetime.timedelta(days=1), 9.0), (4, "t", "ok", DAY + datetime.timedelta(days=1), 4.0)]
    for part in (rows, later):
        spark.createDataFrame(part, "job_id long, stage string, status string, started_at timestamp, seconds double").write.mode("append").parquet(f"{base}/in")
        keyed.follow_runs(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint")
    assert {(r["stage"], r["job_id"], r["version"]) for r in keyed.current(spark, f"{base}/out", "stage").collect()} == {("s", 2, 1), ("t", 4, 2)}


def test_as_of_is_a_replay(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "c", "hot", None]) if i % 3 else "hot", DAY + datetime.timedelta(hours=rng.randrange(4000)), i, rng.choice(["put", "put", "delete"]), i * 0.5) for i in range(600)] + [("n", None, 1, "put", 0.0)]
    changes = spark.createDataFrame(rows, "id string, at timestamp, seq long, op string, value double").repartition(4).cache()
    index = versions.intervals(changes).cache()
    assert index.count() == sum(1 for r in rows if r[0] is not None and r[1] is not None)
    for hours in (0, 7, 900, 2500, 9000):
        time = F.lit(DAY + datetime.timedelta(hours=hours))
        seen = lambda d: {(r["id"], r["seq"], r["value"]) for r in d.collect()}
        assert seen(versions.as_of(index, time)) == seen(versions.replay(changes, time))
    assert {r["id"] for r in versions.latest(index).collect()} == {r["id"] for r in versions.replay(changes, F.lit(DAY + datetime.timedelta(days=999))).collect()}
    early, late = changes.where("seq % 2 = 0"), changes.where("seq % 2 = 1")
    again = versions.extended(versions.intervals(early), late.where("at is not null and id is not null"))
    assert sorted((r["id"], r["seq"], str(r["valid_to"])) for r in again.collect()) == sorted((r["id"], r["seq"], str(r["valid_to"])) for r in index.collect())
    newest = [r["seq"] for r in versions.of_id(index, "hot").collect()]
    assert newest[0] == max((r for r in rows if r[0] == "hot"), key=lambda r: (r[1], r[2]))[2]
    assert versions.intervals(changes.limit(0)).count() == 0
    fetches = spark.createDataFrame([("f1", "2025-01-01T00:00:00"), ("f2", "2024-12-30T00:00:00"), ("f3", "bad"), ("f4", "2024-01-01T00:00:00")], "entry_id string, at string")
    assert [r["entry_id"] for r in versions.kept(fetches, 3, 30, F.lit("2025-01-01 10:00:00").cast("timestamp")).collect()] == ["f1", "f2"]


def test_trees_name_where_copies_differ(spark, tmp_path):
    here = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v")).unionByName(spark.createDataFrame([(None, 1), (7, 21), (7, 21)], "k long, v long"))
    there = here.where("k is null or k not in (100, 200)").withColumn("v", F.when(F.col("k") == 300, 0).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(9999, 1), (7, 21)], "k long, v long"))
    base = str(tmp_path)
    for name, table in (("here", here), ("there", there), ("same", here.repartition(7))):
        hashtree.build(table, "k", f"{base}/{name}")
    ranges = hashtree.differing(spark, f"{base}/here", f"{base}/there")
    assert {(r["k"], r["state"]) for r in hashtree.rows_that_differ(here, there, "k", ranges).collect()} == {(100, "missing there"), (200, "missing there"), (300, "differs"), (9999, "missing here"), (7, "differs")}
    assert 1 <= ranges.count() <= 5 and ranges.agg(F.sum("rows_here")).first()[0] < 50
    assert hashtree.differing(spark, f"{base}/here", f"{base}/same").count() == 0
    hashtree.build(here.limit(0), "k", f"{base}/none")
    gone = hashtree.differing(spark, f"{base}/here", f"{base}/none")
    assert gone.agg(F.sum("rows_here"), F.sum("rows_there")).first()[:] == (5003, 0)
