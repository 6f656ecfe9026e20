from pyspark.sql import functions as F

from corpusmill.sources import files
from corpusmill.streaming import feeds


def test_documents_with_front_matter(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\npage_id: ns:a\ntitle: 'T'\n---\n\nbody\n", "utf-8")
    (tmp_path / "b.txt").write_bytes("grün".encode("cp1252"))
    (tmp_path / "c.md").write_text("---\nbroken\nno end", "utf-8")
    found = {r["doc_id"]: r for r in files.documents(spark, str(tmp_path), "pages").collect()}
    assert set(found) == {"ns:a", "b", "c"}
    assert found["ns:a"]["title"] == "T" and found["b"]["body"] == "grün" and "broken" in found["c"]["body"]


def test_json_lines_skip_bad_rows(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "1"}\n\nnot json\n{"id": "2"}\n')
    assert {r["id"] for r in files.json_lines(spark, str(tmp_path / "x.jsonl"), "id string").collect()} == {"1", "2"}


def test_points_are_upserted(spark, tmp_path):
    path = str(tmp_path / "points")
    rows = lambda *ids: spark.createDataFrame([(i, [float(len(i))]) for i in ids], "id string, vector array<double>")
    files.upsert_points(spark, rows("a", "b"), path)
    files.upsert_points(spark, rows("b", "c"), path)
    assert {r["id"] for r in files.latest(spark.read.parquet(path), "version").collect()} == {"a", "b", "c"}


def test_checksums(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "name string, md5 string")
    found = files.checksums_differ(rows(("a", "1"), ("b", "1"), ("c", "1")), rows(("a", "1"), ("b", "2"), ("d", "1")))
    assert {r["name"]: r["state"] for r in found.collect()} == {"b": "differs", "c": "missing there", "d": "missing here"}


def test_streams_keep_state(spark, tmp_path):
    source, state, mark = (str(tmp_path / n) for n in ("in", "state", "mark"))
    rows = lambda *r: spark.createDataFrame(list(r), "job_id long, stage string, status string, started_at long")
    rows((1, "a", "done", 1), (2, "b", "done", 2)).write.parquet(source)
    schema = spark.read.parquet(source).schema
    feeds.follow(spark, source, schema, state, mark, feeds.latest_runs)
    rows((3, "a", "failed", 3)).write.mode("append").parquet(source)
    feeds.follow(spark, source, schema, state, mark, feeds.latest_runs)
    assert {(r["stage"], r["job_id"]) for r in feeds.current(spark, state).collect()} == {("a", 3), ("b", 2)}


def test_change_feed(spark, tmp_path):
    source, state, mark = (str(tmp_path / n) for n in ("in", "state", "mark"))
    shape = "id string, revision long, hash string, size long, namespace string"
    spark.createDataFrame([("a", 1, "x", 1, "n"), ("a", 2, "y", 1, "n")], shape).write.parquet(source)
    feeds.follow(spark, source, spark.read.parquet(source).schema, state, mark, feeds.changes)
    assert feeds.current(spark, state).select(F.max("revision")).first()[0] == 2
