"""Exact search in pairs of blocks, and judgements counted by group, against plain versions."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill import catalog
from corpusmill.operators import ir, nearest, retrieval, truth
from corpusmill.plans import preparation, ranking


def _rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(160, 8))
    rows = [(i, x[i].tolist()) for i in range(160)]
    rows += [(1000 + i, x[i % 2 * 20].tolist()) for i in range(60)]  # copies
    rows += [(2000 + i, (x[40] * (1 + i)).tolist()) for i in range(20)]  # one direction
    return rows + [(3000, None), (3020, []), (3040, [0.0] * 8), (3060, [float("nan")] * 8), (3080, [float("inf"), *[0.0] * 7]), (3100, [1.0] * 7), (3120, [None, *[1.0] * 7]), (3140, [0.0] * 8)]


def _score(a, b):
    if a is None or b is None or len(a) != len(b) or None in a or None in b:
        return 0.0
    dot = na = nb = 0.0
    for x, y in zip(a, b, strict=True):
        dot, na, nb = dot + x * y, na + x * x, nb + y * y
    both = math.sqrt(na) * math.sqrt(nb)
    return 0.0 if both == 0 else dot / both


@pytest.mark.parametrize("sizes", [{}, {"ROWS": 40, "LEAST_ROWS": 20, "ASKED": 7, "QUERIES": 3, "FIRST": 8, "TILE": 16, "PAIRS": 5}])
@pytest.mark.parametrize("without_self", [True, False])
def test_blocks_find_what_all_pairs_give(spark, monkeypatch, sizes, without_self):
    for name, size in sizes.items():
        monkeypatch.setattr(nearest, name, size)
    rows = _rows()
    corpus = spark.createDataFrame(rows, "doc_id long, vector array<double>").repartition(3)
    queries = corpus.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "vector")
    found = {}
    for r in retrieval.dense_top_k(corpus, queries, 5, without_self).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["doc_id"], str(r["score"] + 0.0))
    asked = [(i, v) for i, v in rows if i % 20 == 0]
    assert set(found) == {i for i, _ in asked}
    for q, v in asked:
        scored = [(i, _score(w, v)) for i, w in rows if not (without_self and i == q)]
        best = sorted(scored, key=lambda x: (-math.inf if math.isnan(x[1]) else -x[1], x[0]))[:5]
        assert [found[q][n + 1] for n in range(5)] == [(i, str(s + 0.0)) for i, s in best]
    assert retrieval.dense_top_k(corpus.limit(0), queries, 5).count() == retrieval.dense_top_k(corpus, queries.limit(0), 5).count() == 0


def _repeated():
    """Rows of which some have the id of a query, and nearly its vector."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8))
    rows = [(i, x[i].tolist()) for i in range(60)]
    more = [(i, (x[i] + rng.normal(size=8) / 1000).tolist()) for i in (0, 20) for _ in range(14)]
    return rows, [*rows, *more, (21, [float("inf")] * 8), (22, [1e200] * 8), (22, x[22].tolist()), (40, [0.0] * 8), (41, [0.0] * 8)]


def _nearest(rows, q, v, k):
    scored = [(i, _score(w, v)) for i, w in rows if i != q]
    return [(i, str(s + 0.0)) for i, s in sorted(scored, key=lambda x: (-math.inf if math.isnan(x[1]) else -x[1], x[0]))[:k]]


def test_rows_of_the_id_of_a_query_hide_no_others(spark):
    asked, rows = _repeated()
    corpus = spark.createDataFrame(rows, "doc_id long, vector array<double>").repartition(3)
    queries = spark.createDataFrame([r for r in asked if r[0] % 20 == 0], "query_id long, vector array<double>")
    found = {}
    for r in retrieval.dense_top_k(corpus, queries, 5, without_self=True).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["doc_id"], str(r["score"] + 0.0))
    for q, v in asked:
        if q % 20 == 0:
            assert [found.get(q, {}).get(n + 1) for n in range(5)] == _nearest(rows, q, v, 5)


@pytest.mark.parametrize("name", ["dense_topk", "ranked_heads", "access_filtered"])
def test_ids_that_stand_in_several_rows(spark, sf, tmp_path, name):
    path = str(tmp_path / "embeddings.parquet")
    held = spark.read.parquet(f"{sf}/embeddings.parquet")
    more = held.where("vec_id in (0, 20, 41)").crossJoin(spark.range(1, 15).withColumnRenamed("id", "n"))
    moved = more.withColumn("embedding", F.transform("embedding", lambda x: (x * 1.5 + F.col("n") / 10000).cast("float"))).drop("n")
    held.unionByName(moved).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    frame = catalog.QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(frame.columns)} FROM ({catalog.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(want)


@pytest.mark.parametrize("sizes", [{}, {"FIRST": 8, "TILE": 16, "QUERIES": 3, "PAIRS": 5}, {"FIRST": 8, "TILE": 16, "HELD": 0}, {"FIRST": 3, "TILE": 5, "QUERIES": 7, "HELD": 12}])
def test_a_pair_of_blocks_gives_the_best_of_every_query(monkeypatch, sizes):
    for name, size in sizes.items():
        monkeypatch.setattr(nearest, name, size, raising=False)
    asked, rows = _repeated()
    asked = [*asked, (500, [0.0] * 8), (501, [float("inf"), *[1.0] * 7])]
    side = lambda held: nearest.Side(np.array([v for _, v in held]), np.zeros(len(held), bool), np.array([i for i, _ in held]))
    qi, ids, score = nearest.pair(side(rows), side(asked), 5, True)
    for n, (q, v) in enumerate(asked):
        best = sorted(zip(ids[qi == n].tolist(), score[qi == n].tolist(), strict=True), key=lambda x: (-math.inf if math.isnan(x[1]) else -x[1], x[0]))
        assert [(i, str(s + 0.0)) for i, s in best] == _nearest(rows, q, v, 5)


def test_pairs_of_blocks_are_not_put_together_in_few_tasks(spark, monkeypatch):
    for name, size in {"ROWS": 40, "LEAST_ROWS": 20, "ASKED": 7}.items():
        monkeypatch.setattr(nearest, name, size)
    corpus = spark.createDataFrame([(i, v) for i, v in _rows() if v is not None], "doc_id long, vector array<double>")
    queries = corpus.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "vector")
    of_rows, of_queries = nearest.blocks(corpus.count(), queries.count())
    tasks = nearest.top_k(corpus, queries, 5).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > of_rows * of_queries / 2


def test_search_and_metrics_list_no_pairs(spark, sf):
    plan = ranking.metrics(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan


def test_judgements_by_group_are_those_of_pairs(spark):
    corpus = spark.createDataFrame([(i, None if i % 13 == 0 else i % 4, i % 4 if i % 4 < 3 else 2) for i in range(60)], "doc_id long, label int, rel int")
    queries = spark.createDataFrame([(i, None if i % 13 == 0 else i % 4) for i in range(0, 60, 5)] + [(999, 1), (998, 77)], "query_id long, label int")
    ranked = spark.createDataFrame([(q, (q * 7 + r * 3) % 60, r) for q in range(0, 60, 5) for r in range(1, 11)] + [(999, r, r) for r in range(1, 11)], "query_id long, doc_id long, rank int")
    qrels = queries.join(corpus, "label").where("query_id <> doc_id").select("query_id", "doc_id", "rel")
    plain = lambda f: sorted(tuple(round(float(x), 9) for x in r) for r in f.collect())
    assert plain(ir.per_query_by_group(ranked, corpus, queries, "label")) == plain(ir.per_query(ranked, qrels, queries))
    every = queries.join(corpus, "label").select("query_id", "doc_id", "rel")
    assert plain(ir.per_query_by_group(ranked, corpus, queries, "label", without_self=False)) == plain(ir.per_query(ranked, every, queries))


def test_baseline_by_group_is_that_of_listed_sources(spark):
    docs = spark.createDataFrame([(i, i % 5) for i in range(50)], "doc_id long, rest long")
    queries = spark.createDataFrame([(q, q % 5) for q in range(8)] + [(9, 77)], "query_id long, rest long")
    ranked = spark.createDataFrame([(q, (q * 3 + r * 7) % 50, r) for q in (0, 1, 2, 3, 4, 9) for r in range(1, 14)], "query_id long, doc_id long, rank int")
    errors = spark.createDataFrame([(3, "down"), (6, "down")], "query_id long, error string")
    listed = queries.join(docs, "rest", "left").groupBy("query_id").agg(F.collect_list(F.col("doc_id").cast("string")).alias("sources"), F.lit(None).cast("string").alias("source_file"))
    want = truth.keyword_baseline(listed, ranked.withColumn("doc_id", F.col("doc_id").cast("string")), errors)
    assert sorted(map(str, truth.keyword_baseline_by_group(queries, docs, "rest", ranked, errors).collect())) == sorted(map(str, want.collect()))


def test_baseline_lists_no_sources(spark, sf):
    plan = preparation.QUERIES["keyword_baseline"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(doc_id" not in plan and "sources" not in plan
