"""Indexed search, posting blocks and chunk sizes against plain versions."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import cells, chunksizes, postings, retrieval
from corpusmill.plans import ranking
from corpusmill.sources.shared import stored


def _vectors(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + rng.normal(size=16) * 0.3).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # copies
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [float("inf")] * 16), (2005, [1.0] * 15)]
    return spark.createDataFrame(rows, "doc_id long, vector array<double>").repartition(4), rows


def _nearest(rows, query, k):
    v = {i: np.array(x) / np.linalg.norm(x) for i, x in rows if i < 2000}
    return sorted((i for i in v if i != query), key=lambda i: (-round(float(v[i] @ v[query]), 9), i))[:k]


def test_index_finds_what_exact_search_finds(spark, monkeypatch):
    monkeypatch.setattr(cells, "BUCKET", 50)
    monkeypatch.setattr(cells, "BLOCK", 7)
    corpus, rows = _vectors(spark)
    queries = corpus.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "vector")
    model = cells.fit(corpus, 16, parts=4)
    codes = stored(cells.index(corpus, model), "test-cells")
    assert codes.count() == 960
    probes, refine = cells.audited(corpus, codes, queries, model, 10, 0.98, refine=3, without_self=True)
    assert refine > 3
    found = cells.search(corpus, codes, queries, model, 10, probes, refine, without_self=True).collect()
    lists = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        lists.setdefault(r["query_id"], []).append(r["doc_id"])
    asked = [i for i, _ in rows if i % 20 == 0 and i < 2000]
    hits = sum(len(set(lists[q]) & set(_nearest(rows, q, 10))) for q in asked)
    assert set(lists) == set(asked) and hits >= 0.95 * 10 * len(asked)
    # copies are ranked by id: a copy's neighbours are the least ids among the copies
    assert lists[1040] == [0, *range(1000, 1009)]
    with pytest.raises(ValueError):
        cells.audited(corpus, codes.limit(5), queries, model, 10, 0.98)
    nothing = corpus.limit(0)
    empty = cells.fit(nothing, 16)
    assert cells.search(nothing, cells.index(nothing, empty), queries.limit(0), empty).count() == 0


def test_cells_share_buckets_and_only_nearest_ones_are_looked_up(spark, monkeypatch):
    monkeypatch.setattr(cells, "BUCKET", 200)
    corpus, _ = _vectors(spark)
    queries = corpus.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "vector")
    model = cells.fit(corpus, 16, parts=4, cells=30)
    codes = stored(cells.index(corpus, model), "test-buckets")
    placed = cells._buckets(codes, 48)
    assert sum(n for _, n in placed.values()) <= len(placed) + 5 and len({at for at, _ in placed.values()}) <= 10
    of = {r["doc_id"]: r["cell"] for r in codes.collect()}
    one = cells.candidates(codes, queries, model, 1, 5, True).collect()
    assert one and all(of[r["query_id"]] == of[r["doc_id"]] and r["query_id"] != r["doc_id"] for r in one)
    wide = cells.candidates(codes, queries, model, 30, 5, True).collect()
    assert {q for q, _ in wide} == {i for i in of if i % 20 == 0} and len(wide) == 5 * len({q for q, _ in wide})


def test_quantised_codes_stand_for_their_vectors(spark):
    corpus, rows = _vectors(spark)
    model = cells.fit(corpus, 16, parts=8)
    x = cells.unit([v for i, v in rows if i < 900])
    cell = model.cells(x)[:, 0]
    pieces = [b[c] for b, c in zip(model.books, model.encoded(x, cell).T, strict=True)]
    again = np.concatenate(pieces, axis=1) + model.centres[cell]
    assert np.linalg.norm(again - x, axis=1).mean() < 0.2 * np.linalg.norm(x, axis=1).mean()


@pytest.mark.parametrize("shard", [4096, 40])
def test_posting_blocks_against_all_scores(spark, monkeypatch, shard):
    monkeypatch.setattr(postings, "SHARD", shard)
    monkeypatch.setattr(postings, "QUERIES", 3)
    rng = np.random.default_rng(2)
    weights = [(d, f"t{t}", round(float(rng.exponential() * (5 if t > 20 else 0.2)), 6)) for d in range(300) for t in range(40) if rng.random() < (0.9 if t < 20 else 0.03)]
    weights += [(d, "same", 1.0) for d in range(400, 450)]  # ties
    queries = [(q, f"t{t}", round(float(rng.exponential()), 6)) for q in range(10) for t in rng.choice(40, 12, replace=False).tolist()] + [(77, "same", 2.0), (78, "unknown", 1.0)]
    w = spark.createDataFrame(weights, "doc_id long, term string, weight double").repartition(3)
    lists = stored(postings.build(w, 350), "test-postings")
    found = postings.top_k(lists, spark.createDataFrame(queries, "query_id long, term string, weight double"), 5).collect()
    by_doc = {}
    for d, t, x in weights:
        by_doc.setdefault(d, {})[t] = x
    for q in {q for q, _, _ in queries}:
        own = {t: x for i, t, x in queries if i == q}
        scores = {d: round(sum(own[t] * x for t, x in terms.items() if t in own), 4) for d, terms in by_doc.items()}
        want = sorted(((d, s) for d, s in scores.items() if s > 0), key=lambda x: (-x[1], x[0]))[:5]
        got = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [(r["doc_id"], pytest.approx(r["score"], abs=1.1e-4)) for r in got] == want
    if shard == 4096:
        assert all(r["read"] <= r["blocks"] for r in found) and sum(r["read"] for r in found if r["rank"] == 1) < 0.9 * sum(r["blocks"] for r in found if r["rank"] == 1)
    assert postings.top_k(lists.limit(0), spark.createDataFrame([], "query_id long, term string, weight double"), 5).count() == 0


def test_chunk_sizes_count_pages(spark, monkeypatch):
    texts = [(1, "alpha beta gamma delta " * 4), (2, "other words here now " * 4), (3, "alpha beta gamma delta " * 4), (4, None), (5, ""), (6, "   ")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([(1, "alpha beta"), (2, "here now"), (9, "nothing at all"), (10, None), (11, "gamma")], "query_id long, text string")
    for queries, size in ((1024, 1 << 21), (2, 50)):
        monkeypatch.setattr(chunksizes, "QUERIES", queries)
        monkeypatch.setattr(chunksizes, "SLICE", size)
        found = {r["size"]: r for r in chunksizes.compare(docs, asked, [23, 92], k=10, model=lambda: chunksizes.WordCounts(4096)).collect()}
        assert {s: (r["chunks"], r["queries"]) for s, r in found.items()} == {23: (12, 3), 92: (3, 3)}
        for r in found.values():
            assert r["mrr"] == 1.0 and r["hit_rate"] == 1.0 and r["ndcg"] == pytest.approx(1.0) and r["precision"] == pytest.approx((0.4 + 0.2 + 0.4) / 3)
    assert chunksizes.compare(docs.limit(0), asked, [23]).count() == 0
    v = chunksizes.WordCounts(64).embed([texts[0][1], ""])
    assert v.sum() == 16 and not v[1].any()


def test_best_chunks_over_slices_are_the_best_of_all():
    rng = np.random.default_rng(1)
    scores = np.round(rng.random((400, 7)), 1)  # many ties
    docs, places = rng.integers(0, 50, 400), np.arange(400)
    best = chunksizes.Best(10, 7)
    for i in range(0, 400, 37):
        best.add(scores[i : i + 37], docs[i : i + 37], places[i : i + 37])
    for q in range(7):
        want = sorted(range(400), key=lambda i: (-scores[i, q], docs[i], places[i]))[:10]
        assert best.rows[best.rows["q"] == q]["chunk_index"].tolist() == want


def test_windows_are_the_vectors_of_the_chunks_that_are_cut():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \nÄé\t\x0b\x1c xyz😀 ") for _ in range(rng.randrange(1, 90))) for _ in range(300)] + [" " * 36, "a" * 50, " ", "\n"]
    model = chunksizes.WordCounts(16)
    for size, vectors, number, place in model.windows(texts, [3, 7, 16]):
        chunks = [(i, p, c) for i, t in enumerate(texts) for p, c in enumerate(chunksizes.fixed(t, size)) if c.strip(" ")]
        assert list(zip(number.tolist(), place.tolist(), strict=True)) == [c[:2] for c in chunks]
        assert (vectors == model.embed([c for _, _, c in chunks])).all()
    assert [chunksizes.alike(t) for t in ("aÄ", "İ", "ΟΔΟΣ")] == [True, False, False]


def test_texts_that_change_in_lower_case_are_cut_first(spark):
    texts = [(1, "İstanbul liegt am Meer und ist eine große Stadt"), (2, "ΟΔΟΣ ΟΔΟΣΑ ist ein Weg in der Stadt"), (3, "Wege und Meere liegen in der Stadt am Meer")]
    docs, asked = spark.createDataFrame(texts, "doc_id long, text string"), pd.DataFrame({"query": [1, 2], "text": ["am Meer", "οδος ist ein Weg"]})
    found = chunksizes.retrieved(docs, asked, [9], 20, model=lambda: chunksizes.WordCounts(4096)).where("query is not null").collect()
    model = chunksizes.WordCounts(4096)
    want = {}
    for q, v in zip((1, 2), model.embed(list(asked["text"])), strict=True):
        for doc, text in texts:
            for place, chunk in enumerate(chunksizes.fixed(text, 9)):
                c = model.embed([chunk])[0]
                if v @ c > 0:
                    want[q, doc, place] = (v @ c) / ((v @ v) ** 0.5 * (c @ c) ** 0.5)
    assert {(r["query"], r["doc_id"], r["chunk_index"]): round(r["score"], 9) for r in found} == {k: round(s, 9) for k, s in want.items()}


def test_sparse_shards_give_their_best_only(spark, monkeypatch):
    """Shards and blocks of queries give the lists that all pairs give, and few rows besides: equal texts, ties by rounding, an id and terms that nothing shares."""
    monkeypatch.setattr(retrieval, "SHARD", 16)
    monkeypatch.setattr(retrieval, "ASKED", 3)
    monkeypatch.setattr(retrieval, "ROWS", 7)
    rows = [(d, t, float((d % 5 * 7 + j * 3) % 11) / 10 + 0.1 + (d % 3) * 1e-6) for d in range(90) for j, t in enumerate(("all", f"w{d % 4}", f"w{d % 5}x"))]
    docs = spark.createDataFrame([*rows, (None, "all", 0.5), (1000, "unasked", 1.0)], "doc_id long, term string, weight double")
    asked = spark.createDataFrame([(q, t, w) for q in range(8) for t, w in (("all", 1.0 + q), (f"w{q % 5}x", 0.5), ("nowhere", 1.0))], "query_id long, term string, weight double")
    ranked = lambda found: sorted(tuple(r) for r in retrieval.top_k(found.withColumn("score", F.round("score", 4)), 4).select("query_id", "rank", "doc_id", "score").collect())
    best = retrieval.sparse_best(docs, asked, 4, 92)
    assert ranked(best) == ranked(retrieval.sparse_scores(docs, asked))
    assert best.count() < retrieval.sparse_scores(docs, asked).count()
    # a word that stands in every document: pairs are not dealt out, a shard gives k rows a query
    same = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("all").alias("term"), F.lit(1.0).alias("weight"))
    assert retrieval.sparse_best(same, asked, 4, 400).count() == 8 * 4 * 25
    assert [r["doc_id"] for r in retrieval.top_k(retrieval.sparse_best(same, asked, 4, 400), 4).where("query_id = 0").orderBy("rank").collect()] == [0, 1, 2, 3]
    none = docs.where("false")
    assert retrieval.sparse_best(none, asked, 4, 0).count() == 0 and retrieval.sparse_best(docs, asked.where("false"), 4, 92).count() == 0


def test_sparse_hits_deal_out_no_pairs(spark, sf, monkeypatch):
    def pairs(*_):
        raise AssertionError("all pairs of documents and queries")

    monkeypatch.setattr(retrieval, "sparse_scores", pairs)
    assert ranking.hybrid_rrf(spark, sf).count() > 0
