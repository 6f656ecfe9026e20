"""Indexed search, dense and sparse, and chunk sizes compared by retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cells, chunksizes, postings, retrieval
from ..sources.shared import stored
from . import inputs as I
from . import ranking as R

SIZES, PLACES = (256, 512, 1024), 256


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Corpus rows, and the ten best of each query (ids divisible by 20) by the index, itself left out."""
    e = I.table(spark, sf_dir, "embeddings")
    corpus = e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    queries = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    model = cells.fit(corpus, 64, parts=32)
    codes = stored(cells.index(corpus, model), "cells")
    probes, refine = cells.audited(corpus, codes, queries, model, 10, 0.97, without_self=True)
    return queries, cells.search(corpus, codes, queries, model, 10, probes, refine, without_self=True)


def indexed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(spark, sf_dir)[1].select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def indexed_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index held against exact search: queries, exact hits, and whether 95 of 100 of these are found."""
    queries, found = _indexed(spark, sf_dir)
    exact = R.hits(spark, sf_dir).select("query_id", "doc_id")
    both = exact.join(found.select("query_id", "doc_id", F.lit(1).alias("one")), ["query_id", "doc_id"], "left")
    sums = both.agg(F.count("*").alias("wanted"), F.sum(F.coalesce("one", F.lit(0))).alias("found"))
    return sums.crossJoin(queries.agg(F.count("*").alias("queries"))).select("queries", "wanted", (F.col("found") * 100 >= F.col("wanted") * 95).alias("reached"))


def _blockmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text")
    asked = retrieval.term_counts(I.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text"), "query_id")
    counts = stored(retrieval.term_counts(docs, only=asked.select("term").distinct()), "counts")
    n = docs.count()
    idfs = retrieval.idf(counts, docs.agg(F.count("*").alias("n")))
    lists = stored(postings.build(retrieval.bm25_weights(counts, idfs), n), "postings")
    weights = retrieval.bm25_weights(asked, idfs).select("query_id", "term", "weight")
    return postings.top_k(lists, stored(weights, "asked"), 10)


def blockmax_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lists as ``bm25_topk``, from blocks of postings read by falling bound."""
    return _blockmax(spark, sf_dir).select("query_id", "doc_id", "score", F.col("rank").cast("long").alias("rank"))


def blockmax_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many posting blocks of a query's terms were read."""
    found = _blockmax(spark, sf_dir).groupBy("query_id").agg(F.first("read").alias("read"), F.first("blocks").alias("blocks"))
    return found.select("query_id", "read", "blocks", F.round(F.col("read") / F.col("blocks"), 4).alias("share"))


def chunk_size_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of the benchmark ask for the documents that hold them."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text")
    questions = I.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = chunksizes.compare(docs, questions, list(SIZES), model=lambda: chunksizes.WordCounts(PLACES))
    return found.select("size", "chunks", "queries", *(F.round(c, 6).alias(c) for c in ("mrr", "precision", "ndcg", "hit_rate")))


QUERIES = {f.__name__: f for f in (indexed_topk, indexed_recall, blockmax_topk, blockmax_share, chunk_size_comparison)}

_PLACE = f"CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {PLACES}"
_WORDS = "regexp_extract_all(lower(text), '[^\\s]+')"

ORACLE_SQL = {
    "indexed_recall": f"WITH {R._DENSE} SELECT (SELECT count(*) FROM q) AS queries, count(*) AS wanted, true AS reached FROM hits",
    "blockmax_topk": R.ORACLE_SQL["bm25_topk"],
    "chunk_size_comparison": f"""
        WITH cut AS (
            SELECT size, doc_id, unnest(range(0, greatest(length(text), 1), size)) AS start, text FROM documents, (SELECT unnest({list(SIZES)}) AS size)
        ), chunks AS (
            SELECT size, doc_id, start, text, md5(text) AS digest FROM (SELECT size, doc_id, start, substr(text, CAST(start AS INT) + 1, size) AS text FROM cut) WHERE trim(text) <> ''
        ), places AS (
            SELECT digest, place, count(*) AS n
            FROM (SELECT digest, {_PLACE} AS place FROM (SELECT digest, unnest({_WORDS}) AS w FROM (SELECT DISTINCT digest, text FROM chunks))) GROUP BY digest, place
        ), norms AS (
            SELECT digest, sum(n * n) AS xx FROM places GROUP BY digest
        ), wanted AS (
            SELECT item_id AS query_id, doc_id FROM benchmark JOIN documents ON contains(documents.text, benchmark.text)
        ), asked AS (
            SELECT query_id, place, count(*) AS n
            FROM (SELECT query_id, {_PLACE} AS place FROM (SELECT item_id AS query_id, unnest({_WORDS}) AS w FROM benchmark)) GROUP BY query_id, place
        ), lengths AS (
            SELECT query_id, sum(n * n) AS qq FROM asked GROUP BY query_id
        ), dots AS (
            SELECT query_id, digest, sum(asked.n * places.n) AS d FROM asked JOIN places USING (place) GROUP BY query_id, digest
        ), scores AS (
            SELECT query_id, digest, CAST(d AS DOUBLE) / (sqrt(CAST(qq AS DOUBLE)) * sqrt(CAST(xx AS DOUBLE))) AS score FROM dots JOIN norms USING (digest) JOIN lengths USING (query_id)
        ), best AS (
            SELECT size, query_id, doc_id, row_number() OVER (PARTITION BY size, query_id ORDER BY score DESC, doc_id, start) AS place
            FROM scores JOIN chunks USING (digest)
        ), pages AS (
            SELECT *, row_number() OVER (PARTITION BY size, query_id ORDER BY first) AS rank
            FROM (SELECT size, query_id, doc_id, min(place) AS first FROM best WHERE place <= 10 GROUP BY size, query_id, doc_id)
        ), judged AS (
            SELECT s.size, w.query_id, w.doc_id, rank FROM wanted w CROSS JOIN (SELECT DISTINCT size FROM chunks) s
                LEFT JOIN pages p ON p.size = s.size AND p.query_id = w.query_id AND p.doc_id = w.doc_id
        ), each AS (
            SELECT size, query_id, min(rank) AS first, count(*) FILTER (WHERE rank <= 5) AS hits, sum(CASE WHEN rank <= 10 THEN 1 / log2(rank + 1e0) ELSE 0 END) AS dcg,
                list_sum(list_transform(range(1, least(10, count(*)) + 1), lambda i: 1 / log2(i + 1e0))) AS idcg
            FROM judged GROUP BY size, query_id
        )
        SELECT CAST(size AS INT) AS size, n AS chunks, count(*) AS queries, round(avg(coalesce(1.0e0 / first, 0)), 6) AS mrr, round(avg(hits / 5e0), 6) AS precision,
            round(avg(dcg / idcg), 6) AS ndcg, round(avg(CASE WHEN hits > 0 THEN 1e0 ELSE 0 END), 6) AS hit_rate
        FROM each JOIN (SELECT size, count(*) AS n FROM chunks GROUP BY size) USING (size) GROUP BY size, n
    """,
}
