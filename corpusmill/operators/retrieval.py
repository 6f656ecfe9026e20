"""Exact dense search, BM25, fusion and content relevance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import nearest

# German stop words of the sparse retriever, in its order; the joined entries and the repeats are its own.
STOPWORDS = (
    "der", "die", "das", "ein", "eine", "einer", "eines", "einem", "einen", "und", "oder", "aber", "auchist", "sind",
    "war", "waren", "wird", "werden", "hat", "hatte", "haben", "zu", "in", "von", "mitauf", "für", "an", "bei",
    "nach", "über", "aus", "um", "durch", "als", "wie", "nicht", "noch", "wennwir", "sie", "er", "es", "ich", "du",
    "ihr", "man", "so", "da", "wo", "was", "wer", "wie", "kann", "nursein", "seine", "seiner", "seinem", "seinen",
    "ihre", "ihrem", "ihren", "ihres", "imzum", "zur", "des", "den", "dem", "vor", "bis", "alle", "einem", "einer",
    "keine", "mehrdiese", "dieser", "diesem", "dieses", "welche", "welcher", "welchem", "welchesschon", "bereits",
    "dann", "dort", "hier", "jetzt", "sehr", "viel",
)
TOKEN = "(?iu)[a-zäöüß]{2,}"


def top_k(scored: DataFrame, k: int, query: str = "query_id", score: str = "score", key: str = "doc_id") -> DataFrame:
    """The k best rows of each query with their rank; ties by key."""
    order = Window.partitionBy(query).orderBy(F.desc(score), F.asc(key))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def dense_top_k(corpus: DataFrame, queries: DataFrame, k: int, without_self: bool = False) -> DataFrame:
    """(query_id, doc_id, score, rank): the k best rows of every query by cosine, all rows compared; ties by id."""
    return top_k(nearest.top_k(corpus, queries, k, without_self), k)


def page_ranks(hits: DataFrame, page: Column) -> DataFrame:
    """Best rank of each page, ranked again without gaps."""
    best = hits.groupBy("query_id", page.alias("page_id")).agg(F.min("rank").alias("first"), F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("first", "page_id")
    return best.select("query_id", "page_id", "score", F.row_number().over(order).alias("rank"))


def tokens(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), F.lower)
    return F.filter(found, lambda t: ~t.isin(list(STOPWORDS)))


def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", only: DataFrame | None = None) -> DataFrame:
    """(key, term, tf, dl) of all terms, or of those that ``only`` (term) holds."""
    tokenized = docs.select(key, tokens(F.col(text)).alias("t")).select(key, F.size("t").alias("dl"), F.explode("t").alias("term"))
    if only is not None:
        tokenized = tokenized.join(only, "term", "left_semi")
    return tokenized.groupBy(key, "term").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))


def idf(counts: DataFrame, n: DataFrame) -> DataFrame:
    """(term, df, idf); ``n`` is a one-row frame with the number of documents, ``n``."""
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("term", "df", F.ln((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0).alias("idf"))


def vocabulary(idfs: DataFrame) -> DataFrame:
    """Terms numbered in their order: inside those of the same first two letters, after all that come before these."""
    terms = idfs.select("term").distinct().withColumn("part", F.substring("term", 1, 2))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("term"))
    sizes = terms.groupBy("part").agg(F.count("*").alias("held"))  # one row for every two letters
    before = sizes.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("start"))
    return terms.withColumn("n", inside).join(F.broadcast(before), "part").select("term", (F.col("start") + F.col("n") - 1).alias("term_index"))


def bm25_weights(counts: DataFrame, idfs: DataFrame, k1: float = 1.5, b: float = 0.75, avgdl: float = 100.0) -> DataFrame:
    """Input keys with the weight of each term, positive ones only, to six digits."""
    part = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / avgdl))
    weighted = counts.join(idfs.select("term", "idf"), "term").withColumn("weight", F.round(F.col("idf") * part, 6))
    return weighted.where("weight > 0").drop("idf")


def sparse_scores(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Dot products of weighted documents (doc_id, term, weight) and queries (query_id, term, weight)."""
    both = docs.select("doc_id", "term", F.col("weight").alias("w")).join(queries.select("query_id", "term", F.col("weight").alias("q")), "term")
    return both.groupBy("query_id", "doc_id").agg(F.sum(F.col("w") * F.col("q")).alias("score"))


#: Documents of a shard, queries of a block, rows that are scored at once.
SHARD, ASKED, ROWS = 4096, 256, 16_384


def _shard_best(docs: pa.Table, asked: pa.Table, k: int, within: float) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Queries, documents and scores of a shard: all that are no more than ``within`` below the k-th, of equal scores k."""
    terms = pc.unique(asked["term"].combine_chunks())
    rows, wanted = (t["doc_id" if t is docs else "query_id"].combine_chunks().dictionary_encode(null_encoding="encode") for t in (docs, asked))
    d, q = (x.indices.to_numpy() for x in (rows, wanted))
    own, theirs = (pc.fill_null(pc.index_in(t["term"].combine_chunks(), value_set=terms), -1).to_numpy() for t in (docs, asked))
    order = np.lexsort((own, d))
    order = order[own[order] >= 0]  # by document and term, so that equal documents have equal sums
    d, own, weight = d[order], own[order], docs["weight"].to_numpy()[order]
    by_term = np.argsort(theirs, kind="stable")
    held = np.bincount(theirs, minlength=len(terms))
    start, q, asked_weight = np.cumsum(held) - held, q[by_term], asked["weight"].to_numpy()[by_term]
    n, m = len(rows.dictionary), len(wanted.dictionary)
    total = np.zeros(n * m)
    for at in range(0, len(d), ROWS):
        mine, name = d[at : at + ROWS], own[at : at + ROWS]
        sizes = held[name]
        to = np.repeat(start[name] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        cells = np.repeat((mine - mine[0]) * m, sizes) + q[to]
        sums = np.bincount(cells, np.repeat(weight[at : at + ROWS], sizes) * asked_weight[to], (mine[-1] - mine[0] + 1) * m)
        total[mine[0] * m : (mine[-1] + 1) * m] += sums
    total = total.reshape(n, m)
    least = np.partition(total, n - k, axis=0)[n - k] - within if n > k else np.zeros(m)
    di, qi = np.nonzero((total > 0) & (total >= least))
    score, place = total[di, qi], pc.rank(rows.dictionary, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()
    order = np.lexsort((place[di], -score, qi))
    di, qi, score = di[order], qi[order], score[order]
    first = np.r_[True, (qi[1:] != qi[:-1]) | (score[1:] != score[:-1])][: len(qi)]
    kept = np.arange(len(qi)) - np.maximum.accumulate(np.where(first, np.arange(len(qi)), 0)) < k
    return wanted.dictionary.take(pa.array(qi[kept])), rows.dictionary.take(pa.array(di[kept])), score[kept]


def sparse_best(docs: DataFrame, queries: DataFrame, k: int, documents: int, within: float = 1e-4) -> DataFrame:
    """(query_id, doc_id, score): of ``sparse_scores`` at least those that can be among the k best once scores are rounded to a step of ``within``.

    A task holds one shard of documents and one block of queries, and gives its best only.
    """
    shards, blocks = max(1, -(-documents // SHARD)), max(1, -(-queries.select("query_id").distinct().count() // ASKED))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = docs.select(dealt("doc_id", shards).alias("shard"), every(blocks).alias("block"), "doc_id", "term", F.col("weight").cast("double").alias("weight"))
    wanted = queries.select(every(shards).alias("shard"), dealt("query_id", blocks).alias("block"), "query_id", "term", F.col("weight").cast("double").alias("weight"))

    def run(key, mine: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([asked.schema.field("query_id"), mine.schema.field("doc_id"), ("score", pa.float64())])
        return pa.table(list(_shard_best(mine, asked, k, within)), schema=schema) if len(mine) and len(asked) else schema.empty_table()

    kinds = dict(wanted.dtypes)["query_id"], dict(rows.dtypes)["doc_id"]
    return rows.groupBy("shard", "block").cogroup(wanted.groupBy("shard", "block")).applyInArrow(run, f"query_id {kinds[0]}, doc_id {kinds[1]}, score double")


def fused(lists: list[DataFrame], k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of ranked lists (query_id, doc_id, rank), the k best."""
    every = lists[0].select("query_id", "doc_id", "rank")
    for other in lists[1:]:
        every = every.unionByName(other.select("query_id", "doc_id", "rank"))
    scored = every.groupBy("query_id", "doc_id").agg(F.sum(1.0 / (constant + F.col("rank"))).alias("score"))
    return top_k(scored, k)


def relevance(context: Column, truth: Column, keywords: Column) -> Column:
    """0.4 shared words + 0.3 keywords found + 0.3 fragments of 20 characters found, at most 1."""
    low, want = F.lower(context), F.lower(truth)
    split = lambda t: F.array_distinct(F.regexp_extract_all(t, F.lit(r"[^\s]+"), F.lit(0)))
    share = lambda part, whole: F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    words = share(F.size(F.array_intersect(split(want), split(low))), F.size(split(want)))
    named = share(F.size(F.filter(keywords, lambda k: F.contains(low, F.lower(k)))), F.size(keywords))
    starts = F.sequence(F.lit(0), F.greatest(F.length(want) - 20, F.lit(1)) - 1, F.lit(10))
    pieces = F.transform(starts, lambda i: F.substr(want, i + 1, F.lit(20)))
    parts = share(F.size(F.filter(pieces, lambda p: F.contains(low, p))), F.size(pieces))
    return F.least(F.lit(1.0), 0.4 * words + F.when(F.size(keywords) > 0, 0.3 * named).otherwise(0.0) + 0.3 * parts)


def keyword_query(question: Column, keywords: Column, mode: str = "question") -> Column:
    """The question, or its first five keywords where there are any."""
    if mode == "question":
        return question
    return F.when(F.size(keywords) > 0, F.concat_ws(" ", F.slice(keywords, 1, 5))).otherwise(question)
