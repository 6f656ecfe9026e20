"""Top-k of sparse scores from impact-ordered posting lists in blocks with their maxima.

Documents are dealt to shards and their terms' weights kept as posting lists; a list is cut
into blocks of ``SPAN`` neighbouring documents, each with its largest weight.  In a shard a
query takes its lists by falling impact.  After each list a document can still gain the
block maxima of the lists to come; one that cannot reach the k-th score so far is out, and
a block is read only where a document is left in it.  What is not read cannot be among the
k best.  The best of all shards are merged.

A task holds one shard (about ``SHARD`` documents) and one block of queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD, SPAN, QUERIES = 4096, 16, 256


def build(weights: DataFrame, documents: int) -> DataFrame:
    """(shard, term, docs, weights) from weights (doc_id, term, weight): posting lists by document."""
    shards = max(1, -(-documents // SHARD))
    rows = weights.select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"), "term", F.struct("doc_id", "weight").alias("p"))
    lists = rows.groupBy("shard", "term").agg(F.sort_array(F.collect_list("p")).alias("p"))
    return lists.select("shard", "term", F.col("p.doc_id").alias("docs"), F.col("p.weight").alias("weights"))


class Shard:
    """The posting lists of a shard, with their blocks' maxima over its spans."""

    def __init__(self, lists: pd.DataFrame):
        self.ids = np.unique(np.concatenate(lists["docs"].tolist()))
        spans = -(-len(self.ids) // SPAN)
        self.lists, self.most = {}, {}
        for term, docs, weights in zip(lists["term"], lists["docs"], lists["weights"], strict=True):
            at, weight = np.searchsorted(self.ids, docs), np.asarray(weights, float)
            most = np.zeros(spans)
            np.maximum.at(most, at // SPAN, weight)
            self.lists[term], self.most[term] = (at, weight), most

    def best(self, terms: list[str], weights: list[float], k: int, digits: int) -> tuple[list[tuple[int, float]], int, int]:
        """The k best documents with their scores, blocks read, and blocks there are."""
        own = [(t, w) for t, w in zip(terms, weights, strict=True) if t in self.lists]
        if not own:
            return [], 0, 0
        own.sort(key=lambda x: -x[1] * self.most[x[0]].max())
        left = sum(w * self.most[t] for t, w in own)
        span, total, alive = np.arange(len(self.ids)) // SPAN, np.zeros(len(self.ids)), np.ones(len(self.ids), bool)
        read = blocks = 0
        for t, w in own:
            left = left - w * self.most[t]
            docs, weight = self.lists[t]
            opened = np.bincount(span[alive], minlength=len(left)) > 0
            held = self.most[t] > 0
            blocks, read = blocks + int(held.sum()), read + int((held & opened).sum())
            inside = opened[span[docs]]
            total[docs[inside]] += w * weight[inside]
            # a document without a score so far is none of the k; scores are ranked as rounded
            least = np.partition(total, -k)[-k] if len(total) > k else 0.0
            alive &= total + np.maximum(left, 0)[span] >= least - 2 * 10.0**-digits
        hit = np.flatnonzero(alive & (total > 0))
        ids, scores = self.ids[hit], np.floor(total[hit] * 10.0**digits + 0.5) / 10.0**digits
        top = np.lexsort((ids, -scores))[:k]
        return list(zip(ids[top].tolist(), scores[top].tolist(), strict=True)), read, blocks


def _asked(queries: DataFrame, lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries as one row each in every shard, and the lists of their terms in every block of queries."""
    blocks = F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-queries.select("query_id").distinct().count() // QUERIES)))).cast("int")
    whole = queries.groupBy("query_id").agg(F.collect_list(F.struct("term", "weight")).alias("t")).select("query_id", blocks.alias("block"), F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))
    shards = lists.select(F.col("shard").alias("at")).distinct()
    terms = queries.select("term", blocks.alias("block")).distinct()
    return whole.crossJoin(shards).withColumnRenamed("at", "place"), lists.join(terms, "term")


def top_k(lists: DataFrame, queries: DataFrame, k: int, digits: int = 4) -> DataFrame:
    """(query_id, doc_id, score, rank, read, blocks) of queries (query_id, term, weight).

    Scores are rounded to ``digits``, ties go by document.  ``read`` of ``blocks`` posting
    blocks of the query's terms were looked at.  Queries are a stated set: each is met by
    every shard, in blocks.
    """
    asked, held = _asked(queries, lists)

    def run(key, postings: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(postings) and len(wanted):
            shard = Shard(postings)
            for q, terms, weights in zip(wanted["query_id"], wanted["terms"], wanted["weights"], strict=True):
                found, read, blocks = shard.best(list(terms), list(weights), k, digits)
                out += [(q, d, s, 0, 0) for d, s in found] + [(q, None, None, read, blocks)]
        return pd.DataFrame(out, columns=["query_id", "doc_id", "score", "read", "blocks"]).astype({"doc_id": "Int64"})

    kind = dict(queries.dtypes)["query_id"]
    found = held.groupBy("shard", "block").cogroup(asked.groupBy("place", "block")).applyInPandas(run, f"query_id {kind}, doc_id bigint, score double, read bigint, blocks bigint")
    each = Window.partitionBy("query_id")
    told = found.withColumns({"read": F.sum("read").over(each), "blocks": F.sum("blocks").over(each)}).where("doc_id is not null")
    return told.withColumn("rank", F.row_number().over(each.orderBy(F.desc("score"), "doc_id"))).where(F.col("rank") <= k)
