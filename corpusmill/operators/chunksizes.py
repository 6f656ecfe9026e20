"""Chunk sizes compared by what is retrieved from them, in one plan over all sizes.

One pass over the documents cuts each at every size, makes a vector of every chunk, scores
these against a block of queries, and keeps the best of each size and query.  Windows of
fixed size are counted without cutting: a text is split into words once for all sizes, and
only the words that a window's end cuts are looked at again.  Otherwise every different
chunk is given to the model (by digest: equal chunks of any size or document of a slice).  A task sends its
best and its numbers of chunks and nothing else, so no text and no vector is written or
moved; these bests are written once.  Queries come in blocks of ``QUERIES``, each with a pass of its own.

Null, empty and blank texts have no chunks.  Copies tie and go by document and place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from . import ir

#: Queries of one pass; with their vectors this is all that every task is given.
QUERIES = 1024
#: Characters of text whose chunks are scored together, and words whose places a task remembers.
SLICE, WORDS = 1 << 21, 500_000


class WordCounts:
    """A stand-in for a model: how many words of a text fall to each place, by a digest of the word."""

    def __init__(self, dimensions: int = 256):
        self.dimensions = dimensions
        self.places: dict[bytes, int] = {}

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions))
        if len(self.places) > WORDS:
            self.places.clear()
        for row, text in zip(out, texts, strict=True):
            np.add.at(row, self._placed(text.lower().encode().split()), 1)
        return out

    def _placed(self, words: list[bytes]) -> list[int]:
        for w in set(words).difference(self.places):
            self.places[w] = int.from_bytes(hashlib.md5(w).digest()[:4]) % self.dimensions
        return list(map(self.places.__getitem__, words))

    def windows(self, texts: list[str], sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(size, vectors, text number, place) of the windows of ``fixed`` that hold more than spaces.

        A text must be as long in lower case, and each of its letters there by itself (``alike``).
        """
        if len(self.places) > WORDS:
            self.places.clear()
        low = "\n".join(t.lower() for t in texts)
        codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
        black = np.r_[False, (codes > 32) | (codes < 9) | ((codes > 13) & (codes < 32)), False]
        turns = np.flatnonzero(black[1:] != black[:-1])
        starts, ends = turns[::2], turns[1::2]
        placed = np.array(self._placed(low.encode().split()), np.int64)
        lengths = np.array([len(t) for t in texts])
        heads = np.cumsum(lengths + 1) - lengths - 1
        doc = np.searchsorted(heads, starts, "right") - 1
        first, last = starts - heads[doc], ends - heads[doc] - 1
        filled = np.r_[0, np.cumsum(codes != 32)]
        for size in sizes:
            n = -(-lengths // size)
            base = np.cumsum(n) - n
            number = np.repeat(np.arange(len(texts)), n)
            place = np.arange(len(number)) - base[number]
            row, end = base[doc] + first // size, base[doc] + last // size
            whole = row == end
            cells = row[whole] * self.dimensions + placed[whole]
            rows, pieces = [], []
            for head, at, stop in zip(heads[doc[~whole]].tolist(), starts[~whole].tolist(), ends[~whole].tolist(), strict=True):
                while at < stop:
                    till = min(stop, head + ((at - head) // size + 1) * size)
                    pieces.append(low[at:till].encode())
                    rows.append(till - 1)
                    at = till
            if rows:
                ats = np.array(rows)
                of = np.searchsorted(heads, ats, "right") - 1
                cells = np.r_[cells, (base[of] + (ats - heads[of]) // size) * self.dimensions + self._placed(pieces)]
            vectors = np.bincount(cells, minlength=len(number) * self.dimensions).reshape(len(number), self.dimensions).astype(float)
            low_end = heads[number] + place * size
            held = np.flatnonzero(filled[np.minimum(low_end + size, heads[number] + lengths[number])] > filled[low_end])
            yield size, vectors[held], number[held], place[held]


def alike(text: str) -> bool:
    """Is a piece of the text in lower case the piece of the text in lower case?"""
    return len(text.lower()) == len(text) and "\u03a3" not in text


def fixed(text: str, size: int) -> list[str]:
    """Windows of ``size`` characters."""
    return [text[i : i + size] for i in range(0, len(text), size)]


class Best:
    """The k best chunks of one size for every query so far."""

    def __init__(self, k: int, queries: int):
        self.k, self.least = k, np.zeros(queries)
        self.rows = pd.DataFrame({"q": [], "score": [], "doc_id": [], "chunk_index": []}).astype({"q": int, "score": float, "doc_id": int, "chunk_index": int})

    def add(self, scores: np.ndarray, docs: np.ndarray, places: np.ndarray) -> None:
        """Chunks by queries; a chunk that ties with the k-th best is looked at."""
        own = np.partition(scores, -self.k, axis=0)[-self.k] if len(scores) > self.k and not self.least.all() else np.zeros(scores.shape[1])
        at, q = np.nonzero((scores >= np.maximum(self.least, own)) & (scores > 0))
        if not len(at):
            return
        new = pd.DataFrame({"q": q, "score": scores[at, q], "doc_id": docs[at], "chunk_index": places[at]})
        rows = pd.concat([self.rows, new]).sort_values(["q", "score", "doc_id", "chunk_index"], ascending=[True, False, True, True])
        self.rows = rows[rows.groupby("q").cumcount() < self.k]
        full = self.rows.groupby("q")["score"].agg(["size", "min"])
        full = full[full["size"] == self.k]
        self.least[full.index] = full["min"]


def _slices(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sizes = pdf["text"].str.len().fillna(0).cumsum() // SLICE
        for _, part in pdf.groupby(sizes, sort=False):
            yield part


def retrieved(docs: DataFrame, queries: pd.DataFrame, sizes: list[int], k: int, cut: Callable[[str, int], list[str]] = fixed, model: Callable[[], WordCounts] = WordCounts) -> DataFrame:
    """(size, query, score, doc_id, chunk_index, chunks) of documents (doc_id, text): each task's k best of each size and query.

    ``queries`` holds (query, text), ``QUERIES`` of them at most; ``query`` is a whole number.
    Rows without a query tell how many chunks of a size the task has cut.
    """
    asked = model().embed(queries["text"].tolist())
    lengths, names = np.sqrt((asked * asked).sum(1)), queries["query"].to_numpy()

    def run(batches):
        embedder = model()
        best = {s: Best(k, len(names)) for s in sizes}
        n = dict.fromkeys(sizes, 0)

        def score(s, vectors, ids, places):
            n[s] += len(ids)
            # counts are whole numbers: products are exact, and equal chunks score alike
            norms = np.sqrt((vectors * vectors).sum(1))
            best[s].add((vectors @ asked.T) / np.maximum(lengths[None, :] * norms[:, None], 1e-300), ids, places)

        for pdf in _slices(batches):
            pdf = pdf[pdf["text"].str.len() > 0]
            plain = pdf["text"].map(alike).astype(bool) if cut is fixed and hasattr(embedder, "windows") else pd.Series(False, index=pdf.index)
            if plain.any():
                ids = pdf["doc_id"][plain].to_numpy()
                for s, vectors, number, places in embedder.windows(pdf["text"][plain].tolist(), sizes):
                    if len(number):
                        score(s, vectors, ids[number], places)
            numbers: dict[bytes, int] = {}
            texts: list[str] = []
            held = {s: ([], [], []) for s in sizes}
            for doc, text in zip(pdf["doc_id"][~plain].tolist(), pdf["text"][~plain], strict=True):
                for s in sizes:
                    for place, chunk in enumerate(cut(text, s)):
                        if chunk.strip(" "):
                            key = hashlib.md5(chunk.encode()).digest()
                            if key not in numbers:
                                numbers[key] = len(texts)
                                texts.append(chunk)
                            for column, x in zip(held[s], (numbers[key], doc, place), strict=True):
                                column.append(x)
            vectors = embedder.embed(texts) if texts else None
            for s, (own, ids, places) in held.items():
                if own:
                    score(s, vectors[own], np.array(ids), np.array(places))
        for s in sizes:
            rows = best[s].rows.assign(size=s, chunks=0)
            yield rows.assign(query=names[rows["q"]]).drop(columns="q")[ORDER]
            yield pd.DataFrame([[s, None, None, None, None, n[s]]], columns=ORDER).astype({"query": "Int64", "doc_id": "Int64", "chunk_index": "Int64", "score": float})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, SCHEMA)


SCHEMA = "size int, query bigint, score double, doc_id bigint, chunk_index bigint, chunks bigint"
ORDER = [c.split()[0] for c in SCHEMA.split(", ")]


def holders(docs: DataFrame, passages: pd.DataFrame) -> DataFrame:
    """(query, doc_id): the documents that hold a passage (query, text) whole; one automaton finds all in one pass."""
    by_text = {t: sorted(set(g["query"].tolist())) for t, g in passages[passages["text"].str.len() > 0].groupby("text")}

    def run(batches):
        found = ahocorasick.Automaton()
        for text, names in by_text.items():
            found.add_word(text, names)
        if by_text:
            found.make_automaton()
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"], strict=True):
                names = {n for _, own in found.iter(text) for n in own} if text and by_text else ()
                rows += [(n, doc) for n in names]
            yield pd.DataFrame(rows, columns=["query", "doc_id"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "query bigint, doc_id bigint")


def compare(docs: DataFrame, questions: DataFrame, sizes: list[int], k: int = 10, cut: Callable[[str, int], list[str]] = fixed, model: Callable[[], WordCounts] = WordCounts) -> DataFrame:
    """(size, chunks, queries, mrr, precision, ndcg, hit_rate) of questions (query_id, text).

    A question asks for the documents that hold its text; those that no document holds are
    left out.  In each size the ``k`` best chunks of a question are reduced to their pages.
    """
    asked = questions.select(F.col("query_id").cast("long").alias("query"), "text").where("text is not null").orderBy("query")
    found = wanted = None
    for block in _blocks(asked):
        one, held = retrieved(docs, block, sizes, k, cut, model), holders(docs, block)
        found, wanted = (one, held) if found is None else (found.unionByName(one.withColumn("chunks", F.lit(0).cast("long"))), wanted.unionByName(held))
    # both are read several times, and each reading would be a pass over the documents
    found, wanted = stored(found, "best"), stored(wanted, "holders")
    hits = found.where("query is not null")
    order = Window.partitionBy("size", "query").orderBy(F.desc("score"), "doc_id", "chunk_index")
    best = hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    pages = best.groupBy("size", "query", "doc_id").agg(F.min("place").alias("first"))
    ranked = pages.withColumn("rank", F.row_number().over(Window.partitionBy("size", "query").orderBy("first")))
    counts = found.groupBy("size").agg(F.sum("chunks").alias("chunks"))
    name = F.struct("size", "query").alias("query_id")
    qrels = wanted.distinct().crossJoin(F.broadcast(counts.select("size"))).select(name, "doc_id", F.lit(1).alias("rel"))
    metrics = ir.per_query(ranked.select(name, "doc_id", "rank"), qrels, qrels)
    means = metrics.groupBy(F.col("query_id.size").alias("size")).agg(F.count("*").alias("queries"), F.avg("rr").alias("mrr"), F.avg("p_at_k").alias("precision"), F.avg("ndcg").alias("ndcg"), F.avg("hit").alias("hit_rate"))
    return counts.join(means, "size")


def _blocks(asked: DataFrame) -> Iterator[pd.DataFrame]:
    """Questions in blocks, one at a time on the driver; an empty block where there are none."""
    block, any_ = [], False
    for row in asked.toLocalIterator():
        block.append(row)
        if len(block) == QUERIES:
            yield pd.DataFrame(block, columns=["query", "text"])
            block, any_ = [], True
    if block or not any_:
        yield pd.DataFrame(block, columns=["query", "text"]).astype({"query": int, "text": str})
