"""Indexed vector search: inverted cells, product-quantised codes, exact re-ranking.

``fit`` learns centroids and code books from at most ``SAMPLE`` vectors drawn by a hash of
their ids; ``index`` gives every vector its cell and a code of one byte for each of
``parts`` pieces of what is left after its centroid.  A search looks a query up in its
nearest cells, ranks these by the cosine with what their codes stand for, and compares the
``refine`` best of each query exactly.

Cells are put into buckets of about ``BUCKET`` vectors, larger cells are cut into several,
and queries into blocks; one task holds one bucket and one block, ranks all of its cells by
matrix products and gives ``refine`` rows a query, however many cells are looked up.  Copies
of a vector are ranked by id.  The model has at most ``MOST_CELLS`` cells and is sent to the
tasks; the index and the queries are joined by bucket.

Vectors that are null, zero, of another length or hold non-finite components are no part of
the index and find nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine
from . import nearest

SAMPLE, MOST_CELLS, CODES = 20_000, 4096, 256
BUCKET, BLOCK = 32_768, 16_384
#: Queries whose exact neighbours a search is audited against.
AUDIT = 256


def sound(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce((F.size(vector) == dims) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows) -> np.ndarray:
    v = np.stack([np.asarray(r, np.float64) for r in rows]) if len(rows) else np.zeros((0, 1))
    return v / np.linalg.norm(v, axis=1, keepdims=True) if len(v) else v


def _gaps(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids."""
    return (x * x).sum(1)[:, None] - 2 * (x @ to.T) + (to * to).sum(1)[None, :]


def _means(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """k means from the first k distinct rows; rows come in the order of a hash."""
    _, first = np.unique(x, axis=0, return_index=True)
    centres = x[np.sort(first)[:k]].copy()
    for _ in range(rounds):
        own = _gaps(x, centres).argmin(1)
        n = np.bincount(own, minlength=len(centres))
        for d in range(x.shape[1]):
            total = np.bincount(own, weights=x[:, d], minlength=len(centres))
            centres[n > 0, d] = total[n > 0] / n[n > 0]
    return centres


@dataclass
class Model:
    centres: np.ndarray
    books: list[np.ndarray]

    def cells(self, x: np.ndarray, n: int = 1) -> np.ndarray:
        gaps = _gaps(x, self.centres)
        return gaps.argmin(1)[:, None] if n == 1 else np.argsort(gaps, axis=1, kind="stable")[:, :n]

    def encoded(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = np.array_split(x - self.centres[cell], len(self.books), axis=1)
        return np.stack([_gaps(r, b).argmin(1) for r, b in zip(rest, self.books, strict=True)], 1).astype(np.uint8)

    def decoded(self, codes: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        return np.concatenate([b[c] for b, c in zip(self.books, codes.T, strict=True)], axis=1) + self.centres[cell]


def fit(corpus: DataFrame, dims: int, parts: int = 16, cells: int | None = None, rounds: int = 8) -> Model:
    """A model of the rows (doc_id, vector); about the square root of their number of cells."""
    rows = corpus.where(sound(F.col("vector"), dims))
    n = rows.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where(share < min(1.0, SAMPLE / max(n, 1))).select("vector", F.xxhash64("doc_id").alias("h")).toPandas()
    x = unit(drawn.sort_values("h", kind="stable")["vector"].tolist())
    if not len(x):
        return Model(np.zeros((1, dims)), [np.zeros((1, len(p))) for p in np.array_split(np.arange(dims), parts)])
    k = cells or max(1, min(MOST_CELLS, round(math.sqrt(n))))
    centres = _means(x, min(k, len(x)), rounds)
    rest = x - centres[_gaps(x, centres).argmin(1)]
    return Model(centres, [_means(r, CODES, rounds) for r in np.array_split(rest, parts, axis=1)])


def index(corpus: DataFrame, model: Model) -> DataFrame:
    """(doc_id, cell, code) of every sound vector."""
    dims = model.centres.shape[1]

    def run(batches):
        for pdf in batches:
            x = unit(pdf["vector"].tolist())
            if len(x):
                cell = model.cells(x)[:, 0]
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "cell": cell.astype(np.int32), "code": [c.tobytes() for c in model.encoded(x, cell)]})

    rows = corpus.where(sound(F.col("vector"), dims)).select(F.col("doc_id").cast("long"), "vector")
    return rows.mapInPandas(run, "doc_id bigint, cell int, code binary")


def _buckets(codes: DataFrame, queries: int) -> dict[int, tuple[int, int]]:
    """First bucket and number of buckets of each cell, from one total a cell, of which there are ``MOST_CELLS`` at most."""
    sizes = sorted((r["cell"], r["count"]) for r in codes.groupBy("cell").count().collect())
    n = sum(size for _, size in sizes)
    most = min(BUCKET, math.ceil(n / nearest.blocks(n, queries)[0]))
    placed, at, fill = {}, 0, 0
    for cell, size in sizes:
        if fill and fill + size > most:
            at, fill = at + 1, 0
        parts = max(1, math.ceil(size / most))
        placed[cell] = (at, parts)
        at, fill = (at + parts, 0) if parts > 1 else (at, fill + size)
    return placed


def _probes(queries: DataFrame, model: Model, probes: int, placed: dict[int, tuple[int, int]]) -> DataFrame:
    """(query_id, vector, bucket) of each query in the buckets of its nearest cells."""
    dims = model.centres.shape[1]

    def run(batches):
        for pdf in batches:
            near = model.cells(unit(pdf["vector"].tolist()), probes) if len(pdf) else np.zeros((0, 1), int)
            found = [sorted({b for c in own for at, n in [placed.get(c, (0, 0))] for b in range(at, at + n)}) for own in near.tolist()]
            yield pdf.assign(buckets=[np.array(f, np.int32) for f in found])

    rows = queries.where(sound(F.col("vector"), dims)).select(F.col("query_id").cast("long"), F.col("vector").cast("array<double>").alias("vector"))
    found = rows.mapInPandas(run, "query_id bigint, vector array<double>, buckets array<int>")
    return found.select("query_id", "vector", F.explode("buckets").alias("bucket"))


def candidates(codes: DataFrame, queries: DataFrame, model: Model, probes: int, refine: int, without_self: bool) -> DataFrame:
    """(query_id, doc_id): the ``refine`` nearest of each query by code, from its ``probes`` nearest cells."""
    m, every = queries.count(), probes >= len(model.centres)
    placed, blocks = _buckets(codes, m), max(1, math.ceil(m / BLOCK))
    places = codes.sparkSession.createDataFrame([(c, at, n) for c, (at, n) in placed.items()], "cell int, at int, parts int")
    dealt = codes.join(F.broadcast(places), "cell").withColumn("bucket", F.col("at") + F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    dealt = dealt.select("doc_id", "cell", "code", "bucket", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = _probes(queries, model, probes, placed).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    schema = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("near", pa.float64())])

    def run(key, rows: pa.Table, wanted: pa.Table) -> pa.Table:
        if not rows.num_rows or not wanted.num_rows:
            return schema.empty_table()
        ids, cell, names = (t[c].to_numpy() for t, c in ((rows, "doc_id"), (rows, "cell"), (wanted, "query_id")))
        x = model.decoded(np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(ids), -1), cell)
        kept = nearest.least_of_copies(x, np.zeros(len(ids), bool), ids, refine)
        q, none = nearest.matrix(wanted["vector"], x.shape[1])
        looked_up = None
        if not every:
            probed = np.zeros((len(names), len(model.centres)), bool)
            np.put_along_axis(probed, model.cells(q / np.linalg.norm(q, axis=1, keepdims=True), probes), True, axis=1)
            of = cell[kept]
            looked_up = lambda asked, low, high: probed[asked[:, None], of[None, low:high]]
        found = nearest.pair(nearest.Side(x[kept], np.zeros(len(kept), bool), ids[kept]), nearest.Side(q, none, names), refine, without_self, looked_up)
        return pa.table([names[found[0]], found[1], found[2]], schema=schema)

    on = ("bucket", "block")
    found = dealt.groupBy(*on).cogroup(asked.groupBy(*on)).applyInArrow(run, "query_id bigint, doc_id bigint, near double")
    order = Window.partitionBy("query_id").orderBy(F.desc("near"), "doc_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= refine).select("query_id", "doc_id")


def search(corpus: DataFrame, codes: DataFrame, queries: DataFrame, model: Model, k: int = 10, probes: int = 8, refine: int = 100, without_self: bool = False) -> DataFrame:
    """(query_id, doc_id, score, rank): the k best by cosine among what the index finds; ties by id."""
    near = candidates(codes, queries, model, probes, refine, without_self)
    both = near.join(queries.select("query_id", F.col("vector").alias("q")), "query_id").join(corpus.select("doc_id", "vector"), "doc_id")
    scored = both.select("query_id", "doc_id", cosine(F.col("vector"), F.col("q")).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact(corpus: DataFrame, queries: DataFrame, dims: int, k: int, without_self: bool = False) -> DataFrame:
    """(query_id, doc_id) of the exact k best for at most ``AUDIT`` queries, which every task compares its rows with."""
    asked = queries.where(sound(F.col("vector"), dims)).select("query_id", "vector").toPandas()
    names, q = asked["query_id"].to_numpy(), unit(asked["vector"].tolist())

    def run(batches):
        best: dict[int, list[pd.DataFrame]] = {}
        for pdf in batches:
            x = unit(pdf["vector"].tolist())
            if not len(x) or not len(q):
                continue
            score, ids = q @ x.T, pdf["doc_id"].to_numpy()
            for i, name in enumerate(names.tolist()):
                own = np.where(ids == name, -np.inf, score[i]) if without_self else score[i]
                top = np.lexsort((ids, -own))[:k]
                kept = pd.DataFrame({"doc_id": ids[top], "score": own[top]})
                best[i] = [pd.concat([*best.get(i, []), kept]).sort_values(["score", "doc_id"], ascending=[False, True])[:k]]
        for i, frames in best.items():
            yield pd.concat(frames).assign(query_id=names[i])[["query_id", "doc_id", "score"]]

    rows = corpus.where(sound(F.col("vector"), dims)).select(F.col("doc_id").cast("long"), "vector")
    found = rows.mapInPandas(run, "query_id bigint, doc_id bigint, score double").where("score > double('-infinity')")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("query_id", "doc_id")


def audited(corpus: DataFrame, codes: DataFrame, queries: DataFrame, model: Model, k: int, target: float, refine: int = 100, without_self: bool = False) -> tuple[int, int]:
    """(probes, refine) with which audited queries find the target share of their exact neighbours.

    The cells to look up are widened until they do; where all cells are not enough, what is
    compared exactly is, up to every vector of the index.
    """
    n = queries.count()
    share = F.pmod(F.xxhash64("query_id", F.lit("audit")), F.lit(1 << 30)) / float(1 << 30)
    drawn = queries.where(share < min(1.0, AUDIT / 2 / max(n, 1))).limit(AUDIT)
    true = exact(corpus, drawn, model.centres.shape[1], k, without_self).toPandas()
    wanted = set(map(tuple, true.to_numpy().tolist()))
    every, rows = len(model.centres), codes.count()
    probes = min(8, every)
    while wanted:
        found = search(corpus, codes, drawn, model, k, probes, refine, without_self).select("query_id", "doc_id").toPandas()
        reached = len(wanted & set(map(tuple, found.to_numpy().tolist()))) / len(wanted)
        if reached >= target:
            break
        if probes == every and refine >= rows:
            raise ValueError(f"only {reached:.3f} of the exact neighbours are in the index")
        probes, refine = (min(4 * probes, every), refine) if probes < every else (probes, 4 * refine)
    return probes, refine
