"""Nearest rows of each query by cosine, exactly, over pairs of blocks.

Rows and queries are dealt into blocks by a hash of their ids, and every block of queries
meets every block of rows once.  In a pair of blocks, products of unit vectors in single
precision screen out what cannot be among the k best; what is left is compared in double
precision, summed in the order of the components, so scores do not depend on the blocks.
Of equal vectors of a block only the least ids are looked at.  Pairs of blocks are dealt
into more partitions than there are pairs, so that most of them are a task of their own.

The job is the product of rows and queries by nature; a task holds one pair of blocks and
tiles of its products, and gives k rows a query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS, LEAST_ROWS, SPREAD, ASKED = 32_768, 4096, 16, 16_384
TILE, FIRST, QUERIES, PAIRS, HELD, APART = 8192, 2048, 1024, 1 << 12, 1 << 18, 4


def matrix(column, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Components as doubles, and which rows have none: those of another length or with null components, which are zero here."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    x, void = np.zeros((len(sizes), max(length, 1))), np.ones(len(sizes), bool)
    fits = np.flatnonzero(sizes == length) if length > 0 else np.zeros(0, int)
    if len(fits):
        flat = lists.take(pa.array(fits)).flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, length).all(1)
        x[fits[known]] = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, length)[known]
        void[fits[known]] = False
    return x, void


def lengths(x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    with np.errstate(all="ignore"):
        for d in range(x.shape[1]):
            total += x[:, d] * x[:, d]
    return np.sqrt(total)


def least_of_copies(x: np.ndarray, void: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among k best: of each vector the k + 1 least ids (one may be the query itself), k rows of an id at most."""
    if not len(ids):
        return np.zeros(0, int)
    own = np.unique(np.concatenate([x + 0.0, void[:, None]], 1).view(np.dtype((np.void, 8 * (x.shape[1] + 1)))).ravel(), return_inverse=True)[1].ravel()
    order = np.lexsort((ids, own))
    group, name, at = own[order], ids[order], np.arange(len(ids))
    starts = np.r_[True, group[1:] != group[:-1]]
    news = starts | np.r_[True, name[1:] != name[:-1]]
    numbered = np.cumsum(news)
    nth = numbered - np.maximum.accumulate(np.where(starts, numbered, 0))
    again = at - np.maximum.accumulate(np.where(news, at, 0))
    return np.sort(order[(nth <= k) & (again < k)])


class Side:
    """One block: ids, vectors, their lengths, unit vectors in single precision, and which are void, zero or not finite."""

    def __init__(self, x, void, ids):
        self.x, self.void, self.ids, self.norm = x, void, ids, lengths(x)
        self.wild = ~np.isfinite(self.norm) & ~void
        with np.errstate(all="ignore"):
            unit = x / self.norm[:, None]
        self.flat = void | (self.norm == 0)
        unit[self.flat | self.wild] = 0
        self.unit = unit.astype(np.float32)


def _exact(rows: Side, asked: Side, ci: np.ndarray, qi: np.ndarray) -> np.ndarray:
    out = np.zeros(len(ci))
    for at in range(0, len(ci), PAIRS):
        c, q = ci[at : at + PAIRS], qi[at : at + PAIRS]
        total = np.zeros(len(c))
        with np.errstate(all="ignore"):
            products = rows.x[c] * asked.x[q]
            for d in range(products.shape[1]):
                total += products[:, d]
            both = rows.norm[c] * asked.norm[q]
            score = total / both
        score[(both == 0) | rows.void[c] | asked.void[q]] = 0.0
        out[at : at + PAIRS] = score
    return out


def _best(qi, ids, score, k):
    """The k best of each query; scores that are no number come first, as Spark orders them."""
    key = np.where(np.isnan(score), np.inf, score)
    order = np.lexsort((ids, -key, qi))
    q = qi[order]
    first = np.maximum.accumulate(np.where(np.r_[True, q[1:] != q[:-1]], np.arange(len(q)), 0)) if len(q) else q
    kept = order[np.arange(len(q)) - first < k]
    return qi[kept], ids[kept], score[kept]


def _places(mask: np.ndarray) -> np.ndarray:
    """Places of the few that are true, row after row; eight are looked at together."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    at = (8 * np.flatnonzero(flat[:whole].view(np.uint64))[:, None] + np.arange(8)).ravel()
    return np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])


def _themselves(rows: Side, asked: Side) -> tuple[np.ndarray, np.ndarray]:
    """(query number, row number) wherever both have one id, by query; an id may stand in several rows."""
    order = np.argsort(rows.ids, kind="stable")
    first, last = (np.searchsorted(rows.ids, asked.ids, side, sorter=order) for side in ("left", "right"))
    qi = np.repeat(np.arange(len(asked.ids)), last - first)
    return qi, order[np.arange(len(qi)) + np.repeat(first - np.r_[0, np.cumsum(last - first)[:-1]], last - first)]


def _bounds(qi, near, k, n):
    """Product of the k-th best of n queries, where that many are known; what must be compared in any case is no bound."""
    sure = np.where(near > 1.5, -2.0, near.astype(float))
    order = np.argsort(qi - sure / 4)
    starts = np.flatnonzero(np.diff(qi[order], prepend=-1))
    starts = starts[np.diff(starts, append=len(qi)) >= k]
    out = np.full(n, -np.inf)
    out[qi[order[starts]]] = sure[order[starts + k - 1]]
    return out


def pair(rows: Side, asked: Side, k: int, without_self: bool, looked_up=None):
    """(query number, id, score) of the k best rows of every query of a pair of blocks.

    ``looked_up(queries, low, high)`` tells which of the rows from low to high each of these
    queries may find; without it all of them.
    """
    margin = 4.0 * (rows.x.shape[1] + 8) * 2.0**-24
    wild = np.flatnonzero(rows.wild)
    tame = np.flatnonzero(~rows.wild)
    few = np.concatenate([wild, tame[least_of_copies(np.zeros((len(tame), 1)), np.zeros(len(tame), bool), rows.ids[tame], k)]])
    bounds = [0, *range(FIRST, len(rows.ids), TILE), len(rows.ids)]
    own = _themselves(rows, asked) if without_self else (np.zeros(0, int), np.zeros(0, int))
    nothing = (np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.float32))
    out = []
    for at in range(0, len(asked.ids), QUERIES):
        here = np.arange(at, min(at + QUERIES, len(asked.ids)))
        flat = here[asked.flat[here]]
        full = here[~asked.flat[here]]
        found, held = (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)), nothing
        mine = slice(*np.searchsorted(own[0], [at, at + len(here)]))
        nth = np.full(len(here), -1)
        nth[full - at] = np.arange(len(full))
        self_q, self_c = nth[own[0][mine] - at], own[1][mine]

        def add(found, ci, qi):
            if without_self:
                other = rows.ids[ci] != asked.ids[qi]
                ci, qi = ci[other], qi[other]
            new = (qi, rows.ids[ci], _exact(rows, asked, ci, qi))
            return _best(*(np.concatenate(p) for p in zip(found, new, strict=True)), k)

        if len(flat):
            found = add(found, np.tile(few, len(flat)), np.repeat(flat, len(few)))
        least = np.full(len(full), -np.inf)
        for low, high in zip(bounds, bounds[1:], strict=False):
            if not len(full) or low == high:
                continue
            near = asked.unit[full] @ rows.unit[low:high].T
            near[:, rows.wild[low:high]] = -np.inf
            seen = None if looked_up is None else looked_up(full, low, high)
            if seen is not None:
                near[~seen] = -np.inf
            met = (self_q >= 0) & (self_c >= low) & (self_c < high)
            near[self_q[met], self_c[met] - low] = -np.inf
            if low == 0 and high > k:
                least = np.partition(near, high - k, axis=1)[:, high - k] - 2 * margin
            near[:, rows.wild[low:high]] = 2
            near[asked.wild[full]] = 2
            if seen is not None:
                near[~seen] = -np.inf
            qi, ci = np.divmod(_places(near > least[:, None].astype(np.float32)), high - low)
            held = tuple(np.concatenate(p) for p in zip(held, (qi, ci + low, near[qi, ci]), strict=True))
            least = np.maximum(least, _bounds(held[0], held[2], k, len(full)) - 2 * margin)
            kept = held[2] > least[held[0]]
            held = tuple(p[kept] for p in held)
            if len(held[0]) > HELD:
                found, held = add(found, held[1], full[held[0]]), nothing
                n = np.bincount(found[0] - at, minlength=len(here))[full - at]
                worst = np.full(len(here), np.inf)
                np.minimum.at(worst, found[0] - at, np.where(np.isnan(found[2]), 2.0, found[2]))
                least = np.where(n >= k, np.maximum(least, worst[full - at] - 2 * margin), least)
        out.append(add(found, held[1], full[held[0]]))
    return tuple(np.concatenate(p) for p in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))


def blocks(n: int, m: int) -> tuple[int, int]:
    """How many blocks of rows and of queries: no block grows with the table, and small tables are still spread."""
    return max(math.ceil(n / ROWS), min(SPREAD, math.ceil(n / LEAST_ROWS)), 1), max(math.ceil(m / ASKED), 1)


def paired(rows: DataFrame, row_key: str, queries: DataFrame, query_key: str, parts: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the number ``pair`` of each pair of blocks that they are part of."""
    of_rows, of_queries = parts
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("block", F.pmod(F.xxhash64(row_key), F.lit(of_rows)).cast("int")).withColumn("pair", every(of_queries))
    right = queries.withColumn("asked", F.pmod(F.xxhash64(query_key), F.lit(of_queries)).cast("int")).withColumn("pair", every(of_rows))
    return left.withColumn("pair", F.col("pair") * of_rows + F.col("block")).drop("block"), right.withColumn("pair", F.col("asked") * of_rows + F.col("pair")).drop("asked")


def _plain(vector: str, frame: DataFrame):
    held = frame.schema[vector].dataType.elementType.typeName()
    return F.col(vector) if held in ("float", "double") else F.col(vector).cast("array<double>")


def top_k(corpus: DataFrame, queries: DataFrame, k: int, without_self: bool = False) -> DataFrame:
    """(query_id, doc_id, score): at least the k best rows of each query (query_id, vector), k of every block of rows; ties by id.

    A score is 0 where a vector is zero, null or of another length or has null components.
    """
    rows = corpus.where("doc_id is not null").select(F.col("doc_id").cast("long"), _plain("vector", corpus).alias("vector"))
    wanted = queries.where("query_id is not null").select(F.col("query_id").cast("long"), _plain("vector", queries).alias("vector"))
    of_rows, of_queries = blocks(rows.count(), wanted.count())
    left, right = paired(rows, "doc_id", wanted, "query_id", (of_rows, of_queries))
    schema = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())])

    def run(key, rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, names = rows["doc_id"].to_numpy(), asked["query_id"].to_numpy()
        sizes = pc.fill_null(pc.list_value_length(asked["vector"]), -1).to_numpy()
        parts = []
        for length in np.unique(sizes).tolist() if len(ids) else []:
            mine = np.flatnonzero(sizes == length)
            x, void = matrix(rows["vector"], length)
            kept = least_of_copies(x, void, ids, k)
            q, none = matrix(asked["vector"].take(pa.array(mine)), length)
            qi, found, score = pair(Side(x[kept], void[kept], ids[kept]), Side(q, none, names[mine]), k, without_self)
            parts.append(pa.table([names[mine][qi], found, score], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    left, right = (side.repartition(APART * of_rows * of_queries, "pair") for side in (left, right))
    return left.groupBy("pair").cogroup(right.groupBy("pair")).applyInArrow(run, "query_id bigint, doc_id bigint, score double")
