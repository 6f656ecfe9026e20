"""Near-duplicate vectors by a robust-pruned flat graph.

1. Vectors equal in every component, and in label, are one class; the rest works on classes.
2. A label of more than three times ``REGION`` is cut: a tree of centroids, fitted on bounded samples (``SAMPLE`` of all, and of each cell that
   is still too large), cuts it into cells of about ``REGION``; a class is a member
   of its nearest cells.  Of how many is told by an audit: ``ASKED`` classes are compared
   with all classes of their label, and the overlap grows until ``RECALL`` of their links
   share a cell (or ``MOST_OVERLAP`` is reached).  A cell of more than ``BLOCK`` members is
   dealt into blocks, and all pairs of its blocks are searched, so no task grows with it.
3. A block is cut into overlapping cluster shards.  In each shard a flat graph is built:
   candidates by similarity, robust-pruned so that the neighbours kept lie in different
   directions, reverse edges and a few random ones.  The adjacency lists that a class has
   in its shards are united.
4. Every member walks the united graph greedily from the medoids of all shards; when the
   beam has settled, all classes in range are expanded until no new one is found.  Recall
   is audited against brute force for some queries of every block, and the beam widens
   until ``RECALL`` is reached.
5. Every pair found is verified by cosine in double precision.  A pair that two cells
   share counts in the lower one.  Links are counted and joined to components.

Vectors that are null, zero, or hold null or non-finite components, and those without a
label, link with nothing; vectors of different lengths neither.  Rows that repeat an id
are vectors of their own.  Empty tables give no rows.  Columns other than ``vec_id``,
``embedding`` and ``label`` do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut, tidy
from .graph import Sets, connected_components

SAMPLE, FAN, REGION = 20_000, 512, 3000
OVERLAP, MOST_OVERLAP, ASKED = 2, 6, 2000
BLOCK, SHARD = 9000, 1000
MOST_CENTRES = 128 << 20  # bytes of centroids that are broadcast; beyond them cells are larger
DEGREE, POOL, ALPHA, RANDOM = 16, 48, 1.2, 4
BEAM, AUDITED, RECALL = 8, 128, 0.999


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def centroids(vectors: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    rng = np.random.default_rng(seed)
    k = min(k, len(vectors))
    centre = vectors[rng.choice(len(vectors), k, replace=False)] if k else vectors[:0]
    for _ in range(rounds if k > 1 else 0):
        own = np.argmax(vectors @ centre.T, 1)
        total = np.zeros_like(centre)
        np.add.at(total, own, vectors)
        empty = np.linalg.norm(total, axis=1) == 0
        total[empty] = vectors[rng.choice(len(vectors), int(empty.sum()))]
        centre = unit(total)
    return centre


def robust_prune(v: np.ndarray, own: int, pool: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[int]:
    """Of a pool ordered by distance keep each candidate that no kept one is nearer to by the factor alpha."""
    near = np.sqrt(np.maximum(2 - 2 * (v[pool] @ v[own]), 0))
    between = np.sqrt(np.maximum(2 - 2 * (v[pool] @ v[pool].T), 0))
    open_, kept = np.ones(len(pool), bool), []
    for i in range(len(pool)):
        if open_[i]:
            kept.append(int(pool[i]))
            if len(kept) == degree:
                break
            open_ &= alpha * between[i] > near
    return kept


def pruned_lists(v: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Adjacency lists of the unit vectors of one shard."""
    n = len(v)
    out: list[set[int]] = []
    pool = min(POOL, n - 1)
    for a in range(0, n, 256):
        near = v[a : a + 256] @ v.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -2
        chosen = np.argpartition(-near, pool - 1, axis=1)[:, :pool] if pool else np.zeros((len(near), 0), int)
        chosen = np.take_along_axis(chosen, np.argsort(-np.take_along_axis(near, chosen, 1), 1, kind="stable"), 1)
        out += [set(robust_prune(v, a + i, row)) for i, row in enumerate(chosen)]
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(out):
        for j in row:
            back[j].append(i)
    lists = []
    for i in range(n):
        every = np.array(sorted(out[i] | set(back[i])), np.int64)
        if len(every) > 2 * DEGREE:
            every = every[np.argsort(-(v[every] @ v[i]), kind="stable")]
            every = np.array(robust_prune(v, i, every, 2 * DEGREE), np.int64)
        lists.append(np.union1d(every, rng.integers(0, n, min(RANDOM, n - 1))))
    return lists


def build(v: np.ndarray, seed: int, shard: int = SHARD) -> tuple[list[np.ndarray], np.ndarray]:
    """United adjacency lists of a block of unit vectors over its overlapping shards, and the shards' medoids."""
    n, rng = len(v), np.random.default_rng(seed)
    k = max(1, round(n / shard))
    if k == 1:
        shards = [np.arange(n)]
    else:
        some = v if n <= 20 * shard else v[rng.choice(n, 20 * shard, replace=False)]
        near = v @ centroids(some, k).T
        own = np.argpartition(-near, 1, axis=1)[:, :2]
        shards = [x for j in range(k) if len(x := np.flatnonzero((own == j).any(1)))]
    united: list[list[np.ndarray]] = [[] for _ in range(n)]
    medoids = []
    for members in shards:
        part = v[members]
        for i, row in zip(members.tolist(), pruned_lists(part, rng), strict=True):
            united[i].append(members[row])
        medoids.append(int(members[np.argmax(part @ part.mean(0))]))
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int64) for x in united], np.unique(np.array(medoids, np.int64))


class Graph:
    """A block's vectors with united adjacency lists padded to one width, and the medoids that searches start from."""

    def __init__(self, v: np.ndarray, lists: list[np.ndarray], medoids: np.ndarray):
        self.v, self.medoids = v, medoids
        width = max([len(x) for x in lists], default=0)
        self.next = np.full((len(v), max(width, 1)), len(v), np.int64)
        for i, x in enumerate(lists):
            self.next[i, : len(x)] = x

    def search(self, q: np.ndarray, least: float, beam: int) -> np.ndarray:
        """Vectors of similarity ``least`` or more, by beam search from the medoids and expansion in range."""
        n = len(self.v)
        near = np.full(n + 1, -2, np.float32)
        done, reached = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        seen = np.zeros(n + 1, bool)
        seen[n] = True  # what pads the lists
        known = self.medoids
        near[known] = self.v[known] @ q
        seen[known] = True
        while True:
            best = known if len(known) <= beam else known[np.argpartition(-near[known], beam - 1)[:beam]]
            front = best[~done[best]]
            if not len(front):
                front = known[(near[known] >= least) & ~done[known]]
                if not len(front):
                    return known[near[known] >= least]
            done[front] = True
            reached[:] = False
            reached[self.next[front]] = True
            fresh = np.flatnonzero(reached & ~seen)
            if len(fresh):
                seen[fresh] = True
                near[fresh] = self.v[fresh] @ q
                known = np.concatenate([known, fresh])


def audited_search(graph: Graph, queries: np.ndarray, least: float, seed: int) -> np.ndarray:
    """Matrix of query and vector in range; the beam widens until brute force agrees on the audited queries.

    What the audit finds short is answered by it; where no beam is wide enough, as some
    vectors are in nobody's list, the whole block is.
    """
    rng = np.random.default_rng(seed)
    # what is searched lies a little below the threshold, so that rounding cannot lose a pair; pairs are verified later
    least -= 1e-6
    some = rng.choice(len(queries), min(AUDITED, len(queries)), replace=False)
    truth = queries[some] @ graph.v.T >= least
    beam = BEAM
    while sum(len(graph.search(queries[i], least, beam)) for i in some) < RECALL * truth.sum():
        if beam >= len(graph.v):
            return queries @ graph.v.T >= least
        beam *= 2
    out = np.zeros((len(queries), len(graph.v)), bool)
    for i, q in enumerate(queries):
        out[i, graph.search(q, least, beam)] = True
    out[some] |= truth
    return out


def closed(found: np.ndarray, v: np.ndarray, least: float) -> np.ndarray:
    """Links of a block with those that a walk has missed between vectors that other links join: each joined set is compared with itself."""
    seen = ~found.any(1)
    for first in range(len(found)):
        if seen[first]:
            continue
        joined = np.zeros(len(found), bool)
        joined[first] = True
        front = np.array([first])
        while len(front):
            reached = found[front].any(0) & ~joined
            joined |= reached
            front = np.flatnonzero(reached)
        seen |= joined
        at = np.flatnonzero(joined)
        for a in range(0, len(at) if len(at) > 2 else 0, 2048):
            part = at[a : a + 2048]
            found[np.ix_(part, at)] |= v[part] @ v[at].T >= least - 1e-6
    np.fill_diagonal(found, False)
    return found


def _rows(table: pa.Table) -> dict[str, np.ndarray | list]:
    dim = len(table["vector"][0])
    flat = table["vector"].combine_chunks()
    vectors = np.asarray(flat.flatten(), np.float64).reshape(-1, dim)
    return {"id": np.asarray(table["class"]), "v": vectors, "size": np.asarray(table["size"]), "cells": np.array(table["cells"].to_pylist(), np.int64)}


def _linked(left: dict, right: dict, graph: Graph, cell: int, same: bool, least: float) -> pa.Table:
    """Verified links of the left rows in the graph of the right ones: how many each class has, and the least class they reach."""
    found = audited_search(graph, unit(left["v"]).astype(np.float32), least, cell & 0xFFFF)
    if same:
        found |= found.T
        np.fill_diagonal(found, False)
        found = closed(found, graph.v, least)
    i, j = np.nonzero(found)
    norms = [np.linalg.norm(s["v"], axis=1) for s in (left, right)]
    true = np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 16):
        x, y = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
        true[a : a + (1 << 16)] = np.einsum("ij,ij->i", left["v"][x], right["v"][y]) / (norms[0][x] * norms[1][y]) >= least
    i, j = i[true], j[true]
    common = np.full(len(i), np.iinfo(np.int64).max)
    for a in range(left["cells"].shape[1]):
        for b in range(right["cells"].shape[1]):
            both = left["cells"][i, a] == right["cells"][j, b]
            common[both] = np.minimum(common[both], left["cells"][i, a][both])
    here = common == cell
    i, j = i[here], j[here]
    links: dict[int, int] = {}
    sets = Sets()
    for ids, sizes, a, b in [(left["id"], right["size"], i, j)] + ([] if same else [(right["id"], left["size"], j, i)]):
        total = np.bincount(a, weights=sizes[b], minlength=len(ids)).astype(np.int64)
        for c, n in zip(ids.tolist(), total.tolist(), strict=True):
            if n:
                links[c] = links.get(c, 0) + n
    for c, d in zip(left["id"][i].tolist(), right["id"][j].tolist(), strict=True):
        sets.join(c, d)
    ids = sorted(links)
    return pa.table({"class": pa.array(ids, pa.int64()), "links": pa.array([links[c] for c in ids], pa.int64()), "root": pa.array([sets.find(c) for c in ids], pa.int64())})


def _graph_of(rows: dict, shard: int) -> Graph:
    v = unit(rows["v"]).astype(np.float32)
    return Graph(v, *build(v, int(rows["id"][0]) & 0xFFFF, shard))


def _search_cell(least: float, shard: int):
    """Build and walk the graph of a cell that is one block."""

    def run(table: pa.Table) -> pa.Table:
        rows = _rows(table.sort_by("class"))
        return _linked(rows, rows, _graph_of(rows, shard), table["cell"][0].as_py(), True, least)

    return run


def _build_block(shard: int):
    """The rows of a block with their adjacency lists, and which of them are medoids."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        rows = _rows(table)
        lists, medoids = build(unit(rows["v"]).astype(np.float32), int(rows["id"][0]) & 0xFFFF, shard)
        first = np.zeros(len(lists), bool)
        first[medoids] = True
        return table.append_column("near", pa.array([x.tolist() for x in lists], pa.list_(pa.int64()))).append_column("medoid", pa.array(first))

    return run


def _search_blocks(least: float):
    """Walk the graph of one block for the members of another, or of itself."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        lo, hi, cell = (table[c][0].as_py() for c in ("lo", "hi", "cell"))
        block = np.asarray(table["block"])
        sides = [table.filter(pa.array(block == b)) for b in (lo, hi)]
        if not len(sides[0]) or not len(sides[1]):
            return pa.table({"class": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        left, right = (_rows(s) for s in sides)
        lists = [np.array(x, np.int64) for x in sides[1]["near"].to_pylist()]
        graph = Graph(unit(right["v"]).astype(np.float32), lists, np.flatnonzero(np.asarray(sides[1]["medoid"])))
        return _linked(left, right, graph, cell, lo == hi, least)

    return run


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the key of their class (null: links with nothing), and the classes."""
    v = F.col("embedding").cast("array<double>")
    squares = F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x)
    sound = F.coalesce(F.col("label").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("embedding") > 0) & (squares > 0) & (squares < float("inf")), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), v.alias("vector"), sound.alias("sound"))
    rows = rows.withColumn("key", F.when(F.col("sound"), F.unhex(F.sha2(F.concat_ws("|", "label", F.col("vector").cast("string")), 256))))
    grouped = rows.where("key is not null").groupBy("key").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("size"), F.min("vec_id").alias("least"))
    return rows.select("vec_id", "key"), cut(grouped.withColumn("class", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")))


class Cells:
    """A tree of centroids of unit vectors of one length: cells of the first level, and of those that were cut again."""

    def __init__(self, first: np.ndarray):
        self.first, self.below = first, {}
        self._finish()

    def _finish(self) -> None:
        parts = [(self.below[j] if j in self.below else self.first[j : j + 1]) for j in range(len(self.first))]
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.leaves = np.concatenate(parts) if parts else self.first

    def cut(self, cell: int, centre: np.ndarray) -> None:
        self.below[cell] = centre
        self._finish()

    def near(self, v: np.ndarray, overlap: int) -> np.ndarray:
        """The nearest leaves of each vector below its nearest cells of the first level, nearest first; -1 where there are no more."""
        out = np.full((len(v), overlap), -1, np.int64)
        if not len(self.first):
            out[:, 0] = 0
            return out
        top = v @ self.first.T
        wide = min(overlap, top.shape[1])
        chosen = np.argsort(-top, axis=1, kind="stable")[:, :wide]
        if not self.below:
            out[:, :wide] = chosen
            return out
        for i, cells in enumerate(chosen.tolist()):
            leaf = np.concatenate([np.arange(self.starts[j], self.starts[j + 1]) for j in cells])
            order = leaf[np.argsort(-(self.leaves[leaf] @ v[i]), kind="stable")][:overlap]
            out[i, : len(order)] = order
        return out


def _vectors(table: pa.Table) -> np.ndarray:
    part = table["vector"].combine_chunks()
    return unit(np.asarray(part.flatten(), np.float64).reshape(len(table), -1))


def _cut_again(region: int, fan: int):
    """Centroids of a sample of one cell."""

    def run(table: pa.Table) -> pa.Table:
        centre = centroids(_vectors(table), min(fan, math.ceil(table["most"][0].as_py() / region)))
        return pa.table({"cell": pa.array([table["cell"][0].as_py()]), "centre": pa.array([centre.tolist()], pa.list_(pa.list_(pa.float64())))})

    return run


def fitted(classes: DataFrame, region: int) -> dict[int, Cells]:
    """The tree of each length of vectors, so that the largest label has cells of about ``region`` classes."""
    sizes = {r["dim"]: (r["most"], r["n"]) for r in classes.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count").alias("most"), F.sum("count").alias("n")).collect()}
    tree: dict[int, Cells] = {}
    for dim, (most, n) in sizes.items():
        region_of = max(region, math.ceil(n * dim * 8 / MOST_CENTRES))
        k = min(FAN, math.ceil(most / region_of))
        tree[dim] = Cells(np.zeros((0, dim)))
        if most <= 3 * region_of:
            continue  # overlapping cells would each hold nearly all
        rate = min(1.0, SAMPLE / n)
        drawn = classes.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("key"), F.lit(1 << 32)) < int(rate * (1 << 32)))).orderBy("key").limit(SAMPLE)
        tree[dim] = Cells(centroids(_vectors(drawn.select("vector").toArrow()), k))
        if most <= FAN * region_of:
            continue
        shared = tree[dim]

        def placed(batches, shared=shared):
            for batch in batches:
                if batch.num_rows:
                    cells = shared.near(_vectors(pa.Table.from_batches([batch])), 1)[:, 0]
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

        own = cut(classes.where(F.col("dim") == dim).select("key", "label", "vector").mapInArrow(tidy(placed), "key binary, label string, vector array<double>, cell bigint"))
        large = own.groupBy("label", "cell").count().groupBy("cell").agg(F.max("count").alias("most"), F.sum("count").alias("n")).where(F.col("most") > region_of)

        # SAMPLE vectors of each cell at most are expected in a task
        some = own.join(large, "cell").where(F.pmod(F.xxhash64("key"), F.lit(1 << 32)) < F.least(F.lit(1.0), SAMPLE / F.col("n")) * float(1 << 32))
        for row in some.select("cell", "most", "vector").groupBy("cell").applyInArrow(_cut_again(region_of, FAN), "cell bigint, centre array<array<double>>").collect():
            shared.cut(row["cell"], np.array(row["centre"]))
    return tree


def cell_overlap(classes: DataFrame, tree: dict[int, Cells], least: float) -> int:
    """How many nearest cells a class must be a member of, so that the links of ASKED classes lie in a cell.

    Where MOST_OVERLAP cells are not enough, twice as many are looked at, up to all of them.
    """
    most = MOST_OVERLAP
    while True:
        overlap, reached = cell_recall(classes, tree, least, most)
        if reached >= RECALL:
            return overlap
        if most >= max(len(c.leaves) for c in tree.values()):
            raise ValueError(f"only {reached:.4f} of the audited links lie in a cell")
        most *= 2


def cell_recall(classes: DataFrame, tree: dict[int, Cells], least: float, most: int = MOST_OVERLAP) -> tuple[int, float]:
    """The least overlap that is enough, else ``most``, and which share of the links of ASKED classes then lie in a cell."""
    asked = classes.orderBy(F.xxhash64("key"), "key").limit(ASKED).select("class", "label", "dim", "vector").toArrow()
    queries = {d: asked.filter(pa.array(np.asarray(asked["dim"]) == d)) for d in tree}
    told = {d: (np.asarray(t["class"]), np.array(t["label"].to_pylist(), object), _vectors(t), tree[d].near(_vectors(t), most)) for d, t in queries.items() if len(t)}
    shared = classes.sparkSession.sparkContext.broadcast((told, tree))  # ASKED rows and the centroids

    def run(batches):
        told, tree = shared.value
        total = np.zeros(most + 2, np.int64)
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for d, (ids, labels, v, cells) in told.items():
                part = pa.Table.from_batches([batch]).filter(pa.array(dims == d))
                if not len(part):
                    continue
                w, own = _vectors(part), np.array(part["label"].to_pylist(), object)
                i, j = np.nonzero((v @ w.T >= least) & (labels[:, None] == own[None, :]) & (ids[:, None] != np.asarray(part["class"])[None, :]))
                if not len(i):
                    continue
                theirs = tree[d].near(w[j], most)
                need = np.full(len(i), most + 1)
                for a in range(most):
                    for b in range(most):
                        both = (cells[i, a] == theirs[:, b]) & (cells[i, a] >= 0)
                        need[both] = np.minimum(need[both], max(a, b) + 1)
                total += np.bincount(need, minlength=most + 2)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total))), pa.array(total)], names=["need", "n"])

    found = {r["need"]: r["n"] for r in classes.select("class", "label", "dim", "vector").mapInArrow(tidy(run), "need bigint, n bigint").groupBy("need").agg(F.sum("n").alias("n")).collect()}
    every = sum(found.values())
    share = lambda o: sum(n for k, n in found.items() if k <= o) / every if every else 1.0
    overlap = next((o for o in range(OVERLAP, most) if share(o) >= RECALL), most)
    return overlap, share(overlap)


def assigned(classes: DataFrame, least: float, region: int) -> DataFrame:
    """One row for each class and cell that it is a member of."""
    kept = classes.select("class", "label", "dim", "vector", "size")
    tree = fitted(classes, region)
    if all(len(c.first) < 2 for c in tree.values()):
        return kept.withColumns({"cells": F.array(F.lit(0).cast("long")), "cell": F.lit(0).cast("long")})
    overlap = cell_overlap(classes, tree, least)
    shared = classes.sparkSession.sparkContext.broadcast(tree)  # MOST_CENTRES bytes at most

    def run(batches):
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            cells = np.zeros((batch.num_rows, overlap), np.int64)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                cells[at] = shared.value[d].near(_vectors(pa.Table.from_batches([batch]).take(pa.array(at))), overlap)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.tolist(), pa.list_(pa.int64()))], names=[*batch.schema.names, "cells"])

    out = kept.mapInArrow(tidy(run), "class bigint, label string, dim int, vector array<double>, size bigint, cells array<bigint>")
    # every class has as many places for cells as any other, so that they form a matrix; -1 is none
    return out.withColumn("cell", F.explode(F.filter("cells", lambda c: c >= 0)))


def near_duplicates(vectors: DataFrame, least: float = 0.98, region: int = REGION, most: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows, classes = classes_of(vectors)
    members = cut(assigned(classes, least, region))
    place = ["label", "dim", "cell"]
    columns = [*place, "block", "class", "vector", "size", "cells"]
    blocks = members.groupBy(*place).agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"))
    dealt = members.join(blocks, place).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    out = "class bigint, links bigint, root bigint"
    whole = dealt.where("blocks = 1").select(*columns).groupBy(*place).applyInArrow(_search_cell(least, shard), out)
    cells = dealt.where("blocks > 1").select(*columns, "blocks")
    graphs = cells.groupBy(*place, "block").applyInArrow(_build_block(shard), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.schema.fields) + ", near array<bigint>, medoid boolean")
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least(i, "block").alias("lo"), F.greatest(i, "block").alias("hi"))))
    tasks = graphs.withColumn("pair", pair).select(*columns, "near", "medoid", F.col("pair.lo").alias("lo"), F.col("pair.hi").alias("hi"))
    found = cut(whole.unionByName(tasks.groupBy(*place, "lo", "hi").applyInArrow(_search_blocks(least), out)))
    roots = connected_components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    of_class = classes.select("key", "class", "size", "least").join(counts, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least_id = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    told = of_class.join(least_id, "root").select("key", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    linked = rows.where("key is not null").join(told, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def measured_recall(vectors: DataFrame, result: DataFrame, least: float = 0.98, every: int = 20) -> float:
    """Share of the true links of every ``every``-th id that ``result`` counts; queries go in blocks against all rows."""
    v = F.col("embedding").cast("array<double>")
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda t, x: t + x * x))
    sound = vectors.where("label is not null and embedding is not null").select("vec_id", "label", v.alias("v")).withColumn("norm", norm(F.col("v"))).where("norm > 0")
    queries = sound.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("q"), "label", F.col("v").alias("w"), F.col("norm").alias("wn"))
    dot = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
    pairs = sound.join(queries, "label").where(F.col("q") != F.col("vec_id")).where(dot / (F.col("norm") * F.col("wn")) >= least)
    truth = pairs.groupBy(F.col("q").alias("vec_id")).agg(F.count("*").alias("true_links"))
    row = truth.join(result, "vec_id", "left").agg(F.sum("true_links").alias("t"), F.sum(F.least("true_links", F.coalesce("n_links", F.lit(0)))).alias("f")).first()
    return 1.0 if not row["t"] else row["f"] / row["t"]
