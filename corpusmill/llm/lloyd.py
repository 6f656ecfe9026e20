"""Exact integer k-means by dual-tree Lloyd rounds.

Vectors are turned into integers and put, in blocks of ``BLOCK`` rows as a task meets them,
into cover trees: a node's children are a net of its points at half its scale, each point
under the first net point that covers it.  The trees are written once to the shared folder.
In every round a small cover tree over the centroids meets every block's tree.  Pairs of
nodes are held by distance bounds: a centroid node goes when its least distance is beyond
the greatest distance to another; a node of vectors with one centroid left is assigned
whole; only pairs of leaves are compared, exactly, in 64-bit integers.  Bounds are widened
by more than rounding can spoil, so ties always reach the exact comparison, where the
smaller centroid number wins.

A round sends the count and the component sums of each centroid once from each task, and
the driver receives k centroids and no more.

Vectors that are null, of another length, or hold null, non-finite or (in integer form)
components beyond 2**27 are left out: squared distances would not fit a long.  Each row is
a vector of its own, repeated ids too; of equal hashes the smaller vector comes first.
Fewer rows than k give as many centroids as rows.  An empty table gives no rows.  Other
columns are not carried.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import drop_path, shared_path, tidy, written

BLOCK = 1024
LEAF = 16
LARGEST = 1 << 27
#: Widening of bounds against the rounding of distances, as a share of the largest norm.
SLACK = 1e-6


@dataclass
class CoverTree:
    """Nodes in breadth-first order over points in tree order; a node's centre is its first point."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # first child
    count: np.ndarray  # number of children, 0 of a leaf
    radius: np.ndarray

    FIELDS = (("start", "<i4"), ("end", "<i4"), ("first", "<i4"), ("count", "<i4"), ("radius", "<f8"))

    def packed(self) -> bytes:
        return b"".join(getattr(self, n).astype(t).tobytes() for n, t in self.FIELDS)

    @classmethod
    def unpacked(cls, data: bytes) -> CoverTree:
        n, at, found = len(data) // 24, 0, []
        for _, t in cls.FIELDS:
            found.append(np.frombuffer(data, t, n, at))
            at += n * np.dtype(t).itemsize
        return cls(np.zeros(0, np.int64), *found)


def squares(points: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs of a block's points, as floats."""
    x = points.astype(np.float64)
    norms = (x * x).sum(1)
    found = norms[:, None] + norms[None, :] - 2 * (x @ x.T)
    np.fill_diagonal(found, 0)
    return np.maximum(found, 0, out=found)


def cover_tree(points: np.ndarray, leaf: int) -> CoverTree:
    d2 = squares(points)
    order = np.arange(len(points))
    start, end, first, count, radius = [0], [len(points)], [], [], []
    node = 0
    while node < len(start):
        s, e = start[node], end[node]
        own = order[s:e]
        far = d2[own[0], own]
        r = float(np.sqrt(far.max()))
        radius.append(r)
        if e - s <= leaf or r == 0:
            first.append(0)
            count.append(0)
            node += 1
            continue
        scale = 4.0 ** (np.ceil(np.log2(r)) - 1)
        groups, rest, near = [], own, far <= scale
        while True:
            groups.append(rest[near])
            rest = rest[~near]
            if not len(rest):
                break
            near = d2[rest[0], rest] <= scale
        first.append(len(start))
        count.append(len(groups))
        order[s:e] = np.concatenate(groups)
        ends = s + np.cumsum([len(g) for g in groups])
        start += [s, *ends[:-1].tolist()]
        end += ends.tolist()
        node += 1
    return CoverTree(order, *(np.array(x) for x in (start, end, first, count)), np.array(radius))


class Centroids:
    """The tree over one round's centroids; equal ones count as the one of the smallest number."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.floats = values.astype(np.float64)
        self.tree = cover_tree(values, 1)
        n = len(self.tree.start)
        self.number = np.array([self.tree.order[self.tree.start[i] : self.tree.end[i]].min() for i in range(n)])
        self.centre = self.floats[self.tree.order[self.tree.start]]


def _children(tree: CoverTree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each child of the nodes: which of the nodes it comes from, and the child."""
    n = tree.count[nodes].astype(np.int64)
    which = np.repeat(np.arange(len(nodes)), n)
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return which, tree.first[nodes][which] + step


def _exact(vectors: np.ndarray, values: np.ndarray, point: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Squared distances of pairs, in 64-bit integers."""
    out = np.empty(len(point), np.int64)
    for i in range(0, len(point), 1 << 14):
        part = slice(i, i + (1 << 14))
        gap = vectors[point[part]] - values[number[part]]
        out[part] = np.einsum("ij,ij->i", gap, gap)
    return out


def nearest(tree: CoverTree, vectors: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, int]:
    """The centroid of each vector (in tree order), and how many pairs were compared exactly."""
    owner = np.full(len(vectors), -1, np.int64)
    floats = vectors.astype(np.float64)
    other = centroids.tree
    slack = SLACK * (1 + max(np.sqrt((floats * floats).sum(1)).max(), np.sqrt((centroids.floats**2).sum(1)).max()))
    q, r = np.zeros(1, np.int64), np.zeros(1, np.int64)
    points, numbers = [], []
    best = np.empty(len(tree.start))
    while len(q):
        gap = floats[tree.start[q]] - centroids.centre[r]
        d = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        best[q] = np.inf
        np.minimum.at(best, q, d + tree.radius[q])
        keep = d - tree.radius[q] - other.radius[r] <= best[q] + slack
        q, r = q[keep], r[keep]
        inner = (other.count[r] > 0) & (other.radius[r] > 0)
        left = np.bincount(q, minlength=len(tree.start))
        sole = (left[q] == 1) & ~inner
        for node, centroid in zip(q[sole].tolist(), r[sole].tolist(), strict=True):
            owner[tree.start[node] : tree.end[node]] = centroids.number[centroid]
        q, r, inner = q[~sole], r[~sole], inner[~sole]
        leaf = tree.count[q] == 0
        # a node of vectors stays while a node of centroids as wide as it, or any beside a leaf, can be opened
        wide = np.zeros(len(tree.start), bool)
        wide[q[inner & (leaf | (other.radius[r] >= tree.radius[q]))]] = True
        wide = wide[q]
        done = leaf & ~wide
        size = (tree.end - tree.start)[q[done]].astype(np.int64)
        if len(size):
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            points.append(np.repeat(tree.start[q[done]].astype(np.int64), size) + step)
            numbers.append(np.repeat(centroids.number[r[done]], size))
        opened = wide & inner
        which, child = _children(other, r[opened])
        split = ~wide & ~leaf
        from_, below = _children(tree, q[split])
        q, r = np.concatenate([q[wide & ~inner], q[opened][which], below]), np.concatenate([r[wide & ~inner], child, r[split][from_]])
    if not points:
        return owner, 0
    point, number = np.concatenate(points), np.concatenate(numbers)
    distance = _exact(vectors, centroids.values, point, number)
    ranked = np.lexsort((number, distance, point))
    point, number = point[ranked], number[ranked]
    head = np.r_[True, point[1:] != point[:-1]]
    owner[point[head]] = number[head]
    return owner, len(point)


def integers(frame: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): the kept vectors as integers, the floor of ``scale`` times each component."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * scale) < LARGEST, F.lit(False)) & ~F.isnan(x))
    return frame.where((F.size("embedding") == dims) & sound).select(F.col("vec_id").cast("long"), whole.cast("array<int>").alias("v"))


def blocks(rows: DataFrame, dims: int, block: int = BLOCK) -> DataFrame:
    """Cover trees over blocks of rows: (tree, ids, vectors), both in tree order."""

    def made(ids, vectors):
        ids, vectors = np.concatenate(ids), np.concatenate(vectors)
        tree = cover_tree(vectors, LEAF)
        data = [tree.packed(), vectors[tree.order].astype("<i4").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([data[0]], pa.binary()), pa.array([ids[tree.order].tolist()], pa.list_(pa.int64())), pa.array([data[1]], pa.binary())], names=["tree", "ids", "vectors"])

    def run(batches):
        ids, vectors, have = [], [], 0
        for batch in batches:
            column = batch.column("v")
            values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            at = 0
            while at < len(values):
                take = min(block - have, len(values) - at)
                ids.append(_objects(batch.column("vec_id").slice(at, take)))
                vectors.append(values[at : at + take].astype(np.int64))
                have, at = have + take, at + take
                if have == block:
                    yield made(ids, vectors)
                    ids, vectors, have = [], [], 0
        if have:
            yield made(ids, vectors)

    return rows.mapInArrow(tidy(run), "tree binary, ids array<bigint>, vectors binary")


def _objects(column: pa.Array) -> np.ndarray:
    """Ids, null ones included."""
    return np.array([*column.to_pylist(), None], object)[:-1]


def _read(batch: pa.RecordBatch, dims: int):
    for i in range(batch.num_rows):
        vectors = np.frombuffer(batch.column("vectors")[i].as_py(), "<i4").reshape(-1, dims).astype(np.int64)
        yield CoverTree.unpacked(batch.column("tree")[i].as_py()), batch.column("ids")[i].values, vectors


def moved(trees: DataFrame, values: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    k, dims = values.shape

    def run(batches):
        centroids = Centroids(values)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for tree, _, vectors in _read(batch, dims):
                owner, _ = nearest(tree, vectors, centroids)
                n += np.bincount(owner, minlength=k)
                for c in np.unique(owner).tolist():
                    sums[c] += vectors[owner == c].sum(0)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array(n[has]), pa.array(list(sums[has]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    # exact sums: one row of each centroid from each task, each of its components a decimal
    sent = trees.mapInArrow(tidy(run), "cluster int, n bigint, sums array<bigint>")
    spread = sent.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    totals = spread.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out = values.copy()
    for row in totals.collect():
        out[row["cluster"], row["at"]] = int(row["total"]) // row["n"]
    return out


def assigned(trees: DataFrame, values: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dims = values.shape[1]

    def run(batches):
        centroids = Centroids(values)
        for batch in batches:
            for tree, ids, vectors in _read(batch, dims):
                owner, _ = nearest(tree, vectors, centroids)
                distance = _exact(vectors, values, np.arange(len(vectors)), owner)
                yield pa.RecordBatch.from_arrays([ids, pa.array(owner, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return trees.mapInArrow(tidy(run), "vec_id bigint, cluster int, distance bigint")


def seeds(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The first centroids: the vectors with the k smallest hashes of seed and id, in that order."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select("v", hashed.alias("h")).orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def cluster(frame: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """Every kept vector with its cluster, squared distance, sums of distances and a digest of its final centroid."""
    spark = frame.sparkSession
    rows = integers(frame, dims, scale)
    values = seeds(rows, k, seed)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    path = shared_path(spark, "trees")
    trees = written(blocks(rows, dims, block), path)
    for _ in range(rounds):
        values = moved(trees, values)
    found = written(assigned(trees, values), shared_path(spark, "assigned"))
    drop_path(spark, path)
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in values.tolist()]
    told = [(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()]
    # k rows at most
    facts = F.broadcast(spark.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"))
    return found.join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
