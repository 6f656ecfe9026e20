"""Connected components of an edge table.

Partitions first reduce their own edges to spanning stars.  Then large-star and
small-star steps alternate (Kiveris et al., 2014): every node's larger neighbours, then
its smaller ones, are linked to the least of its neighbourhood, until nothing changes.
Nothing but a count and a checksum of the edges comes to the driver; the minimum of a
hot node is summed before the shuffle, and the join back to it may be split by Spark.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut, tidy


class Sets:
    """Disjoint sets of integers; the root is the least member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, a: int) -> int:
        up = self.up
        root = a
        while (n := up.get(root, root)) != root:
            root = n
        while a != root:
            up[a], a = root, up.get(a, a)
        return root

    def join(self, a: int, b: int) -> int:
        a, b = self.find(a), self.find(b)
        if a > b:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return a


def _stars(batches):
    """Spanning stars of the edges of a partition, taken a bounded run of batches at a time."""
    sets, held = Sets(), 0

    def out():
        nodes = [n for n in sets.up if sets.find(n) != n]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([sets.find(n) for n in nodes], pa.int64())], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            sets.join(a, b)
        held += batch.num_rows
        if held > 2_000_000:
            yield from out()
            sets, held = Sets(), 0
    yield from out()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), root being the least node that it is linked to.

    Nulls and loops are no edges; a node without other edges is left out.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v and a is not null and b is not null")
    now = cut(pairs.mapInArrow(tidy(_stars), "u bigint, v bigint").distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = cut(linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        mark, before = _mark(after), mark
        now = after
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

