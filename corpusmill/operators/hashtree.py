"""Where two copies of a table differ, from trees of sums over ranges of their keys' tokens.

A key's token is the first 32 bits of a digest, so both copies cut the same ranges without
telling each other anything, and ranges hold about equal shares whatever the keys are.  The
lowest nodes hold the number and the sum of their rows' hashes, every node above those of
its children.  The trees are written beside the copies, by level; a comparison starts at
the top and reads of each level only the children of nodes that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a token that each level tells further, and levels below the top.
STEP, LEVELS = 4, 4


def token(key: Column) -> Column:
    """32 bits of a key's digest, as a whole number; a null key has the token of nothing."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def _row_hash(table: DataFrame) -> Column:
    return F.xxhash64(*(F.col(c) for c in sorted(table.columns))).cast("decimal(38,0)")


def build(table: DataFrame, key: str, path: str, levels: int = LEVELS) -> None:
    """Write the tree of a table: (level, node, rows, total), a folder for each level."""
    leaf = F.shiftright(token(F.col(key)), 32 - STEP * levels)
    nodes = table.groupBy(leaf.alias("node")).agg(F.count("*").alias("rows"), F.sum(_row_hash(table)).alias("total"))
    spark = table.sparkSession
    nodes.write.parquet(f"{path}/level={levels}")
    for level in range(levels - 1, -1, -1):
        below = spark.read.parquet(f"{path}/level={level + 1}")
        above = below.groupBy(F.shiftright("node", STEP).alias("node")).agg(F.sum("rows").alias("rows"), F.sum("total").cast("decimal(38,0)").alias("total"))
        above.write.parquet(f"{path}/level={level}")


def _levels(spark: SparkSession, path: str, level: int, among: DataFrame | None) -> DataFrame:
    nodes = spark.read.parquet(f"{path}/level={level}")
    return nodes if among is None else nodes.join(among, F.shiftright(nodes["node"], STEP) == among["parent"], "left_semi")


def differing(spark: SparkSession, here: str, there: str, levels: int = LEVELS) -> DataFrame:
    """(node, first_token, last_token, rows_here, rows_there) of the lowest nodes whose sums differ.

    The descent ends where a level has no difference.
    """
    among = found = None
    for level in range(levels + 1):
        a, b = (_levels(spark, p, level, among).select("node", F.col("rows").alias(f"rows_{s}"), F.col("total").alias(f"total_{s}")) for p, s in ((here, "here"), (there, "there")))
        both = a.join(b, "node", "full_outer")
        same = F.col("total_here").eqNullSafe(F.col("total_there")) & F.col("rows_here").eqNullSafe(F.col("rows_there"))
        found = both.where(~same)
        if level < levels:
            among = found.select(F.col("node").alias("parent"))
    width = 1 << (32 - STEP * levels)
    first = F.col("node") * F.lit(width).cast("long")
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.select("node", first.alias("first_token"), (first + width - 1).alias("last_token"), none("rows_here"), none("rows_there"))


def rows_that_differ(here: DataFrame, there: DataFrame, key: str, ranges: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(key, state) of the rows of differing ranges: missing on a side, or of other content.

    Only rows of these ranges are moved.  Rows that repeat a key are compared by their number and sum.
    """

    def sums(table: DataFrame, side: str) -> DataFrame:
        node = F.shiftright(token(F.col(key)), 32 - STEP * levels)
        rows = table.select(F.col(key), _row_hash(table).alias("h"), node.alias("node")).join(ranges.select("node"), "node", "left_semi")
        return rows.groupBy(key).agg(F.sum("h").alias(side), F.count("*").alias(f"n_{side}"))

    a, b = sums(here, "here"), sums(there, "there")
    both = a.join(b.withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key")), "full_outer")
    state = F.when(F.col("n_there").isNull(), "missing there").when(F.col("n_here").isNull(), "missing here").when((F.col("here") != F.col("there")) | (F.col("n_here") != F.col("n_there")), "differs")
    return both.select(F.coalesce(key, "__key").alias(key), state.alias("state")).where("state is not null")
