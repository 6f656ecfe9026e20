"""Differences of snapshots, merges, and history."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def diff(before: DataFrame, after: DataFrame, by: str = "revision", newer_only: bool = False) -> DataFrame:
    """(id, change, old and new columns) of a full outer join on id.

    ``by`` is what tells a modified entry: revision, else hash where both are known; or
    hash, else size (for media).  ``newer_only`` counts only larger revisions, as against
    a live listing.
    """
    old = before.select("id", *(F.col(c).alias(f"old_{c}") for c in before.columns if c != "id"), F.lit(True).alias("was"))
    new = after.select("id", *(F.col(c).alias(f"new_{c}") for c in after.columns if c != "id"), F.lit(True).alias("is"))
    both_hashed = F.col("old_hash").isNotNull() & F.col("new_hash").isNotNull() & (F.col("old_hash") != "") & (F.col("new_hash") != "")
    if by == "revision":
        moved = F.col("new_revision") > F.col("old_revision") if newer_only else ~F.col("new_revision").eqNullSafe(F.col("old_revision"))
        differs = moved | (both_hashed & (F.col("old_hash") != F.col("new_hash")))
    else:
        differs = F.when(both_hashed, F.col("old_hash") != F.col("new_hash")).otherwise(~F.col("old_size").eqNullSafe(F.col("new_size")))
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "deleted").when(F.coalesce(differs, F.lit(False)), "modified").otherwise("unchanged")
    return old.join(new, "id", "full_outer").withColumn("change", change).drop("was", "is")


def summary(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change").agg(F.count("*").alias("entries"))


def to_fetch(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("change").isin("added", "modified"))


def by_namespace(changes: DataFrame) -> DataFrame:
    """One row for each namespace, one count for each kind of change."""
    ns = F.coalesce("new_namespace", "old_namespace")
    return changes.groupBy(ns.alias("namespace")).pivot("change", ["added", "deleted", "modified", "unchanged"]).agg(F.count("id")).fillna(0)


def with_sizes(changes: DataFrame) -> DataFrame:
    """Size change, percent (0 where the old size is 0), and magnitude."""
    old, new = F.coalesce("old_size", F.lit(0)), F.coalesce("new_size", F.lit(0))
    percent = F.coalesce(F.try_divide((new - old) * F.lit(100.0), old), F.lit(0.0))
    return changes.withColumn("size_change", new - old).withColumn("percent", F.round(percent, 4)).withColumn("magnitude", size_magnitude(F.col("change"), percent))


def size_magnitude(change: Column, percent: Column) -> Column:
    return F.when(change.isin("added", "deleted"), "major").when(F.abs(percent) > 50, "rewrite").when(F.abs(percent) > 20, "major").otherwise("minor")


def age_magnitude(old: Column, new: Column) -> Column:
    """By the gap of two revisions in Unix seconds."""
    gap = new - old
    return F.when(gap < 86400, "minor").when(gap < 7 * 86400, "major").otherwise("rewrite")


def one_digit(value: Column) -> Column:
    """A number of at most four digits after the point to one, as C prints it: its exact value decides, and halves go to the even digit.

    Spark's own format rounds what is written, so 2481.25 gave 2481.3 and 0.15 (which is less) gave 0.2.
    """
    half = F.rint(value * 20)  # an odd one lies between two digits
    above = value * 16 - half + value * 4  # exact, as both products are
    up, down = (half + 1) / 2, (half - 1) / 2
    between = (F.pmod(half, F.lit(2.0)) == 1) & (F.abs(above) < 1e-3)
    tenths = F.when(~between, F.rint(value * 10)).when(above > 0, up).when(above < 0, down).when(F.pmod(up, F.lit(2.0)) == 0, up).otherwise(down)
    return F.format_string("%.1f", tenths / 10)


def sentence(changes: DataFrame) -> DataFrame:
    """What happened to a page, in words."""
    size, new, old = F.col("size_change"), F.coalesce("new_size", F.lit(0)), F.coalesce("old_size", F.lit(0))
    percent = one_digit(F.col("percent"))
    said = (
        F.when(F.col("change") == "added", F.format_string("New page (%d bytes)", new))
        .when(F.col("change") == "deleted", F.format_string("Page removed (was %d bytes)", old))
        .when((F.col("change") == "modified") & (size > 0), F.format_string("Content expanded (+%d bytes, %s%%)", size, percent))
        .when((F.col("change") == "modified") & (size < 0), F.format_string("Content reduced (%d bytes, %s%%)", size, percent))
        .when(F.col("change") == "modified", "Content modified (same size)")
        .otherwise("")
    )
    return changes.withColumn("summary", said)


def merge(base: DataFrame, other: DataFrame, overwrite: bool = True) -> DataFrame:
    """Union by id; of entries in both the other's stays, or the base's."""
    order = Window.partitionBy("id").orderBy(F.col("priority"))
    every = base.withColumn("priority", F.lit(1)).unionByName(other.withColumn("priority", F.lit(0 if overwrite else 2)))
    return every.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n", "priority")


def carry_forward(before: DataFrame, fetched: DataFrame, changes: DataFrame) -> DataFrame:
    """Unchanged entries of the old snapshot, the fetched ones, and the gone ones marked deleted."""
    kept = before.join(changes.where("change = 'unchanged'").select("id"), "id", "left_semi").withColumn("status", F.lit("active"))
    gone = before.join(changes.where("change = 'deleted'").select("id"), "id", "left_semi").withColumn("status", F.lit("deleted"))
    return kept.unionByName(fetched.withColumn("status", F.lit("active"))).unionByName(gone)


def remove(base: DataFrame, ids: DataFrame) -> DataFrame:
    return base.join(ids.select("id"), "id", "left_anti")


def mark_deleted(base: DataFrame, ids: DataFrame) -> DataFrame:
    gone = ids.select("id").distinct().withColumn("gone", F.lit(True))
    return base.join(gone, "id", "left").withColumn("status", F.when(F.col("gone"), "deleted").otherwise(F.col("status"))).drop("gone")


def problems(entries: DataFrame, required: tuple[str, ...] = ("id", "hash", "namespace")) -> DataFrame:
    """(id, problem): missing fields and repeated ids."""
    missing = F.array_compact(F.array(*(F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"missing {c}")) for c in required)))
    first = entries.select("id", F.explode(missing).alias("problem"))
    return first.unionByName(entries.groupBy("id").count().where("count > 1").select("id", F.lit("repeated id").alias("problem")))


def first_seen(entries: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of each key."""
    return entries.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("n = 1").drop("n")


def keep_history(history: DataFrame, most: int, days: int, as_of: Column) -> DataFrame:
    """Newest entries first, at most so many, none older than so many days."""
    recent = history.where(F.datediff(as_of, "at") <= days)
    return recent.orderBy(F.desc("at"), "entry_id").limit(most)


def any_newer(listing: DataFrame, known: DataFrame) -> DataFrame:
    """One row: is there a revision after the latest known one (true where none is known)?"""
    last = known.agg(F.max("revision").alias("last"))
    newest = listing.agg(F.max("revision").alias("newest"))
    return newest.crossJoin(last).select(F.coalesce(F.col("newest") > F.col("last"), F.lit(True)).alias("changed"))


def _lines(text: str) -> list[str]:
    """Lines with their ends, as a text file gives them."""
    return re.findall("[^\\n]*\\n|[^\\n]+", text.replace("\r\n", "\n").replace("\r", "\n"))


@F.pandas_udf(T.StructType([T.StructField("added", T.LongType()), T.StructField("removed", T.LongType())]))
def _edited(old: pd.Series, new: pd.Series) -> pd.DataFrame:
    counts = []
    for a, b in zip(old, new, strict=True):
        a, b = _lines(a or ""), _lines(b or "")
        added = removed = 0
        for kind, i, j, k, m in SequenceMatcher(None, a, b).get_opcodes():
            if kind != "equal":
                # lines that would look like the head of a file are not counted
                removed += sum(not x.startswith("--") for x in a[i:j])
                added += sum(not x.startswith("++") for x in b[k:m])
        counts.append((added, removed))
    return pd.DataFrame(counts, columns=["added", "removed"])


def line_changes(pairs: DataFrame) -> DataFrame:
    """(id, added, removed, changed) lines of texts (id, old, new), in their order; only texts that differ go to Python."""
    same = pairs.where(F.col("old").eqNullSafe(F.col("new"))).select("id", F.lit(0).cast("long").alias("added"), F.lit(0).cast("long").alias("removed"))
    edited = pairs.where(~F.col("old").eqNullSafe(F.col("new"))).select("id", _edited("old", "new").alias("d")).select("id", "d.added", "d.removed")
    return same.unionByName(edited).withColumn("changed", F.least("added", "removed"))


def namespace_list(entries: DataFrame) -> DataFrame:
    """Distinct namespaces of a snapshot."""
    return entries.select("namespace").where("namespace is not null").distinct()


def selected(entries: DataFrame, namespace: str | None = None, status: str | None = None, extension: str | None = None) -> DataFrame:
    """Entries of a namespace or below it, of a status, of a file suffix."""
    if namespace is not None:
        entries = entries.where((F.col("namespace") == namespace) | F.col("namespace").startswith(namespace + ":"))
    if status is not None:
        entries = entries.where(F.col("status") == status)
    if extension is not None:
        entries = entries.where(F.lower(F.substring_index("id", ".", -1)) == extension.lower().lstrip("."))
    return entries


def expired(history: DataFrame, days: int, as_of: Column) -> DataFrame:
    """One row: how many entries a cleanup would take away."""
    return history.agg(F.count_if(F.datediff(as_of, "at") > days).alias("expired"))


def incremental(before: DataFrame, listing: DataFrame, fetch) -> DataFrame:
    """The next snapshot: changes against a listing, ``fetch`` of what is new or modified, the rest carried or marked deleted.

    ``fetch`` turns entries to fetch into fetched ones of the same columns; without changes nothing is fetched.
    """
    changes = diff(before, listing, newer_only=True)
    wanted = listing.join(to_fetch(changes).select("id"), "id", "left_semi")
    return carry_forward(before, fetch(wanted).select(*before.columns), changes)


def change_report(before: DataFrame, after: DataFrame) -> dict[str, DataFrame]:
    """The parts of a report of changes: totals, changes by namespace, and every changed entry with its size and sentence."""
    changes = diff(before, after)
    told = sentence(with_sizes(changes)).where("change <> 'unchanged'").select("id", "change", "size_change", "percent", "magnitude", "summary")
    return {"Totals": summary(changes), "Namespaces": by_namespace(changes), "Changes": told.orderBy("id")}
