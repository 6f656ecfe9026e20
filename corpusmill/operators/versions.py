"""History with time travel: every version of an entry with the time from which and until which it held.

``intervals`` turns changes (id, at, seq, op, ...) into versions; ``as_of`` is then a filter
on two columns, which a scan can push down, instead of a replay.  Changes of one id are
chained inside months and between months by the first change of the next one, so an id
with very many changes is not one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DELETE = "delete"


def _month(at: Column) -> Column:
    return F.trunc(at, "month")


def intervals(changes: DataFrame) -> DataFrame:
    """Input columns with valid_from and valid_to (null of the latest).

    ``at`` is a time, ``seq`` a whole number that orders changes of one time; ``op`` tells a
    deletion.  A change that another of the same time follows holds for no time at all.
    Rows without id or time are left out.
    """
    rows = changes.where("id is not null and at is not null").withColumn("__month", _month(F.col("at")))
    first = rows.groupBy("id", "__month").agg(F.min("at").alias("__first"))
    months = Window.partitionBy("id").orderBy("__month")
    following = first.select("id", "__month", F.lead("__first").over(months).alias("__next"))
    inside = Window.partitionBy("id", "__month").orderBy("at", "seq")
    chained = rows.withColumn("__after", F.lead("at").over(inside)).join(following, ["id", "__month"])
    to = F.coalesce("__after", "__next")
    return chained.withColumns({"valid_from": F.col("at"), "valid_to": to}).drop("__month", "__after", "__next")


def as_of(versions: DataFrame, time: Column) -> DataFrame:
    """The versions that hold at a time; deleted entries are gone."""
    holds = (F.col("valid_from") <= time) & (F.col("valid_to").isNull() | (F.col("valid_to") > time))
    return versions.where(holds & (F.col("op") != DELETE))


def latest(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("valid_to").isNull() & (F.col("op") != DELETE))


def of_id(versions: DataFrame, name: str) -> DataFrame:
    """All versions of an entry, newest first."""
    return versions.where(F.col("id") == name).orderBy(F.desc("valid_from"), F.desc("seq"))


def extended(versions: DataFrame, changes: DataFrame) -> DataFrame:
    """Versions with later or earlier changes worked in; ids without a change are carried as they are."""
    touched = changes.select("id").where("id is not null").distinct()
    again = versions.join(touched, "id", "left_semi").drop("valid_from", "valid_to").unionByName(changes)
    return versions.join(touched, "id", "left_anti").unionByName(intervals(again))


def replay(changes: DataFrame, time: Column) -> DataFrame:
    """The same state by replaying all changes up to a time: the last of each id."""
    rest = [c for c in changes.columns if c != "id"]
    last = changes.where((F.col("at") <= time) & F.col("id").isNotNull()).groupBy("id").agg(F.max_by(F.struct(*rest), F.struct("at", "seq")).alias("row"))
    return last.select("id", "row.*").where(F.col("op") != DELETE)


def kept(entries: DataFrame, most: int, days: int, as_of: Column) -> DataFrame:
    """Fetch entries (entry_id, at, ...) newest first, at most so many, none older than so many whole days; unreadable times go."""
    at = F.col("at").try_cast("timestamp")
    age = F.floor((F.unix_seconds(as_of) - F.unix_seconds(at)) / 86400)
    newest = entries.orderBy(F.desc(at), F.desc("entry_id")).limit(most)
    return newest.where(at.isNotNull() & (age <= days))
