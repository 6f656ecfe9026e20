"""Freshness scales. Age is counted from ``as_of``, never from the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import tiers


def age_days(modified: Column, as_of: Column) -> Column:
    """Age in days and fractions."""
    return (F.unix_seconds(as_of) - F.unix_seconds(modified)) / F.lit(86400.0)


def whole_days(modified: Column, as_of: Column) -> Column:
    return F.floor(age_days(modified, as_of))


def by_steps(age: Column) -> Column:
    """Page quality: 30, 180, 365 and 730 days; unknown 0.5."""
    return F.when(age.isNull(), 0.5).otherwise(tiers(age, [(30, 1.0), (180, 0.8), (365, 0.6), (730, 0.4)], 0.2))


def linear_score(days: Column, archived: Column, newest_year: Column, year: int) -> Column:
    """1 to 0.7 between 90 and 365 days, to 0.4 at 730, then 0.3; years where no date is known."""
    dated = F.when(days <= 90, 1.0).when(days <= 365, 1.0 - (days - 90) / 275.0 * 0.3).when(days <= 730, 0.7 - (days - 365) / 365.0 * 0.3).otherwise(0.3)
    years = F.when(newest_year >= year, 0.8).when(newest_year >= year - 1, 0.6).when(newest_year.isNotNull(), 0.4).otherwise(0.5)
    return F.when(archived, 0.3).when(days.isNotNull(), dated).otherwise(years)


def linear_category(days: Column, archived: Column, newest_year: Column, year: int) -> Column:
    dated = F.when(days <= 90, "current").when(days <= 365, "recent").otherwise("outdated")
    years = F.when(newest_year >= year, "current").when(newest_year >= year - 1, "recent").when(newest_year.isNotNull(), "outdated").otherwise("unknown")
    return F.when(archived, "archived").when(days.isNotNull(), dated).otherwise(years)


def loose_score(days: Column, namespace: Column) -> Column:
    """90, 365, 730 and 1460 days; archive namespaces 0.2, unknown 0.5."""
    steps = tiers(days, [(90, 1.0), (365, 0.85), (730, 0.7), (1460, 0.5)], 0.3)
    return F.when(F.lower(F.trim(namespace)).startswith("archive"), 0.2).when(days.isNull(), 0.5).otherwise(steps)


def loose_category(days: Column, namespace: Column) -> Column:
    steps = tiers(days, [(365, "fresh"), (730, "recent"), (1460, "outdated")], "stale")
    return F.when(F.lower(F.trim(namespace)).startswith("archive"), "archived").when(days.isNull(), "unknown").otherwise(steps)


def plain_category(days: Column) -> Column:
    return F.when(days.isNull(), "unknown").otherwise(tiers(days, [(365, "fresh"), (730, "recent"), (1460, "outdated")], "archived"))


# Weight of each freshness category.
WEIGHTS = {"current": 1.0, "recent": 0.9, "outdated": 0.7, "archived": 0.5, "unknown": 0.5}


def rag_weight(category: Column, archived: Column, outdated_years: Column) -> Column:
    base = F.lit(0.5)
    for name, weight in WEIGHTS.items():
        base = F.when(category == name, weight).otherwise(base)
    base = F.when(archived, F.least(base, F.lit(WEIGHTS["archived"]))).otherwise(base)
    return F.round(F.when(outdated_years, base * 0.9).otherwise(base), 2)


def years(text: Column) -> Column:
    """Distinct years 2000 to 2099, ascending."""
    found = F.regexp_extract_all(text, F.lit(r"\b20[0-9]{2}\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda y: y.cast("int"))))


def has_outdated(found: Column, year: int) -> Column:
    return F.exists(found, lambda y: y < year - 2)


def first_time(fields: list[Column]) -> Column:
    """The first of several fields that holds a time."""
    return F.coalesce(*(parsed_time(f) for f in fields))


#: Names that a time of change goes by, in the order that they are looked at.
TIME_FIELDS = ("last_modified", "lastModified", "modified", "date")


def parsed_time(raw: Column) -> Column:
    """ISO date or time, ``dd.mm.yyyy``, or Unix seconds."""
    iso = F.try_to_timestamp(F.regexp_replace(raw, "(Z|[+-][0-9]{2}:?[0-9]{2})$", ""))
    local = F.try_to_timestamp(raw, F.lit("dd.MM.yyyy"))
    return F.coalesce(iso, local, F.timestamp_seconds(F.expr("NULL").cast("long") if raw is None else raw.try_cast("long")))
