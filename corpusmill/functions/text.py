"""Text measures. White space is that of the regex class \\s with Unicode off, which DuckDB shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: White space as texts outside ASCII have it, with what separates records and no-break spaces.
WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Runs of visible characters."""
    return F.regexp_extract_all(text, F.lit(r"[^\s]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def count_literal(text: Column, literal: str) -> Column:
    """Occurrences of a literal that do not overlap, found from the left."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / len(literal)).cast("long")


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def matched_chars(text: Column, pattern: str) -> Column:
    """Characters in matches of a pattern: what taking them away leaves less."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text, "\n\n"), strip), lambda p: p != "")


def share(part: Column, whole: Column, otherwise: float = 0.0) -> Column:
    """part / whole, or ``otherwise`` where the whole is empty."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(otherwise))


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def tiers(value: Column, steps: list[tuple[float, object]], otherwise: object) -> Column:
    """The result of the first step whose bound is above the value."""
    out = F.lit(None)
    first = True
    for bound, result in steps:
        out = F.when(value < bound, F.lit(result)) if first else out.when(value < bound, F.lit(result))
        first = False
    return out.otherwise(F.lit(otherwise))
