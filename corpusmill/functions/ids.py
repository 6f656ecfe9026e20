"""Page and media identifiers ``ns:sub:page`` and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def top_namespace(page_id: Column, otherwise: str = "root") -> Column:
    """First segment, or ``otherwise`` where there is no colon."""
    return F.when(F.contains(page_id, F.lit(":")), F.substring_index(page_id, ":", 1)).otherwise(F.lit(otherwise))


def parent_namespace(page_id: Column) -> Column:
    """All but the last segment; empty where there is none."""
    return F.when(F.contains(page_id, F.lit(":")), F.regexp_replace(page_id, ":[^:]*$", "")).otherwise(F.lit(""))


def depth(page_id: Column) -> Column:
    return (F.length(page_id) - F.length(F.replace(page_id, F.lit(":"), F.lit("")))).cast("long")


def prefixes(page_id: Column, most: int) -> Column:
    """The namespaces above a page, down to a depth of ``most``."""
    parts = F.split(parent_namespace(page_id), ":")
    levels = F.sequence(F.lit(1), F.least(F.size(parts), F.lit(most)))
    return F.when(parent_namespace(page_id) == "", F.array().cast("array<string>")).otherwise(F.transform(levels, lambda n: F.array_join(F.slice(parts, 1, n), ":")))


def extension(name: Column) -> Column:
    """Lower-case suffix after the last dot; empty without a dot."""
    return F.when(F.contains(name, F.lit(".")), F.lower(F.substring_index(name, ".", -1))).otherwise(F.lit(""))


def file_to_page(name: Column) -> Column:
    """Page id of an exported file: suffix off, underscores to colons."""
    return F.translate(F.regexp_replace(name, r"\.(txt|md)$", ""), "_", ":")


def page_to_file(page_id: Column) -> Column:
    return F.translate(page_id, ":/", "__")


def sanitized(name: Column) -> Column:
    """An identifier as a file name: colons and both slashes become underscores."""
    return F.translate(name, ":/\\", "___")


def content_hash(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def _two_digits(size: Column, power: int) -> Column:
    """size / 1024 ** power with two decimals; whole numbers are divided exactly, halves go to the even digit."""
    hundred, unit = size.cast("decimal(28,0)") * 100, F.lit(1024**power).cast("decimal(20,0)")
    rest = hundred % unit
    whole = ((hundred - rest) / unit).cast("decimal(28,0)")
    up = (rest * 2 > unit) | ((rest * 2 == unit) & (whole % 2 == 1))
    whole = (whole + F.when(up, 1).otherwise(0)).cast("decimal(28,0)")
    return F.concat(F.floor(whole / 100).cast("string"), F.lit("."), F.lpad((whole % 100).cast("int").cast("string"), 2, "0"))


def human_bytes(size: Column) -> Column:
    """Whole bytes in the largest unit below 1024 of it, with two decimals."""
    out = F.concat(_two_digits(size, 4), F.lit(" TB"))
    for power, unit in ((3, " GB"), (2, " MB"), (1, " KB"), (0, " B")):
        out = F.when(size < 1024 ** (power + 1), F.concat(_two_digits(size, power), F.lit(unit))).otherwise(out)
    return out


#: What shows that an id is an address or a query: a script, marks of a query, what follows a scheme.
NO_MEDIA = r"doku\.php|[?=]|//"


def valid_media(media_id: Column) -> Column:
    """Not empty, no address or query, and a dot in the last segment."""
    return F.coalesce((media_id != "") & ~media_id.rlike(NO_MEDIA) & F.contains(F.substring_index(media_id, ":", -1), F.lit(".")), F.lit(False))


def in_namespaces(namespace: Column, names: list[str]) -> Column:
    """Equal to a name or below it."""
    found = F.lit(False)
    for n in names:
        found = found | (namespace == n) | namespace.startswith(n + ":")
    return found


def included(namespace: Column, include: list[str], exclude: list[str]) -> Column:
    """Exclusion wins; without inclusions all others pass."""
    inside = in_namespaces(namespace, include) if include else F.lit(True)
    return inside & ~in_namespaces(namespace, exclude)
