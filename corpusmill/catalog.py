"""All registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import content, evaluation, hypertext, inference, preparation, ranking, search, stores, structure

_PLANS = (ranking, search, content, structure, hypertext, stores, evaluation, inference, preparation)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _plan in _PLANS:
    QUERIES |= _plan.QUERIES
    ORACLE_SQL |= _plan.ORACLE_SQL
