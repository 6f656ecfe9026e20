"""Every registered query against its SQL, or at least to its end."""

import pytest

from corpusmill import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, sf, same, name):
    same(catalog.QUERIES[name](spark, sf), catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() >= 0


def test_every_sql_has_a_query():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() == 1
