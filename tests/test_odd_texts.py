"""Queries against their SQL on documents with little or nothing in them."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import chunks, scores
from corpusmill.plans import evaluation

TEXTS = ("", " ", "**", "//", "[[", "\n", "\n\n", " \n ", "A", "A.", "two\nlines", "a b. c d")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder of documents, each text with and without every part that pages add, and DuckDB over it."""
    import duckdb

    path = str(tmp_path_factory.mktemp("odd"))
    rows = [(i * 420 + j, t, "en", "web", len(t)) for i, t in enumerate(TEXTS) for j in range(420)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    return path, con


def equal(spark, odd, name):
    path, con = odd
    found = evaluation.QUERIES[name](spark, path)
    told = con.execute(evaluation.ORACLE_SQL[name])
    columns = [d[0] for d in told.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(told.fetchall())


def test_tables_of_pages_that_are_headings_only(spark, odd):
    assert chunks.by_table("== A ==\n\n") == ["== A =="] and chunks.by_table("# A\n\n# B\n") == ["# A\n\n# B"]
    equal(spark, odd, "chunk_table")


def test_scores_of_pages_of_nothing_but_markup(spark, odd):
    rows = spark.createDataFrame([("** **", "x"), ("a", "a")], "source string, result string")
    assert [r[0] for r in rows.select(scores.completeness(F.col("source"), F.col("result"))).collect()] == [0.0, 1.0]
    equal(spark, odd, "doc_scores")
