import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    made = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    made.sparkContext.setLogLevel("OFF")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return float(value) if hasattr(value, "as_tuple") else value


@pytest.fixture(scope="session")
def same(duck):
    """Do a frame and a SQL text have the same columns and rows?"""

    def check(frame, sql):
        columns = sorted(frame.columns)
        ours = sorted(str([plain(r[c]) for c in columns]) for r in frame.collect())
        query = duck.execute(sql)
        names = [d[0] for d in query.description]
        theirs = sorted(str([plain(dict(zip(names, r, strict=True))[c]) for c in columns]) for r in query.fetchall())
        assert sorted(names) == columns
        assert ours == theirs

    return check
