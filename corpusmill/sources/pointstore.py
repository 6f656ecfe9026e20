"""Collections of points that take upserts at the cost of the change: merged when they are read.

A collection is a log of entries, each one file that names a table: a base, or a delta of
points put and ids dropped since.  An upsert of n points writes n rows and one entry; a
reader takes the last base, leaves out the ids that later deltas hold, and adds these
deltas' latest points.  Compaction writes what a reader sees as a new base.  Entries are
created, never changed: of two writers one takes the next number and the other the one
after it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def entries(spark: SparkSession, path: str) -> list[dict]:
    """The log in its order."""
    store, log = _folder(spark, f"{path}/log")
    if not store.exists(log):
        return []
    found = []
    for status in store.listStatus(log):
        stream = store.open(status.getPath())
        try:
            found.append(json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()
    return sorted(found, key=lambda e: e["number"])


def _commit(spark: SparkSession, path: str, kind: str, data: str) -> int:
    """Append an entry under the next free number."""
    number = max((e["number"] for e in entries(spark, path)), default=0)
    while True:
        number += 1
        store, where = _folder(spark, f"{path}/log/{number:012d}.json")
        try:
            out = store.create(where, False)
        except Exception as error:  # another writer has taken the number
            if "FileAlreadyExists" in str(error) or "already exists" in str(error):
                continue
            raise
        try:
            out.write(bytearray(json.dumps({"number": number, "kind": kind, "data": data}).encode()))
        finally:
            out.close()
        return number


def _write(rows: DataFrame, path: str, kind: str) -> int:
    data = f"data/{kind}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{data}")
    return _commit(rows.sparkSession, path, kind, data)


def _latest(rows: DataFrame, *order) -> DataFrame:
    """One row for each id: the greatest by the given columns, then by all others."""
    rest = [c for c in rows.columns if c != "id"]
    told = rows.groupBy("id").agg(F.max_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest))).alias("row"))
    return told.select("id", "row.*")


def upsert(points: DataFrame, path: str) -> int:
    """Put points (id, ...): n rows are written, whatever the collection holds.  Gives the entry's number.

    Of rows of one id in a batch one is taken, the same whenever the batch is the same.
    Rows without an id are left out.
    """
    rows = _latest(points.where("id is not null"))
    return _write(rows.withColumn("__dropped", F.lit(False)), path, "delta")


def drop(ids: DataFrame, path: str) -> int:
    """Take points away by id: a tombstone for each."""
    blank = [F.lit(None).cast(kind).alias(c) for c, kind in _types(ids.sparkSession, path).items() if c != "id"]
    rows = ids.where("id is not null").select("id").distinct()
    return _write(rows.select("id", *blank, F.lit(True).alias("__dropped")), path, "delta")


def recreate(points: DataFrame, path: str) -> int:
    """Start the collection anew with these points."""
    return _write(_latest(points.where("id is not null")), path, "base")


def _types(spark: SparkSession, path: str) -> dict[str, str]:
    log = entries(spark, path)
    if not log:
        raise ValueError(f"no collection at {path}")
    found = spark.read.parquet(f"{path}/{log[0]['data']}").drop("__dropped")
    return dict(found.dtypes)


def current(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The points as the log tells them, up to an entry where one is named."""
    log = [e for e in entries(spark, path) if number is None or e["number"] <= number]
    if not log:
        raise ValueError(f"no collection at {path}")
    last = max((i for i, e in enumerate(log) if e["kind"] == "base"), default=-1)
    base = spark.read.parquet(f"{path}/{log[last]['data']}") if last >= 0 else None
    deltas = log[last + 1 :]
    if not deltas:
        return base
    rows = None
    for e in deltas:
        one = spark.read.parquet(f"{path}/{e['data']}").withColumn("__number", F.lit(e["number"]))
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    newest = _latest(rows, "__number")
    put = newest.where("not __dropped").drop("__dropped", "__number")
    # only ids that a delta holds are looked for among the base's
    return put if base is None else base.join(newest.select("id"), "id", "left_anti").unionByName(put, allowMissingColumns=True)


def compact(spark: SparkSession, path: str) -> int:
    """What a reader sees as a new base.  An upsert that commits meanwhile is behind it and stays."""
    log = entries(spark, path)
    upto = log[-1]["number"]
    data = f"data/base-{uuid.uuid4().hex}"
    current(spark, path, upto).write.parquet(f"{path}/{data}")
    after = [e for e in entries(spark, path) if e["number"] > upto]
    number = _commit(spark, path, "base", data)
    for e in after:
        # told again behind the base, in their order; points are put twice at most, with the same result
        number = _commit(spark, path, e["kind"], e["data"])
    return number


def vacuum(spark: SparkSession, path: str) -> int:
    """Take away the tables of entries before the last base; gives how many.  Readers of these must be done."""
    log = entries(spark, path)
    last = max((i for i, e in enumerate(log) if e["kind"] == "base"), default=0)
    kept = {e["data"] for e in log[last:]}
    gone = 0
    for e in log[:last]:
        store, entry = _folder(spark, f"{path}/log/{e['number']:012d}.json")
        store.delete(entry, False)
        if e["data"] not in kept:
            store.delete(_folder(spark, f"{path}/{e['data']}")[1], True)
            gone += 1
    return gone


def rows_written(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """(number, kind, rows) of every entry."""
    return [(e["number"], e["kind"], spark.read.parquet(f"{path}/{e['data']}").count()) for e in entries(spark, path)]
