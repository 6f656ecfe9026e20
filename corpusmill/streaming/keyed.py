"""The change feed and the job log as keyed state: a batch touches the keys that it holds, and no others.

Every id has its entry in the state store, with a number that counts its versions.  A batch
folds an id's rows into it, and only what changes is written out; the written rows are a
log from which the snapshot is read as each id's last version.  A deleted id keeps a
tombstone, so late rows of older revisions cannot bring it back; a timer takes the
tombstone away once the watermark is ``keep`` days past the deletion.

Nulls: rows without id or time are left out; a null revision is older than any other.
"""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

FIELDS = "revision long, hash string, size long, namespace string"
ENTRY = f"{FIELDS}, deleted boolean, at timestamp, version long"
CHANGE = f"id string, {FIELDS}, change string, at timestamp, version long"
INPUT = f"id string, {FIELDS}, op string, at timestamp"
NAMES = ("revision", "hash", "size", "namespace")

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _plain(value):
    """A value as the state store takes it."""
    return None if value is None or value is pd.NaT or (isinstance(value, float) and value != value) else value


class Entries(StatefulProcessor):
    """Folds the rows of an id by revision and time; gives the changed entry, if there is one.

    It works on rows: an id has few of them, and a data frame for each id costs more than all else.
    """

    def __init__(self, keep_days: int):
        self.keep = timedelta(days=keep_days)

    def init(self, handle):
        self.handle = handle
        self.entry = handle.getValueState("entry", ENTRY)

    def handleInputRows(self, key, rows, timerValues):
        entry = before = self.entry.get()
        for r in sorted(rows, key=lambda r: (r.revision is not None, r.revision or 0, r.at)):
            if entry is not None and ((entry[0] if entry[0] is not None else -1) > (r.revision if r.revision is not None else -1)):
                continue
            gone = r.op == "delete"
            values = (r.revision, r.hash, r.size, r.namespace) if not gone else (r.revision, *(entry[1:4] if entry else (None, None, None)))
            if entry is not None and entry[4] == gone and (gone or tuple(entry[:4]) == values):
                continue
            entry = (*values, gone, r.at, (entry[6] if entry else 0) + 1)
        if entry is before:
            return
        self.entry.update(tuple(entry))
        if entry[4]:
            self.handle.registerTimer(int((entry[5] + self.keep).timestamp() * 1000))
        was = before is not None and not before[4]
        if not was and entry[4] and before is None:
            return  # deleted before it was ever seen: a tombstone and no change
        change = "deleted" if entry[4] else "modified" if was else "added"
        yield Row(id=key[0], **dict(zip(NAMES, entry, strict=False)), change=change, at=entry[5], version=entry[6])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        entry = self.entry.get() if self.entry.exists() else None
        # an entry that has come back since keeps its state
        if entry is not None and entry[4] and (entry[5] + self.keep).timestamp() * 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.entry.clear()
        return iter(())

    def close(self):
        pass


class Latest(StatefulProcessor):
    """The last run of each stage by start and job; gives it where it changes."""

    def init(self, handle):
        self.run = handle.getValueState("run", "job_id long, status string, started_at timestamp, seconds double, version long")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows)).sort_values(["started_at", "job_id"])
        last = batch.iloc[-1]
        old = self.run.get() if self.run.exists() else None
        at, job = last["started_at"].to_pydatetime(), int(last["job_id"])
        if old is not None and (old[2], old[0]) >= (at, job):
            return
        version = (old[4] if old is not None else 0) + 1
        self.run.update((job, _plain(last["status"]), at, float(last["seconds"]), version))
        yield pd.DataFrame([(key[0], job, _plain(last["status"]), at, float(last["seconds"]), version)], columns=["stage", "job_id", "status", "started_at", "seconds", "version"])

    def close(self):
        pass


def _follow(spark: SparkSession, path: str, schema: str, time: str, key: str, processor: StatefulProcessor, out: str, output: str, mode: str, checkpoint: str) -> None:
    """Work what is new below a folder into the state, then stop; a stop in between is taken up where it was."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    rows = own.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(path).where(f"{key} is not null and {time} is not null")
    keyed = rows.withWatermark(time, "0 seconds").groupBy(key)
    fold = keyed.transformWithState if isinstance(processor, Entries) else keyed.transformWithStateInPandas
    changed = fold(processor, outputStructType=output, outputMode="Append", timeMode=mode)
    changed.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def follow_entries(spark: SparkSession, path: str, out: str, checkpoint: str, keep_days: int = 30) -> None:
    """Entries (id, revision, hash, size, namespace, op, at) below ``path`` into changes below ``out``."""
    _follow(spark, path, INPUT, "at", "id", Entries(keep_days), out, CHANGE, "EventTime", checkpoint)


def follow_runs(spark: SparkSession, path: str, out: str, checkpoint: str) -> None:
    """Job log rows (job_id, stage, status, started_at, seconds) into the last run of each stage."""
    schema = "job_id long, stage string, status string, started_at timestamp, seconds double"
    _follow(spark, path, schema, "started_at", "stage", Latest(), out, "stage string, job_id long, status string, started_at timestamp, seconds double, version long", "None", checkpoint)


def current(spark: SparkSession, out: str, key: str = "id") -> DataFrame:
    """The last version of each key from the written changes; deleted ones are gone."""
    rows = spark.read.parquet(out)
    rest = [c for c in rows.columns if c != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "version").alias("row")).select(key, "row.*")
    return last.where("change <> 'deleted'") if "change" in rest else last
