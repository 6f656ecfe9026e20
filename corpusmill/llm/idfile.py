"""Files of token ids with Elias-Fano encoded document boundaries.

A shard is one file: a header, the ids of its documents one after the other (two bytes
each where the vocabulary allows, else four), and two Elias-Fano sequences, one of the
places where documents end and one of the documents' ids.  Such a sequence keeps the low
bits of each value packed and the high bits in unary; a directory of one 32-bit count for
every 512 bits answers ``select`` by a search in the directory, a sum over one block and a
table for one byte.  That is about two bits and the low bits for a document, and no table
of 64-bit offsets.  All numbers are little-endian; a line feed ends the file.

Writing.  Documents are dealt by ranges of their id and sorted, tokenised in a stream, and
every shard is one row that Spark's text writer commits as a file of its own: a failed task
leaves nothing and any store that Spark writes will do.  The manifest beside the shards
tells how many ids come before each: sums inside a partition by a window, one total for
each partition of the writing job on the driver.

Reading.  Every file is checked against its checksum and gives a row for each document;
boundaries come from ``select``.

A null text is empty: its document is the end id alone.  Null ids come first.  Rows of one
id follow each other in the order of a hash of their text; rows that repeat id and text
are documents of their own and one task takes them all, as a stream.  A document of any
length stays in one shard; a shard is closed at ``SHARD_IDS`` ids, so a task holds one shard
or one document at a time.  Other columns are not carried.  An empty table gives a manifest
without rows.
"""

from __future__ import annotations

import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import tidy, written
from .packing import ByteEncoder
from .words import slices

MAGIC = b"IDFILE01"
#: magic, partition, shard, documents, documents without id, ids, bytes of an id, low bits of ends and of doc ids, least doc id, checksum of the rest.
HEADER = struct.Struct("<8sIIIIIBBBxqI4x")
SHARD_IDS = 1 << 24
SHARD_DOCS = 1 << 18
BLOCK = 64  # bytes of high bits for each count of the directory

_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_COUNT = _ONES.sum(1).astype(np.uint8)
#: Place of the k-th one of a byte.
_PLACE = np.argsort(1 - _ONES, axis=1, kind="stable").astype(np.uint8)


class EliasFano:
    """A non-decreasing sequence of n numbers from 0 on."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.bits, self.low, self.high, self.directory = n, bits, low, high, directory

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        taken = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(taken.astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = -(-(int(places[-1]) + 1) // (8 * BLOCK)) * BLOCK
        high = np.zeros(size, np.uint8)
        np.bitwise_or.at(high, places >> 3, np.left_shift(np.uint8(1), (places & 7).astype(np.uint8)))
        return cls(n, bits, low, high, cls._directory(high))

    @staticmethod
    def _directory(high: np.ndarray) -> np.ndarray:
        """How many ones stand before each block."""
        ones = _COUNT[high].reshape(-1, BLOCK).sum(1)
        return (np.cumsum(ones) - ones).astype(np.uint32)

    def packed(self) -> bytes:
        return struct.pack("<III", len(self.low), len(self.high), len(self.directory)) + self.low.tobytes() + self.high.tobytes() + self.directory.astype("<u4").tobytes()

    @classmethod
    def unpacked(cls, data: memoryview, n: int, bits: int) -> tuple[EliasFano, int]:
        """The sequence at the start of the bytes, and how many bytes it takes."""
        low, high, directory = struct.unpack_from("<III", data)
        at = 12 + low + high
        parts = np.frombuffer(data, np.uint8, low, 12), np.frombuffer(data, np.uint8, high, 12 + low), np.frombuffer(data, "<u4", directory, at)
        return cls(n, bits, *parts), at + 4 * directory

    def _places(self, k: np.ndarray) -> np.ndarray:
        """Where the k-th ones of the high bits stand."""
        block = np.searchsorted(self.directory, k, "right") - 1
        rest = k - self.directory[block].astype(np.int64)
        out = np.empty(len(k), np.int64)
        for i in range(0, len(k), 1 << 14):
            part = slice(i, i + (1 << 14))
            inside = self.high.reshape(-1, BLOCK)[block[part]]
            before = np.cumsum(_COUNT[inside], axis=1, dtype=np.int64)
            byte = (before <= rest[part, None]).sum(1)
            rows = np.arange(len(byte))
            value = inside[rows, byte]
            left = rest[part] - (before[rows, byte] - _COUNT[value])
            out[part] = (block[part] * BLOCK + byte) * 8 + _PLACE[value, left]
        return out

    def select(self, k) -> np.ndarray:
        """The k-th values; k is one place or an array of places."""
        k = np.atleast_1d(np.asarray(k, np.int64))
        upper = (self._places(k) - k).astype(np.uint64) << np.uint64(self.bits)
        value = np.zeros(len(k), np.uint64)
        for bit in range(self.bits):
            at = k * self.bits + bit
            value |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(bit)
        return upper | value

    def rank(self, value: int) -> int:
        """How many of the numbers are at most ``value``: the document that holds an id's place, if these are ends."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if int(self.select(middle)[0]) <= value:
                low = middle + 1
            else:
                high = middle
        return low


class Shard:
    """One file read from its bytes; ids stay where they are."""

    def __init__(self, data):
        data = memoryview(data)
        magic, self.part, self.shard, self.n_docs, self.n_null, self.n_ids, self.width, ends, docs, self.least, crc = HEADER.unpack_from(data)
        if magic != MAGIC or data[-1] != 10 or zlib.crc32(data[HEADER.size : -1]) != crc:
            raise ValueError("not a whole file of ids")
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, HEADER.size)
        at = HEADER.size + self.n_ids * self.width
        self.ends, size = EliasFano.unpacked(data[at:], self.n_docs, ends)
        self.docs, _ = EliasFano.unpacked(data[at + size :], self.n_docs - self.n_null, docs)

    def doc_ids(self) -> list:
        found = self.docs.select(np.arange(self.docs.n)).astype(np.int64) if self.docs.n else np.zeros(0, np.int64)
        return [None] * self.n_null + (found + np.int64(self.least)).tolist()

    def document(self, k: int) -> np.ndarray:
        start = int(self.ends.select(k - 1)[0]) if k else 0
        return self.ids[start : int(self.ends.select(k)[0])]

    def holder(self, place: int) -> int:
        """The document that holds the id at a place of the shard."""
        return self.ends.rank(place)


def shard_bytes(part: int, number: int, doc_ids: list, documents: list[np.ndarray], width: int) -> bytes:
    """A whole file but for the line feed at its end; ids of documents ascend, null ones first."""
    ids = np.concatenate(documents).astype(f"<u{width}")
    ends = EliasFano.encode(np.cumsum([len(d) for d in documents]))
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    docs = EliasFano.encode((known - np.int64(least)).view(np.uint64))
    body = ids.tobytes() + ends.packed() + docs.packed()
    head = HEADER.pack(MAGIC, part, number, len(doc_ids), len(doc_ids) - len(known), len(ids), width, ends.bits, docs.bits, least, zlib.crc32(body))
    return head + body


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, shard_ids: int = SHARD_IDS, shard_docs: int = SHARD_DOCS) -> None:
    """Shards of all documents in ascending order of doc_id under ``path``, and their manifest."""

    def run(batches):
        encoder, part, number = ByteEncoder(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        width = 2 if max(encoder.exact.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        names, documents, have = [], [], 0

        def closed():
            data = shard_bytes(part, number, names, documents, width)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["content"])

        for whole in batches:
            for batch in slices(whole, "text"):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    names.append(doc_id)
                    documents.append(np.frombuffer(encoder.encode(text or "") + end, "<u4").astype(f"<u{width}"))
                    have += len(documents[-1])
                    if have >= shard_ids or len(names) >= shard_docs:
                        yield closed()
                        names, documents, have, number = [], [], 0, number + 1
        if names:
            yield closed()

    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long"), "text").withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    # the writer puts the bytes of a string as they are; one row a file
    shards = ordered.mapInArrow(tidy(run), "content binary").select(F.col("content").cast("string"))
    shards.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").option("compression", "none").text(f"{path}/shards")
    _manifest(spark, path).write.parquet(f"{path}/manifest")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/shards").select("content")


def _shards(batches):
    for batch in batches:
        column = batch.column("content")
        for i in range(batch.num_rows):
            yield Shard(column[i].as_buffer())


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """(part, shard, base, n_docs, n_ids, least, greatest) of every shard, checked to ascend over the partitions."""

    def run(batches):
        for s in _shards(batches):
            greatest = s.least + int(s.docs.select(s.docs.n - 1)[0]) if s.docs.n else None
            yield pa.RecordBatch.from_pylist([{"part": s.part, "shard": s.shard, "n_docs": s.n_docs, "n_ids": s.n_ids, "least": s.least if s.docs.n else None, "greatest": greatest}], schema=arrow)

    arrow = pa.schema([(n, pa.int64()) for n in ("part", "shard", "n_docs", "n_ids", "least", "greatest")])
    found = written(_files(spark, path).mapInArrow(tidy(run), ", ".join(f"{n} bigint" for n in arrow.names)), f"{path}/headers")
    # one row for each partition of the writing job
    totals = found.groupBy("part").agg(F.sum("n_ids").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest")).orderBy("part").collect()
    known = [t for t in totals if t["least"] is not None]
    if any(a["greatest"] > b["least"] for a, b in itertools.pairwise(known)):
        raise ValueError("partitions do not ascend")
    bases = itertools.accumulate((t["n"] for t in totals), initial=0)
    before = spark.createDataFrame([(t["part"], b) for t, b in zip(totals, bases, strict=False)], "part bigint, before bigint")
    inner = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rel = F.coalesce(F.sum("n_ids").over(inner), F.lit(0))
    return found.withColumn("rel", rel).join(before, "part").select("part", "shard", (F.col("before") + F.col("rel")).alias("base"), "n_docs", "n_ids", "least", "greatest")


ROW = "part bigint, shard bigint, doc_id bigint, rel bigint, n_tokens bigint, ids_crc32 bigint"


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Every document from the files: doc_id, start, n_tokens, ids_crc32, and its ids where asked for."""

    def run(batches):
        for s in _shards(batches):
            ends = s.ends.select(np.arange(s.n_docs)).astype(np.int64)
            starts = np.r_[0, ends[:-1]]
            names = s.doc_ids()
            for at in range(0, s.n_docs, 10_000):
                part = slice(at, at + 10_000)
                own = [s.ids[a:b].astype("<u4") for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)]
                n = len(own)
                columns = [pa.array(np.full(n, s.part)), pa.array(np.full(n, s.shard)), pa.array(names[part], pa.int64()), pa.array(starts[part]), pa.array(ends[part] - starts[part]), pa.array([zlib.crc32(x) for x in own], pa.int64())]
                if ids:
                    columns.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    schema = ROW + ", ids array<int>" * ids
    found = _files(spark, path).mapInArrow(tidy(run), schema)
    bases = spark.read.parquet(f"{path}/manifest").select("part", "shard", "base")
    return found.join(bases, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("rel")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))
