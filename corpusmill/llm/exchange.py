"""Exchange of sorted hash lists between runs of documents.

Documents are held in chunks: rows of a few MB of text as one compressed Arrow stream,
written once to the shared folder, so that a chunk is the same whenever it is read.
A chunk sends the hashes it knows to buckets of the hash space, sorted and as byte
planes of their differences, which compress to two or three bytes each.  A bucket
answers each chunk in the order of what it was sent, so an answer needs no keys.
Text moves only when answers meet their chunk; no task holds more than one bucket or
one chunk of a batch.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import dealt, tidy
from .words import slices

CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 9 << 20  # of text whose hashes go to one bucket


@dataclass
class Chunks:
    """Rows (chunk, blob) dealt by chunk into ``parts``, so that what is dealt alike meets them where they are."""

    frame: DataFrame
    parts: int
    buckets: int

    def beside(self, rows: DataFrame) -> DataFrame:
        """Rows of chunks dealt as the chunks are."""
        return rows.repartition(self.parts, "chunk")


def chunked(docs: DataFrame, text: str, limit: int = CHUNK_BYTES) -> Chunks:
    """Chunks of about ``limit`` bytes of text each (one document at least)."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def closed():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
                for b in held:
                    out.write_batch(b)
            blob = sink.getvalue().to_pybytes()
            return pa.RecordBatch.from_arrays([pa.array([(part << 24) + number]), pa.array([blob], pa.binary())], names=["chunk", "blob"])

        for whole in batches:
            for batch in slices(whole, text, limit // 8):
                held.append(batch)
                size += pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
                if size >= limit:
                    yield closed()
                    held, size, number = [], 0, number + 1
        if held:
            yield closed()

    parts = max(8, math.ceil(total / limit))
    return Chunks(dealt(docs.mapInArrow(tidy(run), "chunk bigint, blob binary"), parts, "chunk"), parts, max(8, math.ceil(total / BUCKET_BYTES)))


def opened(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all()


def places(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper and 32 further bits of the hash in the lower half; ordered as the hashes are."""
    n = np.uint64(buckets)
    return (hashes >> np.uint64(32)) * n + (((hashes & np.uint64(0xFFFFFFFF)) * n) >> np.uint64(32))


def planes(values: np.ndarray) -> bytes:
    """Little-endian bytes of fixed-width values, all first bytes first."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, len(data) // width).T).view(kind).ravel()


def packed(ordered: np.ndarray) -> bytes:
    """Planes of the differences of ordered unsigned values."""
    return planes(np.diff(ordered, prepend=ordered.dtype.type(0)))


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(from_planes(data, kind), dtype=kind)


def bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def from_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def parts(bucket_of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of an ordered array of bucket numbers."""
    if len(bucket_of):
        heads = np.flatnonzero(np.concatenate([[True], bucket_of[1:] != bucket_of[:-1]]))
        for b, a, z in zip(bucket_of[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(bucket_of)], strict=True):
            yield int(b), a, z


def ask(chunks: DataFrame, send: Callable[[dict], Iterator[tuple[int, list[bytes]]]], fields: list[str]) -> DataFrame:
    """Messages (bucket, chunk, payload fields) of every chunk; ``send`` gets a chunk's row as a dict."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = list(send(row))
                if found:
                    columns = zip(*(m for _, m in found), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int64()), pa.array([row["chunk"]] * len(found), pa.int64()), *(pa.array(c, pa.binary()) for c in columns)], names=["bucket", "chunk", *fields])

    return chunks.mapInArrow(tidy(run), "bucket bigint, chunk bigint, " + ", ".join(f"{f} binary" for f in fields))


def answer(chunks: Chunks, messages: DataFrame, reply: Callable[[list[dict]], list[bytes]], name: str) -> DataFrame:
    """The chunks with their answers by bucket, as the list ``name`` of (bucket, data); chunks stay where they are."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: r["chunk"])
        return pa.table({"chunk": pa.array([r["chunk"] for r in rows], pa.int64()), "bucket": pa.array([r["bucket"] for r in rows], pa.int64()), "data": pa.array(reply(rows), pa.binary())})

    replies = messages.groupBy("bucket").applyInArrow(run, "chunk bigint, bucket bigint, data binary")
    return chunks.frame.join(chunks.beside(replies).groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "data"))).alias(name)), "chunk", "left")


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of an ordered array begin."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
