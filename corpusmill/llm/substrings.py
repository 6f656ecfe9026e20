"""Removal of repeated word sequences by fixed-block anchors.

The reference index holds the non-overlapping blocks of ``length // 2`` words of every
document; every rolling window of that many words probes it.  A block that another
position shares is an anchor.  Every sequence of ``length`` words holds at least one
whole block of its own document, so a repeated sequence lies around anchors: each
anchor is extended to the windows of ``length`` words about it whose own blocks are
all anchors.  The index names the place where each of them stands first; windows that
follow each other there as they do here are extended to the maximal repeat.  Each
maximal repeat is then compared with its source by a 128-bit digest of the words
themselves.  The index keeps hashes only; where a repeat is none by its words, the index
is made anew with other hashes, so what is removed never rests on a hash of the index.

Of equal windows the one in the smallest ``doc_id`` (there the earliest) stays; the
words of all later ones are removed.  A null id comes after all others; rows that
repeat an id are ordered as they are stored.  Null and empty texts have no words.
Documents shorter than ``length`` words lose nothing.  A text of any length is one row
of one chunk and is read whole.  An empty table gives no rows.  Input columns named as
an output are replaced, others are kept.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import exchange as X
from .frames import cut, dealt, extend, tidy, with_columns
from .words import grams, slices, split_words, window_starts

LAST = np.iinfo(np.int64).max
ASKS = 50_000  # comparisons of one source that a task takes at a time
TRIES = 4


class Chunk:
    """Documents of a chunk in the order of their ids, and the hashes of their words."""

    def __init__(self, row: dict, text: str, doc_id: str, seed: int = 0):
        table = X.opened(row["blob"])
        ids = np.asarray(pc.fill_null(table[doc_id].cast(pa.int64()), LAST), np.int64)
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.table = table.take(pa.array(order)).combine_chunks()
        self.number, self.text, self.seed = row["chunk"], text, seed

    def parts(self):
        for batch in self.table.to_batches():
            for part in slices(batch, self.text):
                yield part, split_words(part.column(self.text))

    @cached_property
    def _read(self) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, words in self.parts():
            hashes.append(words.hashes(seed=self.seed))
            counts.append(words.counts)
        return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    @property
    def hashes(self) -> np.ndarray:
        return self._read[0]

    @property
    def first(self) -> np.ndarray:
        return self._read[1]

    def digests(self, at: np.ndarray, n: np.ndarray) -> list[bytes]:
        """Digest of the n words from each position on, joined by one space."""
        text, offsets = [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)]
        for _, words in self.parts():
            spelled, starts = words.spelled()
            text.append(spelled)
            offsets.append(starts[1:] + offsets[-1][-1])
        data, begins = np.concatenate(text), np.concatenate(offsets)
        return [hashlib.blake2b(data[a : z - 1], digest_size=16).digest() for a, z in zip(begins[at].tolist(), begins[at + n].tolist(), strict=True)]

    def within(self, n: int) -> np.ndarray:
        """Positions that begin a window of n words."""
        return np.flatnonzero(window_starts(self.first, n))

    def relative(self, at: np.ndarray) -> np.ndarray:
        """Position inside its document."""
        return at - self.first[np.searchsorted(self.first, at, "right") - 1]

    def probes(self, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rolling windows in the order of their places: places, positions, whether each is a reference block, and where equal places begin."""
        at = self.within(block)
        place = X.places(grams(self.hashes, block)[at], buckets)
        order = np.argsort(place, kind="stable")
        at, place = at[order], place[order]
        return place, at, self.relative(at) % block == 0, X.runs(place)

    def windows(self, length: int, block: int, buckets: int, anchors: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows about anchors in the order of bucket and hash: buckets, hashes, positions."""
        place, at, is_block, heads = self.probes(block, buckets)
        anchor = np.zeros(len(self.hashes) + 2 * length, bool)
        if len(heads):
            held = np.logical_or.reduceat(is_block, heads)
            data = {m["bucket"]: m["data"] for m in anchors or []}
            shared = np.zeros(len(heads), bool)
            shared[held] = np.concatenate([X.from_bits(data[b], z - a) for b, a, z in X.parts(place[heads][held] >> np.uint64(32))])
            anchor[at[is_block & np.repeat(shared, np.diff(heads, append=len(at)))]] = True
        q = self.within(length)
        inside = self.relative(q)
        lead = -(-inside // block) * block - inside
        held = anchor[q + lead] & (anchor[q + lead + block] | (lead + 2 * block > length))
        q = q[held]
        bucket = X.places(grams(self.hashes, length, 1)[q], buckets) >> np.uint64(32)
        key = grams(self.hashes, length)[q]
        order = np.lexsort((q, key, bucket))
        return bucket[order], key[order], q[order]


class Repeats:
    """Windows of a chunk that stand earlier, in the order of their positions, with the place (chunk, position) where they stand first."""

    def __init__(self, chunk: Chunk, length: int, block: int, buckets: int, row: dict):
        bucket, key, at = chunk.windows(length, block, buckets, row["anchors"])
        new = np.ones(len(at), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])
        source, place = np.full(int(new.sum()), chunk.number), at[new]
        data = {m["bucket"]: m["data"] for m in row["later"] or []}
        later = np.zeros(len(place), bool)
        for b, a, z in X.parts(bucket[new]):
            size = -(-(z - a) // 8)
            later[a:z] = found = X.from_bits(data[b][:size], z - a)
            n = int(found.sum())
            source[a:z][found] = X.from_planes(data[b][size : size + 8 * n], "<i8")
            place[a:z][found] = X.from_planes(data[b][size + 8 * n :], "<u4")
        which = np.cumsum(new) - 1
        repeated = later[which] | ~new if len(new) else new
        order = np.argsort(at[repeated])
        self.at = at[repeated][order]
        self.source, self.place = source[which][repeated][order], place[which][repeated][order]

    def maximal(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows that follow each other here and at their source, run together: positions, words, source chunks and positions there."""
        heads = np.ones(len(self.at), bool)
        heads[1:] = (np.diff(self.at) != 1) | (np.diff(self.place) != 1) | (self.source[1:] != self.source[:-1])
        heads = np.flatnonzero(heads)
        return self.at[heads], np.diff(heads, append=len(self.at)) + length - 1, self.source[heads], self.place[heads]


def find_anchors(rows: list[dict]) -> list[bytes]:
    """For the reference blocks of each chunk, in order: does another position hold the same words?"""
    codes = [X.unpacked(r["codes"], "<u4") for r in rows]
    blocks = [X.from_bits(r["blocks"], len(c)) for r, c in zip(rows, codes, strict=True)]
    every = np.concatenate(codes)
    times = 1 + np.concatenate([X.from_bits(r["again"], len(c)) for r, c in zip(rows, codes, strict=True)]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    heads = X.runs(every[order])
    shared = np.empty(len(every), bool)
    if len(heads):
        shared[order] = np.repeat(np.add.reduceat(times[order], heads) > 1, np.diff(heads, append=len(every)))
    ends = np.cumsum([len(c) for c in codes])[:-1]
    return [X.bits(s[b]) for s, b in zip(np.split(shared, ends), blocks, strict=True)]


def find_first(rows: list[dict]) -> list[bytes]:
    """For the distinct windows of each chunk, in order: does an earlier document elsewhere hold it, and where does it stand first?"""
    keys = [X.unpacked(r["keys"], "<u8") for r in rows]
    every, doc, place = np.concatenate(keys), *(np.concatenate([X.from_planes(r[c], k) for r in rows]) for c, k in (("docs", "<i8"), ("places", "<u4")))
    chunk = np.repeat([r["chunk"] for r in rows], [len(k) for k in keys])
    order = np.lexsort((np.arange(len(every)), doc, every))
    heads = X.runs(every[order])
    first = np.empty(len(every), np.int64)
    first[order] = np.repeat(order[heads], np.diff(heads, append=len(every)))
    later = first != np.arange(len(every))
    out = []
    for a, z in zip(ends := np.cumsum([0] + [len(k) for k in keys]), ends[1:], strict=False):
        own = first[a:z][later[a:z]]
        out.append(X.bits(later[a:z]) + X.planes(chunk[own].astype("<i8")) + X.planes(place[own].astype("<u4")))
    return out


def _joined(words, kept: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    out, at = words.spelled(kept)
    rows = words.rows()[kept]
    first = np.searchsorted(rows, np.arange(len(words.first)))
    # the space after the last word of a row is left out
    ends = np.zeros(len(out), bool)
    last = first[1:][first[1:] > first[:-1]]
    ends[at[last] - 1] = True
    begins = at[first] - np.searchsorted(last, first, "right")
    return pa.LargeStringArray.from_buffers(len(words.first) - 1, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(out[~ends])).cast(pa.string())


ADDED = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_text", T.StringType())]


def remove_repeats(docs: DataFrame, length: int = 20, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Input columns plus the words of every document, those removed, and the kept words joined by one space."""
    if length < 2:
        raise ValueError("length must be at least 2")
    chunks = X.chunked(docs, text)
    for seed in range(TRIES):
        runs = maximal_repeats(chunks, length, text, doc_id, seed)
        if not _differing(chunks, runs, text, doc_id):
            break
    else:
        raise RuntimeError("no index told the words apart")
    schema = with_columns(docs.schema, ADDED)
    own = chunks.beside(runs.select("chunk", F.struct("at", "n").alias("run"))).groupBy("chunk").agg(F.collect_list("run").alias("runs"))

    def finish(batches):
        for whole in batches:
            for row in whole.to_pylist():
                chunk = Chunk(row, text, doc_id)
                spans = np.array([(r["at"], r["at"] + r["n"]) for r in row["runs"] or []], np.int64).reshape(-1, 2)
                seen = 0
                for part, words in chunk.parts():
                    n = len(words.starts)
                    # maximal repeats may overlap, and none crosses a document's end
                    change = np.zeros(n + 1, np.int64)
                    for column, step in ((0, 1), (1, -1)):
                        inside = spans[(spans[:, 0] >= seen) & (spans[:, 0] < seen + n), column] - seen
                        np.add.at(change, inside, step)
                    mask = np.cumsum(change[:-1]) > 0
                    seen += n
                    removed = np.add.reduceat(np.concatenate([mask, [False]]).astype(np.int64), words.first[:-1]) if part.num_rows else np.zeros(0, np.int64)
                    removed = np.where(words.counts > 0, removed, 0)
                    yield extend(part, {"n_words": pa.array(words.counts), "n_removed": pa.array(removed), "kept_text": _joined(words, ~mask)})

    return chunks.frame.join(own, "chunk", "left").mapInArrow(tidy(finish), schema)


RUNS = "chunk bigint, at bigint, n bigint, source bigint, place bigint, digest binary"


def maximal_repeats(chunks: X.Chunks, length: int, text: str, doc_id: str, seed: int) -> DataFrame:
    """Rows (chunk, at, n, source, place, digest): n words from ``at`` on in a chunk that stand first at ``place`` of the source chunk."""
    block, buckets = max(1, length // 2), chunks.buckets

    def send_probes(row):
        place, _, is_block, heads = Chunk(row, text, doc_id, seed).probes(block, buckets)
        if not len(heads):
            return
        # what a chunk holds often goes once
        held, again, place = np.logical_or.reduceat(is_block, heads), np.diff(heads, append=len(place)) > 1, place[heads]
        for b, a, z in X.parts(place >> np.uint64(32)):
            yield b, [X.packed((place[a:z] & np.uint64(0xFFFFFFFF)).astype("<u4")), X.bits(held[a:z]), X.bits(again[a:z])]

    anchored = X.answer(chunks, X.ask(chunks.frame, send_probes, ["codes", "blocks", "again"]), find_anchors, "anchors")
    # a bit for each block is kept, so that probes are not sent twice
    anchors = dealt(anchored.select("chunk", "anchors"), chunks.parts, "chunk")
    anchored = replace(chunks, frame=chunks.frame.join(anchors, "chunk"))

    def send_windows(row):
        chunk = Chunk(row, text, doc_id, seed)
        bucket, key, at = chunk.windows(length, block, buckets, row["anchors"])
        new = np.ones(len(at), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])
        bucket, key, at = bucket[new], key[new], at[new]
        owner = chunk.ids[np.searchsorted(chunk.first, at, "right") - 1]
        for b, a, z in X.parts(bucket):
            yield b, [X.packed(key[a:z].astype("<u8")), X.planes(owner[a:z].astype("<i8")), X.planes(at[a:z].astype("<u4"))]

    def spell(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, text, doc_id, seed)
                at, n, source, place = Repeats(chunk, length, block, buckets, row).maximal(length)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), chunk.number)), pa.array(at), pa.array(n), pa.array(source), pa.array(place.astype(np.int64)), pa.array(chunk.digests(at, n), pa.binary())], names=[c.split()[0] for c in RUNS.split(", ")])

    return cut(X.answer(anchored, X.ask(anchored.frame, send_windows, ["keys", "docs", "places"]), find_first, "later").mapInArrow(tidy(spell), RUNS))


def _differing(chunks: X.Chunks, runs: DataFrame, text: str, doc_id: str) -> int:
    """How many maximal repeats differ from their source by their words.

    Repeats of one extent are compared once; what one source is asked is split where it is much.
    """
    asks = runs.select(F.col("source").alias("chunk"), "place", "n", "digest").distinct()
    share = asks.groupBy("chunk").agg(F.ceil(F.count("*") / ASKS).alias("shares"))
    by_share = asks.join(share, "chunk").groupBy("chunk", F.pmod(F.xxhash64("place", "n", "digest"), "shares").alias("share")).agg(F.collect_list(F.struct("place", "n", "digest")).alias("asks"))

    def check(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = Chunk(row, text, doc_id).digests(*(np.array([a[k] for a in row["asks"]], np.int64) for k in ("place", "n")))
                yield pa.RecordBatch.from_arrays([pa.array([sum(a["digest"] != d for a, d in zip(row["asks"], own, strict=True))])], names=["bad"])

    found = chunks.frame.join(chunks.beside(by_share), "chunk").select("chunk", "blob", "asks").mapInArrow(tidy(check), "bad bigint")
    return found.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("n")).first()["n"]
