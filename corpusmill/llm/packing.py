"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

A document's ids (its tokens, then an end id) are cut into whole windows and a rest,
the rest into pieces of at most ``PIECE`` ids.  Whole windows are sequences by
themselves.  The pieces are dealt by a hash of their row into groups of about ``GROUP``
windows.  In each group every piece starts as a partial partition of the windows; the two partial partitions with the largest
imbalance are merged with their imbalances opposed until one is left, whose windows
are nearly equal.  If its fullest window exceeds the capacity, the number of windows
rises and the group is done again.

Null and empty texts are documents of the end id alone.  Repeated rows are documents
of their own.  Empty tables give no rows.
"""

from __future__ import annotations

import heapq
import json
import math
import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut, tidy
from .words import slices

WINDOW = 2048
GROUP = 256
PIECE = 512
CACHED = 300_000
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_TWO_SPACES = re.compile("[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2}")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Cache(dict):
    """Ids, as bytes, of the segments met so far, each behind the same lead."""

    def __init__(self, encoding, lead: str):
        super().__init__()
        self.encoding, self.lead = encoding, lead

    def __missing__(self, part: str) -> bytes:
        ids = self[part] = array("I", self.encoding.encode_ordinary(self.lead + part)).tobytes()
        return ids


class ByteEncoder:
    """Ids of a byte-level BPE vocabulary file, as the ``tokenizers`` library gives them.

    Pre-tokens never span a single space between two visible characters, except that
    the space belongs to what follows.  So a text is cut there, and the ids of a
    segment are kept for its next occurrence.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.heads, self.tails = _Cache(self.fast, ""), _Cache(self.fast, " ")

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.special and self.special.search(text):
            return array("I", self.exact.encode(text, add_special_tokens=False).ids).tobytes()
        if _TWO_SPACES.search(text) or text[:1].isspace() or text[-1:].isspace():
            head, *tails = _SAFE_CUT.split(text)
        else:
            head, *tails = text.split(" ")
        for cache in (self.heads, self.tails):
            if len(cache) > CACHED:
                cache.clear()
        return self.heads[head] + b"".join(map(self.tails.__getitem__, tails))


def difference(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Window of each item, and the windows' sums, by multiway differencing into k windows."""
    n = len(sizes)
    sums: list[np.ndarray | None] = [None] * (2 * n)
    ways: list[tuple | None] = [None] * (2 * n)
    heap = []
    for i, size in enumerate(sizes.tolist()):
        heap.append((-size if k > 1 else 0, i))
    heapq.heapify(heap)
    top = n
    single = np.zeros(k, np.int64)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        pair = []
        for node in (a, b):
            if node < n:
                own = single.copy()
                own[0] = sizes[node]
                pair.append(own)
            else:
                pair.append(sums[node])
                sums[node] = None
        total = pair[0] + pair[1][::-1]
        order = np.argsort(-total, kind="stable")
        sums[top] = total[order]
        ways[top] = (a, b, order.astype(np.int32))
        heapq.heappush(heap, (int(total[order[-1]] - total[order[0]]), top))
        top += 1
    root = heap[0][1]
    window = np.zeros(n, np.int64)
    stack = [(root, np.arange(k))]
    while stack:
        node, slots = stack.pop()
        if node < n:
            window[node] = slots[0]
            continue
        a, b, order = ways[node]
        of_a = np.empty(k, np.int64)
        of_a[order] = slots
        stack.append((a, of_a))
        stack.append((b, of_a[::-1]))
    return window, np.bincount(window, weights=sizes, minlength=k).astype(np.int64)


def pack_group(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item so that no window exceeds the capacity; every item fits by itself."""
    total = int(sizes.sum())
    k = max(1, math.ceil(total / capacity))
    while True:
        window, sums = difference(sizes, k)
        if sums.max() <= capacity:
            return window
        k += max(1, int(k * (sums.max() / capacity - 1) / 3))


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = 1, piece: int = PIECE, keep_ids: bool = False) -> DataFrame:
    """Whole windows and pieces of the rest of every document, with their ids where asked for."""

    def run(batches):
        encoder = ByteEncoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, "text"):
                rows, ids_of = [], []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    rest = n - n % window
                    for start in (*range(0, rest, window), *range(rest, n, piece)):
                        own = ids[4 * start : 4 * (start + (window if start < rest else piece))]
                        rows.append((doc_id, start, len(own) // 4, zlib.crc32(own), n))
                        if keep_ids:
                            ids_of.append(np.frombuffer(own, "<u4").astype(np.int32))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                if keep_ids:
                    columns.append(pa.array(ids_of, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    schema = PIECES + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), schema)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = 1, piece: int = PIECE, keep_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its place there; the ids too where asked for."""
    cutting = cut(pieces(docs, path, window, end_id, piece, keep_ids).withColumn("uid", F.monotonically_increasing_id()))
    whole = cutting.where(F.col("length") == window).withColumn("sequence_id", F.col("uid") + F.lit(1 << 61)).withColumn("offset", F.lit(0).cast("long"))
    rests = cutting.where(F.col("length") < window)
    total = rests.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, math.ceil(total / (window * GROUP)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid", ignore_index=True)
        at = pack_group(group["length"].to_numpy(), window)
        group["sequence_id"] = (group["group"].to_numpy() << 32) + at
        group["offset"] = group.groupby(at)["length"].cumsum() - group["length"]
        return group[["uid", "length", "sequence_id", "offset"]].drop(columns="length")

    dealt = rests.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("group"))
    placed = dealt.groupBy("group").applyInPandas(place, "uid bigint, sequence_id bigint, offset bigint")
    return whole.unionByName(rests.join(placed, "uid")).drop("uid")
