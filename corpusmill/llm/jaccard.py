"""Joins of documents by the Jaccard similarity of their word shingles, by T-occurrence search.

1. Chunks send the hashes of their shingles, each once with its count, to buckets, which
   answer with the number of documents that hold it (see ``exchange``).  A partner at
   threshold ``t`` shares at least ``t`` of a document's shingles, so a document of which
   fewer are shared with any other has no partner, and its shingles go no further.
2. Documents of equal words become one class.  Each class lists the rarest shingles that
   any partner must touch (all but ``ceil(t n) - 1`` of them); classes that list the
   same shingle, and whose sizes allow the threshold, are joined, in each partition first.
   The components are search groups: no link leaves its group.
3. In a group (in pairs of blocks, where it holds more than ``BLOCK`` classes) every
   class queries the inverted lists of the shingles.  By DivideSkip the longest lists
   are set aside; the short ones are merged by a heap that skips ahead to what can
   still reach the required overlap, and the candidates are probed in the long lists
   by binary search.  Candidates that are linked already are left out, which cannot
   change a component.
4. Every link that joins components is verified by the words of its two documents.
5. The links' components are taken across blocks and mapped back to the documents.

The lists hold 64-bit hashes of shingles, which find candidates and count ``n_shingles``;
classes are told apart by a 128-bit digest of their words, links by the words themselves.
Null and empty texts have no shingles and link with nothing; a text of fewer words than a
shingle is one shingle.  A text of any length is one row and is read whole.  Rows that
repeat an id are one document of several texts.  A null id is linked with nothing and
is its own component, null.  An empty table gives no rows; columns other than the two
that are read do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import exchange as X
from .frames import cut, drop_path, shared_path, tidy, written
from .graph import Sets, connected_components
from .quality import _LOWER
from .words import _STEP, Words, grams, mix, slices, split_bytes, split_words, window_starts

BLOCK = 500
SLICE = 4 << 20  # bytes of text in a chunk
KEYS = 300_000  # shingles that a partition holds at a time while it joins classes
REPRESENTATIVES = 4  # members of the main component of a block that a class is compared with before it searches
SKIP_WEIGHT = 0.01  # cost of a probe against a merge step, for the choice of the long lists


def lowered(array: pa.Array) -> Words:
    """Words of each row, A to Z in lower case."""
    raw = split_words(array)
    return Words(_LOWER[raw.data], raw.offsets, raw.starts, raw.ends, raw.first)


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, and the rows' offsets."""
    h = words.hashes()
    row = words.rows()
    at = np.flatnonzero(window_starts(words.first, n))
    keys, rows = [grams(h, n)[at]], [row[at]]
    for few in range(1, n):
        short = np.flatnonzero(words.counts == few)
        keys.append(grams(h, few)[words.first[short]] if len(short) else np.zeros(0, np.uint64))
        rows.append(short)
    key, row = np.concatenate(keys), np.concatenate(rows)
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], np.searchsorted(row[new], np.arange(len(words.first)))


def shingles(body: bytes, n: int) -> set[tuple[bytes, ...]]:
    """Distinct shingles of words that are joined by single spaces."""
    words = body.split(b" ")
    return set(zip(*(words[i:] for i in range(n)), strict=False)) if len(words) >= n else {tuple(words)}


def _of_chunk(row: dict, n: int, spelled: bool = False) -> tuple[list, np.ndarray, np.ndarray, list[bytes]]:
    """Ids, shingle hashes with offsets and, where asked for, the lower-case words of each document joined by one space."""
    table = X.opened(row["blob"])
    ids, keys, sizes, bodies = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
    for batch in table.to_batches():
        for part in slices(batch, "text"):
            words = lowered(part.column("text"))
            key, offsets = shingle_sets(words, n)
            ids += part.column("doc_id").to_pylist()
            keys.append(key)
            sizes.append(np.diff(offsets))
            if spelled:
                data, at = words.spelled()
                whole, at = data.tobytes(), at[words.first].tolist()
                bodies += [whole[a : max(a, z - 1)] for a, z in zip(at, at[1:], strict=False)]
    return ids, np.concatenate(keys), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), bodies


def count_documents(rows: list[dict]) -> list[bytes]:
    """For the distinct shingles of each chunk, in order, a code of how many documents hold them: exact to 200, then by powers."""
    codes = [X.unpacked(r["codes"], "<u4") for r in rows]
    every = np.concatenate(codes)
    times = np.concatenate([X.from_planes(r["times"], "<u4") for r in rows]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    heads = X.runs(every[order])
    out = np.empty(len(every), np.uint8)
    if len(heads):
        size = np.add.reduceat(times[order], heads)
        code = np.where(size <= 200, size, np.minimum(200 + np.log2(np.maximum(size, 200) / 200) * 2, 255)).astype(np.uint8)
        out[order] = np.repeat(code, np.diff(heads, append=len(every)))
    return [p.tobytes() for p in np.split(out, np.cumsum([len(c) for c in codes])[:-1])]


def least_overlap(n: int, percent: int) -> int:
    """Shingles that any partner of a set of n must share with it."""
    return -(-percent * n // 100)


SETS = "doc_id bigint, n_shingles bigint, digest binary, tokens binary, body binary"


def shared_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Every document's number of shingles; where a partner is possible also the digest of its
    words, its shared shingles, rarest first, and its words, compressed."""
    chunks = X.chunked(docs, "text", SLICE)
    buckets = chunks.buckets

    def ordered(keys):
        place = X.places(keys, buckets)
        order = np.argsort(place, kind="stable")
        return place[order], order, X.runs(place[order])

    def send(row):
        place, _, heads = ordered(_of_chunk(row, n)[1])
        # what many documents of a chunk hold goes once
        times, place = np.diff(heads, append=len(place)).astype("<u4"), place[heads]
        for b, a, z in X.parts(place >> np.uint64(32)):
            yield b, [X.packed((place[a:z] & np.uint64(0xFFFFFFFF)).astype("<u4")), X.planes(times[a:z])]

    counted = X.answer(chunks, X.ask(chunks.frame, send, ["codes", "times"]), count_documents, "counts")

    def keep(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, keys, offsets, bodies = _of_chunk(row, n, spelled=True)
                _, order, heads = ordered(keys)
                held = np.zeros(len(keys), np.uint8)
                held[order] = np.repeat(np.frombuffer(b"".join(m["data"] for m in row["counts"] or []), np.uint8), np.diff(heads, append=len(keys)))
                size = np.diff(offsets)
                total = np.concatenate([[0], np.cumsum(held > 1)])
                shared = total[offsets[1:]] - total[offsets[:-1]]
                digests, tokens, kept = [], [], []
                pack = zstandard.ZstdCompressor(level=3).compress
                for i, (doc, a, z) in enumerate(zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    if doc is None or a == z or 100 * int(shared[i]) < percent * (z - a):
                        digests.append(None)
                        tokens.append(None)
                        kept.append(None)
                        continue
                    own, counts = keys[a:z], held[a:z]
                    digests.append(hashlib.blake2b(bodies[i], digest_size=16).digest())
                    own, counts = own[counts > 1], counts[counts > 1]
                    tokens.append(own[np.lexsort((own, counts))].astype("<u8").tobytes())
                    kept.append(pack(bodies[i]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(size, pa.int64()), *(pa.array(x, pa.binary()) for x in (digests, tokens, kept))], names=[c.split()[0] for c in SETS.split(", ")])

    return cut(counted.mapInArrow(tidy(keep), SETS))


class Lists:
    """Inverted lists of the shingles of some classes."""

    def __init__(self, sets: list[np.ndarray]):
        token = np.concatenate([np.zeros(0, np.uint64), *sets])
        owner = np.repeat(np.arange(len(sets)), np.array([len(s) for s in sets], np.int64))
        order = np.lexsort((owner, token))
        token = token[order]
        self.owner = owner[order]
        heads = X.runs(token).astype(np.int64)
        self.tokens = token[heads]
        self.bounds = np.append(heads, len(token))

    def of(self, tokens: np.ndarray, open_: np.ndarray) -> list[list[int]]:
        """What the lists of tokens hold of the open classes; ascending class numbers, empty lists left out."""
        if not len(self.tokens):
            return []
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        at = at[self.tokens[at] == tokens]
        own = [self.owner[a:z] for a, z in zip(self.bounds[at].tolist(), self.bounds[at + 1].tolist(), strict=True)]
        every = np.concatenate(own) if own else np.zeros(0, np.int64)
        held = open_[every]
        ends = np.concatenate([[0], np.cumsum(held)])[np.cumsum([0] + [len(x) for x in own])].tolist()
        left = every[held].tolist()
        return [left[a:z] for a, z in zip(ends, ends[1:], strict=False) if z > a]


def merge_skip(lists: list[list[int]], needed: int) -> dict[int, int]:
    """Classes found in at least ``needed`` of the lists, and in how many, by a heap that skips ahead."""
    heap = [(own[0], i, 0) for i, own in enumerate(lists) if own]
    heapq.heapify(heap)
    found: dict[int, int] = {}
    while len(heap) >= needed:
        first = heap[0][0]
        popped = []
        while heap and heap[0][0] == first:
            popped.append(heapq.heappop(heap))
        if len(popped) >= needed:
            found[first] = len(popped)
            target = first + 1
        else:
            while heap and len(popped) < needed - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            target = max(heap[0][0], first + 1)
        for _, i, at in popped:
            own = lists[i]
            at = bisect_left(own, target, at)
            if at < len(own):
                heapq.heappush(heap, (own[at], i, at))
    return found


def t_occurrence(lists: list[list[int]], needed: int) -> dict[int, int]:
    """Classes found in at least ``needed`` of the lists, and in how many (DivideSkip)."""
    if len(lists) < needed:
        return {}
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    aside = min(needed - 1, int(needed / (SKIP_WEIGHT * math.log2(longest + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    found = {}
    for c, n in merge_skip(short, needed - aside).items():
        left = aside
        for own in long:
            if n + left < needed:
                break
            left -= 1
            at = bisect_left(own, c)
            n += at < len(own) and own[at] == c
        if n >= needed:
            found[c] = n
    return found


class Class:
    """One class in a search: its id, the size of its set, its shared shingles and its words."""

    def __init__(self, number: int, size: int, tokens: np.ndarray, body: bytes):
        self.number, self.size, self.tokens, self.body = number, size, tokens, body

    def words(self, n: int) -> set:
        return shingles(zstandard.ZstdDecompressor().decompress(self.body), n)


def similar(a: Class, b: Class, own: set, n: int, percent: int) -> bool:
    """Do two classes link by their words?  ``own`` holds the shingles of the first."""
    other = b.words(n)
    shared = len(own & other)
    return 100 * shared >= percent * (len(own) + len(other) - shared)


def search(queries: list[Class], classes: list[Class], percent: int, n: int) -> Sets:
    """Disjoint sets of the class ids that links join.

    A link is seen from either end.  So where all classes query, the component that holds
    most of them, once there is one, need not be looked up any more: its members look up
    whoever is outside, in lists of those alone.  A class that links with one of a few
    members of it is a member, and need not look up the rest either.
    """
    sets = Sets()
    both, main, members = queries is classes, None, []
    held, lists = classes, Lists([c.tokens for c in classes])
    outer, outer_lists = held, lists

    def columns(own):
        return np.array([c.size for c in own], np.int64), np.array([sets.find(c.number) for c in own], np.int64)

    sizes, roots = columns(held)
    for number, me in enumerate(queries):
        own = None
        mine = sets.find(me.number)
        if main is not None and mine != sets.find(main):
            for other in members:
                overlap = len(np.intersect1d(me.tokens, other.tokens, assume_unique=True))
                if 100 * overlap >= percent * (me.size + other.size - overlap):
                    own = own if own is not None else me.words(n)
                    if similar(me, other, own, n, percent):
                        mine = sets.join(me.number, other.number)
                        _, roots = columns(held)
                        break
        inside = main is not None and mine == sets.find(main)
        if inside:
            at, found = outer, outer_lists
            size_of, root_of = columns(outer)
        else:
            at, found, size_of, root_of = held, lists, sizes, roots
        # open are the classes of a possible size that are not linked to this one yet
        open_ = (root_of != mine) & (100 * size_of >= percent * me.size) & (100 * me.size >= percent * size_of)
        if both and main is not None and not inside:
            open_ &= root_of != sets.find(main)
        if not open_.any():
            continue
        linked = []
        for c, overlap in t_occurrence(found.of(me.tokens, open_), least_overlap(me.size, percent)).items():
            other = at[c]
            if 100 * overlap >= percent * (me.size + other.size - overlap) and sets.find(me.number) != sets.find(other.number):
                own = own if own is not None else me.words(n)
                if similar(me, other, own, n, percent):
                    sets.join(me.number, other.number)
                    linked.append(other)
        if not linked:
            continue
        _, roots = columns(held)
        if main is None and number < 16:
            values, counts = np.unique(roots, return_counts=True)
            if 2 * counts.max() >= len(held):
                main = int(values[counts.argmax()])
                members = [c for c in (me, *linked) if sets.find(c.number) == sets.find(main)][:REPRESENTATIVES]
        if main is not None and 2 * np.count_nonzero(columns(outer)[1] != sets.find(main)) < len(outer):
            outer = [c for c in outer if sets.find(c.number) != sets.find(main)]
            outer_lists = Lists([c.tokens for c in outer])
            if both:
                held, lists = outer, outer_lists
                sizes, roots = columns(held)
    return sets


def components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id is the least id that links reach."""
    sets = shared_sets(docs.select(F.col("doc_id").cast("long"), "text"), n, percent)
    classes = cut(sets.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("size"), F.first("tokens").alias("tokens"), F.first("body").alias("body")).withColumn("class", F.monotonically_increasing_id()))

    def listed(batches):
        """Classes of a partition that list a shingle and are of about one size, joined; each shingle goes on with one of them."""
        sets, least = Sets(), {}
        # a little more than the widest ratio of sizes, so that rounding parts no partners
        ratio = math.log(100 / percent) * (1 + 1e-9)

        def told():
            keys = list(least)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([least[k] for k in keys], pa.int64()), pa.nulls(len(keys), pa.int64())], names=["key", "class", "other"])

        for batch in batches:
            for c, size, tokens in zip(*(batch.column(x).to_pylist() for x in ("class", "size", "tokens")), strict=True):
                own = np.frombuffer(tokens, "<u8")
                # of the whole set the unshared shingles come first; they have no partner
                own = own[: max(1, len(own) - least_overlap(size, percent) + 1)]
                # partners are of one step of sizes or of two that follow each other, so they share one of two keys
                step = int(math.log(size) / ratio) if ratio else size
                for more in (0, 1) if ratio else (0,):
                    for k in mix(own + np.uint64(step + more) * _STEP).view(np.int64).tolist():
                        sets.join(c, least.setdefault(k, c))
                if len(least) > KEYS:
                    yield from told()
                    least = {}
        yield from told()
        nodes = [c for c in sets.up if sets.find(c) != c]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(nodes, pa.int64()), pa.array([sets.find(c) for c in nodes], pa.int64())], names=["key", "class", "other"])

    path = shared_path(docs.sparkSession, "listed")
    rows = written(classes.select("class", "size", "tokens").mapInArrow(tidy(listed), "key bigint, class bigint, other bigint"), path)
    # a shingle comes from each partition once at most, however many classes list it
    across = rows.where("key is not null").groupBy("key").agg(F.min("class").alias("a"), F.collect_set("class").alias("every")).where(F.size("every") > 1)
    edges = rows.where("key is null").select(F.col("class").alias("a"), F.col("other").alias("b")).unionByName(across.select("a", F.explode("every").alias("b")))
    groups = connected_components(edges)
    drop_path(docs.sparkSession, path)  # the components have read all of it

    grouped = classes.select("class", "size", "tokens", "body").join(groups.select(F.col("node").alias("class"), F.col("root").alias("grp")), "class")
    sizes = groups.groupBy(F.col("root").alias("grp")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    split = sizes.where("blocks > 1")
    alone = grouped.join(split, "grp", "left_anti").withColumns({"lo": F.lit(0), "hi": F.lit(0), "block": F.lit(0)})
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    pair = F.explode(F.transform(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")), lambda i: F.struct(F.least(i, "block").alias("lo"), F.greatest(i, "block").alias("hi"))))
    cross = grouped.join(split, "grp").withColumn("block", block).withColumn("pair", pair).select("class", "size", "tokens", "body", "grp", F.col("pair.lo").alias("lo"), F.col("pair.hi").alias("hi"), "block")

    def links(table: pa.Table) -> pa.Table:
        rows = [(Class(r["class"], r["size"], np.frombuffer(r["tokens"], "<u8"), r["body"]), r["block"]) for r in table.to_pylist()]
        rows.sort(key=lambda r: r[0].number)
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        left = [c for c, block in rows if block == lo]
        found = search(left, left if lo == hi else [c for c, block in rows if block == hi], percent, n)
        nodes = [c for c in found.up if found.find(c) != c]
        return pa.table({"a": pa.array(nodes, pa.int64()), "b": pa.array([found.find(c) for c in nodes], pa.int64())})

    found = alone.unionByName(cross).groupBy("grp", "lo", "hi").applyInArrow(links, "a bigint, b bigint")
    # an id that has several texts joins their classes
    same = sets.where("digest is not null").groupBy("doc_id").agg(F.collect_set("digest").alias("d")).where(F.size("d") > 1).select("doc_id", F.explode("d").alias("digest")).join(classes.select("digest", "class"), "digest")
    same = same.select(F.min("class").over(Window.partitionBy("doc_id")).alias("a"), F.col("class").alias("b"))
    roots = connected_components(found.unionByName(same)).withColumnRenamed("node", "class")
    joined = classes.select("digest", "class", "id").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = joined.groupBy("root").agg(F.min("id").alias("component_id"))
    of_digest = joined.join(least, "root").select("digest", "component_id")
    linked = sets.where("digest is not null").select("doc_id", "n_shingles", "digest").join(of_digest, "digest").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(sets.where("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


