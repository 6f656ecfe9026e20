"""Id files, exact clusters and fill-in-middle against plain versions, with nulls, ties, long texts and empty tables."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import idfile, infill, lloyd, queries
from corpusmill.llm.frames import shared_path

BYTES = "byte_bpe_50k.json"


def test_elias_fano_against_the_numbers():
    rng = np.random.default_rng(2)
    for n, top in [(1, 0), (1, 7), (5, 0), (300, 10), (300, 1 << 40), (2000, 2000), (5000, 1 << 20), (700, (1 << 62) + 5)]:
        values = np.sort(rng.integers(0, top + 1, n))
        made = idfile.EliasFano.encode(values)
        again, size = idfile.EliasFano.unpacked(memoryview(made.packed()), n, made.bits)
        assert size == len(made.packed())
        assert again.select(np.arange(n)).tolist() == values.tolist()
        for k in rng.integers(0, n, 5).tolist():
            assert int(again.select(k)[0]) == values[k]
        for v in [*rng.choice(values, 3).tolist(), -1, top]:
            assert again.rank(v) == (values <= v).sum()
    assert idfile.EliasFano.encode(np.zeros(0)).select(np.zeros(0, int)).tolist() == []
    dense = idfile.EliasFano.encode(np.cumsum(rng.integers(100, 3000, 100_000)))
    # the low bits, two to three bits in unary with the directory: a fifth of a table of 64-bit offsets
    assert len(dense.packed()) * 8 / 100_000 < dense.bits + 3


def test_shard_tells_what_it_holds():
    documents = [np.arange(3), np.zeros(0, int), np.arange(500), np.array([9])]
    data = idfile.shard_bytes(4, 2, [None, -5, -5, 1 << 40], documents, 2) + b"\n"
    shard = idfile.Shard(data)
    assert (shard.part, shard.shard, shard.n_docs, shard.n_ids) == (4, 2, 4, 504) and shard.doc_ids() == [None, -5, -5, 1 << 40]
    assert [shard.document(k).tolist() for k in range(4)] == [d.tolist() for d in documents]
    assert [shard.holder(p) for p in (0, 2, 3, 502, 503)] == [0, 0, 2, 2, 3]
    broken = bytearray(data)
    broken[70] ^= 1
    with pytest.raises(ValueError):
        idfile.Shard(bytes(broken))


def _plain_ids(texts, end):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary(BYTES))
    return [library.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def test_token_files_against_the_library(spark, documents):
    rng = random.Random(8)
    odd = ["<|endoftext|>", "a　b", " x", "'s 're", "\n\n\t", "é" * 40, "日本", "\x00", "\U0001f600 x"]
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(100 + i, "".join(rng.choice(odd) for _ in range(9))) for i in range(60)] + [(-3, "below"), (1 << 50, "far")]
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, start string, ids int").repartition(5)
    want = {i: [] for i, _ in rows}
    ids = dict(zip(rows, _plain_ids([t for _, t in rows], 2), strict=True))
    for (i, _), found in ids.items():
        want[i].append(found)
    for most_ids, most_docs in ((1 << 24, 1 << 18), (900, 7)):
        path = shared_path(spark, "ids")
        idfile.write(docs, path, queries.vocabulary(BYTES), shard_ids=most_ids, shard_docs=most_docs)
        found = idfile.read(spark, path, ids=True).collect()
        assert len(found) == len(rows)
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids"] in want[r["doc_id"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            at += r["n_tokens"]
        order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
        assert order == sorted(order, key=lambda i: (i is not None, i or 0))
        files = [Path(p.replace("file:", "")).read_bytes() for p in (r["path"] for r in spark.read.format("binaryFile").load(f"{path}/shards").select("path").collect())]
        assert sum(idfile.Shard(f).n_docs for f in files) == len(rows) and (most_docs > 7 or len(files) > 8)
    path = shared_path(spark, "ids")
    idfile.write(docs.limit(0), path, queries.vocabulary(BYTES))
    assert idfile.read(spark, path).count() == 0


def test_token_files_query_against_the_library(spark, sf):
    rows = sorted((r["doc_id"], r["text"]) for r in queries.table(spark, sf, "documents").select("doc_id", "text").collect())
    want, at = set(), 0
    for (i, _), ids in zip(rows, _plain_ids([t for _, t in rows], 2), strict=True):
        want.add((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert {tuple(r) for r in queries.op11_token_files(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect()} == want


def test_token_file_of_a_very_long_text(spark):
    text = " ".join(f"w{i % 977}" for i in range(400_000))
    path = shared_path(spark, "ids")
    idfile.write(spark.createDataFrame([(2, text), (1, "a"), (3, text)], "doc_id long, text string"), path, queries.vocabulary(BYTES), shard_ids=1000)
    found = {r["doc_id"]: r for r in idfile.read(spark, path).collect()}
    assert found[2]["ids_crc32"] == found[3]["ids_crc32"] and found[3]["start"] == found[2]["start"] + found[2]["n_tokens"] and found[2]["n_tokens"] > 400_000


def _plain_lloyd(rows, k=16, rounds=3):
    """Straight rounds in Python integers."""
    seeds = sorted(rows, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [list(v) for _, v in seeds]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    for step in range(rounds + 1):
        owner = [min(range(len(centres)), key=lambda c: (far(v, centres[c]), c)) for _, v in rows]
        if step == rounds:
            break
        for c in range(len(centres)):
            own = [v for (_, v), o in zip(rows, owner, strict=True) if o == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    distance = [far(v, centres[o]) for (_, v), o in zip(rows, owner, strict=True)]
    inertia = {c: sum(d for d, o in zip(distance, owner, strict=True) if o == c) for c in set(owner)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i if i is not None else -1), o, d, inertia[o], sum(distance), digest[o]) for (i, _), o, d in zip(rows, owner, distance, strict=True))


@pytest.mark.parametrize("kind", ["spread", "clustered", "ties", "large", "few"])
def test_clusters_against_plain_rounds(spark, kind):
    rng = np.random.default_rng(5)
    n = {"few": 9}.get(kind, 700)
    v = rng.normal(size=(n, 64)) * {"large": 1e5}.get(kind, 1.0)
    if kind == "clustered":
        v = rng.normal(size=(12, 64))[rng.integers(0, 12, n)] + rng.normal(size=(n, 64)) * 0.01
    if kind == "ties":
        v = np.repeat(rng.integers(-1, 2, size=(20, 64)) / 2, 35, axis=0)
    rows = [(i, x) for i, x in enumerate(v.tolist())] + [(3, v[3].tolist()), (None, v[0].tolist())]
    whole = [(i, [int(np.floor(64 * c)) for c in x]) for i, x in rows]
    bad = [(900, None), (901, []), (902, [1.0] * 63), (903, [float("nan")] * 64), (904, [None] + [0.0] * 63), (905, [float("inf")] + [0.0] * 63), (906, [1e30] * 64)]
    frame = spark.createDataFrame([(i, x, "c", 7) for i, x in rows + bad], "vec_id long, embedding array<double>, cluster string, distance int").repartition(3)
    for block in (64, 1024):
        found = sorted((r["vec_id"] if r["vec_id"] is not None else -1, *list(r)[1:]) for r in lloyd.cluster(frame, block=block).collect())
        assert found == _plain_lloyd(whole)
    assert lloyd.cluster(frame.limit(0)).count() == 0


def test_bounds_prune_and_the_tree_covers():
    rng = np.random.default_rng(1)
    groups = rng.integers(-2000, 2000, size=(16, 64))
    v = groups[rng.integers(0, 16, 1000)] + rng.integers(-9, 9, size=(1000, 64))
    tree = lloyd.cover_tree(v, lloyd.LEAF)
    inside = v[tree.order].astype(float)
    for s, e, first, count, r in zip(tree.start, tree.end, tree.first, tree.count, tree.radius, strict=True):
        assert np.sqrt(((inside[s:e] - inside[s]) ** 2).sum(1)).max() <= r + 1e-6
        if count:
            assert tree.start[first] == s and tree.end[first + count - 1] == e
            centres = inside[tree.start[first : first + count]]
            gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2)) + np.eye(count) * 1e9
            assert gaps.min() > 2.0 ** (np.ceil(np.log2(r)) - 1) - 1e-6
    again = lloyd.CoverTree.unpacked(tree.packed())
    owner, compared = lloyd.nearest(again, v[tree.order], lloyd.Centroids(groups.astype(np.int64)))
    assert owner.tolist() == ((inside[:, None] - groups[None]) ** 2).sum(2).argmin(1).tolist()
    assert compared < 1000


CUTS = {"lines": re.compile(r"[^\n]*\n|[^\n]+"), "words": re.compile(r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+"), "chars": re.compile(r"(?s).")}


def _plain_infill(doc_id, text, kind, rate, spm):
    units = CUTS[kind].findall(text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize(("kind", "rate", "spm"), [("lines", 100, 50), ("words", 100, 0), ("chars", 60, 100)])
def test_fill_in_middle_against_plain_cuts(spark, kind, rate, spm):
    rng = random.Random(3)
    bits = ["\n", "\r\n", "a", "bc ", "é", "\U0001f600", "<", "<P", ">", "S>", "\t", "\x00", " ", "<M"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "a<P>b"), (503, "<M>"), (504, "\n"), (505, "x\n" * 60_000 + "end"), (None, "a\nb"), (7, "same\nid"), (7, "same\nid"), (508, " lead")]
    docs = spark.createDataFrame([(i, t, "mine", 1) for i, t in rows], "doc_id long, text string, Form string, kept int").repartition(3)
    made = infill.transform(docs, kind, rate=rate, spm=spm)
    assert [c.lower() for c in made.columns].count("form") == 1 and "kept" in made.columns
    got = sorted(infill.restore(made).select("doc_id", F.coalesce("text", F.lit("")).alias("t"), "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect(), key=str)
    assert len(got) == len(rows) and all(r["restored"] == r["t"] for r in got)
    want = sorted([(i, *_plain_infill(i, t or "", kind, rate, spm)) for i, t in rows], key=str)
    assert sorted([(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got], key=str) == want
    assert infill.digests(infill.transform(docs.limit(0), kind)).count() == 0
