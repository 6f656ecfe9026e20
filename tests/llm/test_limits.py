"""Brute force for scans and scores, very long texts, empty tables, clashing columns."""

import base64
import bz2
import gzip
import hashlib
import lzma
import os
import random
import sys
import urllib.parse
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute

import corpus_pipeline
from corpusmill.llm import bpe, chat, frames, jaccard, quality, queries, secrets, substrings, toxicity, vectors


def test_base_spans_against_a_walk():
    rng = random.Random(6)
    bits = ["password", "PassWD", "secret", "api_key", "APIKEY", "api", "token", "=", ":", '"', "'", " ", "AKIA", "ABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "x", "é", "\n", "K", "ı", "ſecret", "abcdefghijkl", "/+_.-="]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert secrets.base_spans(text) == brute.secrets(text), text


def test_scan_query_against_a_walk(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, sf, "documents").collect()}
    for r in queries.op7_secret_scan(spark, sf).collect():
        spans = brute.secrets(texts[r["doc_id"]])
        written = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(r["spans"].split(","))


def test_every_coding_three_deep():
    deflate = zlib.compressobj(9, zlib.DEFLATED, -15)
    inner = "some words password=abcdefghijkl1 and more"
    codings = {
        "url": lambda t: "".join(f"%{b:02x}" for b in t.encode()), "unicode": lambda t: "".join(f"\\u{ord(c):04x}" for c in t), "base64": lambda t: base64.b64encode(t.encode()).decode(),
        "gzip": lambda t: base64.b64encode(gzip.compress(t.encode())).decode(), "zlib": lambda t: base64.b64encode(zlib.compress(t.encode())).decode(), "bzip2": lambda t: base64.b64encode(bz2.compress(t.encode())).decode(),
        "xz": lambda t: base64.urlsafe_b64encode(lzma.compress(t.encode())).decode(),
    }
    for one in codings.values():
        for two in codings.values():
            coded = one(two(codings["url"](inner)))
            text = f"before {coded} after"
            spans = secrets.find_spans(text)[1]
            assert any(k == 0 and a >= 7 and b <= 7 + len(coded) for a, k, b in spans), text[:80]
            assert inner not in secrets.redacted(text, spans)
    raw = base64.b64encode(deflate.compress(inner.encode()) + deflate.flush()).decode()
    members = base64.b64encode(gzip.compress(b"nothing in here") + gzip.compress(inner.encode())).decode()
    beside = base64.b64encode(bytes(range(128, 228)) + inner.encode() + bytes(range(128, 228))).decode()
    wide = base64.b64encode(inner.encode("utf-16-le")).decode()
    short = base64.b64encode(gzip.compress(inner.encode() * 40)[:-12]).decode()
    for coded in (raw, members, beside, wide, short):
        assert (2, 0, 2 + len(coded)) in [(a, k, b) for a, k, b in secrets.find_spans(f"x {coded}")[1]]
    circle = "%25" * 40 + "41"
    assert secrets.find_spans(circle + urllib.parse.quote(circle))[0] == []


def test_symbols_and_repeated_rows_of_quality(spark):
    text = "## a|b <c> 100% & $5 * word\n" * 3
    found = quality.judge(spark.createDataFrame([(1, text, "en"), (1, text, "en"), (2, None, None)], "doc_id long, text string, lang string")).collect()
    assert [r["n_symbols"] for r in found if r["doc_id"] == 1] == [sum(c in "#*$%&|<>" for c in text)] * 2
    assert [(r["n_dup_lines"], r["kept"]) for r in found if r["doc_id"] == 2] == [(0, False)]


def test_risk_stays_above_zero():
    rng = np.random.default_rng(3)
    # feature 0 marks toxic texts, feature 1 the others, the rest are noise by which few positives could be learned by heart
    make = lambda n, toxic: [np.unique(np.concatenate([[0] if t else [1], rng.integers(2, 100, 6)])).astype(np.int32) for t in toxic[:n]]
    positive, mixed = make(200, np.ones(200, bool)), rng.random(900) < 0.3
    unlabelled = make(900, mixed)
    w = toxicity.train(toxicity.Rows(positive), toxicity.Rows(unlabelled), 0.3, 100, epochs=200)
    z = lambda rows: np.array([w[r].sum() + w[-1] for r in rows])
    negative = np.logaddexp(0, z(unlabelled)).mean() - 0.3 * np.logaddexp(0, z(positive)).mean()
    assert w[0] > 0 > w[1] and negative > -0.05
    score = z(unlabelled)
    assert (score[mixed][:, None] > score[~mixed][None, :]).mean() > 0.9


def test_held_out_rows_by_checksum(spark):
    rows = spark.range(200).select(F.col("id").alias("doc_id"), toxicity.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert spark.createDataFrame([(None,)], "doc_id long").select(toxicity.held_out()).first()[0] is False


@pytest.fixture(scope="module")
def long_rows():
    """A text of more than a chunk, its copy with one word changed, and a passage of it."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(50_000)]
    text = [rng.choice(words) for _ in range(1_300_000)]
    other = [*text]
    other[700_000] = "changed"
    rows = [(1, " ".join(text)), (2, " ".join(other)), (3, " ".join(text[5000:5060]) + " own end"), (4, "")]
    assert len(rows[0][1]) > substrings.X.CHUNK_BYTES
    return rows


def test_very_long_texts(spark, long_rows):
    docs = spark.createDataFrame(long_rows, "doc_id long, text string").repartition(2).cache()
    removed = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed").collect()}
    assert removed == {1: (1_300_000, 0), 2: (1_300_000, 1_299_999), 3: (62, 60), 4: (0, 0)}
    assert {r["doc_id"]: r["component_id"] for r in jaccard.components(docs, 4, 85).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    hidden = docs.where("doc_id = 1").withColumn("text", F.concat("text", F.lit(" password=abcdefghijkl1"))).select("doc_id", "text", F.lit("en").alias("lang"))
    assert secrets.scan(hidden).first()["n_assign"] == 1
    assert quality.judge(hidden).first()["n_words"] == 1_300_001
    docs.unpersist()


def test_nothing_in_nothing_out(spark, nothing, tmp_path):
    assert bpe.round_trip(nothing, queries.vocabulary("word_bpe_49k.json")).count() == 0
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_of_other_meaning_give_way(spark):
    path = queries.vocabulary("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "a b c", "x", "x", "x", "x", "x"), (1, "a b c", "x", "x", "x", "x", "x"), (2, None, None, None, None, None, None)], "doc_id long, text string, ids string, Decoded string, held_out string, predicted string, score string")
    made = bpe.round_trip(docs, path)
    assert [c.lower() for c in made.columns].count("decoded") == 1 and made.where("decoded = ''").count() == 1 and made.where("size(ids) = 3").count() == 2
    scored = toxicity.score(docs, toxicity.Model(np.zeros(0, np.uint64), np.zeros(1)))
    assert scored.columns.count("held_out") == 1 and {r["score"] for r in scored.collect()} == {0.5}
    found = vectors.near_duplicates(spark.createDataFrame([(1, [1.0, 0.0], "a", 5, True), (2, [1.0, 0.0], "a", 6, None)], "vec_id long, embedding array<double>, label string, n_links int, kept boolean"))
    assert {(r["vec_id"], r["n_links"], r["kept"]) for r in found.collect()} == {(1, 1, True), (2, 1, False)}
    turns = spark.createDataFrame([(1, 0, "user", "x", "y"), (1, 1, "assistant", None, None)], "conv_id long, turn long, role string, text string, formatted string")
    assert chat.format_chat(turns).columns.count("formatted") == 1


def test_rows_of_one_id_in_the_second_stage(spark):
    base = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, base, "a"), (1, base, "b"), (1, base + " x", "c"), (2, base, "d"), (None, base, "e"), (None, base, "f"), (3, "other", "g")], "doc_id long, text string, source string")
    left = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == [(0, base), (0, base), (1, base), (1, base + " x"), (3, "other")]


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "none"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, other):
                return other

    with pytest.raises(ValueError):
        frames.shared_dir(Session())


def test_cells_of_two_levels(spark):
    rng = np.random.default_rng(2)
    tree = vectors.Cells(vectors.centroids(vectors.unit(rng.normal(size=(400, 8))), 4))
    tree.cut(1, vectors.centroids(vectors.unit(rng.normal(size=(100, 8))), 3))
    near = tree.near(vectors.unit(rng.normal(size=(50, 8))), 3)
    assert near.shape == (50, 3) and near.min() >= 0 and near.max() == 5 and all(len(set(r)) == 3 for r in near.tolist())
    assert vectors.Cells(np.zeros((0, 8))).near(np.ones((2, 8)), 2).tolist() == [[0, -1], [0, -1]]


def test_arrow_of_nothing():
    assert substrings._joined(substrings.split_words(pa.array(["", None])), np.zeros(0, bool)).to_pylist() == ["", ""]


def _nested(rng, offset, wrap):
    """A text whose only secret lies in compressed data inside compressed data, ``offset`` characters in."""
    noise = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    hard = "".join(chr(rng.randrange(33, 126)) for _ in range(20_000))
    body = base64.b64encode(gzip.compress(f"{hard} password=abcdefghijkl1 ".encode())).decode()
    if wrap:
        body = "\n".join(body[i : i + wrap] for i in range(0, len(body), wrap))
    return base64.b64encode(gzip.compress(f"{noise(offset)} key: {body} {noise(30_000)}".encode())).decode()


@pytest.mark.parametrize("wrap", [0, 76])
def test_no_layer_is_lost_where_windows_meet(monkeypatch, wrap):
    monkeypatch.setattr(secrets, "MAX_LAYER", 1 << 16)
    monkeypatch.setattr(secrets, "OVERLAP", 1 << 12)
    rng = random.Random(wrap)
    for offset in (1000, 40_000, 55_000, 61_000, 65_500, 65_536, 70_000, 128_000):
        coded = _nested(rng, offset, wrap)
        assert (2, 0, 2 + len(coded)) in secrets.find_spans("x " + coded)[1], offset


def test_memory_of_a_long_text_with_one_escape():
    import tracemalloc

    text = "word and more words " * 100_000 + "%41 \\x41" + "word and more words " * 100_000
    tracemalloc.start()
    secrets.find_spans(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * len(text)


def test_forms_of_escapes_and_where_they_come_from():
    secret = "password=abcdefghijkl1"
    forms = {
        "\\u": lambda c: f"\\u{ord(c):04x}", "braces": lambda c: f"\\u{{{ord(c):x}}}", "long": lambda c: f"\\U{ord(c):08X}", "percent u": lambda c: f"%u{ord(c):04x}",
        "byte": lambda c: f"\\x{ord(c):02x}", "percent": lambda c: f"%{ord(c):02X}",
    }
    for one in forms.values():
        whole = "".join(map(one, secret))
        assert secrets.find_spans(f"a {whole} b")[1] == [(2, 0, 2 + len(whole))]
        first = one("p") + secret[1:]
        assert secrets.find_spans(f"a {first} b")[1] == [(2, 0, 2 + len(first))]
        for two in forms.values():
            twice = "".join(map(two, whole))
            assert secrets.find_spans(f"é {twice} b")[1] == [(2, 0, 2 + len(twice))]
    coded = "".join(forms["byte"](c) for c in "nothing") + " \\ud83d\\ude00\\u{110000}\\u{d800}%uD83D " + secret
    assert (len(coded) - len(secret), 0, len(coded)) in secrets.find_spans(coded)[1]


def _decoded_spans(text, depth=3):
    """Spans of texts in which only whole words are encoded, by decoding every word as often as it can be."""
    found = {(a, k, b) for a, k, b in brute.secrets(text)}
    at = 0
    for word in text.split(" "):
        seen, now = set(), {word}
        for _ in range(depth):
            now = {d for w in now for d in _readings(w)} - seen
            seen |= now
            found |= {(at, k, at + len(word)) for w in now for a, k, b in brute.secrets(w)}
        at += len(word) + 1
    return found


def _readings(word):
    out = set()
    if "%" in word:
        out.add(urllib.parse.unquote(word))
    if len(word) >= 16 and not set(word.rstrip("=")) - set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
        try:
            data = base64.b64decode(word.rstrip("=") + "=" * (-len(word.rstrip("=")) % 4))
            out.add(gzip.decompress(data).decode() if data[:2] == b"\x1f\x8b" else data.decode())
        except (ValueError, OSError, EOFError):
            pass
    return out - {word}


def test_decoded_spans_against_a_plain_decoder():
    rng = random.Random(12)
    secret = lambda: rng.choice(["password=", "api_key:", "token="]) + "".join(rng.choice("GHIJKLMNOPQRSTUVWXYZ_.-") for _ in range(rng.randint(8, 16)))
    codings = [
        lambda t: "".join(f"%{b:02X}" for b in t.encode()), lambda t: base64.b64encode(t.encode()).decode(), lambda t: base64.b64encode(gzip.compress(t.encode(), mtime=0)).decode(),
    ]
    for _ in range(300):
        words = []
        for _ in range(rng.randint(1, 6)):
            word = secret() if rng.random() < 0.6 else "plain"
            for _ in range(rng.randint(0, 3)):
                word = rng.choice(codings)(word)
            words.append(word)
        text = " ".join(words)
        got = set(secrets.find_spans(text)[1])
        # a span inside a word that is encoded as a whole may be told more closely than the word
        want = _decoded_spans(text)
        assert all(any(a <= x and y <= b and k == m for x, m, y in got) for a, k, b in want), text
        assert all(any(x >= a and y <= b and k == m for a, k, b in want) for x, m, y in got), text
