import base64
import gzip
import hashlib
import os
import sys
import urllib.parse

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute

from corpusmill.llm import bpe, chat, jaccard, packing, quality, queries, secrets, substrings, toxicity
from corpusmill.llm.words import grams, split_words


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_words_match_the_pattern():
    texts = ["a b  c\nd é", None, "", " x\ty\x0b", "z\x1cw"]
    found = split_words(pa.array(texts))
    assert found.counts.tolist() == [len(brute.WORD.findall(t or "")) for t in texts]
    h = split_words(pa.array(["a b a b"])).hashes()
    assert h[0] == h[2] != h[1] and grams(h, 2)[0] == grams(h, 2)[2]


def test_substrings_against_brute_force(documents, nothing):
    found = substrings.remove_repeats(documents.where("doc_id is null or doc_id <> 6"))
    kept = sorted(rows_of(documents.where("doc_id is null or doc_id <> 6")), key=lambda r: (r[0] is None, r[0] or 0))
    truth = {kept[i][0]: v for i, v in brute.repeats(kept).items()}
    got = found.collect()
    assert len(got) == len(kept) and "lang" in found.columns and found.columns.count("n_words") == 1
    for r in got:
        words, left = truth[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_text"]) == (len(words), len(words) - len(left), " ".join(left))
    assert substrings.remove_repeats(nothing).count() == 0


def test_repeated_rows_keep_one_copy(documents):
    twice = documents.where("doc_id = 6")
    assert sorted(r["n_removed"] for r in substrings.remove_repeats(twice).collect()) == [0, 120]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_components_against_brute_force(documents, n, percent):
    found = jaccard.components(documents, n, percent).collect()
    truth = brute.components(rows_of(documents), n, percent)
    assert len(found) == documents.count()
    for r in found:
        assert r["component_id"] == truth.get(r["doc_id"])
    sizes = {i: len(brute.shingles(t, n)) for i, t in rows_of(documents)}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in found)


def test_components_of_nothing(nothing):
    assert jaccard.components(nothing).count() == 0


def test_blocks_of_a_large_group_lose_no_link(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    truth = brute.components(rows_of(documents), 4, 60)
    assert all(r["component_id"] == truth.get(r["doc_id"]) for r in jaccard.components(documents, 4, 60).collect())


def test_t_occurrence_counts():
    rng = np.random.default_rng(0)
    for _ in range(50):
        lists = [sorted(rng.choice(9, rng.integers(1, 9), replace=False).tolist()) for _ in range(rng.integers(1, 12))]
        for need in range(1, len(lists) + 1):
            assert jaccard.t_occurrence(lists, need) == {c: n for c in range(9) if (n := sum(c in x for x in lists)) >= need}


def test_secrets_in_layers():
    inner = "password=abcdefghijkl1"
    blob = base64.b64encode(gzip.compress(urllib.parse.quote(inner, safe="").encode())).decode()
    text = f"see {blob} and %70assword%3Dabcdefghijklmn, \\u0041KIAABCDEFGHIJKLMNOP, token: 'abcdefghijkl' AKIA{'A' * 14} 0123456789abcdef"
    base, found = secrets.find_spans(text)
    assert [k for _, k, _ in base] == [0, 1, 2]
    at = text.index(blob)
    assert (at, 0, at + len(blob)) in found and any(k == 1 and text[a:b].startswith("\\u0041") for a, k, b in found)
    assert set(base) <= set(found)
    assert secrets.find_spans("") == ([], []) and secrets.base_spans("token=short") == []
    loop = base64.b64encode(b"QUFBQUFBQUFBQUFBQUFBQQ==").decode()
    assert secrets.find_spans(loop)[0] == []


def test_secrets_in_parts_of_an_assignment(monkeypatch):
    value = "hunterhunter1"
    url, escaped = "".join(f"%{ord(c):02x}" for c in value), "".join(f"\\u{ord(c):04x}" for c in value)
    for text in (f"password = {url} end", f'{{"password":"{url}"}}', f"password: {escaped} end", f'{{"password": "{escaped}"}}', f"%70assword = {escaped}"):
        _, found = secrets.find_spans(text)
        assert any(k == 0 for _, k, _ in found) and url not in secrets.redacted(text, found) and escaped not in secrets.redacted(text, found), text
    noise = "".join(map(str, np.random.default_rng(2).integers(0, 9, 400)))
    blob = base64.b64encode(gzip.compress(f"{noise} password={value}".encode())).decode()
    for lines in ("\n".join(blob[i : i + 64] for i in range(0, len(blob), 64)), "\r\n  ".join(blob[i : i + 20] for i in range(0, len(blob), 20))):
        for text in (lines, f"one\n{lines}\nThe end of it", f"data: {lines}\nBye\n", f"internationalization\n{lines}"):
            _, found = secrets.find_spans(text)
            assert any(k == 0 and a <= text.index(lines) and b >= text.index(lines) + len(lines) - 3 for a, k, b in found), text
    plain = base64.b64encode(f"{'some words ' * 9}password={value}".encode()).decode()
    lines = "\n".join(plain[i : i + 30] for i in range(0, len(plain), 30))
    assert any(k == 0 for _, k, _ in secrets.find_spans(f"{lines}\nThe end\n")[1])
    monkeypatch.setattr(secrets, "MAX_LAYER", 1000)
    monkeypatch.setattr(secrets, "OVERLAP", 100)
    for at in (5, 980, 3000, 7900):
        bomb = (b"x " * 4000)[:at] + b" password=hunterhunter1 " + b"x " * 4000
        for coded in (base64.b64encode(gzip.compress(bomb)).decode(), "".join(f"%{c:02x}" for c in gzip.compress(bomb))):
            assert (0, 0, len(coded)) in [(a, k, b) for a, k, b in secrets.find_spans(coded)[1]]


def test_secret_scan_of_odd_rows(documents, nothing):
    found = secrets.scan(documents)
    assert found.count() == documents.count() and found.where("text is null and spans = ''").count() == 1
    assert secrets.scan(nothing).count() == 0


def test_quality_counts(documents, nothing):
    found = {r["doc_id"]: r for r in quality.judge(documents).collect()}
    for i, text in rows_of(documents):
        words = brute.WORD.findall(text or "")
        seen = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        inside = {p for k, g in enumerate(seen) if seen.count(g) > 1 for p in range(k, k + 3)} if len(words) < 500 else None
        lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"]) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)))
        if inside is not None:
            assert r["n_repeat_words"] == len(inside)
            assert r["base_failed"] == (len(words) < 50 or 100 * len(inside) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])
    assert found[0]["kept"] is False and quality.judge(nothing).count() == 0


def test_distance_of_histograms():
    same = quality.js_distance(np.array([[1, 2], [4, 0]]), np.array([[2, 4], [0, 9]]))
    assert same[0] == pytest.approx(0, abs=1e-9) and same[1] == pytest.approx(1)


def test_divergence_rejects_what_the_base_rule_passes(spark):
    rng = np.random.default_rng(3)
    fill = {k: ["".join(rng.choice(list(letters), 6)) for _ in range(300)] for k, letters in (("en", "thnoerds"), ("fr", "aeiouqls"))}

    def prose(lang, end=""):
        common = quality.COMMON[lang].split()
        return " ".join((rng.choice(common) if rng.random() < 0.5 else rng.choice(fill[lang])) + end for _ in range(rng.integers(150, 400)))

    rows = [(i, prose(k), k) for i, k in enumerate(["en", "fr"] * 60)]
    rows += [(1000 + i, prose("fr"), "en") for i in range(3)] + [(1010 + i, prose("en", "###"), "en") for i in range(3)]
    found = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()}
    assert not any(r["base_failed"] for r in found.values())
    assert [i for i, r in found.items() if not r["kept"] and i < 1000] == [] and not any(r["kept"] for i, r in found.items() if i >= 1000)


def test_bpe_equals_the_library(spark, documents):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    library, codec = Tokenizer.from_file(path), bpe.WordCodec(path)
    texts = ["", "Hello, WORLD's <|endoftext|> aaaaaaa 123", "É é ß İ Σς  x\x1cy 東京 😀", "x" * 3000, *(t or "" for _, t in rows_of(documents))]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    made = bpe.decode(bpe.encode(documents, path), path)
    assert made.count() == documents.count() and made.where("text is null and size(ids) = 0 and decoded = ''").count() == 1


def test_packing_keeps_every_id_once(documents, nothing):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = packing.pack(documents.where("doc_id is null or doc_id <> 6"), path, window=256, piece=64, keep_ids=True).collect()
    whole, windows = {}, {}
    for r in rows:
        whole.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in rows_of(documents.where("doc_id is null or doc_id <> 6")):
        parts = sorted(whole[i])
        ids = [x for _, p, _ in parts for x in p]
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 1] and parts[0][2] == len(ids)
    total = 0
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
        total += at
    assert total > 0.9 * 256 * (len(windows) - 1)
    assert packing.pack(nothing, path).count() == 0


def test_differencing_is_even():
    sizes = np.random.default_rng(2).integers(1, 500, 300)
    window = packing.pack_group(sizes, 2048)
    sums = np.bincount(window, weights=sizes)
    assert sums.max() <= 2048 and len(sums) <= np.ceil(sizes.sum() / 2048) * 1.05 + 1


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "a \\[OUT] [ROLE] x [NAME] y", "", None, "plain é", "[\\INST] <\\s>"]
    rows = [(c, t, r, said[(c + t) % len(said)]) for c in range(20) for t, r in enumerate(["system", "user", "assistant", "tool [NAME]", None])]
    rows += [(None, 0, "user", "x"), (None, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    formatted = chat.format_chat(turns)
    got = {r["conv_id"]: r for r in formatted.collect()}
    assert len(got) == 21 and got[None]["n_turns"] == 2
    for c in range(20):
        want = [(r or "", t or "") for conv, _, r, t in rows if conv == c]
        assert chat.read_back(got[c]["formatted"]) == want
        loss = "".join(chat.unescape(got[c]["formatted"][m["start"] : m["end"]]) for m in got[c]["loss_mask"])
        assert loss == "".join(t for r, t in want if r == "assistant")
    digests = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    want = hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for conv, _, r, t in rows if conv == 3).encode()).hexdigest()
    assert digests[3]["turns_sha256"] == want
    assert chat.format_chat(turns.limit(0)).count() == 0


def test_toxicity_on_held_out_rows(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity.score(docs, toxicity.learn(docs, labels)).where("held_out").join(labels, "doc_id").toPandas()
    hit, said, true = ((found.predicted == 1) & (found.toxic == 1)).sum(), (found.predicted == 1).sum(), (found.toxic == 1).sum()
    assert hit / true > 0.8 and hit / said > 0.7


def test_toxicity_without_labels(documents, nothing, spark):
    labels = spark.createDataFrame([(None, None)], "doc_id long, toxic int")
    found = toxicity.score(documents, toxicity.learn(documents, labels))
    assert found.count() == documents.count() and found.where("predicted = 1").count() == 0
    assert toxicity.score(nothing, toxicity.learn(nothing, labels)).count() == 0


def _balanced(n):
    """Two different words whose letters cancel out in any power sum."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_built_alike_are_told_apart(spark):
    a, b = _balanced(1024)
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(i, f"{w} {rest} {w} {w}") for i, w in enumerate([a, b, *_balanced(2048)])]
    rows += [(10 + i, " ".join([w] * 16 + rest.split())) for i, w in enumerate((a, b))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    truth = brute.components(rows, 4, 10)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.components(docs, 4, 10).collect()} == truth
    kept = {i: " ".join(left) for (i, _), (_, left) in zip(rows, brute.repeats(rows, 6).values(), strict=True)}
    assert {r["doc_id"]: r["kept_text"] for r in substrings.remove_repeats(docs, 6).collect()} == kept


def test_a_wrong_index_is_noticed(spark, monkeypatch):
    """Where hashes of windows agree by chance, words decide; a second index tells them apart."""
    rows = [(i, " ".join(f"{c}{k}" for k in range(40))) for i, c in enumerate("abc")] + [(3, " ".join(f"a{k}" for k in range(40)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    real = substrings._differing
    seen = []

    def first_time_wrong(*args):
        seen.append(real(*args))
        return 1 if len(seen) == 1 else seen[-1]

    monkeypatch.setattr(substrings, "_differing", first_time_wrong)
    assert {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(docs).collect()} == {0: 0, 1: 0, 2: 0, 3: 40}
    assert seen == [0, 0]


def test_digests_are_those_of_the_words(spark):
    rows = [(i, " ".join(f"{c}{k}" for k in range(40))) for i, c in enumerate("ab")]
    chunks = substrings.X.chunked(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "text")
    row = chunks.frame.first().asDict()
    chunk = substrings.Chunk(row, "text", "doc_id")
    one, two = chunk.digests(np.array([0, 40]), np.array([40, 40]))
    assert one != two and one == hashlib.blake2b(rows[0][1].encode(), digest_size=16).digest()


def test_links_are_verified_by_words():
    packed = jaccard.zstandard.ZstdCompressor().compress
    tokens = np.arange(1, 10, dtype=np.uint64)
    make = lambda i, text: jaccard.Class(i, 9, tokens, packed(text.encode()))
    words = " ".join(f"w{k}" for k in range(12))
    same = [make(0, words), make(1, words), make(2, " ".join(f"v{k}" for k in range(12)))]
    sets = jaccard.search(same, same, 85, 4)
    assert sets.find(1) == 0 and sets.find(2) == 2


def test_large_groups_in_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 25)
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(160):
        words = list(base)
        for k in rng.choice(200, rng.integers(0, 6), replace=False):
            words[k] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.components(docs, 4, 85).collect()} == brute.components(rows, 4, 85)
