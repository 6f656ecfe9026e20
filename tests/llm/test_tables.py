import base64
import hashlib
import random
import uuid

import numpy as np
import pytest

from corpusmill.llm import queries, vectors, warc
from corpusmill.llm.frames import shared_path
from corpusmill.llm.graph import connected_components


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf, same, name):
    same(queries.QUERIES[name](spark, sf), queries.ORACLE_SQL[name])


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2040)] + [(None, 3), (7, 7)]
    up = {}

    def find(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    frame = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert {r["node"]: r["root"] for r in connected_components(frame).collect()} == {a: find(a) for a in up}
    assert connected_components(frame.limit(0)).count() == 0


@pytest.mark.parametrize(("region", "most", "fan"), [(1000, 1000, 512), (30, 400, 512), (30, 40, 512), (10, 400, 3)])
def test_vectors_against_brute_force(spark, monkeypatch, region, most, fan):
    monkeypatch.setattr(vectors, "FAN", fan)
    near_duplicates = lambda frame: vectors.near_duplicates(frame, region=region, most=most, shard=30)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[i % 40] + rng.normal(size=16) * 0.05).tolist(), int(i % 3)) for i in range(400)]
    rows += [(400 + i, base[0].tolist(), 0) for i in range(5)] + [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, base[0].tolist(), None), (504, [1.0, None], 1), (505, [], 1), (506, [float("inf")] * 16, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    sound = [(i, np.array(v), g) for i, v, g in rows if g is not None and i < 500]
    links = {i: [j for j, w, h in sound if i != j and g == h and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98] for i, v, g in sound}
    found = {r["vec_id"]: r for r in near_duplicates(frame).collect()}
    assert len(found) == len(rows)
    true, got = sum(map(len, links.values())), sum(found[i]["n_links"] for i in links)
    assert got == true
    assert all(found[i]["n_links"] == len(links[i]) for i in links)
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (500, 501, 502, 503, 504, 505, 506))
    assert {found[400 + i]["component_id"] for i in range(5)} == {found[400]["component_id"]}
    assert vectors.measured_recall(frame.where("vec_id < 500"), near_duplicates(frame)) >= 0.999
    assert near_duplicates(frame.limit(0)).count() == 0


def test_warc_round_trip_with_magic_in_payloads(spark):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rng = random.Random(1)
    rows = [(i, f"/u {i}", "x" * rng.randint(0, 900) + ("é" if i % 3 else "")) for i in range(60)]
    rows += [(100, "u", "WARC/1.1\r\n"), (101, "u", "pre" + fake + "post"), (102, "u", fake), (103, None, None), (104, "u\r\nx", ""), (105, "u", "dup"), (106, "u", "dup"), (107, "u", "dup"), (108, "u", fake * 3 + "q" * 7000), (None, "u", "no id"), (109, "u", "\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {}
    for i, _, h in rows:
        texts.setdefault(h or "", []).append(i)
    want = set()
    for i, _, h in rows:
        largest = max((x for x in texts[h or ""] if x is not None), default=None)
        data = (h or "").encode()
        want.add((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == largest else "revisit", None if i == largest else largest))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        for payload in (True, False):
            path = shared_path(spark, f"warc-{uuid.uuid4().hex}")
            warc.write(pages.repartition(3), path)
            records = warc.read(spark, path, payload)
            found = {(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.resolved(records).collect()}
            assert found == want
            if payload:
                bodies = {r["record_id"]: r["payload"] for r in records.where("record_type = 'response'").collect()}
                assert bodies["<urn:page:108>"] == fake * 3 + "q" * 7000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    path = shared_path(spark, "warc-empty")
    warc.write(pages.limit(0), path)
    assert warc.resolved(warc.read(spark, path, False)).count() == 0
