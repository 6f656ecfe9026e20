import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
import brute

import corpus_pipeline
from corpusmill.llm import secrets


def test_stages_against_brute_force(spark, documents, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(999, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        kept[name] = docs
        if name != "packing":
            assert docs.schema.names == before.schema.names
            assert docs.where("score <> 'mine'").count() == 0
        rows = [(r["doc_id"], r["text"]) for r in before.collect()]
        if name == "near_copies":
            root = brute.components(rows, 5, 80)
            assert {r["doc_id"] for r in docs.collect()} == {i for i, _ in rows if i is None or root[i] == i}
        if name == "substrings":
            order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
            for number, (words, left) in brute.repeats(order).items():
                found = [r["text"] for r in docs.collect() if r["doc_id"] == order[number][0]]
                assert found == ([] if words and not left else [order[number][1] if len(left) == len(words) else " ".join(left)])
        if name == "secrets":
            assert all(not secrets.base_spans(r["text"] or "") for r in docs.collect())
    assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in kept["secrets"].collect()}


def test_toxic_documents_go(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    left = dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, "/root/testdata/sf0.1").join(labels, "doc_id")
    assert left.where("toxic = 1").count() < 0.25 * labels.where("toxic = 1").count()
    assert left.where("toxic = 0").count() > 0.93 * labels.where("toxic = 0").count()
