import pytest
from pyspark.sql import functions as F

from corpusmill.operators import ir, models, reports
from corpusmill.sources import strategies


def test_embeddings_come_in_batches(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None)], "id long, text string")
    found = {r["id"]: r["vector"] for r in models.embedded(rows, "id", "text", lambda: models.embedder("hash", dimensions=8), batch=2).collect()}
    assert found[1] == found[2] and len(found[3]) == 8
    with pytest.raises(ValueError):
        models.embedder("unknown")


def test_judge_with_failures(spark):
    pairs = spark.createDataFrame([("q1", "a", ["c"] * 9), ("q2", "boom", ["c"])], "question string, answer string, contexts array<string>")

    def ask(prompt):
        if "boom" in prompt:
            raise RuntimeError("down")
        return '{"score": 0.5}'

    found = models.answered(models.judge_prompts(pairs), ask).withColumn("score", models.response_score(F.col("response")))
    assert found.count() == 10 and found.where("score = 0.5").count() == 5 and found.where("score is null").count() == 5


def test_strategies(spark):
    text = "categories:\n  news: {method: naive, size: 900, include_ids: [a, b], overrides: {b: {action: skip}}}\n  odd: {include_ids: [c]}\n"
    found = {r["page_id"]: r for r in strategies.from_yaml(spark, text).collect()}
    assert found["a"]["content_type"] == "NEWS" and found["b"]["action"] == "skip" and found["c"]["content_type"] == "KNOWLEDGE"


def test_reports(spark):
    rows = spark.createDataFrame([("m1", 0.5), ("m_2", 0.75)], "model string, mrr double")
    assert reports.markdown_table(rows).splitlines()[1] == "| --- | --- |"
    assert r"\textbf{0.7500}" in reports.latex_table(rows, "mrr") and ir.best_by(rows, "mrr", "model").first()["model"] == "m_2"
    assert reports.report("R", {"a": rows}).startswith("# R")
