"""Corpus preparation in stages; each stage works on all that its predecessor kept.

Toxic documents go; of each group of near copies (five words, similarity of 0.8 or more)
the one with the smallest id stays; passages of 20 words that stand earlier are cut out;
secrets are replaced by their kind; what is left is packed into windows of 2048 ids.

Null and empty texts are kept to the end, where they are one id each.  A document of which
nothing is left when repeats are cut out goes.  Rows without an id, repeated rows and
columns named as what an operator adds are kept as they are.  Texts of any length stay
whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import jaccard, packing, secrets, substrings, toxicity
from corpusmill.llm.frames import drop_path, shared_path
from corpusmill.llm.queries import table, vocabulary

_ASIDE = "__input_"


def _aside(docs: DataFrame, names: list[str]) -> DataFrame:
    """Input columns that an operator would replace get another name for as long as it runs."""
    taken = {n.lower() for n in names}
    return docs.withColumnsRenamed({c: _ASIDE + c for c in docs.columns if c.lower() in taken})


def _back(found: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of the input again, with a new text and its length where one is given."""
    out = []
    for field in docs.schema.fields:
        name = _ASIDE + field.name if _ASIDE + field.name in found.columns else field.name
        column = F.col(f"`{name}`")
        if text is not None and field.name == "text":
            column = text
        elif text is not None and field.name == "n_chars":
            column = F.length(text).cast(field.dataType)
        out.append(column.alias(field.name))
    return found.select(*out)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_aside(docs, [n for n, _ in toxicity.ADDED]), model)
    return _back(scored.where("predicted = 0"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id.

    Rows of one id are one document of several texts; of rows that repeat id and text one
    stays.  A row without an id is a document of its own.
    """
    found = jaccard.components(docs, n=5, percent=80)
    told = found.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("__root"), F.count("*").alias("__rows"))
    kept = docs.join(told, "doc_id", "left").where("doc_id is null or __root = doc_id")
    repeated = kept.where("__rows > 1").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return kept.where("__rows is null or __rows = 1").select(*docs.columns).unionByName(repeated)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_aside(docs, [n for n, _ in substrings.ADDED]), length=20)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _back(found.where("n_removed = 0 or n_removed < n_words"), docs, text)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.scan(_aside(docs, [n for n, _ in secrets.ADDED]))
    return _back(found, docs, F.when(F.col("text").isNotNull(), F.col("redacted")))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("substrings", cut_repeats),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]
#: Learned scores and the packing have no SQL; tests hold every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again.

    A stage's table is dropped once the next one is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            drop_path(spark, before)
        before = path
    return docs
