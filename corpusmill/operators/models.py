"""Model calls as Arrow batches with injected providers, and deterministic stand-ins."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import judge_score


class Embedder(Protocol):
    """Anything that turns texts into vectors of one length."""

    name: str
    dimensions: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class HashEmbedder:
    """Unit vectors from hashed words; equal texts get equal vectors."""

    name = "hash"

    def __init__(self, dimensions: int = 32):
        self.dimensions = dimensions

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = np.zeros(self.dimensions)
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                v[h % self.dimensions] += 1 if h >> 63 else -1
            out.append((v / max(np.linalg.norm(v), 1e-12)).tolist())
        return out


#: Makers of embedders by the name that a configuration gives; services are added by whoever has them.
EMBEDDERS: dict[str, Callable[..., Embedder]] = {"hash": HashEmbedder}


def embedder(name: str, **how) -> Embedder:
    if name not in EMBEDDERS:
        raise ValueError(f"no embedder {name}; known are {sorted(EMBEDDERS)}")
    return EMBEDDERS[name](**how)


def embedded(rows: DataFrame, key: str, text: str, make: Callable[[], Embedder], batch: int = 32) -> DataFrame:
    """(key, vector) of texts; the model is made once in each task and called with small batches."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        model = make()
        for pdf in frames:
            vectors: list[list[float]] = []
            for i in range(0, len(pdf), batch):
                vectors += model.embed(pdf[text].iloc[i : i + batch].fillna("").tolist())
            yield pd.DataFrame({key: pdf[key], "vector": vectors})

    return rows.select(key, text).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, vector array<double>")


def embedding_stats(vectors: DataFrame, batch: int = 32) -> DataFrame:
    """One row: vectors, batches at least, and how many are empty."""
    return vectors.agg(F.count("*").alias("vectors"), F.ceil(F.count("*") / batch).alias("batches"), F.count_if(F.coalesce(F.size("vector"), F.lit(0)) <= 0).alias("empty"))


PROMPTS = ("faithfulness", "answer_relevancy", "context_precision", "context_recall", "answer_correctness")


def judge_prompts(pairs: DataFrame, contexts: str = "contexts") -> DataFrame:
    """One prompt for each metric of (question, answer, contexts); at most five contexts of 800 characters."""
    cut = F.array_join(F.transform(F.slice(contexts, 1, 5), lambda c: F.substring(c, 1, 800)), "\n")
    prompt = lambda m: F.concat(F.lit(f"Rate the {m} from 0 to 1 as JSON with the key score.\nQuestion: "), "question", F.lit("\nAnswer: "), "answer", F.lit("\nContext: "), cut)
    return pairs.select("*", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), prompt(m).alias("prompt")) for m in PROMPTS))).alias("p")).select("*", "p.metric", "p.prompt").drop("p")


def answered(prompts: DataFrame, ask: Callable[[str], str], text: str = "prompt", out: str = "response") -> DataFrame:
    """Answers of a model; an exception becomes an error string, which has no score."""

    @F.pandas_udf("string")
    def call(texts: pd.Series) -> pd.Series:
        def one(t: str) -> str:
            try:
                return ask(t)
            except Exception as error:  # a service's failure is a result of the row
                return f"ERROR: {error}"

        return texts.map(one)

    return prompts.withColumn(out, call(text))


def response_score(response: Column) -> Column:
    return F.when(~response.startswith("ERROR:"), judge_score(response))


def valid_question(question: Column) -> Column:
    """A generated question, with its question mark; null where it is too short or long."""
    q = F.trim(question)
    return F.when((F.length(q) >= 10) & (F.length(q) <= 500), F.when(q.endswith("?"), q).otherwise(F.concat(q, F.lit("?"))))
