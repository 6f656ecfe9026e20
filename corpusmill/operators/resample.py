"""Bootstrap intervals of means from one pass: a matrix of sums and counts for every round and group.

Instead of drawing rows, every row gets a Poisson count in every round, drawn from a hash of
its key and the round: the same count wherever the row is read.  A task keeps, for each
group, one sum and one count a round, and sends these; matrices of tasks add up.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The modulus (a Mersenne prime), multipliers of key and round, and of the three mixing steps.
PRIME = (1 << 31) - 1
KEY, ROUND = 1_103_515_245, 362_437_069
STEPS = (1_812_433_253, 1_566_083_941, 1_343_243_707)
#: Draws below the k-th bound count k - 1 at most: shares of the Poisson distribution with mean 1.
BOUNDS = tuple(math.floor(PRIME * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(9))
#: Groups that a task holds matrices of before it sends them.
GROUPS = 512


def _folded(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below 2**62."""
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


def counts(keys: np.ndarray, rounds: int, seed: int) -> np.ndarray:
    """How often each row counts in each round, rows by rounds."""
    row = np.mod(np.mod(keys.astype(np.int64), PRIME) * KEY + seed, PRIME)
    x = _folded(row[:, None] + np.arange(rounds, dtype=np.int64)[None, :] * ROUND % PRIME)
    for step in STEPS:
        x = _folded(_folded(x * x) + x * (step >> 1) % PRIME + step % PRIME)
    out = np.zeros(x.shape, np.uint8)
    for bound in BOUNDS:
        out += x >= bound
    return out


def matrices(rows: DataFrame, by: str, score: str, key: str, rounds: int, seed: int) -> DataFrame:
    """(by, round, total, times): sums over all rows of score times count, and of counts."""
    kind = rows.schema[by].dataType

    def sent(held):
        for group, (total, times) in held.items():
            columns = [pa.array([group] * rounds, arrow), pa.array(np.arange(rounds, dtype=np.int32)), pa.array(total), pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, names=[by, "round", "total", "times"])

    def run(batches):
        held: dict = {}
        for batch in batches:
            groups = batch.column(by).to_pylist()
            keys, scores = batch.column(key).to_numpy(zero_copy_only=False), batch.column(score).to_numpy(zero_copy_only=False)
            places: dict = {}
            for i, g in enumerate(groups):
                places.setdefault(g, []).append(i)
            for g, own in places.items():
                if g not in held and len(held) >= GROUPS:
                    yield from sent(held)
                    held = {}
                total, times = held.setdefault(g, (np.zeros(rounds), np.zeros(rounds, np.int64)))
                for i in range(0, len(own), 256):
                    part = own[i : i + 256]
                    drawn = counts(keys[part], rounds, seed)
                    total += scores[part] @ drawn
                    times += drawn.sum(0, dtype=np.int64)
        yield from sent(held)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)
    told = rows.select(by, F.col(key).cast("long").alias(key), F.col(score).cast("double").alias(score)).where(f"{score} is not null and not isnan({score})")
    parts = told.mapInArrow(run, f"{by} {kind.simpleString()}, round int, total double, times bigint")
    return parts.groupBy(by, "round").agg(F.sum("total").alias("total"), F.sum("times").alias("times"))


def intervals(rows: DataFrame, by: str, score: str, key: str, rounds: int = 1000, confidence: float = 0.95, seed: int = 42) -> DataFrame:
    """(by, low, high): percentile intervals of the mean of each group.

    ``key`` names a whole number that tells rows of a group apart; rows of equal keys count
    alike.  Null and NaN scores are left out.  Rounds that draw nothing have no mean.
    """
    means = matrices(rows, by, score, key, rounds, seed).withColumn("mean", F.try_divide("total", "times"))
    half = (1 - confidence) / 2
    return means.groupBy(by).agg(F.percentile("mean", F.lit(half)).alias("low"), F.percentile("mean", F.lit(1 - half)).alias("high"))
