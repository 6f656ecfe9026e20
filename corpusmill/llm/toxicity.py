"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over words and word stems is trained with numpy from confirmed
toxic texts and unlabelled texts.  The risk is corrected by the class prior: with
``prior`` the share of toxic texts, it is ``prior * R_p(+)`` plus
``R_u(-) - prior * R_p(-)``, and where that second part falls below zero its gradient
is turned round, so the classifier cannot gain by overfitting the positives.

Training takes bounded samples: at most ``MAX_POSITIVE`` toxic texts, those lowest by a
hash of their id, and unlabelled texts drawn by that hash at the rate that gives
``MAX_UNLABELLED`` of them.  They are the same for the same table whatever its
partitions.  Features are those whose shares in the two samples differ by ``MIN_Z``
standard errors, the ``MAX_FEATURES`` most distinct at most.  All texts are scored.

Null and empty texts score as the intercept does; without toxic texts every score is
the prior.  Repeated rows are scored alike.  A text of any length is one row and is read
whole.  An empty table gives no rows.  Input columns named as an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import cut, extend, tidy, with_columns
from .quality import _LOWER
from .words import Words, mix, slices, split_bytes, split_words

MAX_POSITIVE, MAX_UNLABELLED = 8_000, 24_000
#: Texts of the sample that a feature must occur in, and lengths in bytes of the stems taken of each word.
MIN_TEXTS, MIN_Z, MAX_FEATURES = 5, 5.0, 20_000
STEMS = (4, 5, 6)

_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[*range(97, 123), *range(0x80, 256)]] = False


def features(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct words and stems of each row, and the rows' offsets."""
    raw = split_words(array)
    words: Words = split_bytes(_LOWER[raw.data], raw.offsets, _SEPARATORS)
    keys = [words.hashes()] + [mix(words.hashes(ends=np.minimum(words.ends, words.starts + n)) + np.uint64(n)) for n in STEMS]
    key, row = np.concatenate(keys), np.tile(words.rows(), len(keys))
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], np.searchsorted(row[new], np.arange(len(words.first)))


def _row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Rows:
    """Sparse rows of feature numbers that can be taken by number."""

    def __init__(self, parts: list[np.ndarray]):
        self.index = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.offsets[rows + 1] - self.offsets[rows]
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(offsets[-1]) + np.repeat(self.offsets[rows] - offsets[:-1], size)
        return self.index[at], offsets


def train(positive: Rows, unlabelled: Rows, prior: float, size: int, epochs: int = 20, batch: int = 2000, rate: float = 0.02, decay: float = 1e-3, seed: int = 7) -> np.ndarray:
    """Weights of ``size`` features and the intercept that minimise the non-negative PU risk, by Adam steps."""
    rng = np.random.default_rng(seed)
    size += 1
    w, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    w[-1] = np.log(prior / (1 - prior))
    step = 0

    def gradient(rows, chosen, slope_of):
        index, offsets = rows.take(chosen)
        z = _row_sums(w[index], offsets) + w[-1]
        loss, slope = slope_of(z)
        slope = slope / len(chosen)
        out = np.bincount(index, weights=np.repeat(slope, np.diff(offsets)), minlength=size)
        out[-1] = slope.sum()
        return loss.mean(), out

    as_positive = lambda z: (np.logaddexp(0, -z), -sigmoid(-z))
    as_negative = lambda z: (np.logaddexp(0, z), sigmoid(z))
    rounds = max(1, -(-len(unlabelled) // batch))
    for _ in range(epochs):
        order_u, order_p = rng.permutation(len(unlabelled)), rng.permutation(len(positive))
        for part_u, part_p in zip(np.array_split(order_u, rounds), np.array_split(order_p, rounds), strict=True):
            if not len(part_u) or not len(part_p):
                continue
            _, gain = gradient(positive, part_p, as_positive)
            taken, less = gradient(positive, part_p, as_negative)
            given, more = gradient(unlabelled, part_u, as_negative)
            negative = more - prior * less
            g = prior * gain + negative if given - prior * taken >= 0 else -negative
            g[:-1] += decay * w[:-1]
            step += 1
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sampled(docs: DataFrame, labels: DataFrame, max_positive: int, max_unlabelled: int) -> tuple[DataFrame, float]:
    """Texts of the two samples, marked by ``positive`` and ``unlabelled``, and the class prior."""
    texts = docs.select("doc_id", "text").where(~held_out() & F.col("text").isNotNull())
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isNotNull() & ~held_out())
    counts = known.agg(F.count_if(F.col("toxic") == 1).alias("p"), F.count("*").alias("n")).first()
    prior = min(0.9, max(1e-3, counts["p"] / max(1, counts["n"])))
    rate = min(1.0, max_unlabelled / max(1, texts.select("doc_id").count()))
    toxic = known.where("toxic = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positive)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(1 << 32)) < int(rate * (1 << 32))
    # at most max_positive ids are broadcast
    marked = texts.join(F.broadcast(toxic.withColumn("positive", F.lit(True))), "doc_id", "left").withColumn("positive", F.coalesce("positive", F.lit(False)))
    return marked.withColumn("unlabelled", F.coalesce(drawn, F.lit(False))).where("positive or unlabelled").select("text", "positive", "unlabelled"), prior


def _select(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of the features that tell the samples apart; at most ``MAX_FEATURES`` come to the driver."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                keys, offsets = features(batch.column("text"))
                size = np.diff(offsets)
                marks = [np.repeat(np.asarray(batch.column(c)).astype(np.int64), size) for c in ("positive", "unlabelled")]
                distinct, at = np.unique(keys, return_inverse=True)
                counts = [np.bincount(at, weights=m, minlength=len(distinct)).astype(np.int64) for m in marks]
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), *map(pa.array, counts)], names=["key", "p", "u"])

    counts = sample.mapInArrow(tidy(run), "key bigint, p bigint, u bigint").groupBy("key").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    total = sample.agg(F.count_if("positive").alias("p"), F.count_if("unlabelled").alias("u")).first()
    n_p, n_u = max(1, total["p"]), max(1, total["u"])
    pool = (F.col("p") + F.col("u")) / float(n_p + n_u)
    z = F.abs(F.col("p") / float(n_p) - F.col("u") / float(n_u)) / F.sqrt(pool * (1 - pool) * (1 / n_p + 1 / n_u) + 1e-12)
    chosen = counts.where(F.col("p") + F.col("u") >= MIN_TEXTS).withColumn("z", z).where(F.col("z") >= MIN_Z)
    found = chosen.orderBy(F.desc("z"), "key").limit(MAX_FEATURES).select("key").toArrow()["key"]
    return np.sort(np.asarray(found, np.int64).view(np.uint64))


class Model:
    """Sorted feature hashes, their weights, and the intercept."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        self.keys, self.weights = keys, weights

    def numbers(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the known features of each row, and the rows' offsets."""
        keys, offsets = features(array)
        if not len(self.keys):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return at[known].astype(np.int32), np.concatenate([[0], np.cumsum(known)])[offsets]

    def scores(self, array: pa.Array) -> np.ndarray:
        index, offsets = self.numbers(array)
        return sigmoid(_row_sums(self.weights[index], offsets) + self.weights[-1])


def learn(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Train on texts that are not held out."""
    sample, prior = _sampled(docs, labels, max_positive, max_unlabelled)
    sample = cut(sample)  # at most both bounds of texts, read thrice below
    keys = _select(sample)
    empty = Model(keys, np.zeros(len(keys) + 1))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                index, offsets = empty.numbers(batch.column("text"))
                rows = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(index))
                yield pa.RecordBatch.from_arrays([rows, batch.column("positive"), batch.column("unlabelled")], names=["index", "positive", "unlabelled"])

    table = sample.mapInArrow(tidy(run), "index array<int>, positive boolean, unlabelled boolean").toArrow()
    rows = [np.asarray(r.values, np.int32) for r in table["index"]]
    order = sorted(range(len(rows)), key=lambda i: rows[i].tobytes())  # whatever the order of the partitions
    groups = [Rows([rows[i] for i in order if marks[i]]) for marks in (table["positive"].to_pylist(), table["unlabelled"].to_pylist())]
    return Model(keys, train(*groups, prior, len(keys)))


ADDED = [("held_out", T.BooleanType()), ("score", T.DoubleType()), ("predicted", T.IntegerType())]


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """Input columns plus whether a row is held out, its score and the prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES at most
    marked = docs.withColumn("held_out", held_out())

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                found = shared.value.scores(batch.column("text"))
                yield extend(batch, {"held_out": batch.column("held_out"), "score": pa.array(found), "predicted": pa.array((found >= threshold).astype(np.int32))})

    return marked.mapInArrow(tidy(run), with_columns(docs.schema, ADDED))
