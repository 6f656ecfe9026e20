"""Statistics of scores: description, intervals, paired tests, effect sizes."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tiers
from . import order
from .resample import intervals


def describe(frame: DataFrame, by: list, score: str) -> DataFrame:
    """n, mean, median, population deviation, extremes and quartiles (interpolated)."""
    c = F.col(score)
    return frame.groupBy(*by).agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.percentile(c, F.lit(0.5)).alias("median"), F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"), F.percentile(c, F.lit(0.25)).alias("q1"), F.percentile(c, F.lit(0.75)).alias("q3"))


def cohens_d(pairs: DataFrame, by: list) -> DataFrame:
    """Effect of a against b with the pooled population variance; 0 where nothing varies."""
    pooled = F.sqrt((F.var_pop("a") + F.var_pop("b")) / 2)
    return pairs.groupBy(*by).agg(F.coalesce(F.try_divide(F.avg("a") - F.avg("b"), F.nullif(pooled, F.lit(0.0))), F.lit(0.0)).alias("d"))


def effect_label(d: Column) -> Column:
    return tiers(F.abs(d), [(0.2, "vernachlässigbar"), (0.5, "klein"), (0.8, "mittel")], "groß")


def bootstrap(values: np.ndarray, confidence: float = 0.95, rounds: int = 1000, seed: int | None = 42, strict: bool = False, statistic: Callable[[np.ndarray], float] = np.mean) -> tuple[float, float, float]:
    """A statistic and its percentile interval; no values give NaN (an error where strict), one value itself.

    Without a seed every call draws anew.
    """
    values = values[~np.isnan(values)]
    if not len(values):
        if strict:
            raise ValueError("no scores")
        return (math.nan,) * 3
    if len(values) == 1:
        return (float(values[0]),) * 3
    rng = np.random.RandomState(seed)
    means = np.array([statistic(values[rng.choice(len(values), len(values))]) for _ in range(rounds)])
    low, high = np.percentile(means, [(1 - confidence) * 50, (1 + confidence) * 50])
    return float(statistic(values)), float(low), float(high)


def bootstrap_ci(frame: DataFrame, by: str, score: str, **how) -> DataFrame:
    """(by, mean, low, high, n); a group is the scores of one run, which is bounded by its queries."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        mean, low, high = bootstrap(pdf[score].to_numpy(float), **how)
        return pd.DataFrame({by: [pdf[by].iloc[0]], "mean": [mean], "low": [low], "high": [high], "n": [len(pdf)]})

    kind = dict(frame.dtypes)[by]
    return frame.select(by, score).groupBy(by).applyInPandas(run, f"{by} {kind}, mean double, low double, high double, n bigint")


def metric_intervals(metrics: DataFrame, names: list[str], rounds: int = 1000, key: str = "query_id") -> DataFrame:
    """(metric, mean, low, high, n) of per-query metrics; ``key`` is a whole number of each query."""
    long = metrics.unpivot(key, names, "metric", "value").where("value is not null and not isnan(value)")
    means = long.groupBy("metric").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))
    return means.join(intervals(long, "metric", "value", key, rounds), "metric").select("metric", "mean", "low", "high", "n")


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 300):
        for n in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + n * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + n / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return out


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def paired_t(d: np.ndarray) -> float:
    """Two-sided p value of the mean of differences."""
    n, sd = len(d), d.std(ddof=1)
    if sd == 0:
        return 1.0 if d.mean() == 0 else math.nan
    t = d.mean() / (sd / math.sqrt(n))
    return beta_share((n - 1) / 2, 0.5, (n - 1) / (n - 1 + t * t))


def exact_signed_ranks(n: int, w: float) -> float:
    """Two-sided p value of the smaller rank sum w of n distinct sizes."""
    ways = np.zeros(n * (n + 1) // 2 + 1)
    ways[0] = 1
    for r in range(1, n + 1):
        ways[r:] += ways[: len(ways) - r].copy()
    return float(min(1.0, 2 * ways[: int(w) + 1].sum() / 2.0**n))


def wilcoxon(d: np.ndarray) -> float:
    """Two-sided p value of the signed ranks: exact up to 25 distinct values, else by the normal curve with ties."""
    d = d[d != 0]
    n = len(d)
    if n == 0:
        return 1.0
    size = np.abs(d)
    order = np.sort(size)
    ranks = (np.searchsorted(order, size, "left") + np.searchsorted(order, size, "right") + 1) / 2
    w = min(ranks[d > 0].sum(), ranks[d < 0].sum())
    if n <= 25 and len(np.unique(size)) == n:
        return exact_signed_ranks(n, w)
    _, ties = np.unique(size, return_counts=True)
    var = n * (n + 1) * (2 * n + 1) / 24 - (ties**3 - ties).sum() / 48
    return min(1.0, 2 * _normal_tail(abs(w - n * (n + 1) / 4) / math.sqrt(var)))


def _quantile(p: float) -> float:
    low, high = -10.0, 10.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - _normal_tail(mid) < p else (low, mid)
    return (low + high) / 2


# Royston's polynomials of 1 / sqrt(n) for the weights of the largest and the next value, but for their normal scores.
LAST_WEIGHT = (-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0)
NEXT_WEIGHT = (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0)


def royston_p(w: float, n: int) -> float:
    """p value of Shapiro-Wilk's W of n values (Royston 1995)."""
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w >= 1:
        return 1.0
    if n <= 11:
        g = np.polyval([0.459, -2.273], n)
        mu, sigma = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n), math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
        return _normal_tail((-math.log(g - math.log(1 - w)) - mu) / sigma) if math.log(1 - w) < g else 0.0
    log = math.log(n)
    mu, sigma = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], log), math.exp(np.polyval([0.0030302, -0.082676, -0.4803], log))
    return _normal_tail((math.log(1 - w) - mu) / sigma)


def shapiro_wilk(x: np.ndarray) -> float:
    """p value of normality by Royston's approximation (1995), for 3 values or more; constant values are not normal."""
    n = len(x)
    x = np.sort(x)
    if n < 3 or x[0] == x[-1]:
        return 0.0 if n >= 3 else 1.0
    m = np.array([_quantile((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    c, u = m / math.sqrt((m**2).sum()), 1 / math.sqrt(n)
    a = np.zeros(n)
    if n == 3:
        a[-1], a[0] = math.sqrt(0.5), -math.sqrt(0.5)
    else:
        last = np.polyval(LAST_WEIGHT, u) + c[-1]
        if n > 5:
            before = np.polyval(NEXT_WEIGHT, u) + c[-2]
            phi = ((m**2).sum() - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * before**2)
            a[2:-2] = m[2:-2] / math.sqrt(phi)
            a[-2], a[1] = before, -before
        else:
            a[1:-1] = m[1:-1] / math.sqrt(((m**2).sum() - 2 * m[-1] ** 2) / (1 - 2 * last**2))
        a[-1], a[0] = last, -last
    w = min(1.0, float((a @ x) ** 2 / ((x - x.mean()) ** 2).sum()))
    return royston_p(w, n)


def paired_test(a: np.ndarray, b: np.ndarray) -> tuple[str, float]:
    """Test and p value: too few pairs say nothing; t where the differences look normal, else signed ranks."""
    d = a - b
    if len(d) < 3:
        return "none", 1.0
    if d.std() == 0:
        return "none", 1.0 if d.mean() == 0 else math.nan
    return ("t", paired_t(d)) if shapiro_wilk(d) >= 0.05 else ("wilcoxon", wilcoxon(d))


def royston_w(n: int, sd: float, mx: float, mm: float, ends: tuple[float, float, float, float]) -> float:
    """Shapiro-Wilk's W of n values from sums over their ranks; ``ends`` are the two smallest and the two largest values."""
    first, second, before_last, last = ends
    root = math.sqrt(mm)
    score = lambda i: _quantile((i - 0.375) / (n + 0.25))
    top, below, u = score(n), score(n - 1), 1 / math.sqrt(n)
    if n == 3:
        total = math.sqrt(0.5) * (last - first)
    else:
        a = float(np.polyval(LAST_WEIGHT, u) + top / root)
        if n > 5:
            b = float(np.polyval(NEXT_WEIGHT, u) + below / root)
            phi = (mm - 2 * top**2 - 2 * below**2) / (1 - 2 * a**2 - 2 * b**2)
            inner = mx - top * (last - first) - below * (before_last - second)
            total = inner / math.sqrt(phi) + a * (last - first) + b * (before_last - second)
        else:
            phi = (mm - 2 * top**2) / (1 - 2 * a**2)
            total = (mx - top * (last - first)) / math.sqrt(phi) + a * (last - first)
    return min(1.0, total**2 / (sd**2 * (n - 1)))


def signed_ranks(d: DataFrame) -> DataFrame:
    """(g, m, plus, minus, ties) of differences (g, d) that are not 0: how many, sums of ranks by sign, sum of t^3 - t."""
    rows = d.where("d <> 0").select("g", F.abs("d").alias("size"), (F.col("d") > 0).cast("long").alias("up"))
    values = order.ranked(rows, "size", F.sum("up").alias("up"))
    rank = F.col("start") + (F.col("t") + 1) / 2
    t = F.col("t").cast("double")
    return values.groupBy("g").agg(F.sum("t").alias("m"), F.sum(F.col("up") * rank).alias("plus"), F.sum((F.col("t") - F.col("up")) * rank).alias("minus"), F.sum(t * t * t - t).alias("ties"))


def _moments(d: DataFrame) -> DataFrame:
    return d.groupBy("g").agg(F.count("*").alias("n"), F.avg("d").alias("mean"), F.coalesce(F.stddev_samp("d"), F.lit(0.0)).alias("sd"), F.max("d").alias("most"), F.min("d").alias("least"))


_SCORES = ("mx", "mm", "first", "second", "before_last", "last")


def _normality(row) -> tuple[float | None, float]:
    """W and its p value from a row of moments and normal scores; constant values are not normal."""
    if row["n"] < 3 or row["least"] == row["most"]:
        return None, 0.0 if row["n"] >= 3 else 1.0
    w = royston_w(int(row["n"]), row["sd"], row["mx"], row["mm"], tuple(row[c] for c in _SCORES[2:]))
    return w, royston_p(w, int(row["n"]))


def normality(values: DataFrame, by: str, value: str) -> DataFrame:
    """(by, n, w, p_value) of Shapiro-Wilk's test in Royston's form, alike for groups of every size.

    Nulls and NaN are left out; fewer than three values, or equal ones, have no W.
    """
    d = values.select(F.struct(by).alias("g"), F.col(value).cast("double").alias("d")).where("d is not null and not isnan(d)")
    moments = _moments(d)
    joined = moments.join(order.normal_scores(order.ranked(d, "d"), moments, "d"), "g")
    kind = dict(values.dtypes)[by]

    def run(batches):
        for pdf in batches:
            found = [_normality(r) for _, r in pdf.iterrows()]
            yield pd.DataFrame({by: pdf[by], "n": pdf["n"], "w": pd.Series([w for w, _ in found], pdf.index, float), "p_value": pd.Series([p for _, p in found], pdf.index, float)})

    return joined.select(F.col("g")[by].alias(by), "n", "mean", "sd", "most", "least", *_SCORES).mapInPandas(run, f"{by} {kind}, n bigint, w double, p_value double")


def _tested(row) -> tuple[str, float]:
    """Test and p value from sums of a group: moments, normal scores, signed ranks of what is not 0."""
    n = int(row["n"])
    if n < 3:
        return "none", 1.0
    if row["least"] == row["most"]:
        return "none", 1.0 if row["mean"] == 0 else math.nan
    if _normality(row)[1] >= 0.05:
        t = row["mean"] / (row["sd"] / math.sqrt(n))
        return "t", beta_share((n - 1) / 2, 0.5, (n - 1) / (n - 1 + t * t))
    m, w, ties = int(row["m"]), min(row["plus"], row["minus"]), row["ties"]
    if m <= 25 and ties == 0:
        return "wilcoxon", exact_signed_ranks(m, w)
    var = m * (m + 1) * (2 * m + 1) / 24 - ties / 48
    return "wilcoxon", min(1.0, 2 * _normal_tail(abs(w - m * (m + 1) / 4) / math.sqrt(var)))


def compare(pairs: DataFrame, by: str) -> DataFrame:
    """(by, test, p_value, significant, n) of pairs (by, a, b): t where the differences look normal, else signed ranks.

    Ranks, scores and moments are summed by Spark for groups of every size; Python gets one
    row of sums for each group.  Pairs with a null or NaN side are left out; differences that
    are all equal and not 0 have no p value.
    """
    d = pairs.select(F.struct(by).alias("g"), (F.col("a") - F.col("b")).alias("d")).where("d is not null and not isnan(d)")
    moments = _moments(d)
    scores = order.normal_scores(order.ranked(d, "d"), moments, "d")
    sums = moments.join(scores, "g").join(signed_ranks(d), "g", "left")

    def run(batches):
        for pdf in batches:
            found = [_tested(r) for _, r in pdf.iterrows()]
            p = pd.Series([p for _, p in found], pdf.index, float)
            yield pd.DataFrame({by: pdf[by], "test": pd.Series([t for t, _ in found], pdf.index, str), "p_value": p, "significant": p < 0.05, "n": pdf["n"]})

    told = sums.select(F.col("g")[by].alias(by), "n", "mean", "sd", "most", "least", *_SCORES, "m", "plus", "minus", "ties")
    return told.mapInPandas(run, f"{by} {dict(pairs.dtypes)[by]}, test string, p_value double, significant boolean, n bigint")


def compare_configurations(baseline: DataFrame, candidate: DataFrame, metrics: tuple[str, ...] = ("rr", "ndcg", "p_at_k")) -> DataFrame:
    """(metric, test, p_value, significant, n) of two runs (query_id, metrics) over queries and metrics that both hold."""
    shared = [m for m in metrics if m in baseline.columns and m in candidate.columns]
    long = lambda d, to: d.unpivot("query_id", shared, "metric", to)
    pairs = long(baseline.select("query_id", *shared), "a").join(long(candidate.select("query_id", *shared), "b"), ["query_id", "metric"])
    return compare(pairs.select("metric", "a", "b"), "metric")


def judge_score(raw: Column) -> Column:
    """A judge's score from JSON, ``score: x`` or a bare number, brought to 0 to 1; null where it is out of range."""
    text = F.coalesce(F.nullif(F.regexp_extract(raw, r'"score"\s*:\s*"?([0-9]+[.]?[0-9]*)', 1), F.lit("")), F.nullif(F.regexp_extract(raw, r"(?i)score\D{0,5}([0-9]+[.]?[0-9]*)", 1), F.lit("")), F.nullif(F.regexp_extract(raw, r"([0-9]+[.]?[0-9]*)", 1), F.lit("")))
    x = text.try_cast("double")
    return F.when((x >= 0) & (x <= 1), x).when((x > 1) & (x <= 10), x / 10).when((x > 10) & (x <= 100), x / 100)


def judge_summary(scores: DataFrame, metrics: list[str]) -> DataFrame:
    """Means of what is not null (0 without any) and the harmonic mean of the first four that are above 0."""
    row = scores.agg(*(F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in metrics))
    four = F.filter(F.array(*metrics[:4]), lambda x: x > 0)
    inverse = F.aggregate(four, F.lit(0.0), lambda t, x: t + 1.0 / x)
    return row.withColumn("composite", F.coalesce(F.try_divide(F.size(four).cast("double"), inverse), F.lit(0.0)))
