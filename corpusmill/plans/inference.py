"""Paired tests, normality and bootstrap intervals, over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import order, resample, stats
from . import inputs as I
from .ranking import _METRICS, metrics

def _stage() -> Column:
    return F.concat(F.lit("stage"), F.col("user_id") % 5)


def _noise() -> Column:
    """A normal number for each event, from two remainders of its id."""
    i = F.col("event_id")
    u = ((i * i % 1000003 * 7919 + i * 31) % 999983 + 1) / F.lit(999984.0)
    v = (i * i % 999979 * 3 + i * 17) % 65537 / F.lit(65537.0)
    return F.sqrt(-2.0 * F.log(u)) * F.cos(F.lit(6.283185307179586) * v)


def paired_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events")
    found = stats.compare(e.select(_stage().alias("stage"), F.col("value").alias("a"), (F.col("value") * 0.9 + F.col("event_id") % 7).alias("b")), "stage")
    return found.select("stage", "test", F.round("p_value", 6).alias("p_value"), "significant", "n")


def paired_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs whose differences are normal, a little off zero in some stages: the other branch of the test."""
    e = I.table(spark, sf_dir, "events")
    gap = _noise() + F.col("user_id") % 5 * 0.01
    found = stats.compare(e.select(_stage().alias("stage"), gap.alias("a"), F.lit(0.0).alias("b")), "stage")
    return found.select("stage", "test", F.round("p_value", 6).alias("p_value"), "significant", "n")


def normality_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W and p of the events' values and of normal numbers, stage by stage."""
    e = I.table(spark, sf_dir, "events")
    values = e.select(_stage().alias("stage"), F.col("value").alias("v")).unionByName(e.select(F.concat(F.lit("normal"), F.col("user_id") % 5).alias("stage"), _noise().alias("v")))
    found = stats.normality(values, "stage", "v")
    return found.select("stage", "n", F.round("w", 9).alias("w"), F.round("p_value", 6).alias("p_value"))


def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and interval of three models' scores, 1000 rounds."""
    e = I.table(spark, sf_dir, "events")
    runs = e.select("event_id", F.concat(F.lit("model"), F.col("user_id") % 3).alias("model"), F.col("value").alias("score"))
    means = runs.groupBy("model").agg(F.avg("score").alias("mean"), F.count("*").alias("n"))
    found = means.join(resample.intervals(runs, "model", "score", "event_id"), "model")
    return found.select("model", *(F.round(c, 6).alias(c) for c in ("mean", "low", "high")), "n")


def metric_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.metric_intervals(metrics(spark, sf_dir), ["rr", "ndcg", "p_at_k"])
    return found.select("metric", *(F.round(c, 6).alias(c) for c in ("mean", "low", "high")), "n")


QUERIES = {f.__name__: f for f in (paired_test, paired_normal, normality_test, bootstrap_ci, metric_intervals)}

_NOISE_SQL = """sqrt(-2e0 * ln(((event_id * event_id % 1000003 * 7919 + event_id * 31) % 999983 + 1) / 999984e0))
    * cos(6.283185307179586e0 * ((event_id * event_id % 999979 * 3 + event_id * 17) % 65537 / 65537e0))"""


def _ratio_sql(pair: tuple[tuple[float, ...], tuple[float, ...]], x: str) -> str:
    def value(powers: tuple[float, ...]) -> str:
        return " + ".join(f"{p:.17e} * power({x}, {i})" for i, p in enumerate(powers))

    return f"(({value(pair[0])}) / ({value(pair[1])}))"


def _quantile_sql(p: str) -> str:
    """The normal quantile of the share ``p``."""
    far = f"sqrt(-ln(least({p}, 1 - {p})))"
    return f"""CASE WHEN abs({p} - 0.5e0) <= 0.425e0 THEN ({p} - 0.5e0) * {_ratio_sql(order.CENTRE, f"(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))")}
        ELSE sign({p} - 0.5e0) * CASE WHEN {far} <= 5 THEN {_ratio_sql(order.SIDE, f"({far} - 1.6e0)")} ELSE {_ratio_sql(order.TAIL, f"({far} - 5e0)")} END END"""


def _tail_sql(z: str) -> str:
    """The share of the normal distribution above ``z``, from the series of its density."""
    term = "exp((2 * k + 1) * ln(abs({0})) - {0} * {0} / 2 - ((k + 1) * ln(2e0) + lgamma(k + 1.5e0) - 0.5e0 * ln(pi())))".format(z)
    series = f"list_sum(list_transform(range(0, 200), lambda k: {term})) / sqrt(2 * pi())"
    return f"CASE WHEN {z} = 0 THEN 0.5e0 WHEN abs({z}) > 8 THEN CASE WHEN {z} > 0 THEN 0e0 ELSE 1e0 END ELSE 0.5e0 - sign({z}) * {series} END"


def _polynomial(powers: tuple[float, ...], x: str) -> str:
    return "(" + " + ".join(f"{p:.17e} * power({x}, {len(powers) - 1 - i})" for i, p in enumerate(powers)) + ")"


#: W and p of the rows of ``d`` (stage, d), for stages of more than eleven rows.
_W = f"""
    places AS (
        SELECT stage, d, row_number() OVER (PARTITION BY stage ORDER BY d) AS i, count(*) OVER (PARTITION BY stage) AS n FROM d
    ), scored AS (
        SELECT *, {_quantile_sql("((i - 0.375e0) / (n + 0.25e0))")} AS m FROM places
    ), sums AS (
        SELECT stage, count(*) AS n, avg(d) AS mean, stddev_samp(d) AS sd, sum(m * d) AS mx, sum(m * m) AS mm,
            max(d) FILTER (WHERE i = 1) AS x1, max(d) FILTER (WHERE i = 2) AS x2, max(d) FILTER (WHERE i = n - 1) AS y2, max(d) FILTER (WHERE i = n) AS y1,
            max(m) FILTER (WHERE i = n) AS top, max(m) FILTER (WHERE i = n - 1) AS below
        FROM scored GROUP BY stage
    ), weights AS (
        SELECT *, {_polynomial(stats.LAST_WEIGHT, "(1 / sqrt(n))")} + top / sqrt(mm) AS a, {_polynomial(stats.NEXT_WEIGHT, "(1 / sqrt(n))")} + below / sqrt(mm) AS b FROM sums
    ), ws AS (
        SELECT *, power((mx - top * (y1 - x1) - below * (y2 - x2)) / sqrt((mm - 2 * top * top - 2 * below * below) / (1 - 2 * a * a - 2 * b * b))
            + a * (y1 - x1) + b * (y2 - x2), 2) / (sd * sd * (n - 1)) AS w
        FROM weights
    ), zs AS (
        SELECT *, (ln(1 - w) - {_polynomial((0.0038915, -0.083751, -0.31082, -1.5861), "ln(n)")}) / exp({_polynomial((0.0030302, -0.082676, -0.4803), "ln(n)")}) AS z FROM ws
    ), normal AS (
        SELECT *, {_tail_sql("z")} AS p_normal FROM zs
    )"""

#: Two-sided p of Student's t by the series of the incomplete beta function.
_T = """CASE WHEN t = 0 THEN 1e0 WHEN abs(t) > 12 THEN 0e0 ELSE 1 - sqrt(y) * power(1 - y, (n - 1) / 2e0) * 2 / exp(lgamma(0.5e0) + lgamma((n - 1) / 2e0) - lgamma(n / 2e0))
    * list_sum(list_transform(range(0, 500), lambda k: exp(lgamma(n / 2e0 + k) - lgamma(n / 2e0) - lgamma(1.5e0 + k) + lgamma(1.5e0) + k * ln(y)))) END"""


def _paired_sql(pairs: str) -> str:
    return f"""
        WITH d AS (SELECT 'stage' || (user_id % 5) AS stage, {pairs} AS d FROM events), {_W},
        sizes AS (
            SELECT stage, d, rank() OVER (PARTITION BY stage ORDER BY abs(d)) AS first, count(*) OVER (PARTITION BY stage, abs(d)) AS t FROM d WHERE d <> 0
        ), ranks AS (
            SELECT stage, count(*) AS m, coalesce(sum(first + (t - 1) / 2e0) FILTER (WHERE d > 0), 0) AS plus, coalesce(sum(first + (t - 1) / 2e0) FILTER (WHERE d < 0), 0) AS minus,
                sum(CAST(t AS DOUBLE) * t - 1) AS ties
            FROM sizes GROUP BY stage
        ), signed AS (
            SELECT *, abs(least(plus, minus) - m * (m + 1) / 4e0) / sqrt(m * (m + 1e0) * (2 * m + 1) / 24 - ties / 48) AS s,
                mean / (sd / sqrt(n)) AS t, power(mean / (sd / sqrt(n)), 2) / (n - 1 + power(mean / (sd / sqrt(n)), 2)) AS y
            FROM normal JOIN ranks USING (stage)
        ), told AS (
            SELECT stage, n, CASE WHEN p_normal >= 0.05 THEN 't' ELSE 'wilcoxon' END AS test,
                CASE WHEN p_normal >= 0.05 THEN {_T} ELSE least(1e0, 2 * ({_tail_sql("s")})) END AS p
            FROM signed
        )
        SELECT stage, test, round(p, 6) AS p_value, p < 0.05 AS significant, n FROM told
    """


def _bootstrap_sql(rows: str) -> str:
    """Intervals of ``rows`` (g, k, x): counts by the same remainders, round by round."""
    x = f"((k % {resample.PRIME} * {resample.KEY} + 42) % {resample.PRIME} + r * {resample.ROUND} % {resample.PRIME}) % {resample.PRIME}"
    steps = [f"h0 AS (SELECT g, x AS v, r, {x} AS h FROM b, range(1000) t(r))"]
    for i, step in enumerate(resample.STEPS):
        steps.append(f"h{i + 1} AS (SELECT g, v, r, (h * h % {resample.PRIME} + h * {step >> 1} % {resample.PRIME} + {step % resample.PRIME}) % {resample.PRIME} AS h FROM h{i})")
    times = " + ".join(f"CAST(h >= {bound} AS INT)" for bound in resample.BOUNDS)
    return f"""b AS ({rows}), {", ".join(steps)},
        means AS (SELECT g, r, sum(v * n) / sum(n) AS mean FROM (SELECT g, v, r, {times} AS n FROM h{len(resample.STEPS)}) GROUP BY g, r),
        spans AS (SELECT g, quantile_cont(mean, 0.025) AS low, quantile_cont(mean, 0.975) AS high FROM means GROUP BY g),
        plain AS (SELECT g, avg(x) AS mean, count(*) AS n FROM b GROUP BY g)"""


ORACLE_SQL = {
    "paired_test": _paired_sql("value - (value * 0.9e0 + event_id % 7)"),
    "paired_normal": _paired_sql(f"{_NOISE_SQL} + user_id % 5 * 0.01e0"),
    "normality_test": f"""
        WITH d AS (
            SELECT 'stage' || (user_id % 5) AS stage, value AS d FROM events UNION ALL SELECT 'normal' || (user_id % 5) AS stage, {_NOISE_SQL} AS d FROM events
        ), {_W}
        SELECT stage, n, round(w, 9) AS w, round(p_normal, 6) AS p_value FROM normal
    """,
    "bootstrap_ci": f"""
        WITH {_bootstrap_sql("SELECT 'model' || (user_id % 3) AS g, event_id AS k, value AS x FROM events")}
        SELECT g AS model, round(mean, 6) AS mean, round(low, 6) AS low, round(high, 6) AS high, n FROM plain JOIN spans USING (g)
    """,
    "metric_intervals": f"""
        {_METRICS}, {_bootstrap_sql("SELECT name AS g, query_id AS k, x FROM (UNPIVOT (SELECT query_id, CAST(rr AS DOUBLE) AS rr, CAST(ndcg AS DOUBLE) AS ndcg, CAST(p_at_k AS DOUBLE) AS p_at_k FROM m) ON rr, ndcg, p_at_k INTO NAME name VALUE x)")}
        SELECT g AS metric, round(mean, 6) AS mean, round(low, 6) AS low, round(high, 6) AS high, n FROM plain JOIN spans USING (g)
    """,
}
