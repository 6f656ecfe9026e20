"""Ranking metrics in one grouped pass over ranked lists and relevance judgements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def judged(ranked: DataFrame, qrels: DataFrame) -> DataFrame:
    """Ranked rows (query_id, doc_id, rank) with their graded relevance, 0 where none is stated."""
    return ranked.join(qrels.select("query_id", "doc_id", "rel"), ["query_id", "doc_id"], "left").withColumn("rel", F.coalesce("rel", F.lit(0)))


def ideal_gain(qrels: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("rel"), "doc_id")
    best = qrels.where("rel > 0").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return best.groupBy("query_id").agg(F.sum((F.pow(F.lit(2.0), F.col("rel")) - 1) / F.log2(F.col("place") + 1)).alias("idcg"))


def per_query(ranked: DataFrame, qrels: DataFrame, queries: DataFrame, k: int = 5, k_gain: int = 10) -> DataFrame:
    """rr, p_at_k, r_at_k, ndcg, ap and hit of every query; a query without hits has zeros.

    Precision divides by k, reciprocal rank and average precision have no cutoff, gain is
    ``2 ** rel - 1`` over ``log2(rank + 1)``.
    """
    wanted = qrels.where("rel > 0").groupBy("query_id").agg(F.count("*").alias("relevant"))
    return _measured(judged(ranked, qrels), wanted.join(ideal_gain(qrels, k_gain), "query_id", "left"), queries, k, k_gain)


def per_query_by_group(ranked: DataFrame, corpus: DataFrame, queries: DataFrame, group: str, k: int = 5, k_gain: int = 10, without_self: bool = True) -> DataFrame:
    """As ``per_query``, where all rows (doc_id, group, rel) of a query's group are judged, without itself where queries are rows.

    Judgements are counted by group and grade: they are as many as rows times queries of a group, and are never listed.
    """
    asked = queries.select("query_id", group).distinct()
    held = corpus.select("doc_id", F.col(group).alias("of"), "rel")
    rows = ranked.join(asked, "query_id", "left").join(held, "doc_id", "left")
    counted = F.col(group) == F.col("of")
    if without_self:
        counted = counted & (F.col("query_id") != F.col("doc_id"))
    rows = rows.withColumn("rel", F.when(counted, F.col("rel")).otherwise(0)).drop(group, "of")
    grades = corpus.where("rel > 0").groupBy(group, "rel").agg(F.count("*").alias("n")).groupBy(group).agg(F.sort_array(F.collect_list(F.struct("rel", "n")), asc=False).alias("grades"))
    wanted = asked.join(grades, group)
    if without_self:
        own = held.select(F.col("doc_id").alias("query_id"), F.col("of").alias(group), F.col("rel").alias("own")).join(asked, ["query_id", group], "left_semi")
        own = own.where("own > 0").groupBy("query_id", group).agg(F.collect_list("own").alias("own"))
        left = F.transform("grades", lambda g: F.struct(g["rel"].alias("rel"), (g["n"] - F.size(F.filter(F.coalesce("own", F.array().cast("array<int>")), lambda o: o == g["rel"]))).alias("n")))
        wanted = wanted.join(own, ["query_id", group], "left").withColumn("grades", left)
    first = F.slice(F.flatten(F.transform("grades", lambda g: F.array_repeat(g["rel"], F.least(g["n"], F.lit(k_gain)).cast("int")))), 1, k_gain)
    gains = F.transform(first, lambda rel, i: (F.pow(F.lit(2.0), rel) - 1) / F.log2(i + 2))
    wanted = wanted.select("query_id", F.aggregate("grades", F.lit(0).cast("long"), lambda t, g: t + g["n"]).alias("relevant"), F.aggregate(gains, F.lit(0.0), lambda t, x: t + x).alias("idcg"))
    return _measured(rows, wanted, queries, k, k_gain)


def _measured(rows: DataFrame, wanted: DataFrame, queries: DataFrame, k: int, k_gain: int) -> DataFrame:
    """Metrics from judged rows (query_id, doc_id, rank, rel) and what is wanted (query_id, relevant, idcg)."""
    good = F.col("rel") > 0
    seen = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("so_far", F.sum(good.cast("int")).over(seen))
    sums = rows.groupBy("query_id").agg(
        F.min(F.when(good, F.col("rank"))).alias("first"),
        F.count_if(good & (F.col("rank") <= k)).alias("hits"),
        F.sum(F.when(F.col("rank") <= k_gain, (F.pow(F.lit(2.0), F.col("rel")) - 1) / F.log2(F.col("rank") + 1))).alias("dcg"),
        F.sum(F.when(good, F.col("so_far") / F.col("rank"))).alias("precisions"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    joined = queries.select("query_id").distinct().join(sums, "query_id", "left").join(wanted, "query_id", "left")
    return joined.select(
        "query_id",
        zero(F.lit(1.0) / F.col("first")).alias("rr"),
        zero(F.col("hits") / F.lit(float(k))).alias("p_at_k"),
        zero(F.try_divide(F.col("hits").cast("double"), F.col("relevant"))).alias("r_at_k"),
        zero(F.try_divide("dcg", "idcg")).alias("ndcg"),
        zero(F.try_divide("precisions", "relevant")).alias("ap"),
        F.coalesce((F.col("hits") > 0).cast("int"), F.lit(0)).alias("hit"),
    )


METRICS = ("rr", "p_at_k", "r_at_k", "ndcg", "ap", "hit")


def means(metrics: DataFrame, by: list | None = None) -> DataFrame:
    """Means of all metrics with the population deviation of rr, over all queries or by groups."""
    aggs = [F.count("*").alias("n_queries"), *(F.coalesce(F.avg(m), F.lit(0.0)).alias(f"mean_{m}") for m in METRICS), F.coalesce(F.stddev_pop("rr"), F.lit(0.0)).alias("std_rr")]
    return metrics.groupBy(*(by or [])).agg(*aggs)


def numeric_means(frame: DataFrame) -> DataFrame:
    """Mean of every numeric column."""
    kinds = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return frame.agg(*(F.avg(c).alias(f"mean_{c}") for c, t in frame.dtypes if t in kinds or t.startswith("decimal")))


def best_by(frame: DataFrame, score: str, key: str) -> DataFrame:
    """The row of the best score, the first key of equals."""
    return frame.orderBy(F.desc(score), F.asc(key)).limit(1)


def correlation(frame: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) for every two columns; 0 where one of them does not vary."""
    aggs = [F.corr(a, b).alias(f"{a}|{b}") for i, a in enumerate(columns) for b in columns[i:]]
    row = frame.agg(*aggs)
    parts = F.array(*(F.struct(F.lit(c.split("|")[0]).alias("a"), F.lit(c.split("|")[1]).alias("b"), F.col(f"`{c}`").alias("r")) for c in row.columns))
    return row.select(F.explode(parts).alias("x")).select("x.a", "x.b", F.coalesce(F.when(~F.isnan("x.r"), F.col("x.r")), F.lit(0.0)).alias("r"))


def breakdown(metrics: DataFrame, difficulty: str = "difficulty") -> DataFrame:
    """Means by difficulty; missing and blank ones are unknown."""
    name = F.coalesce(F.nullif(F.trim(F.col(difficulty)), F.lit("")), F.lit("unknown"))
    return means(metrics.withColumn(difficulty, name), [difficulty])


ORDERED = ("easy", "medium", "hard")


def ordered_breakdown(metrics: DataFrame, difficulty: str = "difficulty") -> DataFrame:
    """Means by difficulty with its place in the fixed order; others are left out, as are those without queries."""
    place = F.array_position(F.array(*(F.lit(d) for d in ORDERED)), F.col(difficulty))
    return breakdown(metrics.where(F.col(difficulty).isin(*ORDERED)), difficulty).withColumn("place", place)


def hit_matrix(metrics: DataFrame, model: str, models: list[str]) -> DataFrame:
    """One row for each query, one column of 0 and 1 for each model."""
    return metrics.groupBy("query_id").pivot(model, models).agg(F.max("hit"))


def rr_bins(metrics: DataFrame, by: str) -> DataFrame:
    rr = F.col("rr")
    return metrics.groupBy(by).agg(F.count_if(rr == 0).alias("none"), F.count_if((rr > 0) & (rr < 1)).alias("below"), F.count_if(rr == 1).alias("first"))


def ecdf(metrics: DataFrame, by: str, score: str = "rr") -> DataFrame:
    """Share of the rows of a group up to each score; rows are counted by score first, so no group meets in one task."""
    counts = metrics.groupBy(by, score).agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(by).orderBy(score).rowsBetween(Window.unboundedPreceding, 0))
    return counts.select(by, score, (so_far / F.sum("n").over(Window.partitionBy(by))).alias("share"))
