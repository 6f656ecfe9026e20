"""Ground truth of questions, and what compares runs of retrieval with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ir


def stem(name: Column) -> Column:
    """Name without what follows its last dot."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def expected_sources(sources: Column, source_file: Column) -> Column:
    """The sources stated, else the page that the file's name stands for: its first underscore is a colon."""
    derived = F.when(F.coalesce(source_file, F.lit("")) != "", F.array(F.regexp_replace(stem(source_file), "^([^_]*)_", "$1:")))
    return F.when(F.size(F.coalesce(sources, F.array().cast("array<string>"))) > 0, sources).otherwise(F.coalesce(derived, F.array().cast("array<string>")))


def qrels(truth: DataFrame) -> DataFrame:
    """Judgements (query_id, doc_id, rel) of questions (query_id, sources, source_file)."""
    found = truth.select("query_id", F.explode(F.array_distinct(expected_sources(F.col("sources"), F.col("source_file")))).alias("doc_id"))
    return found.withColumn("rel", F.lit(1))


def named_corpus(corpora: dict[str, DataFrame], name: str) -> DataFrame:
    """One of several corpora by its name."""
    if name not in corpora:
        raise ValueError(f"no corpus {name}; known are {sorted(corpora)}")
    return corpora[name]


def restricted(docs: DataFrame, truth: DataFrame, key: str = "source_file") -> DataFrame:
    """Documents that a question names."""
    return docs.join(truth.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def both(pages: DataFrame, media: DataFrame) -> DataFrame:
    """Pages and media as one corpus, each with its collection."""
    return pages.withColumn("collection", F.lit("pages")).unionByName(media.withColumn("collection", F.lit("media")), allowMissingColumns=True)


def allowed(docs: DataFrame, levels: list[str], column: str = "access_level") -> DataFrame:
    """Documents of these access levels; to be taken before a search, so that none of its ranks is lost."""
    return docs.where(F.col(column).isin(*levels))


def mock_hits(truth: DataFrame) -> DataFrame:
    """(query_id, doc_id, rank, score): what is expected, in its order, each of score 1 / rank."""
    found = truth.select("query_id", F.posexplode(expected_sources(F.col("sources"), F.col("source_file"))).alias("pos", "doc_id"))
    return found.select("query_id", "doc_id", (F.col("pos") + 1).alias("rank"), (F.lit(1.0) / (F.col("pos") + 1)).alias("score"))


def ranked_heads(ranked: DataFrame, most: int = 10) -> DataFrame:
    """(query_id, pages): the first documents of each list."""
    return ranked.where(F.col("rank") <= most).groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"]).alias("pages"))


def best_relevance(scored: DataFrame, score: str = "relevance") -> DataFrame:
    """The best relevance over all hits of a query."""
    return scored.groupBy("query_id").agg(F.max(score).alias("relevance"))


def keyword_baseline(truth: DataFrame, ranked: DataFrame, errors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, error, rr, p_at_5, hit) of a keyword search.

    Queries that failed (query_id, error) score 0 and stay in the means; those without results score 0 too.
    """
    return _baseline(ir.per_query(_answered(ranked, errors, k), qrels(truth), truth, k=5), errors)


def keyword_baseline_by_group(queries: DataFrame, docs: DataFrame, group: str, ranked: DataFrame, errors: DataFrame, k: int = 10) -> DataFrame:
    """As ``keyword_baseline``, where all documents (doc_id, group) of a query's group are right; they are counted and not listed."""
    judged = docs.select("doc_id", group, F.lit(1).alias("rel"))
    return _baseline(ir.per_query_by_group(_answered(ranked, errors, k), judged, queries, group, k=5, without_self=False), errors)


def _answered(ranked: DataFrame, errors: DataFrame, k: int) -> DataFrame:
    return ranked.where(F.col("rank") <= k).join(errors.select("query_id"), "query_id", "left_anti")


def _baseline(found: DataFrame, errors: DataFrame) -> DataFrame:
    """Every list ends at k, so a right document is in it where its reciprocal rank is above 0."""
    joined = found.join(errors.select("query_id", "error"), "query_id", "left")
    return joined.select("query_id", "error", "rr", F.col("p_at_k").alias("p_at_5"), (F.col("rr") > 0).alias("hit"))


def baseline_summary(results: DataFrame) -> DataFrame:
    """One row: means over all queries, hits, misses (without errors) and errors."""
    mean = lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 4)
    failed, hit = F.col("error").isNotNull(), F.col("hit")
    return results.agg(mean("rr").alias("mrr"), mean("p_at_5").alias("precision_at_5"), mean(hit.cast("double")).alias("hit_rate"), F.count("*").alias("total"), F.count_if(hit).alias("hits"), F.count_if(~hit & ~failed).alias("misses"), F.count_if(failed).alias("errors"))


def compared(runs: dict[str, DataFrame]) -> DataFrame:
    """Means of the per-query metrics of runs by their configuration, the best mean reciprocal rank first."""
    every = None
    for name, run in runs.items():
        tagged = run.withColumn("config", F.lit(name))
        every = tagged if every is None else every.unionByName(tagged)
    return ir.means(every, ["config"]).withColumn("place", F.row_number().over(Window.orderBy(F.desc("mean_rr"), "config")))  # one row for each run


def rr_pairs(dense: DataFrame, hybrid: DataFrame) -> DataFrame:
    """(query_id, dense, hybrid) reciprocal ranks of queries that both runs hold."""
    return dense.select("query_id", F.col("rr").alias("dense")).join(hybrid.select("query_id", F.col("rr").alias("hybrid")), "query_id")


def with_results(truth: DataFrame, results: DataFrame) -> DataFrame:
    """Questions with the contexts and answer of a run: no contexts and the true answer where there are none."""
    joined = truth.join(results.select("query_id", "contexts", "answer"), "query_id", "left")
    return joined.withColumns({"contexts": F.coalesce("contexts", F.array().cast("array<string>")), "answer": F.coalesce("answer", "ground_truth")})


def with_vectors(chunks: DataFrame, vectors: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Chunks with their vectors by key; a chunk without one, or with several, is an error and not left out."""
    missing, several = chunks.join(vectors, key, "left_anti").limit(1).count(), vectors.groupBy(key).count().where("count > 1").limit(1).count()
    if missing or several:
        raise ValueError("chunks and vectors do not belong together")
    return chunks.join(vectors, key)


def paired_by_stem(originals: DataFrame, processed: DataFrame) -> DataFrame:
    """(id, source, result) of files of one name without suffix; both sides are (name, text)."""
    key = lambda d, to: d.select(stem(F.col("name")).alias("id"), F.col("text").alias(to))
    return key(originals, "source").join(key(processed, "result"), "id")


def body_after_front_matter(text: Column) -> Column:
    """What follows the second line of dashes; the whole text where there are not two."""
    return F.when(text.rlike(r"(?s)^---.*?\n---"), F.regexp_replace(text, r"(?s)^---.*?\n---[ \t]*\n?", "")).otherwise(text)


def first_chunks(chunks: DataFrame, per_page: int, sample: int) -> DataFrame:
    """The first chunks of every page (doc_id, chunk_index), ``sample`` of them in all, by id and place."""
    return chunks.where(F.col("chunk_index") < per_page).orderBy("doc_id", "chunk_index").limit(sample)


def question_export(queries: DataFrame) -> DataFrame:
    """Questions as (question, contexts, ground_truth, metadata): contexts are empty where there is none, chunks at most 200 characters."""
    contexts = F.when(F.coalesce(F.col("context"), F.lit("")) != "", F.array("context")).otherwise(F.array().cast("array<string>"))
    about = F.struct("source_page", "query_type", "namespace", F.when(F.coalesce(F.col("source_chunk"), F.lit("")) != "", F.substring("source_chunk", 1, 200)).alias("source_chunk"))
    return queries.select("question", contexts.alias("contexts"), F.coalesce("expected_answer", F.lit("")).alias("ground_truth"), about.alias("metadata"))


def document_identity(block: Column, body: Column, name: Column, field) -> dict[str, Column]:
    """Page id, namespace and title of a file: from its front matter, else from its name and body.

    ``field(block, key)`` reads a field of the front matter.
    """
    from .corpus import title_from_body

    page = F.coalesce(field(block, "page_id"), field(block, "media_id"), F.translate(F.regexp_replace(name, r"\.md$", ""), "_", ":"))
    above = F.when(F.contains(page, F.lit(":")), F.regexp_replace(page, ":[^:]*$", "")).otherwise("")
    return {"page_id": F.trim(page), "namespace": F.lower(F.trim(F.coalesce(field(block, "namespace"), above))), "title": F.coalesce(field(block, "title"), title_from_body(body))}


def probed_page_id(text: Column, name: Column) -> Column:
    """Id that one of the first 25 lines states, else that of the file's name."""
    lines = F.filter(F.transform(F.slice(F.split(text, "\n"), 1, 25), lambda x: F.trim(x)), lambda x: x.startswith("page_id:") | x.startswith("media_id:"))
    stated = F.regexp_replace(F.trim(F.regexp_replace(F.try_element_at(lines, F.lit(1)), "^[a-z_]+:", "")), "^[\"']+|[\"']+$", "")
    return F.coalesce(stated, F.regexp_replace(F.regexp_replace(name, r"\.md$", ""), "^([^_]*)_", "$1:"))


def resolved_model(configured: str, available: list[str]) -> str | None:
    """The model of this name, else one of its tags, the latest before others."""
    name = (configured or "").strip()
    if not name or not available or name in available:
        return name or None
    tagged = [m for m in available if m.startswith(name + ":")]
    return next((m for m in tagged if m.endswith(":latest")), tagged[0] if tagged else None)


def metric_parts(metrics: DataFrame, column: str) -> tuple[Column, Column]:
    """Mean and deviation of a metric that is a struct of both or a plain number."""
    if metrics.schema[column].dataType.typeName() == "struct":
        return F.coalesce(F.col(f"{column}.mean"), F.lit(0.0)), F.col(f"{column}.std")
    return F.col(column).cast("double"), F.lit(None).cast("double")
