"""Chunking, conversion, scores, statistics, strategies, samples and personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import count_matches
from ..operators import chunks as K
from ..operators import corpus as C
from ..operators import ir, stats
from ..operators import markup as M
from ..operators import scores as S
from . import inputs as I
from .ranking import _METRICS, metrics

KINDS = ("KNOWLEDGE", "NEWS", "TABLE_DATA", "PORTAL", "EMPTY", "OTHER")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*(F.lit(k) for k in KINDS)), (F.col("doc_id") % 6 + 1).cast("int"))
    return I.wiki(spark, sf_dir).select("doc_id", kind.alias("content_type"), M.markdown("content").alias("text"))


def chunk_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.chunk_documents(_docs(spark, sf_dir)).select("chunk_id", "chunk_index", "total_chunks", F.length("chunk").alias("chars"))


def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.chunk_stats(K.chunk_documents(_docs(spark, sf_dir)))


def embedding_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.embedding_usage(K.chunk_documents(_docs(spark, sf_dir)))


def _method(name: str, function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = K.exploded(I.wiki(spark, sf_dir), ["doc_id"], "content", function)
        return made.select("doc_id", "chunk_index", F.length("chunk").alias("chars"), F.md5("chunk").alias("digest"))

    run.__name__ = name
    return run


def chunk_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a head for every line, some deeper than others, behind an introduction."""
    text = F.concat(F.lit("Intro "), "doc_id", F.lit("\n# Head\n"), F.replace(F.replace("text", F.lit(". "), F.lit(".\n### Deep\n")), F.lit("\n"), F.lit("\n\n")))
    made = K.exploded(I.table(spark, sf_dir, "documents").withColumn("content", text), ["doc_id"], "content", K.by_header)
    return made.select("doc_id", "chunk_index", F.length("chunk").alias("chars"), F.md5("chunk").alias("digest"))


def chunk_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents are cut and how many their settings skip."""
    return K.skipped(_docs(spark, sf_dir))


chunk_semantic, chunk_naive = _method("chunk_semantic", K.semantic), _method("chunk_naive", K.naive)
chunk_table, chunk_simple, chunk_querygen = _method("chunk_table", K.by_table), _method("chunk_simple", K.simple), _method("chunk_querygen", K.for_queries)


def chunk_size_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of naive windows at several sizes, without overlap and sentence ends: a count that SQL can check."""
    sizes = spark.createDataFrame([(256,), (512,), (1024,)], "size int")
    docs = I.pages(spark, sf_dir).select("doc_id", "n_chars")
    return docs.crossJoin(F.broadcast(sizes)).groupBy("size").agg(F.sum(F.ceil(F.col("n_chars") / F.col("size"))).alias("chunks"))


def wiki_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.converted(I.wiki(spark, sf_dir)).select("page_id", "title", "success", F.md5("markdown").alias("digest"), count_matches(F.col("markdown"), "(?m)^#").alias("headings"), count_matches(F.col("markdown"), r"\]\(").alias("links"))


def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front matter written, split and read again."""
    pages = I.pages(spark, sf_dir)
    written = pages.select("page_id", "lang", "text", F.concat(M.front_matter({"page_id": F.col("page_id"), "lang": F.col("lang"), "modified": F.col("modified")}), F.col("text")).alias("file"))
    block, body = M.split_front_matter(F.col("file"))
    return written.select("page_id", M.front_matter_field(block, "lang").alias("lang"), (body == F.col("text")).alias("same"), (M.front_matter_field(block, "page_id") == F.col("page_id")).alias("same_id"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.wiki(spark, sf_dir).select(F.col("page_id").alias("id"), F.col("content").alias("source"), F.replace(F.replace(F.col("content"), F.lit("====== "), F.lit("# ")), F.lit(" ======"), F.lit("")).alias("result"))


def doc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores that SQL can say, of a conversion that changes headings only; of a page of nothing but markup nothing is lost."""
    found = S.scored(_pairs(spark, sf_dir), similar=False, nothing=1.0)
    return found.select("id", *(F.round(c, 6).alias(c) for c in ("completeness", "noise", "structure")))


def regression_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir).withColumn("result", M.markdown("source"))
    return S.regression_gate(S.scored(pairs))


def seven_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir).withColumn("result", M.markdown("source"))
    return S.scored(pairs).select("id", S.passes(list(S.THRESHOLDS)).alias("passed"), *(F.round(m, 6).alias(m) for m in S.THRESHOLDS))


def _scored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-event scores of two models."""
    e = I.table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("query_id"), F.concat(F.lit("model"), F.col("user_id") % 3).alias("model"), F.col("value").alias("score"))


def describe_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.describe(_scored_runs(spark, sf_dir), ["model"], "score")
    return found.select("model", "n", *(F.round(c, 6).alias(c) for c in ("mean", "median", "std", "min", "max", "q1", "q3")))


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("stage"), F.col("user_id") % 5).alias("stage"), F.col("value").alias("a"), (F.col("value") * 0.9 + F.col("event_id") % 7).alias("b"))


def cohens_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.cohens_d(_paired(spark, sf_dir), ["stage"])
    return found.select("stage", F.round("d", 6).alias("d"), stats.effect_label(F.col("d")).alias("effect"))


def metric_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ir.correlation(I.table(spark, sf_dir, "lineitem"), _COLUMNS)
    return found.select("a", "b", F.round("r", 6).alias("r"))


def rr_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ir.rr_bins(metrics(spark, sf_dir).withColumn("part", (F.col("query_id") / 20).cast("long") % 2), "part")


def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = I.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("model"), F.floor(F.col("o_totalprice") / 10000).cast("long").alias("rr"))
    return ir.ecdf(orders, "model").select("model", "rr", F.round("share", 6).alias("share"))


def judge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"score": '), F.col("event_id") % 10, F.lit("}"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Score: "), F.col("event_id") % 120)).otherwise(F.lit("none"))
    return e.select("event_id", F.round(stats.judge_score(raw), 6).alias("score"))


def judge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.table(spark, sf_dir, "lineitem").select(F.col("l_discount").alias("m1"), F.col("l_tax").alias("m2"), (F.col("l_quantity") / 50).alias("m3"), F.when(F.col("l_linenumber") > 3, F.lit(0.5)).alias("m4"))
    found = stats.judge_summary(rows, ["m1", "m2", "m3", "m4"])
    return found.select(*(F.round(c, 6).alias(c) for c in found.columns))


def numeric_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ir.numeric_means(I.table(spark, sf_dir, "part"))
    return found.select(*(F.round(c, 6).alias(c) for c in found.columns))


def strategy_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids_ = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    rows = ids_.select(F.concat(F.lit("p"), F.col("id") * 3).alias("page_id"), F.element_at(F.array(F.lit("ARCHIVED"), F.lit("NEWS"), F.lit("KNOWLEDGE")), (F.col("id") % 3 + 1).cast("int")).alias("content_type"), F.lit("naive").alias("method"), F.lit(1024).alias("size"), F.when(F.col("id") % 2 == 0, "skip").otherwise("process").alias("action"))
    pages = I.pages(spark, sf_dir).select(F.concat(F.lit("p"), F.col("doc_id")).alias("page_id"))
    return C.with_strategy(pages, rows).select("page_id", "content_type", "method", "size", "action", "priority")


def table_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = I.wiki(spark, sf_dir)
    rows = count_matches(F.col("content"), r"(?m)^[|^]")
    kind = C.table_override(F.lit("NEWS"), rows, F.length("content"))
    return C.clusters(w.select("doc_id", kind.alias("kind")), "kind", "doc_id").select("kind", "members", F.md5("ids").alias("digest"))


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 100 files: three quarters of the listing are pages, the rest media of three kinds."""
    is_media = F.col("doc_id") % 4 == 3
    ext = F.when(is_media, F.element_at(F.array(F.lit("pdf"), F.lit("docx"), F.lit("png")), (F.col("doc_id") % 3 + 1).cast("int"))).otherwise("md")
    files = I.pages(spark, sf_dir).select(F.col("doc_id").alias("key"), F.when(is_media, "media").otherwise("pages").alias("source"), ids.top_namespace(F.col("page_id")).alias("namespace"), ext.alias("extension"))
    return C.corpus_sample(files, 100)


def spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.some_of_each(I.pages(spark, sf_dir), "lang", "doc_id", 10).select("doc_id", "lang")


def pii_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = I.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.size(C.emails(F.col("text"))).cast("long").alias("emails"), F.size(C.suspicious(F.col("text"), ["example.com"])).cast("long").alias("suspicious"), F.md5(C.redacted(F.col("text"))).alias("digest"))


def qa_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = C.qa_pairs(I.table(spark, sf_dir, "conversations"))
    body = F.when(F.col("conv_id") % 3 == 0, F.col("question")).otherwise(F.concat("question", F.lit(" "), "answer"))
    asked = F.when(F.col("conv_id") % 5 == 0, F.concat(F.lit("Was steht auf dieser Seite "), "turn", F.lit("?"))).otherwise(F.col("question"))
    return pairs.select("conv_id", "turn", C.qa_problem(asked, F.col("answer"), body).alias("problem"), C.is_procedural(F.lit(""), F.col("answer")).alias("procedural"))


def qa_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = I.pages(spark, sf_dir)
    return d.select("doc_id", F.md5(C.excerpt(F.col("text"), 300)).alias("digest"), C.template_question(C.title_from_body(F.col("text")), ids.parent_namespace(F.col("page_id"))).alias("question"), C.template_answer(F.col("text")).alias("answer"))


QUERIES = {
    f.__name__: f
    for f in (
        chunk_dispatch, chunk_stats, chunk_skips, embedding_usage, chunk_semantic, chunk_header, chunk_naive, chunk_table, chunk_simple, chunk_querygen, chunk_size_counts, wiki_to_markdown, front_matter, doc_scores, regression_gate,
        seven_scores, describe_scores, cohens_d, metric_correlation, rr_bins, ecdf, judge_scores, judge_summary, numeric_means, strategy_routing, table_override, stratified_sample, spot_check, pii_redact,
        qa_validate, qa_excerpt,
    )
}

_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_NS = "CASE WHEN contains(page_id, ':') THEN regexp_replace(page_id, ':[^:]*$', '') ELSE '' END"
_DRAW = "(doc_id + 42) * 2654435761 % 4294967296"
_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_RESULT = "replace(replace(content, '====== ', '# '), ' ======', '')"
_BARE = "regexp_replace(content, '(?m)={2,6}|\\[\\[|\\]\\]|\\{\\{|\\}\\}|\\*\\*|//|''''|__|^[ \\t]*[\\*\\-]\\s|<[^>]+>', '', 'g')"
_NOISE = " + ".join(f"coalesce(list_sum(list_transform(regexp_extract_all(result, '{p}'), lambda x: length(x))), 0)" for p in S.NOISE)
_BLOCKS = "len(list_filter(string_split({}, chr(10) || chr(10)), lambda x: regexp_replace(x, '\\s', '', 'g') <> ''))"
_LISTS = "len(regexp_extract_all({}, '(?m)^[ \\t]*[\\*\\-]\\s'))"
_NUMBER = "CASE WHEN x BETWEEN 0 AND 1 THEN x WHEN x > 1 AND x <= 10 THEN x / 10 WHEN x > 10 AND x <= 100 THEN x / 100 END"
_EMAILS = f"regexp_extract_all(text, '{C.EMAIL}')"

_BLOCK_LIST = f"list_filter(list_transform(string_split(content, chr(10) || chr(10)), lambda x: {_STRIP.format('x')}), lambda x: x <> '')"
_CHUNK_ROWS = "SELECT doc_id, CAST(i - 1 AS INT) AS chunk_index, length(chunks[i]) AS chars, md5(chunks[i]) AS digest FROM (SELECT doc_id, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM c)"
_CUR = "list_last(string_split(a, chr(1)))"
_SENTENCES = f"list_filter(list_transform(string_split(replace(b, '. ', '.' || chr(10)), chr(10)), lambda y: {_STRIP.format('y')}), lambda y: y <> '')"



def _semantic_sql(text: str, size: int, least: int = 100) -> str:
    """Chunks of a text as a list: paragraphs packed, long ones by sentences, or by windows where they are one sentence; a short tail joins the chunk before it.

    The state is one string: chunks end in chr(1), paragraphs in a chunk are parted by chr(2), sentences by chr(4).
    """
    cur, part = "list_last(string_split(a, chr(1)))", "list_last(string_split(list_last(string_split(a, chr(1))), chr(2)))"
    parts = "string_split(regexp_replace(b, '([.!?])\\s+', '\\1' || chr(3), 'g'), chr(3))"
    windows = f"list_transform(range(0, length(b), {size - 50}), lambda i: 'N' || {_STRIP.format(f'substr(b, CAST(i AS INT) + 1, {size})')})"
    items = f"flatten(list_transform({_BLOCK_LIST.replace('content', text)}, lambda b: CASE WHEN length(b) <= {size} THEN ['B' || b] WHEN len({parts}) > 1 THEN list_concat(list_transform({parts}, lambda y, i: CASE WHEN i = 1 THEN 'F' ELSE 'S' END || y), ['E']) ELSE list_concat({windows}, ['E']) END))"
    step = f"""CASE WHEN x = 'E' THEN a || chr(1) WHEN {cur} = '' THEN a || substr(x, 2) WHEN x[1] IN ('F', 'N') THEN a || chr(1) || substr(x, 2)
        WHEN x[1] = 'S' THEN CASE WHEN length(replace({cur}, chr(4), '')) + length(x) - 1 > {size} THEN a || chr(1) ELSE a || chr(4) END || substr(x, 2)
        WHEN length(replace({cur}, chr(2), '')) + length(x) - 1 <= {size} THEN a || chr(2) || substr(x, 2)
        WHEN length({part}) < 50 THEN a || chr(1) || {part} || chr(2) || substr(x, 2) ELSE a || chr(1) || substr(x, 2) END"""
    state = f"list_reduce(list_concat([''], {items}), lambda a, x: {step})"
    chunks = "list_transform(list_filter(string_split(s, chr(1)), lambda c: c <> ''), lambda c: replace(replace(c, chr(2), chr(10) || chr(10)), chr(4), ' '))"
    joined = f"CASE WHEN NOT ends_with(s, chr(1)) AND len(cs) > 1 AND length(cs[-1]) < {least} THEN list_concat(cs[:-3], [cs[-2] || chr(10) || chr(10) || cs[-1]]) ELSE cs END"
    return f"list_transform([{state}], lambda s: list_transform([{chunks}], lambda cs: {joined})[1])[1]"


#: Lines with something in them, run together; what stands before and after the table rows of a page.
_FILLED = "array_to_string(list_filter(string_split({}, chr(10)), lambda l: regexp_replace(l, '\\s', '', 'g') <> ''), chr(10))"
_TABLE_ROWS = "'| 1 | 2 |' || chr(10) || '| 3 | 4 |'"

_TABLE_ROWS_MD = "'| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) || '| 3 | 4 |'"
_DISPATCHED = f"""WITH RECURSIVE d AS (SELECT doc_id, markdown AS text, (['KNOWLEDGE', 'NEWS', 'TABLE_DATA', 'PORTAL', 'EMPTY', 'OTHER'])[CAST(doc_id % 6 AS INT) + 1] AS content_type FROM ({I.MARKDOWN})),
    w AS (
        SELECT doc_id, text, 0 AS pos, 0 AS stop, -1 AS i FROM d WHERE content_type = 'NEWS'
        UNION ALL
        SELECT doc_id, text, nxt AS pos, nxt + CASE WHEN nxt + 1024 < length(text) AND cut > 512 THEN cut + 1 ELSE 1024 END AS stop, i + 1 AS i
        FROM (SELECT *, CASE WHEN strpos(reverse(seg), ' .') > 0 THEN length(seg) - strpos(reverse(seg), ' .') - 1 ELSE -1 END AS cut
            FROM (SELECT *, substr(text, nxt + 1, 1024) AS seg FROM (SELECT *, CASE WHEN i < 0 THEN 0 ELSE stop - 150 END AS nxt FROM w)))
        WHERE nxt < length(text)),
    windows AS (SELECT doc_id, list({_STRIP.format('substr(text, pos + 1, stop - pos)')} ORDER BY i) AS chunks FROM w WHERE i >= 0 GROUP BY doc_id),
    t AS (SELECT doc_id, text, strpos(text, {_TABLE_ROWS_MD}) AS spot FROM d WHERE content_type = 'TABLE_DATA'),
    u AS (SELECT doc_id, spot, {_STRIP.format(_FILLED.format("CASE WHEN spot > 0 THEN substr(text, 1, spot - 1) ELSE text END"))} AS front, CASE WHEN spot > 0 THEN {_STRIP.format(_FILLED.format(f'substr(text, spot + length({_TABLE_ROWS_MD}))'))} ELSE '' END AS rest, string_split(text, chr(10))[1] AS head FROM t),
    tables AS (SELECT doc_id, list_concat(list_concat({_semantic_sql('front', 2048)}, CASE WHEN spot > 0 THEN [head || chr(10) || {_TABLE_ROWS_MD}] ELSE [] END), CASE WHEN rest <> '' THEN {_semantic_sql('rest', 2048)} ELSE [] END) AS chunks FROM u),
    packed AS (SELECT doc_id, {_semantic_sql('text', 512)} AS chunks FROM d WHERE content_type = 'OTHER' OR (content_type = 'KNOWLEDGE' AND length(text) > 512)),
    c AS (SELECT doc_id, content_type, CASE WHEN content_type = 'PORTAL' THEN [substr(text, 1, 500)] ELSE coalesce(windows.chunks, tables.chunks, packed.chunks, [text]) END AS chunks
        FROM d LEFT JOIN windows USING (doc_id) LEFT JOIN tables USING (doc_id) LEFT JOIN packed USING (doc_id) WHERE content_type <> 'EMPTY'),
    k AS (SELECT doc_id, content_type, len(chunks) AS total, CAST(i - 1 AS INT) AS chunk_index, chunks[i] AS chunk FROM (SELECT *, unnest(range(1, len(chunks) + 1)) AS i FROM c))
"""

ORACLE_SQL = {
    "chunk_dispatch": f"{_DISPATCHED} SELECT 'documents_' || doc_id || '_' || chunk_index AS chunk_id, chunk_index, total AS total_chunks, length(chunk) AS chars FROM k",
    "chunk_stats": f"{_DISPATCHED} SELECT content_type, count(*) AS chunks, count(DISTINCT doc_id) AS documents, round(avg(length(chunk)), 6) AS mean_length, min(length(chunk)) AS min_length, max(length(chunk)) AS max_length, CAST(sum(length(chunk)) AS BIGINT) AS total_length FROM k GROUP BY content_type",
    "embedding_usage": f"{_DISPATCHED} SELECT CAST(sum(ceil(length(chunk) / 4.0e0)) AS BIGINT) AS tokens, CAST(ceil(count(*) / 20.0e0) AS BIGINT) AS requests, round(sum(ceil(length(chunk) / 4.0e0)) / 1000 * 0.00013e0, 6) AS cost FROM k",
    "wiki_to_markdown": f"SELECT page_id, {_STRIP.format("regexp_extract(content, '^====== *([^\\n]*?) *======', 1)")} AS title, true AS success, md5(markdown) AS digest, len(regexp_extract_all(markdown, '(?m)^#')) AS headings, len(regexp_extract_all(markdown, '\\]\\(')) AS links FROM ({I.MARKDOWN})",
    "chunk_semantic": f"WITH c AS (SELECT doc_id, {_semantic_sql('content', 512)} AS chunks FROM ({I.WIKI})) {_CHUNK_ROWS}",
    "chunk_header": f"""
        WITH parts AS (
            SELECT doc_id, list_filter(list_transform(string_split(regexp_replace('Intro ' || doc_id || chr(10) || '# Head' || chr(10)
                || replace(replace(text, '. ', '.' || chr(10) || '### Deep' || chr(10)), chr(10), chr(10) || chr(10)), '(?m)^(#{{1,6}}\\s)', chr(5) || '\\1', 'g'), chr(5)),
                lambda p: {_STRIP.format("p")}), lambda p: p <> '') AS ps
            FROM documents
        ), spread AS (
            SELECT doc_id, generate_subscripts(ps, 1) AS place, unnest(ps) AS part FROM parts
        ), cut AS (
            SELECT doc_id, place, CASE WHEN length(part) > 512 THEN {_semantic_sql("part", 512)} ELSE [part] END AS own FROM spread
        ), c AS (
            SELECT doc_id, flatten(list(own ORDER BY place)) AS chunks FROM cut GROUP BY doc_id
        ) {_CHUNK_ROWS}
    """,
    "chunk_skips": f"SELECT count(*) AS documents, count(*) FILTER (WHERE doc_id % 6 <> 4) AS processed, count(*) FILTER (WHERE doc_id % 6 = 4) AS skipped FROM ({I.PAGES})",
    "chunk_table": f"""WITH parts AS (SELECT doc_id, strpos(content, {_TABLE_ROWS}) AS spot, content FROM ({I.WIKI})),
        texts AS (SELECT doc_id, spot, {_STRIP.format(_FILLED.format("CASE WHEN spot > 0 THEN substr(content, 1, spot - 1) ELSE content END"))} AS front, CASE WHEN spot > 0 THEN {_STRIP.format(_FILLED.format(f'substr(content, spot + length({_TABLE_ROWS}))'))} ELSE '' END AS rest, string_split(content, chr(10))[1] AS head FROM parts),
        c AS (SELECT doc_id, list_concat(list_concat({_semantic_sql('front', 2048)}, CASE WHEN spot > 0 THEN [head || chr(10) || {_TABLE_ROWS}] ELSE [] END), CASE WHEN rest <> '' THEN {_semantic_sql('rest', 2048)} ELSE [] END) AS chunks FROM texts) {_CHUNK_ROWS}""",
    "chunk_naive": f"""WITH RECURSIVE w AS (
            SELECT doc_id, content, 0 AS pos, 0 AS stop, -1 AS chunk_index FROM ({I.WIKI})
            UNION ALL
            SELECT doc_id, content, nxt AS pos, nxt + CASE WHEN nxt + 1024 < length(content) AND cut > 512 THEN cut + 1 ELSE 1024 END AS stop, chunk_index + 1 AS chunk_index
            FROM (SELECT *, CASE WHEN strpos(reverse(seg), ' .') > 0 THEN length(seg) - strpos(reverse(seg), ' .') - 1 ELSE -1 END AS cut
                FROM (SELECT *, substr(content, nxt + 1, 1024) AS seg FROM (SELECT *, CASE WHEN chunk_index < 0 THEN 0 ELSE stop - 150 END AS nxt FROM w)))
            WHERE nxt < length(content))
        SELECT doc_id, CAST(chunk_index AS INT) AS chunk_index, length(x) AS chars, md5(x) AS digest FROM (SELECT doc_id, chunk_index, {_STRIP.format('substr(content, pos + 1, stop - pos)')} AS x FROM w WHERE chunk_index >= 0)""",
    "chunk_querygen": f"""WITH c AS (SELECT doc_id, list_transform(list_filter(string_split(CASE WHEN len(bs) = 0 THEN '' ELSE list_reduce(bs, lambda a, x: CASE WHEN length({_CUR}) + length(x) > 1000 THEN a || chr(1) || x ELSE a || chr(10) || chr(10) || x END) END, chr(1)), lambda x: length(x) >= 200), lambda x: {_STRIP.format('x')}) AS chunks
            FROM (SELECT doc_id, {_BLOCK_LIST} AS bs FROM ({I.WIKI}))) {_CHUNK_ROWS}""",
    "chunk_simple": f"""WITH items AS (SELECT doc_id, flatten(list_transform({_BLOCK_LIST}, lambda b: CASE WHEN length(b) > 512 THEN list_transform({_SENTENCES}, lambda y, i: CASE WHEN i = 1 THEN 'F' ELSE 'L' END || y) ELSE ['B' || b] END)) AS xs FROM ({I.WIKI})),
        c AS (SELECT doc_id, list_transform(string_split(list_reduce(list_concat([''], xs), lambda a, x: CASE WHEN {_CUR} = '' THEN a || substr(x, 2)
                WHEN x[1] = 'F' THEN a || chr(1) || substr(x, 2)
                WHEN length(replace({_CUR}, chr(2), '')) + length(x) - 1 <= 512 THEN a || chr(2) || substr(x, 2)
                WHEN x[1] = 'B' AND length(list_last(string_split({_CUR}, chr(2)))) <= 50 THEN a || chr(1) || list_last(string_split({_CUR}, chr(2))) || chr(2) || substr(x, 2)
                ELSE a || chr(1) || substr(x, 2) END), chr(1)), lambda x: replace(x, chr(2), chr(10) || chr(10))) AS chunks FROM items WHERE len(xs) > 0) {_CHUNK_ROWS}""",
    "chunk_size_counts": f"SELECT size, CAST(sum(ceil(n_chars / CAST(size AS DOUBLE))) AS BIGINT) AS chunks FROM ({I.PAGES}), (SELECT unnest([256, 512, 1024]) AS size) GROUP BY size",
    "front_matter": f"SELECT page_id, lang, true AS same, true AS same_id FROM ({I.PAGES})",
    "doc_scores": f"""WITH p AS (SELECT page_id AS id, content, {_RESULT} AS result FROM ({I.WIKI})),
        n AS (SELECT *, len(regexp_extract_all(content, '(?m)^={{2,6}}\\s*.*?={{2,6}}\\s*$')) AS h0, len(regexp_extract_all(result, '(?m)^#{{1,6}}\\s+')) AS h1, {_LISTS.format('content')} AS l0, len(regexp_extract_all(result, '(?m)^[ \\t]*[\\*\\-]\\s|^\\d+[\\.\\)]\\s')) AS l1,
            {_BLOCKS.format('content')} AS p0, {_BLOCKS.format('result')} AS p1 FROM p)
        SELECT id, round(least(1.0e0, CAST(length({_STRIP.format('result')}) AS DOUBLE) / length({_STRIP.format(_BARE)})), 6) AS completeness, round(CAST({_NOISE} AS DOUBLE) / length(result), 6) AS noise,
            round((CASE WHEN h0 > 0 THEN 2 * least(1.0e0, CAST(h1 AS DOUBLE) / h0) ELSE 0 END + CASE WHEN l0 > 0 THEN 2 * least(1.0e0, CAST(l1 AS DOUBLE) / l0) ELSE 0 END
                + CASE WHEN p0 = 0 THEN 0 WHEN p1 <= p0 THEN CAST(p1 AS DOUBLE) / p0 ELSE greatest(0.5e0, 1 - (CAST(p1 AS DOUBLE) / p0 - 1) * 0.5e0) END)
                / (CASE WHEN h0 > 0 THEN 2e0 ELSE 0 END + CASE WHEN l0 > 0 THEN 2e0 ELSE 0 END + CASE WHEN p0 > 0 THEN 1e0 ELSE 0 END), 6) AS structure FROM n""",
    "describe_scores": "SELECT 'model' || (user_id % 3) AS model, count(value) AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3 FROM events GROUP BY 1",
    "cohens_d": """SELECT stage, round(d, 6) AS d, CASE WHEN abs(d) < 0.2 THEN 'vernachlässigbar' WHEN abs(d) < 0.5 THEN 'klein' WHEN abs(d) < 0.8 THEN 'mittel' ELSE 'groß' END AS effect
        FROM (SELECT 'stage' || (user_id % 5) AS stage, (avg(value) - avg(value * 0.9e0 + event_id % 7)) / sqrt((var_pop(value) + var_pop(value * 0.9e0 + event_id % 7)) / 2) AS d FROM events GROUP BY 1)""",
    "metric_correlation": " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for i, a in enumerate(_COLUMNS) for b in _COLUMNS[i:]),
    "rr_bins": f"{_METRICS} SELECT query_id // 20 % 2 AS part, count(*) FILTER (WHERE rr = 0) AS none, count(*) FILTER (WHERE rr > 0 AND rr < 1) AS below, count(*) FILTER (WHERE rr = 1) AS first FROM m GROUP BY 1",
    "ecdf": "SELECT DISTINCT model, rr, round(cume_dist() OVER (PARTITION BY model ORDER BY rr), 6) AS share FROM (SELECT o_orderstatus AS model, CAST(floor(o_totalprice / 10000) AS BIGINT) AS rr FROM orders)",
    "judge_scores": f"SELECT event_id, round({_NUMBER}, 6) AS score FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(event_id % 10 AS DOUBLE) WHEN 1 THEN CAST(event_id % 120 AS DOUBLE) END AS x FROM events)",
    "judge_summary": "SELECT round(m1, 6) AS m1, round(m2, 6) AS m2, round(m3, 6) AS m3, round(m4, 6) AS m4, round(4 / (1 / m1 + 1 / m2 + 1 / m3 + 1 / m4), 6) AS composite FROM (SELECT avg(l_discount) AS m1, avg(l_tax) AS m2, avg(l_quantity / 50) AS m3, avg(CASE WHEN l_linenumber > 3 THEN 0.5e0 END) AS m4 FROM lineitem)",
    "numeric_means": "SELECT round(avg(p_partkey), 6) AS mean_p_partkey, round(avg(p_size), 6) AS mean_p_size, round(avg(p_retailprice), 6) AS mean_p_retailprice FROM part",
    "strategy_routing": f"""SELECT 'p' || doc_id AS page_id, coalesce(kind, 'KNOWLEDGE') AS content_type, CASE WHEN i IS NULL THEN 'semantic' ELSE 'naive' END AS method, CASE WHEN i IS NULL THEN 512 ELSE 1024 END AS size, CASE WHEN i % 2 = 0 THEN 'skip' ELSE 'process' END AS action,
        CASE coalesce(kind, 'KNOWLEDGE') WHEN 'ARCHIVED' THEN 'low' WHEN 'KNOWLEDGE' THEN 'high' ELSE 'normal' END AS priority
        FROM ({I.PAGES}) LEFT JOIN (SELECT i, i * 3 AS doc_id, CASE i % 3 WHEN 0 THEN 'ARCHIVED' WHEN 1 THEN 'NEWS' ELSE 'KNOWLEDGE' END AS kind FROM (SELECT doc_id AS i FROM documents)) USING (doc_id)""",
    "table_override": f"""SELECT kind, count(*) AS members, md5(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY CAST(doc_id AS VARCHAR))) AS digest FROM (SELECT doc_id, CASE WHEN n >= 3 AND n / greatest(1, floor(length(content) / 80e0)) >= 0.5 THEN 'TABLE_DATA' ELSE 'NEWS' END AS kind
        FROM (SELECT doc_id, content, len(regexp_extract_all(content, '(?m)^[|^]')) AS n FROM ({I.WIKI}))) GROUP BY kind""",
    "stratified_sample": f"""WITH f AS (SELECT doc_id AS key, CASE WHEN doc_id % 4 = 3 THEN 'media' ELSE 'pages' END AS source, CASE WHEN contains(page_id, ':') THEN split_part(page_id, ':', 1) ELSE 'root' END AS namespace,
            CASE WHEN doc_id % 4 <> 3 THEN 'md' WHEN doc_id % 3 = 0 THEN 'pdf' WHEN doc_id % 3 = 1 THEN 'docx' ELSE 'png' END AS extension, {_DRAW} AS draw FROM ({I.PAGES})),
        r AS (SELECT *, CASE WHEN source = 'pages' THEN row_number() OVER (PARTITION BY source, namespace ORDER BY draw, key) ELSE row_number() OVER (PARTITION BY source, namespace, extension ORDER BY draw, key) END AS n FROM f),
        o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN n = 1 THEN 0 ELSE 1 END, draw, key) AS place FROM r),
        t AS (SELECT least(50, count(*) FILTER (WHERE source = 'pages')) AS p, least(100 - least(50, count(*) FILTER (WHERE source = 'pages')), count(*) FILTER (WHERE source = 'media')) AS m FROM f)
        SELECT key, source, namespace, extension FROM o, t WHERE place <= CASE WHEN source = 'pages' THEN p ELSE m END""",
    "spot_check": f"SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_DRAW}, doc_id) <= 10",
    "pii_redact": f"SELECT doc_id, len({_EMAILS}) AS emails, len(list_filter({_EMAILS}, lambda m: lower(list_last(string_split(m, '@'))) <> 'example.com')) AS suspicious, md5(regexp_replace(text, '{C.EMAIL}', '[EMAIL]', 'g')) AS digest FROM documents",
    "qa_validate": f"""WITH p AS (SELECT x.conv_id, x.turn, CASE WHEN x.conv_id % 5 = 0 THEN 'Was steht auf dieser Seite ' || x.turn || '?' ELSE x.text END AS q0, y.text AS a, CASE WHEN x.conv_id % 3 = 0 THEN x.text ELSE x.text || ' ' || y.text END AS body
            FROM conversations x JOIN conversations y ON x.conv_id = y.conv_id AND x.turn = y.turn - 1 AND x.role = 'user' AND y.role = 'assistant'),
        w AS (SELECT *, trim(regexp_replace({_STRIP.format('q0')}, '^["'']+|["'']+$', '', 'g')) AS q, list_distinct(list_filter(regexp_extract_all(lower(a), '[\\p{{L}}\\p{{N}}_]+'), lambda w: length(w) > 4)) AS ws FROM p)
        SELECT conv_id, turn, CASE WHEN q0 = '' THEN 'empty' WHEN length(q) < 15 THEN 'too short' WHEN length(q) > 200 THEN 'too long' WHEN NOT ends_with(q, '?') THEN 'no question mark'
            WHEN regexp_matches(lower(q), 'welche informationen enthaelt|welche informationen enthält|was steht in diesem dokument|was steht auf dieser seite|was beinhaltet') THEN 'generic' WHEN length({_STRIP.format('a')}) < 10 THEN 'no answer'
            WHEN len(list_filter(ws, lambda w: contains(lower(body), w))) < 2 AND len(ws) >= 2 THEN 'not grounded' ELSE '' END AS problem, regexp_matches(lower(a), '{"|".join(C.PROCEDURAL)}') AS procedural FROM w""",
    "qa_excerpt": f"""WITH d AS (SELECT doc_id, page_id, text, {_NS} AS ns, substr(text, 1, 300) AS h, {_STRIP.format('text')} AS body FROM ({I.PAGES})),
        l AS (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda x: {_STRIP.format('x')}), lambda x: starts_with(x, '# ') OR (x <> '' AND NOT starts_with(x, '|') AND NOT starts_with(x, '-')))[1] AS t,
            list_filter(list_transform(string_split(body, chr(10)), lambda x: {_STRIP.format('x')}), lambda x: x <> '' AND NOT starts_with(x, '|')) AS ls FROM d),
        a AS (SELECT *, CASE WHEN t IS NULL THEN 'Dokument' WHEN starts_with(t, '# ') THEN {_STRIP.format('substr(t, 3)')} ELSE {_STRIP.format('substr(t, 1, 80)')} END AS title, coalesce(array_to_string(ls[1:5], ' '), '') AS five FROM l)
        SELECT doc_id, md5(CASE WHEN length(text) <= 300 THEN text WHEN contains(h, chr(10)) AND length(h) - strpos(reverse(h), chr(10)) > 210 THEN substr(h, 1, length(h) - strpos(reverse(h), chr(10))) ELSE h END) AS digest,
            CASE WHEN title NOT IN ('', 'Dokument') THEN 'Was muss ich ueber ' || title || ' wissen?' ELSE 'Was findet man im Wiki unter ' || ns || '?' END AS question,
            CASE WHEN five = '' THEN substr(body, 1, 200) WHEN length(five) > 300 THEN substr(five, 1, 297) || '...' ELSE five END AS answer FROM a""",
}
