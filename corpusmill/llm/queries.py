"""The operators over the shared tables, one query each, with the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, idfile, infill, jaccard, lloyd, packing, quality, secrets, substrings, toxicity, vectors, warc
from .frames import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.resolved(warc.read(spark, path, payload=False))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents").select("doc_id", "text"), n=4, percent=85)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    found = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), redact=False).drop("text")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("text", "lang")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels"))).drop("text")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.probe_turns(spark))
    return chat.digests(chat.format_chat(turns))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "ids")
    idfile.write(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return idfile.read(spark, path)


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vectors": op1_vectors,
    "op2_substrings": op2_substrings,
    "op3_warc": op3_warc,
    "op4_packing": op4_packing,
    "op5_jaccard": op5_jaccard,
    "op6_bpe": op6_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_toxicity": op9_toxicity,
    "op10_chat_format": op10_chat_format,
    "op11_token_files": op11_token_files,
    "op12_clusters": op12_clusters,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_SQUARES = "list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))"
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
_INTEGERS = "list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))"


def _lloyd_sql(rounds: int = 3, k: int = 16) -> str:
    """Every round as two common tables: the nearest centroid of each vector, and the moved centroids."""
    steps = [
        f"""kept AS (
            SELECT vec_id, {_INTEGERS} AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        f"""m0 AS (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v FROM kept ORDER BY c LIMIT {k}
        )""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
            SELECT vec_id, any_value(kept.v) AS v,
                min({{'d': list_sum(list_transform(list_zip(kept.v, m{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'c': c}}) AS b
            FROM kept CROSS JOIN m{i} GROUP BY vec_id
        )""")
        if i < rounds:
            steps.append(f"""n{i} AS (
                SELECT c, list(CAST(floor(s / n) AS BIGINT) ORDER BY p) AS v
                FROM (SELECT b.c AS c, p, CAST(sum(x) AS DOUBLE) AS s, count(*) AS n FROM (SELECT b, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{i}) GROUP BY b.c, p)
                GROUP BY c
            )""")
            steps.append(f"m{i + 1} AS (SELECT m{i}.c, coalesce(n{i}.v, m{i}.v) AS v FROM m{i} LEFT JOIN n{i} USING (c))")
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, CAST(b.d AS BIGINT) AS distance,
            CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(m{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN m{rounds} ON m{rounds}.c = b.c
    """


ORACLE_SQL: dict[str, str] = {
    "op12_clusters": _lloyd_sql(),
    "op13_fill_in_middle": r"""
        WITH h AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS x FROM documents
        ), d AS (
            SELECT doc_id, t, u, len(u) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
                CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM h
        ), c AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d
        ), p AS (
            SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
                coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix FROM c
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
            CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM p
    """,
    "op2_substrings": f"""
        WITH words AS (
            SELECT doc_id, {_WORDS} AS ws FROM documents
        ), spots AS (
            SELECT doc_id, len(ws) AS n, generate_subscripts(ws, 1) AS p, unnest(ws) AS w, ws FROM words
        ), windows AS (
            SELECT doc_id, p, w,
                CASE WHEN p + 19 <= n THEN row_number() OVER (
                    PARTITION BY CASE WHEN p + 19 <= n THEN array_to_string(ws[p:p + 19], ' ') END ORDER BY doc_id, p) > 1
                ELSE false END AS again
            FROM spots
        ), kept AS (
            SELECT doc_id, p, w,
                max(CAST(again AS INT)) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
            FROM windows
        ), texts AS (
            SELECT doc_id, sum(gone) AS n_removed, string_agg(w, ' ' ORDER BY p) FILTER (WHERE gone = 0) AS kept FROM kept GROUP BY doc_id
        )
        SELECT words.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM words LEFT JOIN texts USING (doc_id)
    """,
    "op5_jaccard": """
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
        ), sets AS (
            SELECT DISTINCT doc_id, array_to_string(ws[p:p + 3], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS p FROM words WHERE len(ws) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        )
        SELECT documents.doc_id, coalesce(max(sizes.n), 0) AS n_shingles, min(reach.b) AS component_id
        FROM documents JOIN reach ON reach.a = documents.doc_id LEFT JOIN sizes ON sizes.doc_id = documents.doc_id
        GROUP BY documents.doc_id
    """,
    "op1_vectors": f"""
        WITH RECURSIVE sound AS (
            SELECT vec_id, label, embedding AS v, sqrt({_SQUARES}) AS n FROM embeddings
            WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND {_SQUARES} > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda x: CAST(x[1] AS DOUBLE) * CAST(x[2] AS DOUBLE))) / (a.n * b.n) >= 0.98
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = vec_id
    """,
    "op3_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder FROM pages
        )
        SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST((CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS INT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INT)) & 31 AS INT) + 1, 1)), '') AS payload_digest,
            CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> holder THEN holder END AS refers_to
        FROM p
    """,
    "op10_chat_format": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), s AS (
            SELECT *, length(text) + len(regexp_extract_all(text, '(?:\\[|<)\\\\*(?:/?(?:SYS|INST|OUT|ROLE|NAME)\\]|/?s>)'))
                + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
                    ELSE 23 + length(role) + len(regexp_extract_all(role, '(?:\\[|<)\\\\*(?:/?(?:SYS|INST|OUT|ROLE|NAME)\\]|/?s>)')) END AS chars FROM t
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM s GROUP BY conv_id
    """,
}
