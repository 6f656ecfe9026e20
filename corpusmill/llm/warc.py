"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing.  A record is one string (header block, payload) and the writer's line separator
is the blank line that ends a record, so every part file is a valid WARC file on any
store that Spark writes.  Of pages of equal payload the one with the largest id is a
response; the others are revisits that refer to it and carry no payload.

Reading.  Files are split at the magic line, by as many tasks as Spark gives them; the
byte offset of each piece follows from the bytes of the pieces before it.  Every piece
is a candidate record, and its header names the offset of the record after it.  In each
split the chain of successors is followed at once; between splits, pointer jumping from
the start of each file doubles the distance it has reached in every round.  Candidates
that the chain never reaches are magic inside payloads; their bytes are given back to
the record that holds them.

Null and empty html give empty payloads.  A null page id is written as no id and is
smaller than any other; rows that repeat the largest id of a payload are all responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import cut, shared_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: The base32 alphabet (RFC 4648) in place of the digits of base 32.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a string column."""
    hexed = F.sha1(payload.cast("binary"))
    fives = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*fives), DIGITS, BASE32)


#: Rows of a side that is joined by broadcast; a larger side is shuffled.
BROADCAST_ROWS = 100_000


def _meet(rows: DataFrame, few: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join wide rows with narrow ones; where these are few, without moving the wide rows."""
    few = cut(few)
    return rows.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, keys, how)


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html) plus digest, record_type and refers_to."""
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html"))).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    chosen = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("copies")).where("copies > 1")
    joined = _meet(rows, chosen, ["digest"], "left")
    revisit = (F.col("payload_bytes") >= least_bytes) & F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return joined.select(
        "page_id", "url", "digest", "payload_bytes",
        F.when(revisit, F.lit("")).otherwise(F.col("html")).alias("payload"),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("holder")).alias("refers_to"),
    )


def write(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2025-01-01T00:00:00Z") -> None:
    """Write one record for each page to WARC files under ``path``."""
    plan = plan_records(pages, least_bytes)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    url = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "_")
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(F.col("refers_to").isNotNull(), line("WARC-Refers-To", urn("refers_to"))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        F.concat(F.lit("Content-Length: "), F.octet_length("payload").cast("string"), F.lit(END)),
        "payload",
    )
    plan.select(record.alias("value")).write.option("lineSep", END).text(path)


def _header(name: str) -> Column:
    found = F.regexp_extract("header", rf"(?im)^{name}: *([^\r\n]*)", 1)
    return F.when(found == "", None).otherwise(found)


FIELDS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}


def pieces(spark: SparkSession, path: str, lean: bool) -> DataFrame:
    """What stands between magic lines, in the order of the file, with the fields of its header; written once.

    ``alone`` tells that a piece is as long as its header declares; ``lean`` leaves out the
    text of such pieces, of which the digest is kept.
    """
    end = len(END)
    raw = spark.read.option("lineSep", MAGIC).text(path).select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    numbered = raw.withColumn("number", F.monotonically_increasing_id()).withColumn("size", F.octet_length("value").cast("long"))
    numbered = numbered.withColumn("header", F.when(F.contains("value", F.lit(END)), F.substring_index("value", END, 1)))
    numbered = numbered.withColumns({"head": F.octet_length("header").cast("long") + end, "length": F.expr("try_cast(nullif(regexp_extract(header, '(?im)^Content-Length: *(\\\\d+)', 1), '') AS BIGINT)")})
    alone = F.coalesce(F.col("head") + F.col("length") + end == F.col("size"), F.lit(False))
    body = F.when(F.col("length") == 0, "").otherwise(F.expr(f"left(substr(value, length(header) + {end} + 1), length(value) - length(header) - {2 * end})"))
    full = numbered.withColumn("alone", alone).withColumn("sha1", F.when(F.col("alone"), base32_sha1(body)))
    text = F.when(F.col("alone"), F.lit(None) if lean else body).otherwise(F.col("value"))
    raw_text = F.when(F.col("alone"), F.lit(None) if lean else F.col("value")).cast("string")
    # raw is the text of such a piece with its header, which is needed only inside another record
    out = full.select("file", "split", "number", "size", "head", "length", "alone", "sha1", *(_header(h).alias(n) for n, h in FIELDS.items()), text.cast("string").alias("text"), raw_text.alias("raw"))
    target = shared_path(spark, "pieces")
    out.write.option("compression", "zstd").parquet(target)
    return spark.read.parquet(target)


def candidates(found: DataFrame) -> DataFrame:
    """Every piece with its byte offset (of the magic line before it) and, of a candidate, its successor's."""
    magic, end = len(MAGIC), len(END)
    narrow = found.select("file", "split", "number", "size", "head", "length")
    inner = Window.partitionBy("file", "split").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = narrow.withColumn("rel", F.coalesce(F.sum(F.col("size") + magic).over(inner), F.lit(0)))
    totals = narrow.groupBy("file", "split").agg(F.sum(F.col("size") + magic).alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    at = placed.join(bases, ["file", "split"]).withColumn("offset", F.col("base") + F.col("rel") - magic)
    after = F.when((F.col("offset") >= 0) & F.col("length").isNotNull(), F.col("offset") + magic + F.col("head") + F.col("length") + end)
    return at.select("file", "split", "number", "size", "offset", "head", "length", after.alias("next"))


def reachable(spots: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain from the start of each file."""
    nodes = cut(spots.where("next is not null").select("file", "split", "offset", "next"))

    def leave(pdf):
        """For each candidate of a split the first place outside its chain there."""
        pdf = pdf.sort_values("offset", ascending=False)
        exits: dict[int, int] = {}
        out = []
        for offset, after in zip(pdf["offset"].tolist(), pdf["next"].tolist(), strict=True):
            exits[offset] = exits.get(after, after)
            out.append(exits[offset])
        pdf["exit"] = out
        return pdf[["file", "split", "offset", "exit"]]

    exits = cut(nodes.groupBy("file", "split").applyInPandas(leave, "file bigint, split bigint, offset bigint, exit bigint"))
    jump = exits.select("file", "offset", F.col("exit").alias("to"))
    entries = cut(exits.where("offset = 0").select("file", "offset"))
    count = entries.count()
    while True:
        onward = entries.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset")).join(exits.select("file", "offset"), ["file", "offset"], "left_semi")
        entries = cut(entries.unionByName(onward).distinct())
        now = entries.count()
        if now == count:
            break
        count = now
        twice = jump.select("file", "offset", F.col("to").alias("mid")).join(jump.select("file", F.col("offset").alias("mid"), F.col("to").alias("far")), ["file", "mid"], "left")
        jump = cut(twice.select("file", "offset", F.coalesce("far", "mid").alias("to")))

    def walk(pdf):
        """All candidates on the chains from a split's entries."""
        after = dict(zip(pdf["offset"].tolist(), pdf["next"].tolist(), strict=True))
        reached = set()
        for start in pdf.loc[pdf["entry"], "offset"].tolist():
            while start in after and start not in reached:
                reached.add(start)
                start = after[start]
        return pdf.loc[pdf["offset"].isin(reached), ["file", "offset"]]

    marked = nodes.join(entries.withColumn("entry", F.lit(True)), ["file", "offset"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return marked.groupBy("file", "split").applyInPandas(walk, "file bigint, offset bigint")


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Every record: file (a hash of its path), offset, the header's fields, payload_bytes, sha1, payload.

    Without ``payload`` only records that magic lines cut up keep their text on the way;
    if such a record holds pieces that look whole, all texts are kept after all.
    """
    found = pieces(spark, path, lean=not payload)
    spots = cut(candidates(found))
    true = reachable(spots).withColumn("start", F.col("offset"))
    inside = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = spots.join(true, ["file", "offset"], "left").withColumn("start", F.last("start", ignorenulls=True).over(inside)).where("start is not null")
    whole = F.col("head") + F.col("length") + len(END) <= F.col("size")
    owned = cut(owned.select("file", "number", "offset", "start", "length", "head", whole.alias("whole")))
    fields = [*FIELDS, "sha1"]
    heads = owned.where("offset = start").select("file", "number", "offset", "length", "head", "whole")
    one = found.select("file", "number", *fields, *(["text"] if payload else [])).join(heads.where("whole").select("file", "number", "offset", "length"), ["file", "number"])
    one = one.select("file", "offset", *FIELDS, F.col("length").alias("payload_bytes"), "sha1", *([F.col("text").alias("payload")] if payload else [F.lit(None).cast("string").alias("payload")]))
    cut_up = cut(owned.join(heads.where("not whole").select("file", F.col("offset").alias("start")), ["file", "start"]).select("file", "number", "offset", "start", F.when(F.col("offset") == F.col("start"), F.col("length")).alias("bytes"), F.when(F.col("offset") == F.col("start"), F.col("head")).alias("from")))
    if cut_up.isEmpty():
        return one
    parts = _meet(found.select("file", "number", "alone", *FIELDS, F.coalesce("raw", F.when(~F.col("alone"), F.col("text"))).alias("value")), cut_up, ["file", "number"], "inner")
    if not payload and not parts.where("value is null").isEmpty():
        return read(spark, path).withColumn("payload", F.lit(None).cast("string"))
    first = lambda c: F.first(F.when(F.col("offset") == F.col("start"), F.col(c)), ignorenulls=True).alias(c)
    joined = parts.groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("p"), *(first(c) for c in (*FIELDS, "bytes", "from")))
    value = F.array_join(F.transform("p", lambda x: x["value"]), MAGIC)
    # the declared length, in bytes, tells where the payload ends
    many = joined.withColumn("value", value).withColumn("payload", F.expr("cast(substr(cast(value AS BINARY), cast(`from` + 1 AS INT), cast(bytes AS INT)) AS STRING)"))
    return one.unionByName(many.select("file", F.col("start").alias("offset"), *FIELDS, F.col("bytes").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("sha1"), "payload"))


def page_number(urn: str) -> Column:
    return F.expr(f"try_cast(regexp_extract({urn}, '<urn:page:(-?[0-9]+)>', 1) AS BIGINT)")


def resolved(records: DataFrame) -> DataFrame:
    """One row for each record with the size and digest of its full payload, a revisit's taken from its response."""
    rows = records.select(page_number("record_id").alias("page_id"), "record_type", page_number("refers_to").alias("refers_to"), "payload_bytes", F.col("sha1").alias("payload_digest"))
    rows = cut(rows)
    responses = rows.where("record_type = 'response'")
    held = responses.groupBy(F.col("page_id").alias("refers_to")).agg(F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"))
    revisits = rows.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to").join(held, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.select(*columns))
