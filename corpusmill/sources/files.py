"""Files as DataFrames: texts with sidecars and front matter, JSON lines, manifests, results.

Fetching over the network, document and image parsers and model services are outside of
this library; what they deliver is read here.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids
from ..operators.markup import front_matter_field, split_front_matter
from ..operators.pages import media_type

CODECS = ("utf-8", "cp1252", "latin-1")


@F.pandas_udf(T.StringType())
def decoded(content: pd.Series) -> pd.Series:
    """Text by the first codec that fits."""

    def text(data: bytes | None) -> str | None:
        for codec in CODECS if data is not None else ():
            try:
                return data.decode(codec)
            except UnicodeDecodeError:
                pass
        return None

    return content.map(text)


def stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def text_files(spark: SparkSession, path: str, glob: str = "*.{txt,md}") -> DataFrame:
    """(path, name, text) of whole files below a folder."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return raw.select("path", stem(F.col("path")).alias("name"), decoded("content").alias("text"), F.md5("content").alias("md5"), "length")


def documents(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """Files with front matter: id (page, media, else file), collection, fields and body; empty ones left out."""
    block, body = split_front_matter(F.col("text"))
    field = lambda n: front_matter_field(F.col("block"), n)
    rows = text_files(spark, path).withColumns({"block": block, "body": body})
    return rows.select(F.coalesce(field("page_id"), field("media_id"), "name").alias("doc_id"), F.lit(collection).alias("collection"), field("title").alias("title"), field("content_type").alias("content_type"), field("access_level").alias("access_level"), field("last_modified").alias("last_modified"), "body", "path").where("trim(body) <> '' or title is not null")


def collection(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Texts of a folder by name; with a limit only so many files are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,md}").load(path).select("path").orderBy("path")
    whole = text_files(spark, path)
    return whole if limit is None else whole.join(F.broadcast(files.limit(limit)), "path", "left_semi")


def sidecars(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """Rows of ``<name>_<kind>.json`` files by the name; bad files are skipped."""
    rows = spark.read.schema(schema).option("multiLine", "true").option("mode", "DROPMALFORMED").option("pathGlobFilter", f"*_{kind}.json").json(path)
    return rows.withColumn("name", F.regexp_replace(stem(F.col("_metadata.file_path")), f"_{kind}$", ""))


def media_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, media_id, extension, size, type) of files below a folder; nothing of them is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    name, ext = F.substring_index("path", "/", -1), ids.extension(F.substring_index("path", "/", -1))
    below = F.translate(F.regexp_replace("path", "^.*?" + path.rstrip("/").split("/")[-1] + "/", ""), "/", ":")
    return files.select("path", below.alias("media_id"), name.alias("name"), ext.alias("extension"), F.col("length").alias("size"), media_type(ext).alias("type"))


def backlinks(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, linked_from) of files that hold a list, or an object with a page id and a list; bad files are skipped."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    whole = F.from_json("value", "page_id string, backlinks array<string>")
    found = raw.select(F.trim("value").startswith("[").alias("plain"), F.from_json("value", "array<string>").alias("several"), whole.alias("one"), F.regexp_replace(stem(F.col("_metadata.file_path")), "_backlinks$", "").alias("name"))
    rows = found.select(F.coalesce(F.nullif(F.when(~F.col("plain"), F.col("one.page_id")), F.lit("")), F.translate("name", "_", ":")).alias("page_id"), F.when(F.col("plain"), F.col("several")).otherwise(F.coalesce("one.backlinks", F.array().cast("array<string>"))).alias("linked_from"), F.when(F.col("plain"), F.col("several").isNotNull()).otherwise(F.col("one.page_id").isNotNull() | F.col("one.backlinks").isNotNull()).alias("sound"))
    return rows.where("sound").drop("sound")


def media_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(media_id, last_modified, author) of ``*_info.json``; Unix revisions become ISO times."""
    rows = sidecars(spark, path, "info", "id string, original_metadata struct<revision: string, author: string>").where("coalesce(id, '') <> ''")
    at = F.timestamp_seconds(F.col("original_metadata.revision").try_cast("long"))
    return rows.select(F.col("id").alias("media_id"), F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit("")).alias("last_modified"), F.coalesce("original_metadata.author", F.lit("")).alias("author"))


def media_usage(spark: SparkSession, path: str) -> DataFrame:
    """(media_id, linked_from) of a usage index; entries without a list are left out."""
    raw = spark.read.text(path, wholetext=True)
    index = F.from_json("value", "media_usage map<string, struct<referenced_by: array<string>>>")
    return raw.select(F.explode(index["media_usage"]).alias("media_id", "x")).select("media_id", F.col("x.referenced_by").alias("linked_from")).where("linked_from is not null")


def newest_path(spark: SparkSession, base: str, prefix: str = "") -> str | None:
    """The entry of a folder whose name sorts last; names end in their time."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return None
    names = sorted(s.getPath().getName() for s in system.listStatus(path))
    names = [n for n in names if n.startswith(prefix)]
    return f"{base.rstrip('/')}/{names[-1]}" if names else None


def evaluation_corpus(docs: DataFrame, least: int = 50) -> DataFrame:
    """Without images and short bodies."""
    return docs.where(~F.lower("path").rlike(r"\.(png|jpe?g|gif|svg|webp)(\.md)?$") & (F.length(F.trim("body")) >= least))


def with_sidecar(pages: DataFrame, side: DataFrame) -> DataFrame:
    """Left join with sidecar rows (name, id, ...); the id stated there wins."""
    return pages.join(side, "name", "left").withColumn("page_id", F.coalesce("id", ids.file_to_page(F.col("name"))))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank and malformed ones are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each JSON file, with the file's stem."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "DROPMALFORMED").json(path).withColumn("name", stem(F.col("_metadata.file_path")))


def latest(rows: DataFrame, run: str = "run_ts") -> DataFrame:
    """Rows of the latest run; runs sort as text."""
    return rows.join(F.broadcast(rows.agg(F.max(run).alias(run))), run, "left_semi")


def cache_index(files: DataFrame) -> DataFrame:
    """Newest archived copy of each media file (media_id, fetch_id, ...)."""
    from pyspark.sql import Window

    order = Window.partitionBy("media_id").orderBy(F.desc("fetch_id"))
    return files.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")


def normalised_records(records: DataFrame) -> DataFrame:
    """(id, vector, payload) of embedded records in either of their two shapes; ids from the text where none is given."""
    return records.select(F.coalesce(F.col("id"), F.md5("text")).alias("id"), F.coalesce("vector", "embedding").alias("vector"), F.coalesce("payload", "metadata").alias("payload"))


def invalid_vectors(records: DataFrame, dimension: int) -> DataFrame:
    return records.where(F.col("vector").isNull() | (F.size("vector") != dimension))


def write_markdown(docs: DataFrame, path: str) -> None:
    """Front matter and body of each document as a text row, by collection."""
    docs.select("collection", "content").write.partitionBy("collection").mode("overwrite").text(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def upsert_points(spark: SparkSession, points: DataFrame, path: str, recreate: bool = False) -> None:
    """Keyed overwrite of a collection of points: into a new folder version, read by the last one."""
    target = f"{path}/version={spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]}"
    if not recreate:
        try:
            old = latest(spark.read.parquet(path), "version").drop("version")
            points = points.unionByName(old.join(points.select("id"), "id", "left_anti"))
        except Exception as error:  # no collection yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
    points.write.parquet(target)


def checksums_differ(here: DataFrame, there: DataFrame) -> DataFrame:
    """(name, state) of files whose digests differ or that stand on one side only."""
    joined = here.select("name", F.col("md5").alias("a")).join(there.select("name", F.col("md5").alias("b")), "name", "full_outer")
    state = F.when(F.col("b").isNull(), "missing there").when(F.col("a").isNull(), "missing here").when(F.col("a") != F.col("b"), "differs")
    return joined.select("name", state.alias("state")).where("state is not null")


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """One row for each question of a ground-truth file: (query_id, question, ground_truth, sources, source_file, keywords, difficulty)."""
    shape = "id string, question string, ground_truth string, sources array<string>, source_file string, context_keywords array<string>, difficulty string"
    fields = ", ".join(": ".join(field.split(" ", 1)) for field in shape.split(", "))
    rows = spark.read.schema(f"qa_pairs array<struct<{fields}>>").option("multiLine", "true").json(path).select(F.explode("qa_pairs").alias("q"))
    return rows.select(F.col("q.id").alias("query_id"), "q.question", "q.ground_truth", F.coalesce("q.sources", F.array().cast("array<string>")).alias("sources"), "q.source_file", F.coalesce("q.context_keywords", F.array().cast("array<string>")).alias("keywords"), "q.difficulty")


def tables_agree(here: DataFrame, there: DataFrame) -> DataFrame:
    """One row: how many rows two copies of a table hold, and whether their contents are the same whatever the order."""
    sums = lambda d, side: d.agg(F.count("*").alias(f"rows_{side}"), F.coalesce(F.sum(F.xxhash64(*sorted(d.columns)).cast("decimal(38,0)")), F.lit(0)).alias(f"sum_{side}"))
    both = sums(here, "here").crossJoin(sums(there, "there"))
    return both.select("rows_here", "rows_there", ((F.col("rows_here") == F.col("rows_there")) & (F.col("sum_here") == F.col("sum_there"))).alias("same"))
