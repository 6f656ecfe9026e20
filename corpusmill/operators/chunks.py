"""Chunking: arrays of chunks from small per-text helpers, then rows by posexplode.

A packer fills chunks with parts; the methods differ in what a part is, in what is
carried over to the next chunk, and in what happens to parts longer than a chunk.
Sizes count the characters of the parts without the joints between them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HEADER = re.compile(r"^#{1,6}\s+.+$", re.M)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_ROW = re.compile(r"\s*\|")
_RULE = re.compile(r"\s*\|[\s\-:|]+\|")
_HEADING = re.compile(r"(#{1,6}\s+.+|={2,}\s*.+\s*={2,})$")


def blocks(text: str) -> list[str]:
    return [b for b in (p.strip() for p in text.split("\n\n")) if b]


class Packer:
    """Fills chunks up to a size; ``carry`` decides what of a full chunk starts the next one."""

    def __init__(self, size: int, joint: str, carry: Callable[[list[str]], list[str]] = lambda parts: []):
        self.size, self.joint, self.carry = size, joint, carry
        self.done: list[str] = []
        self.parts: list[str] = []

    def add(self, part: str) -> None:
        if self.parts and sum(map(len, self.parts)) + len(part) > self.size:
            left = self.carry(self.parts)
            self.close()
            self.parts = left
        self.parts.append(part)

    def close(self) -> None:
        if self.parts:
            self.done.append(self.joint.join(self.parts))
        self.parts = []


def last_if(most: int, strict: bool) -> Callable[[list[str]], list[str]]:
    """Carry the last part if it is short enough."""
    return lambda parts: parts[-1:] if most > 0 and (len(parts[-1]) < most if strict else len(parts[-1]) <= most) else []


def naive(text: str, size: int = 1024, overlap: int = 150) -> list[str]:
    """Fixed windows that end after the last full stop of their second half, each stepping back by the overlap.

    A window that would step back to where it began, or before, has no end and is refused.
    """
    out, at = [], 0
    while at < len(text):
        end = at + size
        if end < len(text) and (stop := text.rfind(". ", at, end)) - at > size // 2:
            end = stop + 1
        out.append(text[at:end].strip())
        step = end - max(overlap, 0)
        if step <= at:
            raise ValueError("the overlap steps back to where the window began")
        at = step
    return out


def sentences(text: str, size: int, overlap: int) -> list[str]:
    """Packed sentences; windows where there is only one."""
    parts = _SENTENCE.split(text)
    if len(parts) < 2:
        return naive(text, size, overlap)
    packer = Packer(size, " ")
    for part in parts:
        packer.add(part)
    packer.close()
    return packer.done


def semantic(text: str, size: int = 512, overlap: int = 50, least: int = 100) -> list[str]:
    """Packed paragraphs; long ones by sentences; a short tail joins the chunk before it."""
    packer = Packer(size, "\n\n", last_if(overlap, True))
    for block in blocks(text):
        if len(block) > size:
            packer.close()
            packer.done += sentences(block, size, overlap)
        else:
            packer.add(block)
    before = len(packer.done)
    packer.close()
    if before and len(packer.done) > before and len(packer.done[-1]) < least:
        tail = packer.done.pop()
        packer.done[-1] += "\n\n" + tail
    return packer.done


def by_header(text: str, size: int = 512, overlap: int = 50, least: int = 100) -> list[str]:
    """A chunk for each headed section, the part before the first heading first; long ones by paragraphs."""
    starts = [m.start() for m in _HEADER.finditer(text)]
    if not starts:
        return semantic(text, size, overlap, least)
    edges = sorted({0, *starts, len(text)})
    out: list[str] = []
    for a, z in zip(edges, edges[1:], strict=False):
        part = text[a:z].strip()
        out += semantic(part, size, overlap, least) if len(part) > size else [part] if part else []
    return out


def _runs(lines: Iterable[str]) -> Iterable[tuple[bool, list[str]]]:
    held: list[str] = []
    kind = False
    for line in lines:
        is_row = bool(_ROW.match(line))
        if held and is_row != kind:
            yield kind, held
            held = []
        kind = is_row
        held.append(line)
    if held:
        yield kind, held


def by_table(text: str, size: int = 2048, overlap: int = 50, least: int = 100) -> list[str]:
    """Tables whole, or cut between rows with their head repeated; headings that stand alone go before the next table.

    A text of nothing but headings is one chunk, stripped as documents are when they are loaded.
    """
    out: list[str] = []
    context = ""
    for is_table, lines in _runs(text.split("\n")):
        if is_table:
            lead = context + "\n" if context else ""
            whole = lead + "\n".join(lines)
            if len(whole) <= size:
                out.append(whole)
            else:
                n = 2 if len(lines) > 1 and _RULE.match(lines[1]) else 1
                head, fixed = lines[:n], len(lead) + len("\n".join(lines[:n]))
                rows: list[str] = []
                for row in lines[n:]:
                    if rows and fixed + sum(len(r) + 1 for r in rows) + len(row) + 1 > size:
                        out.append(lead + "\n".join(head + rows))
                        rows = []
                    rows.append(row)
                if rows:
                    out.append(lead + "\n".join(head + rows))
            context = ""
            continue
        filled = [x for x in lines if x.strip()]
        heads = [x.strip() for x in filled if _HEADING.match(x.strip())]
        if filled and len(heads) == len(filled):
            context = "\n".join(heads)
        elif filled:
            context = heads[-1] if heads else context
            out += semantic("\n".join(filled).strip(), size, overlap, least)
    return out or [text.strip() or text]


def simple(text: str, size: int = 512, overlap: int = 50) -> list[str]:
    """Packed paragraphs, long ones cut after full stops; used for evaluation."""
    found = blocks(text)
    if not found:
        return []
    packer = Packer(size, "\n\n", last_if(overlap, False))
    plain = Packer(size, "\n\n")
    for block in found:
        if len(block) > size:
            packer.close()
            plain.done, plain.parts = packer.done, packer.parts
            for part in block.replace(". ", ".\n").split("\n"):
                if part.strip():
                    plain.add(part.strip())
            packer.done, packer.parts = plain.done, plain.parts
        else:
            packer.add(block)
    packer.close()
    return packer.done


def for_queries(text: str, size: int = 1000, least: int = 200) -> list[str]:
    """Paragraphs run together up to a size, joints counted; chunks shorter than ``least`` are dropped."""
    out, held = [], ""
    for block in blocks(text):
        if len(held) + len(block) > size:
            out.append(held)
            held = block
        else:
            held = f"{held}\n\n{block}" if held else block
    return [c.strip() for c in [*out, held] if len(c) >= least]


METHODS: dict[str, Callable[..., list[str]]] = {
    "semantic": semantic, "recursive_header": by_header, "naive": lambda text, size, overlap, least: naive(text, size, overlap), "table_aware": by_table, "table_row": by_table, "markdown_table": by_table,
    **dict.fromkeys(("metadata_only", "parent_context", "index_as_context_only"), lambda text, size, overlap, least: [text[:size]]),
}


@F.pandas_udf(T.ArrayType(T.StringType()))
def _chunk_texts(text: pd.Series, method: pd.Series, size: pd.Series, overlap: pd.Series, least: pd.Series) -> pd.Series:
    rows = zip(text, method, size, overlap, least, strict=True)
    return pd.Series([METHODS.get(m, semantic)(t, int(s), int(o), int(k)) if t and t.strip() else [] for t, m, s, o, k in rows])


# said not to be deterministic, so that a filter inferred from the explode does not run it twice
chunk_texts = _chunk_texts.asNondeterministic()


#: Bytes of text whose chunks are held at once, whatever Spark puts into a batch.
SLICE = 1 << 20


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Rows in order with about ``SLICE`` bytes of the text column ``at`` together, one row at least."""
    part = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return (batch.slice(low, high - low) for low, high in zip(bounds, bounds[1:], strict=False))


def exploded(docs: DataFrame, keys: list[str], text: str, function: Callable[..., list[str]], settings: tuple[str, ...] = ()) -> DataFrame:
    """(keys, chunk_index, total_chunks, chunk): a row for each chunk that ``function(text, *settings)`` gives; none for null and empty texts."""
    fields = [T.StructField("chunk_index", T.IntegerType()), T.StructField("total_chunks", T.IntegerType()), T.StructField("chunk", T.StringType())]
    rows, n = docs.select(*keys, text, *settings), len(keys)
    names = [*keys, *(f.name for f in fields)]

    def run(batches):
        for part in (part for batch in batches for part in _slices(batch, n)):
            given = (part.column(i).to_pylist() for i in range(n, part.num_columns))
            made = [function(t, *rest) if t else [] for t, *rest in zip(*given, strict=True)]
            sizes = np.array([len(m) for m in made], np.int32)
            own = pa.array(np.repeat(np.arange(len(made)), sizes))
            if len(own):
                places = np.concatenate([np.arange(size, dtype=np.int32) for size in sizes])
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(own) for i in range(n)), pa.array(places), pa.array(np.repeat(sizes, sizes)), pa.array([c for m in made for c in m], pa.string())], names=names)

    return rows.mapInArrow(run, T.StructType([rows.schema[k] for k in keys] + fields))


# Default settings by content type: method, size, overlap, least, action.
CONFIG = [
    ("DEFAULT", "semantic", 512, 50, 100, "process"),
    ("KNOWLEDGE", "recursive_header", 512, 50, 100, "process"),
    ("NEWS", "naive", 1024, 150, 100, "process"),
    ("TABLE_DATA", "table_aware", 2048, 50, 100, "process"),
    ("PORTAL", "metadata_only", 500, 0, 0, "process"),
    ("EMPTY", "semantic", 512, 50, 100, "skip"),
]


def configured(docs: DataFrame, config: list[tuple] = CONFIG) -> DataFrame:
    """Join documents with the settings of their content type, by its upper-case name, else the default."""
    rows = docs.sparkSession.createDataFrame(config, "kind string, method string, size int, overlap int, least int, action string")
    known = F.array(*(F.lit(c[0]) for c in config))
    kind = F.when(F.array_contains(known, F.upper("content_type")), F.upper("content_type")).otherwise("DEFAULT")
    return docs.withColumn("kind", F.coalesce(kind, F.lit("DEFAULT"))).join(F.broadcast(rows), "kind").drop("kind")


def prefixed(text: Column, fields: dict[str, Column]) -> Column:
    """``Name: value`` lines of the fields that are set, before the text."""
    lines = [F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"{n}: "), c)) for n, c in fields.items()]
    head = F.concat_ws("\n", *lines)
    return F.when(head == "", text).otherwise(F.concat(head, F.lit("\n\n"), text))


def chunk_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, chunk_index, total_chunks, chunk) of the documents that are not skipped."""
    by_method = lambda t, m, size, overlap, least: METHODS.get(m, semantic)(t, size, overlap, least) if t.strip() else []
    made = exploded(configured(docs).where("action <> 'skip'"), ["doc_id", "content_type"], "text", by_method, ("method", "size", "overlap", "least"))
    rows = made.select("doc_id", "content_type", "total_chunks", "chunk_index", "chunk")
    return rows.withColumn("chunk_id", F.concat(F.lit("documents_"), F.col("doc_id"), F.lit("_"), F.col("chunk_index")))


def skipped(docs: DataFrame) -> DataFrame:
    """One row: documents, and how many of them their settings process and skip."""
    skip = F.col("action") == "skip"
    return configured(docs).agg(F.count("*").alias("documents"), F.count_if(~skip).alias("processed"), F.count_if(skip).alias("skipped"))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    kind = F.coalesce(F.nullif(F.trim("content_type"), F.lit("")), F.lit("UNKNOWN"))
    n = F.length("chunk")
    return chunks.groupBy(kind.alias("content_type")).agg(F.count("*").alias("chunks"), F.count_distinct("doc_id").alias("documents"), F.round(F.avg(n), 6).alias("mean_length"), F.min(n).cast("long").alias("min_length"), F.max(n).cast("long").alias("max_length"), F.sum(n).alias("total_length"))


def embedding_usage(chunks: DataFrame, per_thousand: float = 0.00013, batch: int = 20) -> DataFrame:
    """Tokens (four characters each), requests and cost of embedding the chunks."""
    tokens = F.sum(F.ceil(F.length("chunk") / 4))
    return chunks.agg(tokens.alias("tokens"), F.ceil(F.count("*") / batch).alias("requests"), F.round(tokens / 1000 * per_thousand, 6).alias("cost"))
