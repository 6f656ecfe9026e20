"""Chat formatting by columnar byte assembly.

A conversation becomes one string: each turn is a header, the escaped text and a
footer.  For a batch of turns the lengths of all segments are computed, summed to
offsets, and headers and contents are scattered into one buffer that becomes the
Arrow string column without further copies.

Control strings inside texts are escaped by a backslash after their first character
(one more where backslashes already stand there), which :func:`unescape` takes away.

Nulls: a null text is empty, a null role is the empty role, a null conversation id is
a conversation of its own; turns are in the order of ``turn`` (nulls first), then role
and text, so ties and repeated rows have one order.  Empty input gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import tidy
from .words import text_bytes

#: role -> header and footer; any other role is written into a general header.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", "</s>")}
OTHER_HEAD, OTHER_NAME, OTHER_FOOT = "[ROLE] ", " [NAME] ", " [/ROLE]"

_ESCAPE = r"(\[|<)(\\*)(/?(?:SYS|INST|OUT|ROLE|NAME)\]|/?s>)"
_UNESCAPE = re.compile(r"([\[<])\\(\\*/?(?:(?:SYS|INST|OUT|ROLE|NAME)\]|s>))")
_TURN = re.compile(r"\[(SYS|INST|OUT|ROLE)\] (.*?)(?: \[/(?:SYS|INST|ROLE)\]|</s>)", re.S)
_ROLE_OF = {"SYS": "system", "INST": "user", "OUT": "assistant"}

FORMATTED = "conv_id bigint, n_turns bigint, formatted string, loss_mask array<struct<start:bigint,end:bigint>>"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, _ESCAPE, r"\1\\\2\3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def assemble(roles: list[str], texts: pa.Array, bounds: np.ndarray) -> tuple[pa.Array, list[list[dict]]]:
    """Format conversations whose turns are rows ``bounds[i]:bounds[i + 1]``; also their loss masks in code points."""
    texts = escape(pc.fill_null(texts, "").cast(pa.large_string()))
    content, content_at = text_bytes(texts)
    kinds = sorted(set(roles))
    name = lambda r: escape(pa.array([r], pa.large_string()))[0].as_py()
    marks = [MARKS.get(r, (OTHER_HEAD + name(r) + OTHER_NAME, OTHER_FOOT)) for r in kinds]
    marks_bytes = [m.encode() for pair in marks for m in pair]
    mark_at = np.concatenate([[0], np.cumsum([len(m) for m in marks_bytes])]).astype(np.int64)
    mark_data = np.frombuffer(b"".join(marks_bytes), np.uint8)
    code = np.searchsorted(np.array(kinds, object), np.array(roles, object)) if kinds else np.zeros(0, np.int64)

    # segments of each turn: header, content, footer
    lengths = np.empty((len(roles), 3), np.int64)
    lengths[:, 0] = np.diff(mark_at)[2 * code]
    lengths[:, 1] = np.diff(content_at)
    lengths[:, 2] = np.diff(mark_at)[2 * code + 1]
    place = np.concatenate([[0], np.cumsum(lengths.ravel())])
    out = np.empty(place[-1], np.uint8)
    for k, (source, source_at) in enumerate(((mark_data, mark_at[2 * code]), (content, content_at[:-1]), (mark_data, mark_at[2 * code + 1]))):
        size, target = lengths[:, k], place[k:-1:3]
        run = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(run, size)
        out[np.repeat(target, size) + step] = source[np.repeat(source_at, size) + step]
    ends = place[3 * bounds]
    buffer = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out))

    chars = np.empty_like(lengths)
    mark_chars = np.array([len(m) for pair in marks for m in pair] or [0])
    chars[:, 0], chars[:, 2] = mark_chars[2 * code], mark_chars[2 * code + 1]
    chars[:, 1] = np.asarray(pc.utf8_length(texts), np.int64)
    char_at = np.concatenate([[0], np.cumsum(chars.ravel())])
    masks = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        masks.append([{"start": int(char_at[3 * i + 1] - char_at[3 * a]), "end": int(char_at[3 * i + 2] - char_at[3 * a])} for i in range(a, b) if roles[i] == "assistant"])
    return buffer, masks


def format_chat(turns: DataFrame) -> DataFrame:
    """One row for each conversation: its formatted text and the loss mask (spans of assistant texts, code points).

    Conversations are hashed to partitions and sorted there, so a task streams through
    them; it holds one batch and the conversation that crosses its end.
    """
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id")
            last = conv[batch.num_rows - 1]
            cutoff = batch.num_rows
            while cutoff and conv[cutoff - 1] == last if last.is_valid else cutoff and not conv[cutoff - 1].is_valid:
                cutoff -= 1
            if cutoff:
                yield from whole([*held, batch.slice(0, cutoff)])
                held = [batch.slice(cutoff)]
            elif held and held[-1].column("conv_id")[0] != last and (held[-1].column("conv_id")[0].is_valid or last.is_valid):
                yield from whole(held)
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield from whole(held)

    def whole(parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).combine_chunks()
        conv = table["conv_id"].combine_chunks()
        ids = np.asarray(pc.fill_null(conv, 0), np.int64)
        null = np.asarray(pc.is_null(conv))
        new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])])
        bounds = np.concatenate([np.flatnonzero(new), [len(ids)]]).astype(np.int64)
        texts, masks = assemble(table["role"].to_pylist(), table["text"].combine_chunks(), bounds)
        keys = conv.take(pa.array(bounds[:-1]))
        mask_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(bounds)), texts.cast(pa.string()), pa.array(masks, mask_type)], names=["conv_id", "n_turns", "formatted", "loss_mask"])

    return rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(tidy(run), FORMATTED)


def read_back(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out = []
    for m in _TURN.finditer(text):
        kind, body = m.groups()
        if kind == "ROLE":
            role, _, body = body.partition(OTHER_NAME)
            out.append((unescape(role), unescape(body)))
        else:
            out.append((_ROLE_OF[kind], unescape(body)))
    return out


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when read back: turns and loss text as digests."""

    def run(batches):
        for batch in batches:
            rows = []
            for conv, text, mask in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist(), batch.column("loss_mask").to_pylist(), strict=True):
                turns = read_back(text)
                all_turns = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                rows.append((conv, len(turns), all_turns, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [c.split()[0] for c in DIGESTS.split(", ")]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return formatted.mapInArrow(tidy(run), DIGESTS)


def probe_turns(spark) -> DataFrame:
    """Conversation -1, whose texts hold the control strings themselves."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")


