"""Fill-in-middle transformation by an Aho-Corasick event scan.

One automaton finds, in one pass over a text's code points, the ASCII characters at which
units begin or end and the sentinels.  Only these events are kept: between two of them the
number of units follows from the length of the gap, so the place of the k-th unit is a
lookup among sparse events.  Units are

``lines``  ``[^\\n]*\\n|[^\\n]+``: every line feed ends one, and so does the text,
``words``  a run outside space and \\x09-\\x0D with the white space after it (at the start of a
           text, white space alone),
``chars``  every code point; the automaton then looks for sentinels alone.

Two hashes of seed and id draw the cuts, a third whether the text is transformed and a
fourth the order of its parts.  A text that is empty or holds a sentinel stays plain, so
what is transformed can be read back exactly.

A null text is empty, a null id is written as nothing behind the seed.  Repeated rows get
equal results.  Columns named as an added one give way to it, others pass through.  A text
of any length is scanned whole; a task holds one slice of a batch at a time and four bytes
for each event of one text.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import extend, tidy, with_columns
from .words import slices

#: The sentinels before prefix, suffix and middle, and each unit's class-changing characters.
SENTINELS = ("<P>", "<S>", "<M>")
CHANGES = {"lines": "\n", "words": "\t\n\v\f\r ", "chars": ""}

ADDED = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType())]


def automaton(units: str, sentinels: Sequence[str]) -> ahocorasick.Automaton:
    """Finds class-changing characters (value 0) and sentinels (value 1)."""
    made = ahocorasick.Automaton()
    for c in CHANGES[units]:
        made.add_word(c, 0)
    for s in sentinels:
        made.add_word(s, 1)
    made.make_automaton()
    return made


class Units:
    """How many units a text has and where each begins, from its events."""

    def __init__(self, text: str, found: ahocorasick.Automaton, kind: str):
        self.size, self.kind = len(text), kind
        self.ends, self.sentinel = array("I"), False
        ends = self.ends
        for at, sentinel in found.iter(text):
            if sentinel:
                self.sentinel = True
            elif kind == "words" and ends and ends[-1] == at:
                ends[-1] = at + 1  # no gap: the run of white space goes on
            else:
                ends.append(at + 1)
        last = ends[-1] if ends else 0
        self.n = self.size if kind == "chars" else len(ends) + (last < self.size)

    def start(self, k: int) -> int:
        """Code points before the k-th unit; the text's length for the number of units."""
        if self.kind == "chars":
            return k
        if k == 0:
            return 0
        return self.ends[k - 1] if k <= len(self.ends) else self.size


def draws(doc_id, seed: int) -> list[int]:
    """The first four groups of eight digits of the hash of seed and id."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]


def transformed(text: str, doc_id, units: Units, seed: int, rate: int, spm: int, sentinels: Sequence[str]) -> tuple[str, int | None, int | None, str]:
    """Form, code points of prefix and middle, and the output."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or units.sentinel or h3 % 100 >= rate:
        return "plain", None, None, text
    low, high = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.start(low), units.start(high)
    p, s, m = sentinels
    if h4 % 100 < spm:
        return "spm", a, b - a, "".join((s, text[b:], p, text[:a], m, text[a:b]))
    return "psm", a, b - a, "".join((p, text[:a], s, text[b:], m, text[a:b]))


def rebuilt(output: str, form: str, sentinels: Sequence[str] = SENTINELS) -> str:
    """The text that an output of this form was made from; its parts hold no sentinel."""
    if form == "plain":
        return output
    p, s, m = sentinels
    first, second = (s, p) if form == "spm" else (p, s)
    at, end = output.index(second), output.index(m)
    one, two, middle = output[len(first) : at], output[at + len(second) : end], output[end + len(m) :]
    return two + middle + one if form == "spm" else one + middle + two


def transform(docs: DataFrame, units: str = "lines", seed: int = 7, rate: int = 100, spm: int = 50, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """The documents with n, form, prefix_chars, middle_chars and output.

    ``rate`` of 100 texts are transformed, ``spm`` of 100 of these with the suffix first.
    """

    def run(batches):
        found = automaton(units, sentinels)
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    text = text or ""
                    scan = Units(text, found, units)
                    rows.append((scan.n, *transformed(text, doc_id, scan, seed, rate, spm, sentinels)))
                columns = zip(*rows, strict=True)
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield extend(batch, {n: pa.array(c, t) for (n, _), c, t in zip(ADDED, columns, types, strict=True)})

    return docs.mapInArrow(tidy(run), with_columns(docs.schema, ADDED))


def restore(outputs: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Outputs with the text rebuilt from output and form alone, as ``restored``; nulls are empty and plain."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "output"):
                texts = [rebuilt(o or "", f or "plain", sentinels) for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist(), strict=True)]
                yield extend(batch, {"restored": pa.array(texts, pa.string())})

    return outputs.mapInArrow(tidy(run), with_columns(outputs.schema, [("restored", T.StringType())]))


def digests(outputs: DataFrame) -> DataFrame:
    """Outputs and the texts rebuilt from them as digests."""
    found = restore(outputs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
