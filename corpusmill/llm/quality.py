"""Quality rules: base counts, and the divergence of a document from its language.

Two histograms are taken of every document: of character classes, and of the common
words of the supported languages.  Summed over all documents of a language they give
its reference.  A document long enough to tell (see ``MIN_CHARS``, ``MIN_WORDS``) fails
where the Jensen-Shannon distance of either histogram from its reference is too large for
its language and length: more than ``SPREADS`` median deviations above the median.

Null texts have no words and fail the base rule; null or other languages share one
reference.  Repeated rows count as often as they occur.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import extend, tidy, with_columns
from .words import SPACE, Words, covered, grams, mix, slices, split_bytes, split_words, sums, window_starts

# Common words of each language.
COMMON = {
    "en": "the of and to in is that it for with as was on be by are this at from or an not which but have they you were her his",
    "fr": "le la les de des du un une et en que qui pour dans par sur pas plus ne se au aux ce il elle est sont avec ou son",
    "de": "der die das und ein eine nicht mit den von zu ist auf für im dem des sich auch als an es so wie bei oder aus wird sind nach",
    "es": "el la los las de del un una y en que por para con no se al lo su es más como pero sus le ya o este ha entre",
}
LANGS = (*COMMON, "other")
WORDS = tuple(sorted({w for text in COMMON.values() for w in text.split()}))
#: Bytes that count as symbols in the base rule.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

N_CLASSES = 8
CLASS = np.full(256, 7, np.uint8)  # control characters
CLASS[0x80:] = 6  # lead bytes of other characters
for _range, _class in (((97, 123), 0), ((65, 91), 1), ((48, 58), 2)):
    CLASS[slice(*_range)] = _class
CLASS[[i for i in range(33, 127) if not chr(i).isalnum()]] = 5
CLASS[list(b".,;:!?'\"()-")] = 4
CLASS[SPACE] = 3
MIDDLE = np.zeros(256, bool)  # continuation bytes
MIDDLE[0x80:0xC0] = True

MIN_CHARS, MIN_WORDS = 400, 80
#: Limits are so many median absolute deviations, each of ``LEAST_SPREAD`` at least, above the median.
SPREADS, LEAST_SPREAD = 6, 0.004
#: Distances are counted in so many steps, by powers of two of the length; a median is taken of so many documents at least.
STEPS, SIZES, LEAST_DOCS = 2000, 32, 20

_LETTERS = np.ones(256, bool)
_LETTERS[[*range(97, 123), *range(0x80, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_table() -> tuple[np.ndarray, np.ndarray]:
    found = split_words(pa.array(WORDS), _LETTERS).hashes()
    order = np.argsort(found)
    return found[order], order


def common_words(words: Words) -> np.ndarray:
    """Counts of the common words (columns of ``WORDS``) and, last, of all others, for each row."""
    table, order = _word_table()
    lower = split_bytes(_LOWER[words.data], words.offsets, _LETTERS)
    h = lower.hashes()
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    column = np.where(table[at] == h, order[at], len(WORDS))
    n, width = len(words.offsets) - 1, len(WORDS) + 1
    return np.bincount(lower.rows() * width + column, minlength=n * width).reshape(n, width)


def char_classes(words: Words) -> np.ndarray:
    n = len(words.offsets) - 1
    row = np.repeat(np.arange(n), np.diff(words.offsets))
    shown = ~MIDDLE[words.data]
    return np.bincount(row[shown] * N_CLASSES + CLASS[words.data[shown]], minlength=n * N_CLASSES).reshape(n, N_CLASSES)


def repeated_words(words: Words, n: int = 3) -> np.ndarray:
    """For each row the words inside windows of n words that the row holds twice or more."""
    h = grams(words.hashes(), n)
    if not len(h):
        return np.zeros(len(words.first) - 1, np.int64)
    row = words.rows()[: len(h)]
    at = np.flatnonzero(window_starts(words.first, n)[: len(h)])
    key = mix(h[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return sums(covered(at[twice], n, len(words.starts)), words.first)


def repeated_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of counts from its row of the reference."""
    p = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    q = reference / np.maximum(reference.sum(1, keepdims=True), 1)
    m = (p + q) / 2
    part = lambda a: np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(1)
    return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


def _lang_index(column: pa.Array) -> np.ndarray:
    at = {k: i for i, k in enumerate(LANGS)}
    return np.array([at.get(v, len(LANGS) - 1) for v in column.to_pylist()], np.int64)


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[np.ndarray, np.ndarray]:
    """Character-class and common-word counts of each language over all documents.

    One row for each of ``LANGS`` comes to the driver, whatever the input holds.
    """
    width = N_CLASSES + len(WORDS) + 1

    def run(batches):
        total = np.zeros((len(LANGS), width), np.int64)
        for whole in batches:
            for batch in slices(whole, text):
                words = split_words(batch.column(text))
                np.add.at(total, _lang_index(batch.column(lang)), np.hstack([char_classes(words), common_words(words)]))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(LANGS))), *(pa.array(c) for c in total.T)], names=["lang", *(f"c{i}" for i in range(width))])

    parts = docs.select(lang, text).mapInArrow(tidy(run), "lang bigint, " + ", ".join(f"c{i} bigint" for i in range(width)))
    total = np.zeros((len(LANGS), width), np.int64)
    for row in parts.groupBy("lang").agg(F.array(*(F.sum(f"c{i}") for i in range(width))).alias("n")).collect():
        total[row["lang"]] = row["n"]
    return total[:, :N_CLASSES], total[:, N_CLASSES:]


def _size(counts: np.ndarray) -> np.ndarray:
    """Whole power of two of each row's sum."""
    return np.log2(np.maximum(counts.sum(1), 1)).astype(np.int64)


def _limit(counts: np.ndarray) -> float:
    """Median and median absolute deviation of counted distances, as a limit."""
    steps, total = (np.arange(STEPS) + 0.5) / STEPS, counts.sum()
    middle = steps[np.searchsorted(np.cumsum(counts), (total + 1) // 2)]
    away = np.abs(steps - middle)
    order = np.argsort(away, kind="stable")
    spread = away[order][np.searchsorted(np.cumsum(counts[order]), (total + 1) // 2)]
    return middle + SPREADS * max(spread, LEAST_SPREAD)


def distance_limits(docs: DataFrame, classes: np.ndarray, common: np.ndarray, text: str = "text", lang: str = "lang") -> np.ndarray:
    """Largest distance that passes, for each histogram, language and length, from the distances of all documents.

    Too few documents of a length take the limit of their language, too few of a language
    that of all.  Counts of at most 2 x ``LANGS`` x ``SIZES`` x ``STEPS`` cells come to the driver.
    """
    shape = (2, len(LANGS), SIZES, STEPS)

    def run(batches):
        # cells are added up over the whole task, so it gives few rows
        total = np.zeros(np.prod(shape), np.int64)
        for whole in batches:
            for batch in slices(whole, text):
                words, row_lang = split_words(batch.column(text)), _lang_index(batch.column(lang))
                for kind, (own, reference, least) in enumerate(((char_classes(words), classes, MIN_CHARS), (common_words(words), common, MIN_WORDS))):
                    step = np.minimum((js_distance(own, reference[row_lang]) * STEPS).astype(np.int64), STEPS - 1)
                    cell = np.ravel_multi_index((np.full(len(step), kind), row_lang, _size(own), step), shape)
                    np.add.at(total, cell[own.sum(1) >= least], 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["cell", "n"])

    total = np.zeros(np.prod(shape), np.int64)
    for row in docs.select(lang, text).mapInArrow(tidy(run), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[row["cell"]] = row["n"]
    total = total.reshape(shape)
    limits = np.full(shape[:3], np.inf)
    for kind, row_lang, size in np.argwhere(total.sum(3)):
        levels = (total[kind, row_lang, size], total[kind, row_lang].sum(0), total[kind].sum((0, 1)))
        limits[kind, row_lang, size] = _limit(next((x for x in levels if x.sum() >= LEAST_DOCS), levels[-1]))
    return limits


ADDED = [
    *((n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    ("base_failed", T.BooleanType()), ("kept", T.BooleanType()), ("class_distance", T.DoubleType()), ("word_distance", T.DoubleType()),
]


def judge(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Input columns plus the counts, the two distances and the verdict of every document."""
    classes, common = language_references(docs, text, lang)
    class_limits, word_limits = distance_limits(docs, classes, common, text, lang)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text):
                column = batch.column(text)
                words = split_words(column)
                n_words, repeats = words.counts, repeated_words(words)
                inside = sums(~MIDDLE[words.data] & ~SPACE[words.data], words.offsets)
                symbols = sums(SYMBOLS[words.data], words.offsets)
                lines = np.array([repeated_lines(v) if v else 0 for v in column.to_pylist()], np.int64)
                failed = (n_words < 50) | (100 * repeats > 50 * n_words)
                row_lang, own_classes, own_words = _lang_index(batch.column(lang)), char_classes(words), common_words(words)
                by_class, by_word = js_distance(own_classes, classes[row_lang]), js_distance(own_words, common[row_lang])
                strange = (own_classes.sum(1) >= MIN_CHARS) & (by_class > class_limits[row_lang, _size(own_classes)])
                strange |= (own_words.sum(1) >= MIN_WORDS) & (by_word > word_limits[row_lang, _size(own_words)])
                found = (n_words, inside, symbols, lines, repeats, failed, ~failed & ~strange, by_class, by_word)
                yield extend(batch, {n: pa.array(v) for (n, _), v in zip(ADDED, found, strict=True)})

    return docs.mapInArrow(tidy(run), with_columns(docs.schema, ADDED))
