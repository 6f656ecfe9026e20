"""Word-level BPE encoding and decoding by a pair occurrence index.

The distinct words of a batch are laid out as one array of symbols.  An index maps
each mergeable pair to all its positions in the batch; the lowest active rank is
applied to all its positions at once, and the lists of the pairs that this makes are
updated, until no rank is active.  A word is merged once for all its occurrences.

Null texts are empty and give no ids.  Repeated rows give repeated results.  A text of
any length is one row and is encoded whole.  An empty table gives no rows.  Input columns
named as an output are replaced.
"""

from __future__ import annotations

import functools
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import extend, tidy, with_columns
from .packing import byte_alphabet
from .words import slices

CACHED = 400_000
AT_ONCE = 60_000
#: Texts of these characters are normal in form NFC, and lower-case character by character.
_PLAIN = re.compile("[\t-\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]*")
#: The pattern of words by classes of characters, and what it says of lower-case plain texts.
_GENERAL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPECIAL = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\u017f]+|[0-9]|[^\\sa-z\xdf-\xf6\xf8-\u017f0-9]+")


class WordCodec:
    """Encoder and decoder of a BPE vocabulary file whose words end in a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.path, self.library = spec["model"], path, None
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        self.tokens: list[str] = [""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in [*vocab.items(), *self.added.items()]:
            self.tokens[i] = token
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = _SPECIAL if pattern == _GENERAL else regex.compile(pattern)
        alphabet = {b: c for c, b in byte_alphabet().items()}
        self.first = np.array([vocab[alphabet[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[alphabet[b] + self.suffix] for b in range(256)], np.int64)
        self.byte_of = {c: b for b, c in alphabet.items()}
        self.size = len(self.tokens)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = self.left * self.size + self.right
        self.rank_order = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_order]
        self.words: dict[str, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_order[at], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (little-endian, 32 bits), all words at a time."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        ends = np.cumsum(sizes) - 1
        symbol = self.first[data]
        symbol[ends] = self.last[data[ends]]
        after = np.arange(1, n + 1)
        after[ends] = -1
        before = np.arange(-1, n - 1)
        before[ends[:-1] + 1] = -1
        alive, again = np.ones(n, bool), np.zeros(n, bool)

        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self.ranks(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            heads = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
            for r, part in zip(rank[heads].tolist(), np.split(at, heads[1:]), strict=True):
                if r in places:
                    places[r].append(part)
                else:
                    places[r] = [part]
                    heapq.heappush(active, r)

        add(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            at = places.pop(r)
            at = np.concatenate(at) if len(at) > 1 else at[0]
            left, right, made = int(self.left[r]), int(self.right[r]), int(self.made[r])
            at = at[alive[at] & (symbol[at] == left)]
            at = at[after[at] >= 0]
            at = at[symbol[after[at]] == right]
            if left == right and len(at) > 1:
                at = self._apart(np.unique(at), after)
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = made
            alive[gone] = False
            beyond = after[gone]
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            behind = before[at]
            behind = behind[behind >= 0]
            again[at] = True
            behind = behind[~again[behind]]
            again[at] = False
            add(np.concatenate([behind, at[inner]]))
        kept = symbol[alive].astype("<i4").tobytes()
        owner = np.repeat(np.arange(len(words)), sizes)[alive]
        cuts = (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
        return [kept[a:z] for a, z in zip(cuts, cuts[1:], strict=False)]

    @staticmethod
    def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of places of a pair of equal symbols, leftmost first those that do not overlap."""
        chosen, taken = [], -1
        for p, q in zip(at.tolist(), after[at].tolist(), strict=True):
            if p != taken:
                chosen.append(p)
                taken = q
        return np.array(chosen, np.int64)

    def split(self, text: str) -> list[str]:
        """Normalised words of a text, without added tokens."""
        if _PLAIN.fullmatch(text):
            return self.pattern.findall(text.lower())
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.byte_of[c] for c in w).decode() for w, _ in found]

    def learn(self, found: list[list[str]]) -> None:
        """Merge the words that are not at hand yet."""
        if len(self.words) > CACHED:
            self.words.clear()
        unknown = [w for w in set().union(*found) if w not in self.words]
        for i in range(0, len(unknown), AT_ONCE):
            part = unknown[i : i + AT_ONCE]
            self.words.update(zip(part, self.merge([w.encode() for w in part]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        added = {t: np.array([i], "<i4").tobytes() for t, i in self.added.items()}
        cut = [self.added_pattern.split(t) if "<|" in t else [t] for t in texts]
        found = [[None if p in added else self.split(p) for p in parts] for parts in cut]
        self.learn([ws for parts in found for ws in parts if ws])
        ids = self.words.__getitem__
        return [b"".join(added[p] if ws is None else b"".join(map(ids, ws)) for p, ws in zip(parts, own, strict=True)) for parts, own in zip(cut, found, strict=True)]

    def decode(self, ids: list[int]) -> str:
        """Tokens of the ids, joined as the library does where a vocabulary has no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec_of(path: str) -> WordCodec:
    """The codec of a file, with the words that it has met, for as long as a worker lives."""
    return WordCodec(path)


def _ids(codec: WordCodec, texts: list[str | None]) -> tuple[list[bytes], pa.Array]:
    found = codec.encode([t or "" for t in texts])
    offsets = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
    return found, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Input columns plus the ids of every text and the text that they decode to, in one pass."""

    def run(batches):
        codec = codec_of(path)
        for whole in batches:
            for batch in slices(whole, text):
                found, column = _ids(codec, batch.column(text).to_pylist())
                back = [codec.decode(np.frombuffer(f, "<i4").tolist()) for f in found]
                yield extend(batch, {ids: column, decoded: pa.array(back, pa.string())})

    return docs.mapInArrow(tidy(run), with_columns(docs.schema, [(ids, T.ArrayType(T.IntegerType())), (decoded, T.StringType())]))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Input columns plus the ids of every text."""

    def run(batches):
        codec = codec_of(path)
        for whole in batches:
            for batch in slices(whole, text):
                yield extend(batch, {ids: _ids(codec, batch.column(text).to_pylist())[1]})

    return docs.mapInArrow(tidy(run), with_columns(docs.schema, [(ids, T.ArrayType(T.IntegerType()))]))


def decode(frame: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Input columns plus the text of every list of ids (null: empty)."""

    def run(batches):
        codec = codec_of(path)
        for batch in (whole.slice(i, 500) for whole in batches for i in range(0, whole.num_rows, 500)):
            column = batch.column(ids)
            found = [codec.decode(column[i].values.to_pylist() if column[i].is_valid else []) for i in range(len(column))]
            yield extend(batch, {text: pa.array(found, pa.string())})

    return frame.mapInArrow(tidy(run), with_columns(frame.schema, [(text, T.StringType())]))
