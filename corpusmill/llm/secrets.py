"""Secret scan with a recursive decoding worklist.

Each text is scanned as it stands; then what is encoded in it (URL escapes and Unicode
escapes, each run by itself and all of the text in place; base64, also over several
lines; gzip, zlib, raw deflate, bzip2 or xz data inside those, all members of them) is
unwrapped, scanned and searched for further layers until nothing new appears.  Bytes that
are no text are read with what cannot be read left blank, so that text beside them is
scanned.  Compressed data that unfold to more than ``MAX_LAYER`` are scanned in windows: what
stands open at the end of one (a run, or base64 over several lines) goes whole into the
next, and ``OVERLAP`` at least; only a single run longer than ``MAX_LAYER`` itself is cut.
Where a character of a layer comes from is kept as runs, not for every character.
A layer already seen in the same text is not unwrapped again,
so data that decode to themselves end.  What is found in a layer is reported at the
place in the original text that it was decoded from.

Nulls count as empty texts; empty texts give no spans.  Rows are independent, so
repeated rows give repeated results.  A text of any length is one row and is scanned whole.
An empty table gives no rows.  Input columns named as an output are replaced.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import extend, tidy, with_columns
from .words import slices

KINDS = ("assign", "access", "hex")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join([_either("password"), _either("passwd"), _either("secret"), _either("token"), _either("api") + "_?" + _either("key")])
ASSIGN = re.compile("(" + _KEYS + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: A text without any of these, in either case, has no assignment.
_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")

_URL_RUN = re.compile(r"(?<![^\s\"<>])[^\s\"<>]*?%[0-9A-Fa-f]{2}[^\s\"<>]*")
_URL_GROUP = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_HEXED = "[0-9A-Fa-f]"
#: Escapes of one code unit, of one byte, and of one code point of any size.
_UNICODE = rf"\\u{_HEXED}{{4}}|%u{_HEXED}{{4}}|\\U{_HEXED}{{8}}|\\x{_HEXED}{{2}}|\\u\{{{_HEXED}{{1,6}}\}}"
_UNICODE_RUN = re.compile(rf"(?<!\S)\S*?(?:{_UNICODE})\S*")
_UNICODE_GROUP = re.compile(rf"(?:\\u{_HEXED}{{4}})+|(?:%u{_HEXED}{{4}})+|(?:\\U{_HEXED}{{8}})+|(?:\\x{_HEXED}{{2}})+|\\u\{{{_HEXED}{{1,6}}\}}")
_UNICODE_MARKS = ("\\u", "\\U", "\\x", "%u")
_LONG_WORD = re.compile(r"\S{16}")
_BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_BREAK = r"[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+"
_BASE64_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:" + _BREAK + r"[A-Za-z0-9+/_-]++)++={0,2}")
_BASE64_LINE = re.compile(r"(?:^|(?<=" + r"\n)|(?<=\\n))[\x20\t]*([A-Za-z0-9+/_-]+)")
_SPACES = " \n\t\r\v\f"
_BASE64_ROW = re.compile(r"[\x20\t]*+[A-Za-z0-9+/_-]++[\x20\t]*+\r?\n[\x20\t]*+")
#: Longest piece, in bytes, of what a compressed layer unfolds to that is scanned at once, and what two pieces share.
MAX_LAYER, OVERLAP = 1 << 26, 1 << 22


def _hinted(text: str) -> bool:
    low = text.lower()
    return any(k in low for k in _HINTS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the plain matches, by start and then kind."""
    found = []
    if (":" in text or "=" in text) and _hinted(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


#: How compressed data begin, and what unfolds them.
_COMPRESSED = ((b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ\x00", lzma.LZMADecompressor), (b"\x78", lambda: zlib.decompressobj(15)))


def _unfolded(data: bytes):
    """Pieces of MAX_LAYER bytes at most that compressed data unfold to, member after member; they end where the data are broken."""
    while data and (make := next((m for magic, m in _COMPRESSED if data.startswith(magic)), None)):
        machine, rest = make(), data
        try:
            while True:
                piece = machine.decompress(rest, MAX_LAYER)
                yield piece
                # zlib gives back what it has not read yet, the others keep it
                rest = getattr(machine, "unconsumed_tail", b"")
                if machine.eof or not (rest or len(piece) == MAX_LAYER):
                    break
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            return
        data = machine.unused_data if machine.eof else b""


def _raw_deflate(data: bytes):
    """Pieces that data without a head unfold to, where they are one whole stream."""
    machine, rest, size = zlib.decompressobj(-15), data, 0
    try:
        while not machine.eof and rest:
            size += len(machine.decompress(rest, MAX_LAYER))
            rest = machine.unconsumed_tail
    except zlib.error:
        return
    if not machine.eof or machine.unused_data or size < 8:
        return
    machine, rest = zlib.decompressobj(-15), data
    while not machine.eof and rest:
        yield machine.decompress(rest, MAX_LAYER)
        rest = machine.unconsumed_tail


def _open_from(text: str) -> int:
    """Where what may go on behind the text begins: its last run, with the lines of base64 that it may end."""
    at = max(len(text) - MAX_LAYER, 0)
    run = max(at, *(text.rfind(c, at) + 1 for c in _SPACES))
    while run > at:
        line = max(text.rfind("\n", at, run - 1) + 1, at)
        if not _BASE64_ROW.fullmatch(text, line, run):
            # the first of such lines may stand behind other words
            end = len(text[line:run].rstrip(_SPACES)) + line
            return max(line, *(text.rfind(c, line, end) + 1 for c in _SPACES)) if text[end:run].count("\n") else run
        run = line
    return run


def _texts(pieces):
    """Text of a stream of pieces, in windows; each takes over what the one before it leaves open, and OVERLAP at least."""
    decoder, kept = codecs.getincrementaldecoder("utf-8")("replace"), ""
    for piece in pieces:
        kept += decoder.decode(piece)
        yield kept
        kept = kept[min(_open_from(kept), max(len(kept) - OVERLAP, 0)) :]


def _windows(data: bytes):
    """Text that compressed data unfold to, in windows of MAX_LAYER bytes that overlap; nothing where they are not compressed."""
    return _texts(_unfolded(data))


def _inflate(data: bytes) -> str | None:
    """What compressed data unfold to where that is a single window."""
    found = _windows(data)
    first = next(found, None)
    return first if first is not None and next(found, None) is None else None


def _readable(data: bytes):
    """Texts held by decoded bytes: what they unfold to, or they themselves with what is no text left blank."""
    unfolded = False
    for window in _windows(data):
        unfolded = True
        yield window
    if unfolded:
        return
    if len(data) > 8 and 3 * data.count(0) > len(data):
        yield data.decode("utf-16-le" if data[1::2].count(0) >= data[::2].count(0) else "utf-16-be", "replace")
    try:
        yield data.decode("utf-8")
        return
    except UnicodeDecodeError:
        pass
    for window in _texts(_raw_deflate(data)):
        unfolded = True
        yield window
    if unfolded:
        return
    yield data.decode("utf-8", "replace")


class _Same:
    """Characters that all come from one stretch."""

    def __init__(self, start: int, end: int):
        self.stretch = start, end

    def start(self, _: int) -> int:
        return self.stretch[0]

    def end(self, _: int) -> int:
        return self.stretch[1]


class _Runs:
    """Where characters come from, run by run: place in the layer, place in the text, step, and width of each."""

    def __init__(self):
        self.at, self.origin, self.step, self.width = (array("q") for _ in range(4))

    def add(self, at: int, origin: int, step: int, width: int) -> None:
        for column, x in zip((self.at, self.origin, self.step, self.width), (at, origin, step, width), strict=True):
            column.append(x)

    def start(self, i: int) -> int:
        run = bisect.bisect_right(self.at, i) - 1
        return self.origin[run] + (i - self.at[run]) * self.step[run]

    def end(self, i: int) -> int:
        run = bisect.bisect_right(self.at, i) - 1
        return self.start(i) + self.width[run]


class _Through:
    """Places in a layer of a layer, by way of both."""

    def __init__(self, outer, inner):
        self.outer, self.inner = outer, inner

    def start(self, i: int) -> int:
        return self.outer.start(self.inner.start(i))

    def end(self, i: int) -> int:
        return self.outer.end(self.inner.end(i) - 1)


def _through(places, origin):
    """Places in the original text, from those in a layer and the layer's own."""
    if origin is None:
        return places
    if isinstance(places, _Same):
        return _Same(origin.start(places.stretch[0]), origin.end(places.stretch[1] - 1))
    return origin if isinstance(origin, _Same) else _Through(origin, places)


def _grouped(run: str, at: int, group: re.Pattern, decode) -> tuple[str, _Runs]:
    """Decode the escape groups of a run, and where its characters come from."""
    out: list[str] = []
    places, size, last = _Runs(), 0, 0
    for m in group.finditer(run):
        text, width = decode(m[0])
        if m.start() > last:
            places.add(size, at + last, 1, 1)
            size += m.start() - last
        if text:
            even = len(text) * width == m.end() - m.start()
            places.add(size, at + m.start(), width if even else 0, width if even else m.end() - m.start())
            size += len(text)
        out += [run[last : m.start()], text]
        last = m.end()
    if last < len(run):
        places.add(size, at + last, 1, 1)
    out.append(run[last:])
    return "".join(out), places


def _from_percent(group: str) -> tuple[str, int]:
    data = bytes.fromhex(group.replace("%", ""))
    return (inflated if (inflated := _inflate(data)) is not None else data.decode("utf-8", "replace")), 3


def _from_unicode(group: str) -> tuple[str, int]:
    mark = group[:2]
    if group.startswith("\\u{"):
        point = int(group[3:-1], 16)
        return (chr(point) if point < 0x110000 and not 0xD800 <= point < 0xE000 else "\ufffd"), len(group)
    digits = group.replace(mark, "")
    if mark == "\\x":
        data = bytes.fromhex(digits)
        return (inflated if (inflated := _inflate(data)) is not None else data.decode("utf-8", "replace")), 4
    if mark == "\\U":
        return bytes.fromhex(digits).decode("utf-32-be", "replace"), 10
    return bytes.fromhex(digits).decode("utf-16-be", "replace"), 6


def _line_runs(text: str):
    """(start, end, characters) of base64 over several lines.

    Words before and after may look like base64 as well: the first line may be none of it, and it ends at the
    last line, before that, or at the first that is not as long as those before it.
    """
    for m in _BASE64_LINES.finditer(text):
        lines = [(x.start(1) + m.start(), x.end(1) + m.start()) for x in _BASE64_LINE.finditer(m[0])]
        n = len(lines)
        for first in range(min(2, n - 1)):
            size = lines[first + 1][1] - lines[first + 1][0]
            even = next((i for i in range(first + 1, n) if lines[i][1] - lines[i][0] != size), n)
            for last in sorted({n, n - 1, even, min(even + 1, n)}):
                if last - first >= 2:
                    body = "".join(text[a:b] for a, b in lines[first:last])
                    if len(body) >= 16:
                        yield lines[first][0], m.end() if last == n else lines[last - 1][1], body


def layers(text: str):
    """What is encoded in a text: the decoded string, and where its characters come from."""
    if "%" in text and _URL_GROUP.search(text):
        for m in _URL_RUN.finditer(text):
            yield _grouped(m[0], m.start(), _URL_GROUP, _from_percent)
        for m in _URL_GROUP.finditer(text):
            for window in _windows(bytes.fromhex(m[0].replace("%", ""))):
                yield window, _Same(m.start(), m.end())
        yield _grouped(text, 0, _URL_GROUP, _from_percent)
    if any(mark in text for mark in _UNICODE_MARKS) and _UNICODE_GROUP.search(text):
        for m in _UNICODE_RUN.finditer(text):
            yield _grouped(m[0], m.start(), _UNICODE_GROUP, _from_unicode)
        yield _grouped(text, 0, _UNICODE_GROUP, _from_unicode)
    runs = []
    if _LONG_WORD.search(text):
        runs += [(*m.span(), m[0].rstrip("=")) for m in _BASE64_RUN.finditer(text)]
    if "\n" in text or "\\n" in text:
        runs += _line_runs(text)
    for start, end, body in runs:
        body = body.replace("-", "+").replace("_", "/")
        if len(body) % 4 == 1:
            continue
        try:
            data = base64.b64decode(body + "=" * (-len(body) % 4))
        except binascii.Error:
            continue
        for inner in _readable(data):
            yield inner, _Same(start, end)


def find_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Plain spans, and all spans with those found in decoded layers, both sorted."""
    base = base_spans(text)
    found = set(base)
    # large layers at once, so that of a stream one window is held; small ones later, so that no depth is held
    work: list[tuple] = []
    later: list[tuple] = [(text, None)]
    seen = {hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()}
    while work or later:
        if not work:
            inner, places = later.pop()
            work.append((layers(inner), places))
        if (layer := next(work[-1][0], None)) is None:
            work.pop()
            continue
        inner, places = layer
        if not inner:
            continue
        places = _through(places, work[-1][1])
        data = inner.encode("utf-8", "surrogatepass")
        key = hashlib.blake2b(f"({places.start(0)}, {places.end(0)})".encode() + data, digest_size=16).digest()
        if key in seen or hashlib.blake2b(data, digest_size=16).digest() in seen:
            continue
        seen.add(key)
        found.update((places.start(a), kind, places.end(b - 1)) for a, kind, b in base_spans(inner))
        if len(inner) > OVERLAP:
            work.append((layers(inner), places))
        else:
            later.append((inner, places))
    return base, sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch covered by spans replaced by the name of the first kind in it."""
    out: list[str] = []
    at = 0
    merged: list[list[int]] = []
    for a, k, b in spans:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([a, k, b])
    for a, k, b in merged:
        out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


ADDED = [("n_assign", T.LongType()), ("n_access", T.LongType()), ("n_hex", T.LongType()), ("base_sha256", T.StringType()), ("spans", T.StringType()), ("redacted", T.StringType())]


def scan(docs: DataFrame, text: str = "text", redact: bool = True) -> DataFrame:
    """Input columns plus counts, digest, spans and (unless ``redact`` is off) the redacted text."""
    added = ADDED if redact else ADDED[:-1]

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text):
                rows: list[tuple] = []
                for value in batch.column(text).to_pylist():
                    value = value or ""
                    base, found = find_spans(value)
                    kinds = [k for _, k, _ in base]
                    row = (kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(written(base).encode()).hexdigest(), written(found))
                    rows.append((*row, redacted(value, found) if found else value) if redact else row)
                columns = list(zip(*rows, strict=True))
                kinds_of = [pa.int64()] * 3 + [pa.string()] * (len(added) - 3)
                yield extend(batch, {n: pa.array(c, k) for (n, _), c, k in zip(added, columns, kinds_of, strict=True)})

    return docs.mapInArrow(tidy(run), with_columns(docs.schema, added))
