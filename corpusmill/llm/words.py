"""Vectorised word handling for Arrow batches.

A word is a run of bytes outside space and \\x09-\\x0D of the UTF-8 text, which
equals the pattern ``[^\\x20\\x09-\\x0D]+`` on code points.  Everything here works
on one slice of a batch at a time, so memory follows the slice, not the partition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"

_STEP = np.uint64(0xD6E8FEB86659FD93)
_KEYS = (0x9E3779B97F4A7C15, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_NEAR = 64  # places of a word whose byte values are kept in a table


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 21):
    """Cut a batch into runs of rows holding at most ``limit`` bytes of text (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    at, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > at and total + size > limit:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += size
    yield batch.slice(at, n - at)


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche the bits of an uint64 array."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _value(place: np.ndarray, byte: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit value of a byte at a place of its word."""
    return mix(((place.astype(np.uint64) << np.uint64(8)) | byte) * _STEP + np.uint64((_KEYS[0] * (2 * seed + 1)) & (1 << 64) - 1))


_tables: dict[int, np.ndarray] = {}


def _near(seed: int) -> np.ndarray:
    if seed not in _tables:
        every = np.arange(_NEAR << 8)
        _tables[seed] = _value(every >> 8, (every & 255).astype(np.uint8), seed)
    return _tables[seed]


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string array and the row offsets into them; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, "")
    array = array.cast(pa.large_string())
    n = len(array)
    if not n or array.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + n + 1]
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of a slice: byte spans, and for each row the range of its words."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # row i owns words first[i]:first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, ends: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes (up to other ends, where given).

        It sums a value drawn for every byte and place, so no structure of the letters cancels out.
        """
        data = self.data
        ends = self.ends if ends is None else ends
        n = len(data)
        total = np.zeros(n + 1, np.uint64)
        if n:
            place = np.zeros(n, np.int64)
            place[self.starts] = self.starts
            place = np.arange(n) - np.maximum.accumulate(place)
            value = _near(seed)[(np.minimum(place, _NEAR - 1) << 8) | data]
            far = np.flatnonzero(place >= _NEAR)
            if len(far):
                value[far] = _value(place[far], data[far], seed)
            np.cumsum(value, out=total[1:])
        return mix(total[ends] - total[self.starts] + (ends - self.starts).astype(np.uint64) * _STEP)

    def spelled(self, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the words (of those kept, where given), one space after each, and where each begins, with the end last."""
        starts, ends = (self.starts, self.ends) if kept is None else (self.starts[kept], self.ends[kept])
        size = ends - starts
        at = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.full(int(at[-1]), 0x20, np.uint8)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(at[:-1], size) + step] = self.data[np.repeat(starts, size) + step]
        return out, at


def split_words(array: pa.Array, space: np.ndarray = SPACE) -> Words:
    """Find the words of each row; rows never share a word."""
    data, offsets = text_bytes(array)
    return split_bytes(data, offsets, space)


def split_bytes(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    inside = ~space[data]
    begin, end = inside.copy(), inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        begin[heads] = inside[heads]
        tails = offsets[1:][offsets[1:] > 0] - 1
        end[tails] = inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def grams(hashes: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions are left out.

    Halves are joined and mixed level by level, so runs that are built alike do not cancel out.
    Positions whose window crosses a row's end are the caller's to mask.
    """
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    key = np.uint64(_KEYS[1 + which])

    def join(a, b):
        return mix((a ^ key) * _STEP + b)

    have, width, out, done = hashes, 1, None, 0
    while True:
        if n & width:
            size = len(hashes) - done - width + 1
            out = have[:size] if out is None else join(out[:size], have[done : done + size])
            done += width
        if done == n:
            return mix(out[: len(hashes) - n + 1] ^ key)
        size = len(have) - width
        have = join(have[:size], have[width : width + size])
        width *= 2


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Mask over word positions: a window of n words from here stays inside its row."""
    counts = np.diff(first)
    room = np.repeat(first[1:], counts) - np.arange(first[0], first[-1])
    return room >= n


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Mask of the positions inside any of the windows of n positions from ``starts``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + n, size), -1)
    return np.cumsum(change[:-1]) > 0


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values between consecutive offsets."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
