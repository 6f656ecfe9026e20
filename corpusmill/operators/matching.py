"""Matching characters of two texts: longest matching blocks, left and right of each again, in bounded cost.

Blocks are those of the standard matcher.  A block grows from the longest run of characters
that are rare in the second text (the first such run, at its first place there), so only
rare characters are looked at.  Runs of 1, 2, 4, ... characters get numbers, and two
overlapping numbers name a run of any length; a sorted search then tells for each stretch
of both texts the longest length that they share.  All runs of that length are taken in one
pass over the stretch, the gaps between them are stretches of shorter runs.  A stretch of
a small area is matched character by character.  Nothing compares all pairs of positions.
"""

from __future__ import annotations

import bisect

import numpy as np

#: From this length of the second text on, characters that make up more than one part in POPULAR of it start no block.
LONG, POPULAR = 200, 100
#: Stretches of at most so many pairs of positions are matched directly.
AREA = 4096


class _Side:
    """Positions of rare characters of a text, and how long the run of rare characters from each is."""

    def __init__(self, codes: np.ndarray, rare: np.ndarray):
        self.codes = codes
        self.at = np.flatnonzero(rare)
        breaks = np.flatnonzero(np.r_[self.at[1:] != self.at[:-1] + 1, True]) if len(self.at) else np.zeros(0, int)
        ends = self.at[breaks[np.searchsorted(breaks, np.arange(len(self.at)))]] + 1 if len(self.at) else self.at
        self.run = ends - self.at


def _common(x: str, y: str, i: int, j: int, most: int, way: int) -> int:
    """How many characters, up to ``most``, are equal from two places on (or before them): pieces are compared at once, and halved where they differ."""
    n, step = 0, 16
    while n < most:
        piece = min(step, most - n)
        if way > 0:
            same = x[i + n : i + n + piece] == y[j + n : j + n + piece]
        else:
            same = x[i - n - piece : i - n] == y[j - n - piece : j - n]
        if same:
            n, step = n + piece, 2 * step
        elif piece == 1:
            break
        else:
            most, step = n + piece - 1, piece // 2
    return n


class Blocks:
    """The rare runs of two texts, numbered by doubling."""

    def __init__(self, a: str, b: str):
        x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) for t in (a, b))
        seen, first = np.unique(y, return_inverse=True)
        number = np.searchsorted(seen, x)
        number[number == len(seen)] = 0
        known = seen[number] == x if len(seen) else np.zeros(len(x), bool)
        usable = np.ones(len(seen), bool)
        if len(y) >= LONG:
            usable = np.bincount(first, minlength=len(seen)) <= len(y) // POPULAR + 1
        self.x, self.y = a, b
        self.a = _Side(np.where(known, number, -1), known & usable[number] if len(seen) else known)
        self.b = _Side(first, usable[first])
        # numbers of runs of 2**p characters, on rare positions only
        self.levels = [(self.a.codes[self.a.at], self.b.codes[self.b.at])]

    def _level(self, p: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.levels) <= p:
            step, half = 1 << len(self.levels), 1 << (len(self.levels) - 1)
            keys = []
            for side, have in zip((self.a, self.b), self.levels[-1], strict=True):
                fits = np.flatnonzero(side.run >= step)
                key = np.full(len(side.at), -1, np.int64)
                key[fits] = (have[fits] << 32) | have[fits + half]
                keys.append(key)
            _, number = np.unique(np.concatenate(keys), return_inverse=True)
            self.levels.append((number[: len(keys[0])], number[len(keys[0]) :]))
        return self.levels[p]

    def _inside(self, which: int, own: np.ndarray, end: int, k: int) -> np.ndarray:
        """Which of some rare places begin a run of k that ends before ``end``."""
        side = (self.a, self.b)[which]
        return (side.run[own] >= k) & (side.at[own] + k <= end)

    def _fits(self, which: int, low: int, high: int, end: int, k: int) -> np.ndarray:
        own = np.arange(low, high)
        return own[self._inside(which, own, end, k)]

    def _named(self, which: int, own: np.ndarray, k: int) -> np.ndarray:
        """Names of the runs of k from some rare places: two numbers, the second of the run's end."""
        p = k.bit_length() - 1
        have = self._level(p)[which]
        return (have[own] << 32) | have[own + k - (1 << p)]

    def matched(self) -> int:
        """Characters in matching blocks."""
        total, stack = 0, [(0, len(self.x), 0, len(self.y), len(self.y) + 1)]
        while stack:
            alo, ahi, blo, bhi, below = stack.pop()
            if alo >= ahi or blo >= bhi:
                continue
            if (ahi - alo) * (bhi - blo) <= AREA:
                total += self._small(alo, ahi, blo, bhi)
                continue
            a1, a2 = np.searchsorted(self.a.at, (alo, ahi)).tolist()
            b1, b2 = np.searchsorted(self.b.at, (blo, bhi)).tolist()
            k = self._longest(a1, a2, ahi, b1, b2, bhi, below) if below > 1 else 0
            if not k:
                # without a rare run only what both begin with is a block
                total += self._grown(alo, blo, 0, alo, ahi, blo, bhi)[2]
                continue
            own, theirs = self._fits(0, a1, a2, ahi, k), self._fits(1, b1, b2, bhi, k)
            names, other = self._named(0, own, k), self._named(1, theirs, k)
            order = np.argsort(other, kind="stable")
            places, other = self.b.at[theirs[order]].tolist(), other[order]
            left, right = np.searchsorted(other, names, "left"), np.searchsorted(other, names, "right")
            hit = right > left
            i, j = alo, blo
            for at, low, high in zip(self.a.at[own[hit]].tolist(), left[hit].tolist(), right[hit].tolist(), strict=True):
                if at < i:
                    continue
                spot = bisect.bisect_left(places, j, low, high)
                if spot == high:
                    continue
                start, there, size = self._grown(at, places[spot], k, i, ahi, j, bhi)
                total += size
                stack.append((i, start, j, there, k))
                i, j = start + size, there + size
            stack.append((i, ahi, j, bhi, k))
        return total

    def _longest(self, a1: int, a2: int, ahi: int, b1: int, b2: int, bhi: int, below: int) -> int:
        """The length of the longest run of rare characters that both stretches hold, 0 without any.

        The largest power of two that they share comes first; only places of such runs can begin a longer one.
        """
        if a1 == a2 or b1 == b2:
            return 0
        top = min(int(self.a.run[a1:a2].max()), int(self.b.run[b1:b2].max()), below - 1)
        for p in range(top.bit_length() - 1, -1, -1):
            mine, theirs = self._level(p)
            x, y = self._fits(0, a1, a2, ahi, 1 << p), self._fits(1, b1, b2, bhi, 1 << p)
            if not len(x) or not len(y):
                continue
            both = np.isin(mine[x], theirs[y])
            if both.any():
                break
        else:
            return 0
        x = x[both]
        y = y[np.isin(theirs[y], mine[x])]
        low, high = 1 << p, min(2 << p, top + 1)
        while high - low > 1:
            k = (low + high) // 2
            i, j = x[self._inside(0, x, ahi, k)], y[self._inside(1, y, bhi, k)]
            same = np.isin(self._named(0, i, k), self._named(1, j, k)) if len(i) and len(j) else np.zeros(0, bool)
            low, high = (k, high) if same.any() else (low, k)
        return low

    def _grown(self, i: int, j: int, size: int, alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
        """A run with all equal characters before and after it."""
        before = _common(self.x, self.y, i, j, min(i - alo, j - blo), -1)
        after = _common(self.x, self.y, i + size, j + size, min(ahi - i, bhi - j) - size, 1)
        return i - before, j - before, before + size + after

    def _small(self, alo: int, ahi: int, blo: int, bhi: int) -> int:
        total, stack = 0, [(alo, ahi, blo, bhi)]
        codes, mine = self.b.codes, self.a.codes
        while stack:
            alo, ahi, blo, bhi = stack.pop()
            if alo >= ahi or blo >= bhi:
                continue
            a1, a2 = bisect.bisect_left(self._a_list, alo), bisect.bisect_left(self._a_list, ahi)
            b1, b2 = bisect.bisect_left(self._b_list, blo), bisect.bisect_left(self._b_list, bhi)
            spots: dict[int, list[int]] = {}
            for j in self._b_list[b1:b2]:
                spots.setdefault(int(codes[j]), []).append(j)
            best, end_i, end_j, runs, last = 0, 0, 0, {}, -2
            for i in self._a_list[a1:a2]:
                if i != last + 1:
                    runs = {}
                now = {}
                for j in spots.get(int(mine[i]), ()):
                    size = now[j] = runs.get(j - 1, 0) + 1
                    if size > best:
                        best, end_i, end_j = size, i, j
                runs, last = now, i
            if not best:
                total += self._grown(alo, blo, 0, alo, ahi, blo, bhi)[2]
                continue
            i, j, size = self._grown(end_i - best + 1, end_j - best + 1, best, alo, ahi, blo, bhi)
            total += size
            stack += [(alo, i, blo, j), (i + size, ahi, j + size, bhi)]
        return total

    @property
    def _a_list(self) -> list[int]:
        if not hasattr(self, "_lists"):
            self._lists = self.a.at.tolist(), self.b.at.tolist()
        return self._lists[0]

    @property
    def _b_list(self) -> list[int]:
        return self._lists[1] if hasattr(self, "_lists") else (self._a_list, self._lists[1])[1]


def ratio(a: str, b: str) -> float:
    """Twice the matching characters over all characters; 1 for two empty texts."""
    if a == b:
        return 1.0
    total = len(a) + len(b)
    return 2.0 * Blocks(a, b).matched() / total if a and b else 0.0
