"""Plain versions of the operators for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(rows, n=20):
    """{row number: (words, kept words)}; rows are (id, text) in the order that decides."""
    seen, out = set(), {}
    for number, (_, text) in enumerate(rows):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            if gram in seen:
                gone.update(range(i, i + n))
            seen.add(gram)
        out[number] = (words, [w for i, w in enumerate(words) if i not in gone])
    return out


def shingles(text, n):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def components(rows, n, percent):
    """{id: least id reachable} of (id, text) rows."""
    rows = [(i, shingles(t, n)) for i, t in rows if i is not None]
    up = {i: i for i, _ in rows}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, x in rows:
        for j, y in rows:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return {i: find(i) for i in up}


KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")
VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
UPPER = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def _run(text, at, allowed):
    end = at
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


def _fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _assignment(text, low, at):
    """End of an assignment that begins here and where its value begins, or nothing."""
    key = next((k for k in KEYS if low.startswith(k, at)), None)
    if key is None:
        return None
    # an optional quote, spaces, one mark, spaces, an optional quote; each as long as it can be
    i = at + len(key)
    i += i < len(text) and text[i] in "\"'"
    i = _run(text, i, " ")
    if i >= len(text) or text[i] not in ":=":
        return None
    i = _run(text, i + 1, " ")
    i += i < len(text) and text[i] in "\"'"
    end = _run(text, i, VALUE)
    return (end, i) if end > i else None


def secrets(text):
    """Base spans by walking the text: (start, kind, end)."""
    found, low = [], _fold(text)
    i = 0
    while i < len(text):
        hit = _assignment(text, low, i)
        if hit:
            if hit[0] - hit[1] >= 12:
                found.append((i, 0, hit[0]))
            i = hit[0]
        else:
            i += 1
    i = 0
    while i < len(text):
        end = _run(text, i + 4, UPPER) if text.startswith("AKIA", i) else i
        if end > i + 4:
            if end - i >= 18:
                found.append((i, 1, end))
            i = end
        else:
            i += 1
    i = 0
    while i < len(text):
        end = _run(text, i, set("0123456789abcdef"))
        if end - i >= 16:
            found.append((i, 2, end))
        i = max(end, i + 1)
    return sorted(found)
