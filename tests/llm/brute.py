"""Plain-Python versions of the operators, for small fixtures."""

from __future__ import annotations

import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k):
    w = words(text)
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def similar(a, b, percent):
    shared = len(a & b)
    return bool(a and b) and 100 * shared >= percent * (len(a) + len(b) - shared)


def components(rows, k, percent):
    """[(doc_id, n_shingles, component_id)] of [(doc_id, text)], all pairs compared."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j], percent):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in least[root(i)] if x is not None]
        out.append((d, len(sets[i]), min(known) if known else d))
    return out


def kept_lines(rows, k=5, percent=80, min_words=1):
    """[(doc_id, text)] without later similar lines; rows are in order of doc_id, None first."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    lines = []
    for i in order:
        for n, line in enumerate((rows[i][1] or "").split("\n")):
            lines.append((i, n, line, shingles(line, k) if len(words(line)) >= min_words else frozenset()))
    gone = set()
    for x, (i, n, _, s) in enumerate(lines):
        for j, m, _, t in lines[:x]:
            if (rows[j][0], m) != (rows[i][0], n) and similar(s, t, percent):
                gone.add((i, n))
                break
    out = []
    for i, (d, text) in enumerate(rows):
        left = [line for j, n, line, _ in lines if j == i and (i, n) not in gone]
        out.append((d, text if text is None else "\n".join(left)))
    return out


def cut_passages(texts, length, n_words):
    """Texts without strings of ``length`` bytes, or of ``n_words`` words, that start more than once; whole characters."""
    raws = [(t or "").encode() for t in texts]
    split = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)] for raw in raws]
    at = [[(i, i + length) for i in range(len(raw) - length + 1)] + [(s[i][0], s[i + n_words - 1][1]) for i in range(len(s) - n_words + 1)]
          for raw, s in zip(raws, split)]
    names = [[raw[a:b] for a, b in spans[:max(0, len(raw) - length + 1)]] + [tuple(raw[a:b] for a, b in s[i:i + n_words]) for i in range(len(s) - n_words + 1)]
             for raw, s, spans in zip(raws, split, at)]
    seen = defaultdict(int)
    for listed in names:
        for name in listed:
            seen[name] += 1
    out = []
    for raw, s, spans, listed in zip(raws, split, at, names):
        gone = [raws.count(raw) > 1 and (len(raw) >= length or len(s) >= n_words)] * len(raw)
        for (a, b), name in zip(spans, listed):
            if seen[name] > 1:
                gone[a:b] = [True] * (b - a)
        kept, part = [], bytearray()
        for byte, g in zip([*raw, 0], [*gone, True]):
            if g:
                kept.append(bytes(part).decode("utf-8", "ignore"))
                part = bytearray()
            else:
                part.append(byte)
        out.append("".join(kept))
    return out


def cut_repeats(texts, length):
    """[(kept bytes, removed, spans)] of texts without the strings that start more than once."""
    raws = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for raw in raws:
        for i in range(len(raw) - length + 1):
            seen[raw[i:i + length]] += 1
    out = []
    for raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((bytes(b for b, g in zip(raw, gone) if not g), sum(gone), spans))
    return out
