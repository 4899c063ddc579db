"""Plain Python statements of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = SPACE_WORD.findall((text or "").translate(A_Z))
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def near_dup(rows, width, num, den):
    """rows: (id, text) -> list of (id, n, component id, kept)."""
    sets = [shingles(t, width) for _, t in rows]
    posting = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            posting[g].add(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        overlap = Counter(j for g in s for j in posting[g] if j > i)
        for j, c in overlap.items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (low.get(r) is None or d < low[r]):
            low[r] = d
    return [(d, len(s), low.get(find(i)), d == low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def exact_repeats(rows, width):
    """rows: (id, text) -> list of (id, n words, n removed, kept text)."""
    words = [SPACE_WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(rows, items, width):
    """rows: (id, text); items: (item id, text) -> (id, n words, n hit, sorted item ids)."""
    by = defaultdict(set)
    for item, text in items:
        w = SYMBOL_WORD.findall((text or "").translate(A_Z))
        for i in range(max(1, len(w) - width + 1) if w else 0):
            by[tuple(w[i:i + width])].add(item)
    widths = sorted({len(x) for x in by})
    out = []
    for d, text in rows:
        w = SYMBOL_WORD.findall((text or "").translate(A_Z))
        hit, found = [False] * len(w), set()
        for n in widths:
            for i in range(len(w) - n + 1):
                items_here = by.get(tuple(w[i:i + n]))
                if items_here:
                    found |= items_here
                    hit[i:i + n] = [True] * n
        out.append((d, len(w), sum(hit), sorted(str(x) for x in found if x is not None)))
    return out
