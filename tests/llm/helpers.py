"""Small tables with every awkward case, and brute-force answers."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, kept string, score double, n_words string, doc string"


def docs_of(spark, rows):
    """``(doc_id, text)`` with further columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "k", 0.5, "w", "d") for i, t in rows], SCHEMA)


LINE = "the same line stands in many documents"
AWKWARD = [
    (None, None),
    (None, "no id, but words enough for a line of its own"),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, f"{LINE}\nown line of four which nobody else has\n{LINE.upper()}"),
    (5, f"{LINE}\nshort"),
    (6, f"  {LINE}\t\nÉtude À la carte ünïcode — “quotes” 数学 🙂"),
    (7, f"{LINE}\nshort"),
    (7, f"{LINE}\nshort"),
    (8, "x" * 3000 + " " + "word " * 2000),
    (9, "word  two   spaces here\x1c and <|endoftext|> special don't DON'T '' 's 12345"),
    (10, "<|ENDOFTEXT|> <|startoftext|>é ≠ 1⃣ !—! Kelvin İstanbul"),
    (-5, "a\r\nb\x0bc\x0cd"),
]


def shingles(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    if len(w) < words:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1))


def near_groups(rows, words, percent):
    """Component of each id by comparing all pairs."""
    sets = defaultdict(set)
    for i, t in rows:
        sets[i].add(shingles(t, words))
    ids = sorted(sets, key=lambda i: (i is not None, i or 0))
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def alike(a, b):
        both = len(a & b)
        return a and b and 100 * both >= percent * (len(a) + len(b) - both)

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if any(alike(x, y) for x in sets[a] for y in sets[b]):
                ra, rb = root(a), root(b)
                if ids.index(ra) < ids.index(rb):
                    parent[rb] = ra
                elif ra != rb:
                    parent[ra] = rb
    return {i: root(i) for i in ids}


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def contaminated(rows, items, window=13):
    """n_words, n_hit and item names of each row, by looking everywhere."""
    windows = defaultdict(set)
    for item, text in items:
        w = _WORD.findall((text or "").translate(_LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = Counter()
    for doc_id, text in rows:
        w = _WORD.findall((text or "").translate(_LOWER))
        hit, names = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    names |= found
        out[doc_id, len(w), len(hit), ",".join(sorted(names))] += 1
    return out
