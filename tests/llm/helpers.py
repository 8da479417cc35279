"""Small tables with everything that is odd, and plain versions of what the operators compute."""

from __future__ import annotations

import random
from itertools import combinations

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)


def odd_rows():
    """NULLs everywhere, empty and blank texts, repeats, ties and a very long text."""
    long_text = " ".join(f"w{k % 977}" for k in range(30_000))
    return [
        (1, "The quick brown fox", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, "b"),
        (4, " \t\n ", "fr", None),
        (None, "The quick brown fox", "en", "b"),
        (None, None, None, None),
        (5, "THE QUICK BROWN FOX", "de", "b"),
        (5, "THE QUICK BROWN FOX", "de", "b"),
        (6, long_text, "en", "c"),
        (7, long_text, None, "c"),
        (8, "x", "en", "a"),
        (9, "é ▁ 漢字 \u0000 end", "fr", "a"),
    ]


def words(text, folded=False):
    raw = (text or "").encode()
    return (raw.lower() if folded else raw).split()


def shingles(text, size):
    w = words(text, folded=True)
    if not w:
        return frozenset()
    size = min(size, len(w))
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1))


def near_components(rows, size, percent):
    """doc_id to the smallest id reachable, by testing every pair."""
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def near_family(seed=3, members=60):
    """Texts that differ from one another by a few words, some just above and some just below the limit."""
    draw = random.Random(seed)
    base = [f"t{draw.randrange(500)}" for _ in range(80)]
    rows = []
    for i in range(members):
        text = list(base)
        for _ in range(draw.randrange(0, 9)):
            text[draw.randrange(len(text))] = f"u{draw.randrange(10_000)}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(f"v{draw.randrange(3000)}" for _ in range(60))) for i in range(30)]
    return rows
