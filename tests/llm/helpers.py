"""Small tables and brute-force versions shared by these tests."""

import itertools
from collections import defaultdict

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977}x{i // 977}" for i in range(30_000))


def docs(spark, texts, first=0, lang="en", source="s0"):
    rows = [
        (first + i, t, lang, source, None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def words(count, start=0):
    return " ".join(f"w{start + i}" for i in range(count))


def shingles(text):
    w = (text or "").lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def similar_pairs(sets, threshold=0.8):
    """Pairs of keys whose non-empty sets reach the threshold, by an inverted index."""
    owners = defaultdict(list)
    for key, own in sets.items():
        for gram in own:
            owners[gram].append(key)
    both = defaultdict(int)
    for keys in owners.values():
        for a, b in itertools.combinations(keys, 2):
            both[a, b] += 1
    return {
        p
        for p, n in both.items()
        if n / (len(sets[p[0]]) + len(sets[p[1]]) - n) >= threshold
    }


def roots(keys, pairs):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}
