import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadledger.llm import suffix_dedup
from roadledger.llm.oracle import ORACLE
from roadledger.llm.queries import QUERIES
from tests.compare import difference, duck
from tests.llm.helpers import LONG, docs


def brute(rows, least, keep="none"):
    """[(doc_id, bytes, spans, kept)] of [(doc_id, text)], by all windows."""
    order = sorted(
        range(len(rows)),
        key=lambda i: (rows[i][0] is None, rows[i][0] or 0, (rows[i][1] or "").encode()),
    )
    data = [(t or "").encode() for _, t in rows]
    starts = defaultdict(list)
    for place, i in enumerate(order):
        for a in range(len(data[i]) - least + 1):
            starts[data[i][a : a + least]].append((place, i, a))
    cover = [np.zeros(len(d), dtype=bool) for d in data]
    for own in starts.values():
        if len(own) > 1:
            for place, i, a in own if keep == "none" else own[1:]:
                cover[i][a : a + least] = True
    out = []
    for i, d in enumerate(data):
        edge = np.flatnonzero(np.diff(np.r_[0, cover[i].astype(int), 0]))
        kept = bytes(np.frombuffer(d, np.uint8)[~cover[i]])
        out.append((rows[i][0], d, list(zip(edge[::2].tolist(), edge[1::2].tolist())), kept))
    return sorted(out, key=repr)


def got(frame):
    return sorted(
        (
            (r.doc_id, (r.text or "").encode(), [(s.begin, s.end) for s in r.removed],
             bytes(r.kept))
            for r in frame.collect()
        ),
        key=repr,
    )


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [
        (r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()
    ]
    want = sorted(
        (i, len(d), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for i, d, spans, kept in brute(rows, 200)
    )
    frame = QUERIES["op11_suffix_dedup"](spark, folder)
    assert frame.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(tuple(r) for r in frame.collect()) == want
    assert sum(r[2] for r in want) > 0


def test_query_matches_sql(spark):
    folder, name = "/root/testdata/sf0.001", "op11_suffix_dedup"
    assert difference(QUERIES[name](spark, folder), duck(folder), ORACLE[name]) is None


def mixed(seed, count):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abé\0") for _ in range(rng.randint(3, 40))) for _ in range(9)]
    return ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(count)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_strings_over_few_letters(spark, keep, hot):
    rows = list(enumerate(mixed(5, 60)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"tid": F.lit("x"), "h": F.lit(1), "copies": F.lit(2), "removed": F.lit(3),
         "place": F.lit(4), "ranges": F.lit(5)}
    )
    out = suffix_dedup.without_repeats(frame, least=30, keep=keep, gram=11, hot=hot)
    assert set(out.columns) == set(frame.columns) | {"kept"}
    if keep == "none":
        assert got(out) == brute(rows, 30)
    else:  # order of equal ids does not matter here: ids are distinct
        assert got(out) == brute(rows, 30, "first")


def test_odd_texts(spark):
    body = "".join(chr(97 + i * i % 26) + str(i) for i in range(120))
    texts = [None, "", body, body, "x" * 700, "ab" * 400, body[:199], "é" * 100 + body[:99],
             LONG[:60_000], LONG[30_000:40_000] + "end", "y" + body + "y" + body, " " * 250]
    rows = list(enumerate(texts)) + [(None, body), (7, texts[7]), (7, texts[7])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(suffix_dedup.without_repeats(frame, keep="none")) == brute(rows, 200)


def test_a_text_longer_than_a_slab(spark, monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(900_000))
    rows = [(0, text), (1, text[399_900:400_300]), (2, "z" + text[799_000:899_000])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: [(s.begin, s.end) for s in r.removed] for r in
             suffix_dedup.without_repeats(frame, keep="first").collect()}
    assert found == {0: [], 1: [(0, 400)], 2: [(1, 100_001)]}
    found = {r.doc_id: [(s.begin, s.end) for s in r.removed] for r in
             suffix_dedup.without_repeats(frame, keep="none").collect()}
    assert found[0] == [(399_900, 400_300), (799_000, 899_000)]


def test_nearest_smaller_and_factors():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 400):
        place, same = rng.permutation(n), np.sort(rng.integers(0, 5, n))
        for step in (-1, 1):
            want = []
            for i in range(n):
                j = i + step
                while 0 <= j < n and same[j] == same[i] and place[j] > place[i]:
                    j += step
                want.append(j if 0 <= j < n and same[j] == same[i] else -1)
            assert suffix_dedup.nearest_smaller(place, same, step).tolist() == want


def test_empty_table(spark):
    assert suffix_dedup.without_repeats(docs(spark, [])).count() == 0
    assert suffix_dedup.without_repeats(docs(spark, [None, ""])).count() == 2
