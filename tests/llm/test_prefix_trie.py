import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roadledger.llm import prefix_trie
from roadledger.llm.queries import QUERIES

COLUMNS = "conv_id bigint, turn bigint, role string, text string"
OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
       "saved_tokens", "ends_sha256")


def conversations(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0)
            held[conv].append((key, role or "", text or ""))
    return {c: [t[1:] for t in sorted(own)] for c, own in held.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        head = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(base, [])[:head] + own[head:]
    return out


def brute(convs):
    """Nodes by their definition."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) or 1
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        saved[node] = own + sum(saved[x] for x in below)
    return sorted(
        (
            min(members[x]), len(x), min(members[x[:-1]]) if x else None, len(members[x]),
            len(children[x]), leaves[x], saved[x],
            hashlib.sha256(",".join(map(str, sorted(ends[x]))).encode()).hexdigest(),
        )
        for x in members
    )


def rows_of(frame):
    return sorted(tuple(r[c] for c in OUT) for r in frame.collect())


def nodes(spark, rows):
    frame = spark.createDataFrame(rows, COLUMNS).withColumns(
        {"depth": F.lit("x"), "n": F.lit(1), "stops": F.lit(2), "p1": F.lit(3)}
    )
    return rows_of(prefix_trie.nodes_of(prefix_trie.sequences(frame)))


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_matches_brute_force(spark, size):
    folder = f"/root/testdata/{size}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    frame = QUERIES["op13_prefix_trie"](spark, folder)
    assert frame.columns == list(OUT)
    assert {t for _, t in frame.dtypes[:-1]} == {"bigint"}
    assert rows_of(frame) == brute(rebuilt(conversations(rows)))


def test_shared_branched_and_nested_conversations(spark):
    a, b, c = ("user", "hé"), ("assistant", "yes"), ("user", "x" * 5)
    convs = [[a, b], [a, b], [a, b, c, b, c], [a, b, c, b, b], [a], [b], [a, b, c], [a, b, c]]
    convs += [[a, b, c, b, c] * 60, [a, b, c, b, c] * 60, [a, b, c, b, c] * 60 + [a]]
    rows = [
        (100 - i, t, *turn) for i, own in enumerate(convs) for t, turn in enumerate(own)
    ]
    assert nodes(spark, rows) == brute(conversations(rows))


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "a"), (1, 1, None, "b"), (1, 1, None, "b"), (1, 2, "user", None),
        (2, None, "user", "a"), (2, 1, None, "b"), (2, 2, None, None), (-3, 5, "user", "a"),
        (None, 0, "user", "a"), (4, 0, "", ""), (5, 1, None, None), (6, 0, "usera", ""),
        (7, 0, "user", "a" * 300_000), (8, 3, "z", "t"), (8, 3, "y", "t"),
    ]
    assert nodes(spark, rows) == brute(conversations(rows))


def test_many_equal_conversations_and_turnless_ones(spark):
    rows = [(i, t, "user", f"t{t}") for i in range(20_000) for t in range(2)]
    frame = spark.createDataFrame(rows, COLUMNS)
    assert rows_of(prefix_trie.nodes_of(prefix_trie.sequences(frame))) == brute(
        conversations(rows)
    )
    convs = conversations([(i, 0, "user", "x") for i in range(100, 300)])
    frame = spark.createDataFrame([(i, 0, "user", "x") for i in convs], COLUMNS)
    own = F.col("conv_id")
    found = prefix_trie.with_heads(
        prefix_trie.sequences(frame),
        own - own % 100,
        F.crc32(own.cast("string").cast("binary")) % 6,
        5,
    )
    want = brute(rebuilt(convs))
    assert rows_of(prefix_trie.nodes_of(found)) == want


def test_no_rows(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "user", "a")]) == []
