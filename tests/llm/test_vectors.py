import numpy as np
import pytest
from pyspark.sql import functions as F

from roadledger.llm import columnar_topk, vp_search
from roadledger.llm.oracle import ORACLE
from roadledger.llm.queries import QUERIES
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
COLUMNS = "vec_id bigint, embedding array<float>, label int"


def asked():
    return F.col("vec_id") % 20 == 0


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], COLUMNS).withColumns(
        {"shard": F.lit("mine"), "score": F.lit(1.0), "id": F.lit(2), "q": F.lit(3)}
    )


def brute(vectors, scale=None, k=20):
    """query -> [(score, id)] over {id: vector}, sums in order of dimension."""
    def made(v):
        v = np.asarray(v, dtype=np.float32).astype(float)
        return v if scale is None else np.floor(scale * v)

    rows = {i: made(v) for i, v in vectors.items()}
    out = {}
    for q in rows:
        if q % 20 == 0:
            found = []
            for i, v in rows.items():
                if i != q and len(v) == len(rows[q]):
                    total = 0.0
                    for a, b in zip(rows[q].tolist(), v.tolist()):
                        total += a * b
                    found.append((-total, i))
            out[q] = sorted(found)[:k]
    return out


def answers(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    return out


def test_columnar_query_matches_sql(spark):
    name = "op10_columnar_topk"
    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) is None


def table_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    return {r.vec_id: r.embedding for r in rows}


def test_neighbour_query_recall_and_exact_scores(spark):
    want = brute(table_vectors(spark))
    got = answers(QUERIES["op3_vp_neighbours"](spark, SF).collect())
    assert set(got) == set(want)
    hits = [len({i for _, i in got[q]} & {i for _, i in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    exact = {q: dict((i, s) for s, i in brute_all) for q, brute_all in brute(
        table_vectors(spark), k=10**6).items()}
    assert all(s == exact[q][i] for q in got for s, i in got[q])
    assert all(len(v) == 20 and v == sorted(v) for v in got.values())


def test_factor_one_is_exact_over_several_shards(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = vp_search.nearest(
        vectors, asked(), factor=1.0, leaf=8, shard_rows=90, block_rows=7
    ).collect()
    assert answers(got) == brute(table_vectors(spark))


@pytest.mark.parametrize("dims", [1, 3, 8, 70])
def test_both_are_exact_with_ties_and_copies(spark, dims):
    rng = np.random.default_rng(dims)
    kinds = rng.integers(-2, 3, (6, dims)) / 4
    kinds[0, 0] = 0.25
    vectors = {i: kinds[rng.integers(0, 6)].tolist() for i in range(400)}
    rows = frame(spark, vectors.items())
    got = columnar_topk.top_k(rows, asked(), width=4, shard_rows=64, block_rows=8).collect()
    assert answers(got) == brute(vectors, 64)
    usable = {i: v for i, v in vectors.items() if any(v)}
    got = vp_search.nearest(
        rows, asked(), factor=1.0, leaf=4, shard_rows=64, block_rows=8
    ).collect()
    assert answers(got) == brute(usable)


def test_shards_meet_in_separate_partitions(spark):
    rng = np.random.default_rng(9)
    vectors = {i: rng.normal(size=6).tolist() for i in range(900)}
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        rows = frame(spark, vectors.items())
        got = columnar_topk.top_k(rows, asked(), shard_rows=100, block_rows=9).collect()
        assert answers(got) == brute(vectors, 64)
        got = vp_search.nearest(
            rows, asked(), factor=1.0, shard_rows=100, block_rows=9
        ).collect()
        assert answers(got) == brute(vectors)
    finally:
        spark.conf.unset(name)


def test_unusable_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [nan, 1.0]),
        (5, [inf, 1.0]), (6, [None, 1.0]), (7, [0.0, 0.0]), (None, [1.0, 1.0]),
        (8, [1.0, 0.0, 0.0]), (20, None), (40, [0.25, 0.0]), (1, [0.25, 0.5]),
    ]
    got = answers(vp_search.nearest(frame(spark, rows), asked()).collect())
    assert {q: [i for _, i in v] for q, v in got.items()} == {0: [1, 40], 40: [0, 1]}
    assert got[0][0][0] == -0.25  # of rows with one id the smallest vector
    got = answers(columnar_topk.top_k(frame(spark, rows), asked()).collect())
    assert {q: [i for _, i in v] for q, v in got.items()} == {
        0: [1, 40, 7], 40: [0, 1, 7]
    }


def test_empty_table_and_no_queries(spark):
    for rows in ([], [(1, [1.0]), (2, [2.0])]):
        assert vp_search.nearest(frame(spark, rows), asked()).count() == 0
        assert columnar_topk.top_k(frame(spark, rows), asked()).count() == 0


def test_huge_components_are_held(spark):
    got = columnar_topk.top_k(
        frame(spark, [(0, [1e30, -1e30]), (1, [1e30, 1e30])]), asked()
    ).collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 1, 0)]


def test_large_components_count_in_full(spark):
    rows = [(0, [20000.0, 1.0]), (1, [20000.0, 0.5]), (2, [1.0, 0.5]), (3, [1e10, 0.0]),
            (4, [-1e10, 0.0])]
    got = columnar_topk.top_k(frame(spark, rows), asked()).orderBy("query_id", "rank").collect()
    big = int(64 * float(np.float32(1e10)))
    assert [(r.vec_id, r.score) for r in got if r.query_id == 0] == [
        (3, 1280000 * big), (1, 1280000**2 + 64 * 32), (2, 1280000 * 64 + 64 * 32),
        (4, -1280000 * big),
    ]


def test_scores_beyond_a_bigint_are_its_limit(spark):
    rows = [(0, [1e12, 0.0]), (1, [1e12, 0.0]), (2, [1e30, 0.0]), (3, [-1e30, 0.0])]
    got = columnar_topk.top_k(frame(spark, rows), asked()).orderBy("rank").collect()
    top = 2**63 - 1
    assert [(r.vec_id, r.score) for r in got] == [(1, top), (2, top), (3, -top)]
