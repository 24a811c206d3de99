import numpy as np
import pytest
from pyspark.sql import functions as F

from roadledger.llm import hard_negatives
from roadledger.llm.oracle import ORACLE
from roadledger.llm.queries import QUERIES
from tests.compare import difference, duck

COLUMNS = "vec_id bigint, embedding array<double>, label int"
OUT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).withColumns(
        {"id": F.lit("x"), "shard": F.lit(1), "rank": F.lit(2), "anchor": F.lit(True)}
    )


def mined(spark, rows, **given):
    out = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 100 == 0, **given)
    return sorted(tuple(r[c] for c in OUT) for r in out.collect())


def brute(rows, scale=256):
    """The contract in whole numbers of any size, rows with one id reduced to the least."""
    held = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(
            x is not None and np.isfinite(x) for x in v
        ):
            held[i] = min(held.get(i, (v, label)), (v, label))
    whole = {i: ([int(np.floor(scale * x)) for x in v], c) for i, (v, c) in held.items()}
    out = []
    for a, (v, c) in whole.items():
        if a % 100:
            continue
        scores = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, k)
            for i, (w, k) in whole.items()
            if i != a and len(w) == len(v)
        )
        for p, i, _ in [s for s in scores if s[2] == c][:5]:
            window = [s for s in scores if s[2] != c and -80 * p <= -100 * s[0] <= -100 * p]
            for rank, (n, j, _) in enumerate(window[:5], 1):
                out.append((a, i, rank, j, -p, -n))
    return sorted(out)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, size):
    folder, name = f"/root/testdata/{size}", "op12_hard_negatives"
    frame = QUERIES[name](spark, folder)
    assert difference(frame, duck(folder), ORACLE[name]) is None
    assert frame.count() > 0


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 34, 35), (100, 64, 257), (67, 129, 40)])
def test_strassen_is_exact_up_to_64_bits(shape):
    rng = np.random.default_rng(sum(shape))
    m, d, n = shape
    a, b = rng.integers(-(2**20), 2**20, (m, d)), rng.integers(-(2**20), 2**20, (d, n))
    assert (hard_negatives.strassen(a, b) == a @ b).all()
    high = int(np.sqrt((2**63 - 1) // d))
    a, b = np.full((m, d), high), np.full((d, n), -high)
    assert (hard_negatives.strassen(a, b) == -d * high * high).all()


def test_many_ties_over_tiles(spark):
    rng = np.random.default_rng(3)
    kinds = rng.integers(-2, 3, (9, 40)) / 4
    rows = [
        (i, kinds[rng.integers(0, 9)].tolist(), int(rng.integers(0, 3))) for i in range(700)
    ]
    want = brute(rows)
    assert want and mined(spark, rows, shard_rows=100, block_rows=2) == want


@pytest.fixture
def apart(spark):
    """Shuffle partitions stay apart, as they do where data are large."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_tiles_meet_in_separate_partitions(spark, apart):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist(), i % 3) for i in range(2500)]
    want = brute(rows)
    assert want and mined(spark, rows, shard_rows=400, block_rows=5) == want
    assert mined(spark, rows) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 1.0], 2), (3, [0.9, 0.0], 2),
        (4, None, 2), (5, [], 2), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [None, 1.0], 2),
        (None, [1.0, 1.0], 2), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 2),
        (3, [0.85, 0.0], 2), (11, [0.5, 0.0], 2), (100, [-1.0, 0.0], 1), (12, [2.0, 0.0], 2),
        (200, [1.0], 5),
    ]
    got = mined(spark, rows)
    assert got == brute(rows)
    assert {r[3] for r in got if r[0] == 0} == {2, 3}


def test_components_beyond_64_bits(spark):
    rows = [(0, [1e13, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 3.0], 2), (3, [1e300, 0.0], 2),
            (100, [1.0, 0.25], 2), (4, [1.0, 0.5], 2)]
    got = mined(spark, rows)
    want = brute(rows)
    assert [r for r in got if r[0] == 0] == [r for r in want if r[0] == 0]
    top = 2**63 - 1
    huge = [(0, [1e300, 0.0], 1), (1, [1e300, 0.0], 1), (2, [1e200, 0.0], 2)]
    assert mined(spark, huge) == [(0, 1, 1, 2, top, top)]


def test_empty_tables_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(0, [1.0], 1), (2, [1.0], 2)]) == []
