import pytest
from pyspark.sql import functions as F

from roadledger.model import DIMENSIONS
from roadledger.operators.conform import (
    apply_missing,
    at_members,
    is_known,
    missing_keys,
    resolve_fk,
    resolve_sk,
    surrogate_key,
    with_attributes,
    with_unknown,
)


def test_resolve_fk_keeps_every_row_and_survives_a_hot_key(spark):
    parents = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "p string")
    # A third of the rows share one good key, a third has none.
    keys = ["a"] * 300 + [None] * 300 + ["b", "zz", "-1"] * 100
    fact = spark.createDataFrame(list(enumerate(keys)), "id int, p string")
    got = {r["id"]: r["p"] for r in resolve_fk(fact, parents, "p").collect()}
    assert len(got) == len(keys)
    for i, k in enumerate(keys):
        assert got[i] == (k if k in ("a", "b") else "-1")


def test_resolve_fk_same_result_with_shuffle_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_resolve_fk_keeps_every_row_and_survives_a_hot_key(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_missing_list_gives_what_the_direct_check_gives(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        loads = spark.createDataFrame([("a",), ("b",), ("b",)], "load_id string")
        drivers = spark.createDataFrame([("x",), (None,)], "driver_id string")
        rows = [(i, k, d) for i, (k, d) in enumerate(
            [("a", "x")] * 200 + [("gone", "x")] * 200 + [(None, None)] * 200
            + [("b", "y"), ("a", "-1"), ("x", "a")]
        )]
        fact = spark.createDataFrame(rows, "id int, load_id string, driver_id string")
        parents = {"load_id": (loads, "load_id"), "driver_id": (drivers, "driver_id")}
        missing = missing_keys(fact, parents)
        assert {(r["key"], r["member"], r["rows"]) for r in missing.collect()} == {
            ("load_id", "gone", 200),
            ("load_id", "x", 1),
            ("driver_id", "y", 1),
            ("driver_id", "a", 1),
        }
        got = apply_missing(fact, missing, list(parents))
        want = resolve_fk(resolve_fk(fact, loads, "load_id"), drivers, "driver_id")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_missing_keys_are_spread_over_partitions(spark):
    fact = spark.range(5000).select("id", F.lit(None).cast("string").alias("p"))
    from roadledger.operators.conform import probe

    spread = fact.select(probe("p", ["id"]).alias("k")).distinct().count()
    assert spread > 900


def test_surrogate_keys_are_dense_repeatable_and_unique(spark):
    members = spark.range(5000).select(F.concat(F.lit("K"), "id").alias("k"))
    one = surrogate_key(members, "k", "sk")
    two = surrogate_key(members.repartition(13), "k", "sk")
    rows = {r["k"]: r["sk"] for r in one.collect()}
    assert sorted(rows.values()) == list(range(1, 5001))
    assert rows == {r["k"]: r["sk"] for r in two.collect()}


def test_unknown_member_and_sk_resolution(spark):
    dim = DIMENSIONS["dim_customer"]
    members = spark.createDataFrame(
        [("C1", "x", "t", 1, "f", "Active", None, True)],
        "customer_id string, customer_name string, customer_type string,"
        " credit_terms_days int, primary_freight_type string, account_status string,"
        " annual_revenue_potential decimal(12,0), is_active boolean",
    )
    full = with_unknown(surrogate_key(members, dim.key, dim.sk), dim)
    unknown = full.where("customer_sk = -1").first()
    assert unknown["customer_id"] == "-1"
    assert unknown["customer_name"] == "Unknown Customer"
    assert unknown["is_active"] is None
    fact = spark.createDataFrame(
        [("L1", "C1"), ("L2", "-1"), ("L3", None), ("L4", "zz")],
        "load_id string, customer_id string",
    )
    got = {
        r["load_id"]: r["customer_sk"]
        for r in resolve_sk(fact, full, "customer_id", "customer_sk").collect()
    }
    assert got == {"L1": 1, "L2": -1, "L3": -1, "L4": -1}


@pytest.fixture(scope="module")
def keyed(spark):
    """Sums per natural route key, of which some have no member, and the members."""
    sums = spark.createDataFrame(
        [("R1", 2, 5), ("R2", 1, None), ("GONE", 3, 7), ("-1", 4, 8), (None, 5, 9)],
        "route_sk string, loads long, gross long",
    )
    members = spark.createDataFrame(
        [("R1", "R1", "A -> B"), ("R2", "R2", None)], "route_sk string, route_id string, corridor string"
    )
    return sums, members


def test_groups_without_a_member_are_added_up_under_unknown(keyed):
    got = {tuple(r) for r in at_members(*keyed, "route_sk").collect()}
    assert got == {
        ("R1", "R1", "A -> B", 2, 5), ("R2", "R2", None, 1, None), ("-1", "-1", None, 12, 24)
    }


def test_surrogates_are_joined_as_they_are(spark):
    sums = spark.createDataFrame([(1, 2), (-1, 3)], "route_sk long, loads long")
    dim = spark.createDataFrame([(1, "R1"), (-1, "-1"), (2, "R2")], "route_sk long, route_id string")
    assert {tuple(r) for r in at_members(sums, dim, "route_sk").collect()} == {(1, 2, "R1"), (-1, 3, "-1")}
    assert sums.where(is_known(sums, "route_sk")).count() == 1


def test_rows_get_the_attributes_of_their_member_in_one_join(spark, keyed):
    sums, _ = keyed
    dim = spark.createDataFrame([("R1", "n1")], "customer_sk string, customer_name string")
    fact = sums.withColumnRenamed("route_sk", "customer_sk")
    named = with_attributes(fact, dim, "customer_sk", ["customer_name"], ["loads"])
    assert {(r["customer_sk"], r["customer_name"]) for r in named.collect()} == {
        ("R1", "n1"), *[(k, "Unknown Customer") for k in ("R2", "GONE", "-1", None)]
    }
    assert named.count() == 5 and fact.where(is_known(fact, "customer_sk")).count() == 3
    assert named._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
