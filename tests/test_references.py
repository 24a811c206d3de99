"""References are checked without shuffling wide rows; what is parsed is parsed once."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from roadledger.model import SOURCES
from roadledger.operators import quality
from roadledger.operators.conform import resolve_fk, resolve_sk
from roadledger.plans.silver import check_references
from roadledger.sources.sample import SCHEMAS


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def threshold(spark):
    """Too small to broadcast any parent, large enough for a short list of keys."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "20k")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def tables(spark, tmp_path):
    """Orders 1..9000 with two lines each; a line in 500 has an order that is missing."""
    day = F.lit(datetime(1997, 3, 1)).cast("timestamp_ntz")
    order = F.col("id") + 1
    rows = {
        "orders": spark.range(9000).select(
            order.alias("o_orderkey"), (order % 40).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
            F.lit(10.5).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
        ),
        "lineitem": spark.range(18000).select(
            F.when(order % 500 == 0, order + 100000).otherwise(order % 9000 + 1).alias("l_orderkey"),
            order.alias("l_partkey"), (order % 30 + 1).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
            F.lit(2.0).alias("l_quantity"), F.lit(5.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
            F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
            day.alias("l_shipdate"),
        ),
        "supplier": spark.range(30).select(
            order.alias("s_suppkey"), F.lit("s").alias("s_name"), F.lit(1).alias("s_nationkey"), F.lit(0.0).alias("s_acctbal")
        ),
        "customer": spark.range(40).select(
            F.col("id").alias("c_custkey"), F.lit("c").alias("c_name"), F.lit(1).alias("c_nationkey"),
            F.lit(0.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
        ),
        "nation": spark.range(25).select(
            F.col("id").cast("int").alias("n_nationkey"), F.lit("n").alias("n_name"), F.lit(1).alias("n_regionkey")
        ),
        "events": spark.range(100).select(
            F.col("id").alias("event_id"), day.alias("ts"), (order % 30 + 1).alias("user_id"),
            F.lit("click").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"),
        ),
    }
    for name, frame in rows.items():
        wanted = spark.createDataFrame([], SCHEMAS[name]).schema
        frame.select(*[F.col(f.name).cast(f.dataType) for f in wanted]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_checked_rows_stay_in_place_when_few_keys_are_missing(spark, threshold):
    source = SOURCES["delivery_events"]
    loads = spark.range(20000).select(F.concat(F.lit("L"), "id").alias("load_id"))
    trips = spark.range(20000).select(F.concat(F.lit("T"), "id").alias("trip_id"))
    facilities = spark.range(20000).select(F.concat(F.lit("F"), "id").alias("facility_id"))
    n = F.col("id")
    rows = spark.range(3000).select(
        n.cast("string").alias("event_id"),
        F.when(n % 7 != 0, F.concat(F.lit("L"), n * 7)).alias("load_id"),
        F.when(n % 5 == 0, F.lit("-1")).otherwise(F.concat(F.lit("T"), n)).alias("trip_id"),
        F.lit("F1").alias("facility_id"),
    )
    parents = {"loads": loads, "trips": trips.unionByName(trips), "facilities": facilities}
    got = check_references(rows, source, parents)
    assert "hashpartitioning" not in plan_of(got)
    want = rows
    for key, parent in source.parents.items():
        want = resolve_fk(want, parents[parent], key)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_orphans_need_no_join_of_rows(spark, threshold, tables):
    frame = entry.queries()["dq_orphans"](spark, tables)
    assert "SortMergeJoin" not in plan_of(frame)
    got = {(r["fact"], r["fk"]): r["orphans"] for r in frame.collect()}
    assert got["fact_fuel", "trip"] == 36


def test_conservation_parses_each_line_once(spark, tables):
    frame = entry.queries()["dq_conservation"](spark, tables)
    assert "split(" not in plan_of(frame)
    got = {r["object_name"]: r for r in frame.collect()}
    assert len(got) == 14 and all(r["conserved"] for r in got.values())
    assert got["fact_delivery"]["bronze"] == 18000 and got["fact_load"]["gold"] == 8100


def test_delivery_fact_is_shuffled_for_its_totals_only(spark, threshold, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    frame = entry.queries()["gold_fact_delivery"](spark, tables)
    assert "SortMergeJoin" not in plan_of(frame)
    assert frame.agg(F.sum("rows")).first()[0] == 18000
    # The 36 lines without an order, and those with neither key.
    unknown = (F.col("load_sk") == "-1") & (F.col("trip_sk") == "-1")
    assert frame.where(unknown).agg(F.sum("rows")).first()[0] >= 36


def test_facts_meet_a_dimension_once(spark, threshold, tables):
    """Also one too large to broadcast: no join by surrogate, where all Unknown rows are one key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, facts in (("gold_fact_delivery", 18000), ("gold_fact_fuel", 18000)):
        frame = entry.queries()[name](spark, tables)
        joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[([^\]]*)\]", plan_of(frame))
        assert joins and not any(re.search("(facility|truck|driver)_sk", keys) for keys in joins)
        assert frame.agg(F.sum("rows")).first()[0] == facts
        assert frame.columns[-2:] == ["rows", "total"]


def test_shown_keys_are_those_of_the_surrogates(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "-1"), (5, "a")], "id int, k string")
    dim = spark.createDataFrame([(-1, "-1"), (1, "a"), (2, "-1"), (3, None)], "sk bigint, k string")
    shown = resolve_sk(fact, dim, "k", "sk", show_key=True)
    assert shown.columns == ["id", "sk", "k"]
    want = resolve_sk(fact, dim, "k", "sk").join(dim, "sk").select("id", "sk", "k")
    assert sorted(map(tuple, shown.collect())) == sorted(map(tuple, want.collect()))


def test_integrity_counts_each_key_from_its_own_column(spark, threshold, tables):
    frame = entry.queries()["dq_integrity"](spark, tables)
    assert "stack(" not in plan_of(frame)
    got = {(r["fact"], r["key"]): r["dangling"] for r in frame.collect()}
    assert len(got) == 26 and got["fact_fuel", "trip_id"] == 36
    assert got["fact_trip", "load_id"] == 9000 // 103 and got["fact_delivery", "scheduled_datetime"] == 0


def test_dangling_keys_with_missing_repeated_and_no_members(spark):
    day = F.lit("1997-03-01").cast("date")
    fact = spark.range(10).select(
        F.when(F.col("id") < 7, F.col("id") % 3).alias("k"), day.alias("d"), F.lit(None).cast("string").alias("n")
    )
    members = spark.createDataFrame([("0",), ("0",), ("2",), (None,)], "m string")
    days = spark.range(1).select(day.alias("m"))
    dims = {"k": (members, "m"), "d": (days, "m"), "n": (members, "m")}
    want = {("f", "k", 5), ("f", "d", 0), ("f", "n", 10)}
    for count in (quality.dangling_keys, quality.dangling_by_column):
        assert set(map(tuple, count(fact, "f", dims).collect())) == want
        assert {r.dangling for r in count(fact.limit(0), "f", dims).collect()} == {0}
