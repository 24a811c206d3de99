"""The monthly layers, renewed by month, and distinct counts from bitmaps (RM-5, AGG-3, AGG-12)."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from roadledger.operators.distinct import bitmaps, distinct_members
from roadledger.plans.build import WarehouseBuild
from roadledger.plans.monthly import (
    members_per_period,
    monthly_layers,
    monthly_loads,
    monthly_members,
)
from roadledger.sources.tables import Warehouse
from tests import exports


def months_written(warehouse, table):
    """Month -> its files and their times."""
    top = warehouse.path("gold", table)
    return {
        part.split("=")[1]: sorted(
            (f, os.stat(f"{top}/{part}/{f}").st_mtime_ns)
            for f in os.listdir(f"{top}/{part}")
            if f.endswith(".parquet")
        )
        for part in os.listdir(top)
        if part.startswith("month=")
    }


def content(frame):
    return sorted(frame.select(sorted(frame.columns)).collect(), key=repr)


@pytest.fixture(scope="module")
def twice(spark, tmp_path_factory):
    """A build, and one after it in which a load of May 2023 is dearer."""
    folder = str(tmp_path_factory.mktemp("monthly"))
    rows = exports.rows()
    exports.write(f"{folder}/first", rows)
    build = WarehouseBuild(spark, f"{folder}/first", f"{folder}/wh")
    build.run(date(2022, 1, 1))
    before = {n: months_written(build.warehouse, n) for n in ("monthly_layer", "monthly_trip_members")}
    load = next(r for r in rows["loads"] if any(c.startswith("2023-05") for c in r))
    column = exports.SOURCES["loads"].column_names.index("revenue")
    load[column] = "987654.25"
    exports.write(f"{folder}/second", rows)
    again = WarehouseBuild(spark, f"{folder}/second", f"{folder}/wh")
    again.run(date(2022, 1, 1))
    return before, again


def test_only_the_touched_month_is_rewritten(twice):
    before, build = twice
    now = months_written(build.warehouse, "monthly_layer")
    assert {m for m in now if now[m] != before["monthly_layer"][m]} == {"2023-05-01"}
    assert set(now) == set(before["monthly_layer"]) and len(now) > 12
    assert months_written(build.warehouse, "monthly_trip_members") == before["monthly_trip_members"]


def test_layers_equal_a_full_rebuild(twice):
    _, build = twice
    w = build.warehouse
    for layer in monthly_layers(w):
        assert content(w.read_all("gold", layer.name)) == content(layer.build(w.read("gold", layer.fact)))
        assert layer.touched() == []


def test_a_refresh_opens_the_touched_partitions_alone(twice):
    _, build = twice
    layer = monthly_layers(build.warehouse)[0]
    rows = layer.rows_of([date(2023, 5, 1), date(2023, 12, 1)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    partition = plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "date_year" in partition and "2023" in partition
    assert "GreaterThanOrEqual(date_sk,2023-05-01)" in pushed
    assert "LessThan(date_sk,2023-06-01)" in pushed
    opened = rows.select(F.col("_metadata.file_path")).distinct().collect()
    assert {p[0].split("/")[-2] for p in opened} == {"date_year=2023"}
    assert {str(r[0])[:7] for r in rows.select("date_sk").collect()} <= {"2023-05", "2023-12"}


def test_distinct_counts_per_year_come_from_the_layer(twice):
    _, build = twice
    w = build.warehouse
    maps, trips = w.read_all("gold", "monthly_trip_members"), w.read("gold", "fact_trip")
    for period, key in (("month", F.trunc("date_sk", "month")), ("year", F.year("date_sk")), ("all", F.lit("all"))):
        got = {(r[0], r[1]): r[2] for r in members_per_period(maps, period).collect()}
        for sk in ("driver_sk", "truck_sk", "trailer_sk"):
            want = trips.where(F.col(sk) > 0).groupBy(key.cast("string").alias("p")).agg(F.countDistinct(sk))
            want = {(r[0], sk): r[1] for r in want.collect()}
            assert want and want == {k: v for k, v in got.items() if k[1] == sk}


def test_a_run_that_breaks_leaves_its_months_pending(spark, tmp_path):
    """The fact is renewed and the run ends; the next run renews the layer all the same."""
    w = Warehouse(spark, str(tmp_path))

    def fact(*rows):
        frame = spark.createDataFrame(rows, "load_id string, d string, gross_revenue int")
        return frame.select(
            "load_id", F.to_date("d").alias("date_sk"), F.lit(1).alias("customer_sk"), F.lit(1).alias("route_sk"),
            "gross_revenue", F.lit(1).alias("weight_lbs"), F.year(F.to_date("d")).alias("date_year"),
        )

    def store(frame):
        month = {"month": F.trunc("date_sk", "month")}
        return w.replace_changed(frame, "gold", "fact_load", ["date_year"], month, layer.note)

    def right():
        return content(w.read_all("gold", "monthly_layer")) == content(monthly_loads(w.read("gold", "fact_load")))

    layer = monthly_layers(w)[0]
    rows = [("a", "2022-01-31", 1), ("b", "2022-02-01", 2), ("c", "2023-01-01", 3), ("n", None, 1)]
    assert store(fact(*rows)) == (3, 3)
    assert layer.refresh() is None and right()
    rows[1] = ("b", "2022-02-01", 9)
    assert store(fact(*rows)) == (1, 3)
    assert layer.touched() == [date(2022, 2, 1)] and not right()
    assert store(fact(*rows)) == (0, 3)
    assert monthly_layers(w)[0].refresh() == [date(2022, 2, 1)] and right()
    # A load moves: its old month loses the only row, so the layer is built anew.
    rows[1] = ("b", "2022-12-31", 9)
    store(fact(*rows))
    assert layer.touched() == [date(2022, 2, 1), date(2022, 12, 1)]
    assert layer.refresh() is None and right()
    # A year goes: the fact is replaced, and with it its month of the layer.
    store(fact(rows[0], rows[1], rows[3]))
    assert layer.refresh() is None and right()
    assert layer.refresh() == [] and right()


def test_bitmaps_count_what_countdistinct_counts(spark):
    rows = [(g, s) for g, s in (
        [("a", i) for i in (1, 2, 32767, 32768, 32769, 65536, 65537, 3_000_000_000)] * 3
        + [("b", 2), ("b", 2), ("b", None), ("b", -1), ("c", None), (None, 7), (None, 8)]
    )]
    frame = spark.createDataFrame(rows, "g string, sk long")
    maps = bitmaps(frame, ["g"], "sk")
    assert {r[0]: r[1] for r in distinct_members(maps, ["g"], "n").collect()} == {"a": 8, "b": 1, None: 2}
    assert distinct_members(maps, [], "n").collect()[0][0] == 10
    assert distinct_members(maps.where("false"), [], "n").collect()[0][0] == 0
    assert distinct_members(bitmaps(frame.where("false"), ["g"], "sk"), ["g"], "n").collect() == []


def test_monthly_members_scan_the_fact_once(spark):
    trips = spark.createDataFrame([("2022-01-31", 1, -1), ("2022-01-01", 1, 2)], "d string, x_sk int, y_sk int")
    maps = monthly_members(trips.withColumn("date_sk", F.to_date("d")), ["x_sk", "y_sk"])
    assert {(r[1], r[2]) for r in members_per_period(maps, "month").collect()} == {("x_sk", 1), ("y_sk", 1)}
    assert maps._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
