"""Surrogates and fact partitions that outlive a build; facts by version (WIN-2, RM-3, RM-4)."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from roadledger.operators.history import with_version
from roadledger.operators.keymap import KeyMap
from roadledger.plans.build import WarehouseBuild
from roadledger.sources.tables import Warehouse
from tests import exports


def files(warehouse, table):
    top = warehouse.path("gold", table)
    return {
        (part, f, os.stat(f"{top}/{part}/{f}").st_mtime_ns)
        for part in os.listdir(top)
        if part.startswith("date_year=")
        for f in os.listdir(f"{top}/{part}")
        if f.endswith(".parquet")
    }


def numbers(warehouse, dim, key, sk):
    return {r[0]: r[1] for r in warehouse.read("gold", dim).select(key, sk).collect()}


@pytest.fixture(scope="module")
def twice(spark, tmp_path_factory):
    """State after a build, and the build after it with new members and a moved driver."""
    folder = str(tmp_path_factory.mktemp("lasting"))
    rows = exports.rows()
    exports.write(f"{folder}/first", rows)
    build = WarehouseBuild(spark, f"{folder}/first", f"{folder}/wh")
    build.run(date(2022, 1, 1))
    w = build.warehouse
    before = {
        "drivers": numbers(w, "dim_driver", "driver_id", "driver_sk"),
        "trucks": numbers(w, "dim_truck", "truck_id", "truck_sk"),
        "versions": numbers(w, "dim_driver_versions", "driver_id", "driver_version_sk"),
        "trips": files(w, "fact_trip"),
        "loads": files(w, "fact_load"),
    }
    rows["drivers"].append(["AAA00001", "New", "One"] + [""] * 6 + ["Active", "A", "1"])
    moved = next(d for d in rows["drivers"] if d[0] == "DRV00006")
    moved[8] = "Elsewhere"
    trip = next(t for t in rows["trips"] if t[5].startswith("2024") and t[2] == "DRV00006")
    rows["trips"].append(["TRIP99999", *trip[1:2], "AAA00001", *trip[3:]])
    exports.write(f"{folder}/second", rows)
    again = WarehouseBuild(spark, f"{folder}/second", f"{folder}/wh")
    again.run(date(2024, 1, 1))
    return before, again


def test_old_members_keep_their_numbers(twice):
    before, build = twice
    after = numbers(build.warehouse, "dim_driver", "driver_id", "driver_sk")
    assert {k: after[k] for k in before["drivers"]} == before["drivers"]
    assert after["AAA00001"] == max(before["drivers"].values()) + 1
    assert numbers(build.warehouse, "dim_truck", "truck_id", "truck_sk") == before["trucks"]
    assert {r["dangling"] for r in build.integrity().collect()} == {0}


def test_partitions_without_a_change_are_not_touched(twice):
    before, build = twice
    assert files(build.warehouse, "fact_load") == before["loads"]
    kept = before["trips"] & files(build.warehouse, "fact_trip")
    assert {p for p, _, _ in before["trips"] - kept} == {"date_year=2024"}
    assert {"date_year=2022", "date_year=2023"} <= {p for p, _, _ in kept}
    lines = {r["object_name"]: r for r in build.audit.frame().where("layer = 'gold'").collect()}
    count = len({p for p, _, _ in before["trips"]})
    assert lines["fact_trip"]["notes"] == f"1 of {count} partitions rewritten"
    assert lines["fact_load"]["notes"].startswith("0 of ")
    accepted = build.warehouse.read("gold", "fact_trip").count()
    assert lines["fact_trip"]["rows_loaded"] == accepted


def test_one_drivers_facts_carry_two_versions(twice):
    before, build = twice
    w = build.warehouse
    versions = w.read_all("gold", "dim_driver_versions")
    trips = w.read("gold", "fact_trip").join(
        versions.drop("driver_id"), "driver_version_sk"
    ).join(w.read("gold", "dim_driver").select("driver_sk", "driver_id"), "driver_sk")
    moved = trips.where("driver_id = 'DRV00006'").select("date_sk", "home_terminal").collect()
    assert {r["home_terminal"] for r in moved} == {None, "Elsewhere"}
    assert all((r["date_sk"] >= date(2024, 1, 1)) == (r["home_terminal"] is not None) for r in moved)
    kept = {r[0]: r[1] for r in versions.where("valid_from = '2022-01-01'").select(
        "driver_id", "driver_version_sk").collect()}
    assert {k: v for k, v in before["versions"].items() if k != "-1"} == kept
    unknown = w.read("gold", "fact_trip").where("driver_sk = -1")
    assert {r[0] for r in unknown.select("driver_version_sk").distinct().collect()} == {-1}


def test_a_build_that_runs_again_adds_nothing(spark, twice):
    _, build = twice
    w = build.warehouse
    known = w.read_all("gold", "keys_dim_driver").count()
    facts = files(w, "fact_trip")
    WarehouseBuild(spark, build.source_dir, w.root).run(date(2024, 1, 1))
    assert w.read_all("gold", "keys_dim_driver").count() == known
    assert files(w, "fact_trip") == facts


def test_a_member_that_returns_gets_its_number_back(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    keys = KeyMap(w, "dim_t", "t_id", "t_sk")

    def members(*ids):
        return spark.createDataFrame([(i,) for i in ids], "t_id string")

    assert keys.extend(members("b", "c", None, "c")) == 2
    first = {r["t_id"]: r["t_sk"] for r in keys.read().collect()}
    assert sorted(first.values()) == [1, 2]
    assert keys.extend(members("a")) == 1 and keys.extend(members()) == 0
    assert keys.extend(members("a", "b", "d")) == 1
    assert {r["t_id"]: r["t_sk"] for r in keys.read().collect()} == first | {"a": 3, "d": 4}


def test_versions_on_their_first_and_last_days(spark):
    history = spark.createDataFrame(
        [(1, "d", "2022-01-05", "2022-01-31"), (2, "d", "2022-02-01", None), (-1, "-1", None, None)],
        "v_sk bigint, k string, a string, b string",
    ).select("v_sk", "k", F.col("a").cast("date").alias("valid_from"),
             F.col("b").cast("date").alias("valid_to"))
    days = [("d", "2020-01-01", 1), ("d", "2022-01-31", 1), ("d", "2022-02-01", 2),
            ("d", "2030-01-01", 2), ("x", "2022-01-01", -1), (None, "2022-01-01", -1),
            ("-1", "2022-01-01", -1), ("d", None, -1)]
    fact = spark.createDataFrame(
        [(i, k, d, v) for i, (k, d, v) in enumerate(days)], "n int, k string, d string, want int"
    ).withColumn("d", F.col("d").cast("date"))
    got = with_version(fact, history, "k", "d", "v_sk", ["n"]).collect()
    assert len(got) == len(days) and all(r["v_sk"] == r["want"] for r in got)


def test_replace_changed_over_vanished_and_null_partitions(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))

    def frame(*rows):
        return spark.createDataFrame(rows, "v int, w int, p int")

    def held():
        return sorted(map(tuple, w.read_all("gold", "t").select("v", "w", "p").collect()), key=repr)

    assert w.replace_changed(frame((1, 1, 1), (2, 2, None)), "gold", "t", ["p"]) == (2, 2)
    assert w.replace_changed(frame((2, 2, None), (1, 1, 1)), "gold", "t", ["p"]) == (0, 2)
    assert w.replace_changed(frame((3, None, None), (1, 1, 1)), "gold", "t", ["p"]) == (1, 2)
    assert held() == [(1, 1, 1), (3, None, None)]
    assert w.replace_changed(frame((None, 3, None), (1, 1, 1)), "gold", "t", ["p"]) == (1, 2)
    assert w.replace_changed(frame((1, 1, 1), (1, 1, 1)), "gold", "t", ["p"])[1] == 1
    assert held() == [(1, 1, 1), (1, 1, 1)]
