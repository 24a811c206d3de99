import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roadledger.model import SOURCES
from roadledger.operators import quality
from roadledger.operators.audit import layer_audit
from roadledger.operators.staging import COPIES, REJECT
from roadledger.plans.build import WarehouseBuild
from tests import exports


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("build"))
    exports.write(f"{folder}/src")
    build = WarehouseBuild(spark, f"{folder}/src", f"{folder}/wh")
    build.run()
    return build


@pytest.fixture(scope="module")
def source_rows():
    return exports.rows()


def test_no_row_is_lost(built, source_rows):
    got = {r["object_name"]: r for r in built.conservation().collect()}
    assert len(got) == 14
    for s in SOURCES.values():
        extra = 1 if s.name == "loads" else 0
        assert got[s.target]["bronze"] == len(source_rows[s.name]) + extra
    assert [r["object_name"] for r in got.values() if not r["conserved"]] == []


def test_checks_are_stored_by_the_run(built):
    stored = {
        name: built.warehouse.read_all("audit", f"check_{name}").collect()
        for name in (
            "orphans", "integrity", "conservation", "source_rows", "columns", "trip_events"
        )
    }
    assert all({r["run_id"] for r in rows} == {built.audit.run_id} for rows in stored.values())
    assert all(r["conserved"] for r in stored["conservation"]) and len(stored["conservation"]) == 14
    assert sum(r["orphans"] for r in stored["orphans"]) > 0
    assert sum(r["dangling"] for r in stored["integrity"]) == 0
    columns = {(r["object_name"], r["column_name"]): r for r in stored["columns"]}
    assert len({t for t, _ in columns}) == 14 and columns["drivers", "home_terminal"]["blanks"] > 0
    assert columns["drivers", "date_of_birth"]["uncastable"] == 1
    assert columns["loads", "load_id"]["nulls"] == 1
    assert {r["rule"] for r in stored["trip_events"]} == {"flag_of_open_trip", "finished_without_flag"}
    assert len(stored["source_rows"]) == 14 and all(r["same"] for r in stored["source_rows"])


def test_facts_lie_by_year_and_layers_are_stored(built):
    w = built.warehouse
    loads = w.read("gold", "fact_load")
    assert [f for f in os.listdir(w.path("gold", "fact_load")) if f.startswith("date_year=")]
    year = loads.select(F.max(F.year("date_sk"))).first()[0]
    plan = loads.where(F.col("date_year") == year)._jdf.queryExecution().toString()
    assert "(date_year#" in plan and "PartitionFilters: [isnotnull" in plan
    assert w.read_all("gold", "monthly_layer").agg(F.sum("loads")).first()[0] == loads.count()
    versions = w.read_all("gold", "dim_driver_versions")
    known = versions.count()
    assert versions.where("is_current").count() == w.read("silver", "dim_driver").count()
    built.history()
    assert w.read_all("gold", "dim_driver_versions").count() == known


def test_audit_has_one_line_per_object(built):
    lines = built.warehouse.read_all("audit", "pipeline_audit").collect()
    assert len(lines) == 14 + 15 + 15
    assert {r["status"] for r in lines} == {"DONE"}
    assert {r["run_id"] for r in lines} == {built.audit.run_id}
    assert all(r["finished_at"] >= r["started_at"] for r in lines)
    bronze = layer_audit(built.audit.frame(), "bronze").collect()
    assert [r["object_name"] for r in bronze] == sorted(SOURCES)


def test_refused_rows_stay_visible(built):
    w = built.warehouse
    reasons = {r[REJECT] for r in w.rejected("silver", "fact_load").collect()}
    assert reasons == {"short line", "missing load_date"}
    assert {r[REJECT] for r in w.rejected("gold", "fact_load").collect()} == {
        "load_date outside calendar"
    }
    assert {r[REJECT] for r in w.rejected("gold", "fact_maintenance").collect()} == {
        "missing maintenance_date"
    }
    drivers = sorted(r[REJECT] for r in w.rejected("silver", "dim_driver").collect())
    assert drivers == ["missing driver_id", "missing first_name"]
    surplus = w.rejected("silver", "fact_fuel").select(REJECT, COPIES, "total_cost").collect()
    # The other cost does not fit its type: NULL sorts first and is kept.
    assert [(r[REJECT], r[COPIES], r["total_cost"]) for r in surplus] == [
        ("repeated key", 3, Decimal("350.50"))
    ]


def test_typed_values(built):
    w = built.warehouse
    driver = w.read("silver", "dim_driver").where("driver_id = 'DRV00002'").first()
    assert driver["full_name"] == "First2 Last2"
    assert driver["years_experience"] is None and driver["home_terminal"] is None
    one = w.read("silver", "dim_driver").where("driver_id = 'DRV00001'").first()
    assert (one["employment_status"], one["is_active"]) == ("Unknown", False)
    route = w.read("silver", "dim_route").where("route_id = 'RTE00007'").first()
    assert route["corridor"] is None
    facility = w.read("silver", "dim_facility").first()
    assert facility["latitude"] == Decimal("29.123457")
    maintenance = w.read("silver", "fact_maintenance").where("maintenance_id = 'MNT00003'")
    assert maintenance.first()["service_description"] == "oil, filter, 3"


def test_orphans_and_integrity(built, source_rows):
    orphans = {(r["fact"], r["fk"]): r["orphans"] for r in built.orphans().collect()}
    assert len(orphans) == 18
    trips = source_rows["trips"]
    assert orphans["fact_trip", "driver"] == sum(t[2] == "" for t in trips)
    assert orphans["fact_trip", "trailer"] == sum(t[4] == "TRL99999" for t in trips)
    assert orphans["fact_driver_monthly", "driver"] == 2
    missing = {(r["key"], r["member"]) for r in built.missing("fact_trip").collect()}
    # A load without a usable date is refused, so its trip has no load.
    assert missing == {("trailer_id", "TRL99999"), ("load_id", "LOAD00050")}
    dangling = built.integrity().collect()
    assert len(dangling) == 30 and {r["dangling"] for r in dangling} == {0}
    keys = quality.duplicate_summary(
        built.warehouse.read("silver", "fact_driver_monthly"),
        "fact_driver_monthly",
        ["driver_id", "month"],
    ).first()
    assert (keys["repeated_keys"], keys["surplus_rows"]) == (1, 1)


def test_gross_is_the_same_in_every_grain_safe_view(spark, built):
    total = built.warehouse.read("gold", "fact_load").agg(F.sum("gross_revenue")).first()[0]
    for view in ("v_load_profitability", "v_route_performance", "v_customer_service", "v_monthly_trend"):
        assert spark.table(view).agg(F.sum("gross_revenue")).first()[0] == total
    assert spark.table("v_kpi_overview").first()["gross_revenue"] == total


def test_rerun_gives_the_same_tables(spark, built):
    def content(name):
        frame = built.warehouse.read("gold", name)
        return sorted(map(repr, frame.collect()))

    names = ("dim_truck", "fact_trip", "fact_fuel", "fact_truck_monthly")
    before = {n: content(n) for n in names}
    again = WarehouseBuild(spark, built.source_dir, built.warehouse.root)
    again.run()
    assert {n: content(n) for n in names} == before
    lines = built.warehouse.read_all("audit", "pipeline_audit")
    assert lines.count() == 88 and lines.select("run_id").distinct().count() == 2


def test_export(built, tmp_path):
    built.export(str(tmp_path))
    assert len(os.listdir(tmp_path)) == 16
    names = json.loads(_lines(f"{tmp_path}/fuel_m/cols")[0])
    assert names == ["month", "purchases", "gallons", "cost"]
    rows = [json.loads(line) for line in _lines(f"{tmp_path}/fuel_m/rows")]
    assert sum(r[1] for r in rows) == 480 and all(len(r) == 4 for r in rows)


def _lines(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            out += open(f"{folder}/{name}", encoding="utf-8").read().splitlines()
    return out


def test_kpi_check_fails_on_a_missing_figure(spark):
    actual = spark.createDataFrame([(10.0, None)], "a double, b double")
    got = {r["label"]: r["ok"] for r in quality.kpi_check(
        actual, [("a", 10.4, 0.5), ("b", 1.0, 9.0)]
    ).collect()}
    assert got == {"a": True, "b": False}
