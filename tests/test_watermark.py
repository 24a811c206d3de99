"""Events merged once within a watermark, late ones in quarantine (RM-1)."""

import os

from pyspark.sql import functions as F

from pyspark.sql import functions as F

from roadledger.model import SOURCES
from roadledger.operators.staging import COPIES
from roadledger.plans.silver import silver_rows
from roadledger.sources.tables import Warehouse
from roadledger.streaming.intake import (
    arriving_rows,
    late_rows,
    merge_within_watermark,
)
from tests import exports

KEY = "fuel_purchase_id"


def purchase(key, day):
    return [key, "TRIP1", "TRK1", "DRV1", f"{day} 08:00:00" if day else "", "Town", "TX", "10",
            "3.5", "35.00", "C1"]


def test_replays_merge_once_and_late_rows_are_set_aside(spark, tmp_path):
    w = Warehouse(spark, f"{tmp_path}/wh")
    source = SOURCES["fuel_purchases"]
    empty = spark.createDataFrame([], source.staging_schema())
    start = silver_rows(empty, source).withColumns(
        {COPIES: F.lit(1).cast("bigint"), "year": F.year("purchase_date")}
    )
    w.write(start, "silver", "fact_fuel", ["year"])
    landing, taken = f"{tmp_path}/landing", 0
    os.makedirs(landing)

    def arrive(name, lines):
        nonlocal taken
        exports.write(f"{tmp_path}/{name}", {"fuel_purchases": lines})
        os.link(f"{tmp_path}/{name}/fuel_purchases.csv", f"{landing}/{name}.csv")
        taken += 1
        os.utime(f"{landing}/{name}.csv", (1_700_000_000 + taken, 1_700_000_000 + taken))

    def take():
        query = merge_within_watermark(
            arriving_rows(spark, landing, "fuel_purchases", files_per_batch=1),
            w,
            "fuel_purchases",
            {"year": "year(purchase_date)"},
            "purchase_date",
            "10 days",
            f"{tmp_path}/cp",
        )
        query.awaitTermination()
        assert query.exception() is None
        return query

    def keys(frame):
        return sorted(r[0] for r in frame.select(KEY).collect())

    def late():
        return keys(late_rows(w, "fuel_purchases"))

    arrive("a", [purchase(f"A{i}", f"2023-01-{i:02d}") for i in range(1, 21)])
    arrive("b", [purchase("A19", "2023-01-19"), purchase("B1", "2023-01-15"),
                 purchase("B1", "2023-01-15"), purchase("NONE", "")])
    take()
    table = [f"A{i}" for i in range(1, 21)] + ["B1"]
    assert keys(w.read("silver", "fact_fuel")) == sorted(table) and late() == []
    refused = w.read_all("audit", "refused_fact_fuel").collect()
    assert [r[KEY] for r in refused] == ["NONE"]
    # The watermark is 10 January, also after a restart: C2 is late, A2 a late replay.
    arrive("c", [purchase("C1", "2023-01-11"), purchase("C2", "2023-01-05"),
                 purchase("A2", "2023-01-02"), purchase("C3", "2023-03-01")])
    take()
    table += ["C1", "C3"]
    assert keys(w.read("silver", "fact_fuel")) == sorted(table) and late() == ["C2"]
    # Now it is 19 February; state of January is gone.
    arrive("d", [purchase("D1", "2023-02-01"), purchase("C3", "2023-03-01"),
                 purchase("D2", "2023-02-25")])
    query = take()
    table += ["D2"]
    assert keys(w.read("silver", "fact_fuel")) == sorted(table) and late() == ["C2", "D1"]
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert states and states[-1]["numRowsTotal"] <= 3
    again = take()  # no file is new
    assert keys(w.read("silver", "fact_fuel")) == sorted(table) and late() == ["C2", "D1"]
    assert sum(p["numInputRows"] for p in again.recentProgress) == 0
