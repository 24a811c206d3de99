"""Exchanges of the registered reports: facts are reduced before any key is looked up."""

import pytest

import __spark_entry__ as entry

DIRECTORY = "/root/testdata/sf0.001"
# Query -> exchanges its plan may have when no side is small enough to broadcast.
MOST = {
    "v_kpi_overview": 13,
    "v_load_profitability": 9,
    "v_route_performance": 8,
    "v_driver_performance": 5,
    "v_fleet_utilization": 4,
    "v_maintenance_analysis": 3,
    "v_detention_analysis": 3,
    "kpi_4": 9,
    "kpi_5": 4,
    "kpi_6": 3,
    "kpi_8": 4,
    "kpi_9": 12,
}


@pytest.mark.parametrize("name", MOST)
def test_exchanges(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = entry.queries()[name](spark, DIRECTORY)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [x for x in plan.splitlines() if "Exchange " in x and "Broadcast" not in x]
    assert len(exchanges) <= MOST[name]
    # No member is numbered for a result that shows natural keys.
    assert "_bucket" not in plan
