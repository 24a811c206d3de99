"""Views against row-by-row recomputation on a small star."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from roadledger.operators.statistics import exact_median
from roadledger.plans import views


def half_up(x, places):
    return x.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


@pytest.fixture(scope="module")
def star(spark):
    # Loads 1-6; load 6 has no event; customer 1 holds most of them.
    loads = [(f"L{i}", 1 if i < 5 else 2, Decimal(100 * i)) for i in range(1, 7)]
    fact_load = spark.createDataFrame(
        loads, "load_id string, customer_sk bigint, gross_revenue decimal(14,2)"
    )
    trips = [
        (f"T{i}", -1 if i == 3 else 1, 7, Decimal(50 * i), Decimal(i), Decimal("6.5"), Decimal("0.5"))
        for i in range(1, 7)
    ]
    fact_trip = spark.createDataFrame(
        trips,
        "trip_id string, driver_sk bigint, truck_sk bigint,"
        " actual_distance_miles decimal(10,1), actual_duration_hours decimal(7,2),"
        " average_mpg decimal(6,2), idle_time_hours decimal(7,2)",
    )
    events = [
        ("e1", "L1", "T1", "Pickup", True, 10),
        ("e2", "L1", "T1", "Delivery", False, 20),
        ("e3", "L1", "T2", "Delivery", None, 31),
        ("e4", "L2", "T2", "Delivery", True, None),
        ("e5", "L5", "T5", "Delivery", True, 40),
        ("e6", "-1", "-1", "Delivery", True, 41),
        ("e7", "L3", "-1", "Pickup", False, 5),
    ]
    fact_delivery = spark.createDataFrame(
        [(*e, 3) for e in events],
        "event_id string, load_sk string, trip_sk string, event_type string,"
        " on_time_flag boolean, detention_minutes int, facility_sk bigint",
    )
    dim_customer = spark.createDataFrame(
        [(1, "C1", "n", "t"), (2, "C2", "n", "t"), (-1, "-1", "Unknown Customer", None)],
        "customer_sk bigint, customer_id string, customer_name string, customer_type string",
    )
    dim_driver = spark.createDataFrame(
        [(1, "D1", "f", "h", 3), (-1, "-1", "Unknown Driver", None, None)],
        "driver_sk bigint, driver_id string, full_name string, home_terminal string,"
        " years_experience int",
    )
    dim_facility = spark.createDataFrame(
        [(3, "F3", "dock", "x", "TX")],
        "facility_sk bigint, facility_id string, facility_name string, city string,"
        " state string",
    )
    return {
        "loads": loads,
        "trips": trips,
        "events": events,
        "fact_load": fact_load,
        "fact_trip": fact_trip,
        "fact_delivery": fact_delivery,
        "dim_customer": dim_customer,
        "dim_driver": dim_driver,
        "dim_facility": dim_facility,
    }


def test_customer_service(star):
    args = [star[k] for k in ("fact_load", "fact_delivery", "dim_customer")]
    safe = {r["customer_id"]: r for r in views.customer_service(*args).collect()}
    written = {r["customer_id"]: r for r in views.customer_service_as_written(*args).collect()}
    joined = defaultdict(list)
    for load, customer, gross in star["loads"]:
        matched = [e for e in star["events"] if e[1] == load] or [None]
        joined[f"C{customer}"] += [(load, gross, e) for e in matched]
    for customer, rows in joined.items():
        events = [e for _, _, e in rows if e]
        on_time = sum(e[4] is True for e in events)
        want = half_up(Decimal(100 * on_time) / len(events), 1)
        for got in (safe[customer], written[customer]):
            assert got["loads"] == len({load for load, _, _ in rows})
            assert got["trips"] == len({e[2] for e in events})
            assert got["on_time_pct"] == want
        assert written[customer]["gross_revenue"] == sum(g for _, g, _ in rows)
        assert safe[customer]["gross_revenue"] == sum(
            {load: g for load, g, _ in rows}.values()
        )


def test_driver_performance(star):
    args = [star[k] for k in ("fact_trip", "fact_delivery", "dim_driver")]
    safe = views.driver_performance(*args).collect()
    written = views.driver_performance_as_written(*args).collect()
    assert [r["driver_id"] for r in safe] == [r["driver_id"] for r in written] == ["D1"]
    own = [t for t in star["trips"] if t[1] > 0]
    joined = [
        (t, e)
        for t in own
        for e in ([e for e in star["events"] if e[2] == t[0]] or [None])
    ]
    assert safe[0]["trips"] == len(own) and written[0]["trips"] == len(joined)
    assert safe[0]["total_miles"] == sum(t[3] for t in own)
    assert written[0]["total_miles"] == sum(t[3] for t, _ in joined)
    events = [e for _, e in joined if e]
    want = half_up(Decimal(100 * sum(e[4] is True for e in events)) / len(events), 1)
    assert safe[0]["on_time_pct"] == written[0]["on_time_pct"] == want


def test_detention_mean_and_its_truncated_form(star):
    args = [star["fact_delivery"], star["dim_facility"]]
    minutes = [e[5] for e in star["events"] if e[5] is not None]
    exact = views.detention_analysis(*args).first()
    cut = views.detention_analysis_as_written(*args).first()
    assert exact["avg_detention_min"] == half_up(Decimal(sum(minutes)) / len(minutes), 4)
    assert cut["avg_detention_min"] == sum(minutes) // len(minutes)


def test_views_of_empty_facts(star):
    none = star["fact_delivery"].where("false")
    got = views.customer_service(star["fact_load"], none, star["dim_customer"]).collect()
    assert {(r["trips"], r["on_time_pct"]) for r in got} == {(0, None)}
    assert views.detention_analysis(none, star["dim_facility"]).count() == 0


def test_exact_median(spark):
    frame = spark.createDataFrame([(v,) for v in [5] * 40 + [1, 2, 9, None]], "v int")
    assert exact_median(frame, frame["v"], "m").first()["m"] == 5.0
    two = spark.createDataFrame([(1,), (4,)], "v int")
    assert exact_median(two, two["v"], "m").first()["m"] == 2.5
    assert exact_median(two.where("false"), two["v"], "m").first()["m"] is None


def test_hot_load_gives_the_same_result_when_its_partition_is_split(spark, star):
    fact_load = spark.range(300).selectExpr(
        "concat('L', id) AS load_id",
        "IF(id % 3 = 0, 1, 2) AS customer_sk",
        "CAST(id AS DECIMAL(14,2)) AS gross_revenue",
    )
    # A third of all events belongs to one load, a third to none.
    fact_delivery = spark.range(30000).selectExpr(
        "concat('e', id) AS event_id",
        "CASE id % 3 WHEN 0 THEN 'L0' WHEN 1 THEN '-1' ELSE concat('L', id % 300) END"
        " AS load_sk",
        "concat('T', id % 700) AS trip_sk",
        "IF(id % 2 = 0, 'Delivery', 'Pickup') AS event_type",
        "id % 5 < 2 AS on_time_flag",
    )
    builders = (views.customer_service, views.customer_service_as_written)

    def rows():
        return [
            sorted(map(tuple, b(fact_load, fact_delivery, star["dim_customer"]).collect()))
            for b in builders
        ]

    want = rows()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8kb",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert rows() == want
        split = views.customer_service(fact_load, fact_delivery, star["dim_customer"])
        split.collect()
        assert "skew=true" in split._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert want[0][0][3] == 100 and sum(r[3] for r in want[0]) == 300
