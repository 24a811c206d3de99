"""Plans over stored facts: pruning through the calendar, joins without a shuffle."""

import uuid

import pytest
from pyspark.sql import functions as F

from roadledger.plans.colocated import load_stories, store_colocated
from roadledger.sources.calendar import calendar, facts_on
from roadledger.sources.tables import Warehouse


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_calendar_filter_opens_its_years_alone(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    days = F.date_add(F.to_date(F.lit("2020-01-01")), (F.col("id") % 3000).cast("int"))
    fact = spark.range(6000).select(F.col("id").alias("n"), days.alias("date_sk"))
    w.write(fact.withColumn("date_year", F.year("date_sk")), "gold", "fact_t", ["date_year"])
    leap = calendar(spark, "2020-01-01", "2028-12-31").where(
        (F.col("season") == "Summer") & F.col("is_weekend") & (F.col("year_nbr") % 4 == 0)
    )
    found = facts_on(w.read("gold", "fact_t"), leap.select("date_id", "year_nbr", "month_nbr"))
    assert "dynamicpruning" in plan(found)
    opened = found.select(F.col("n"), "date_sk", "year_nbr", "month_nbr", "date_year")
    rows = opened.collect()
    assert {r["year_nbr"] for r in rows} == {2020, 2024}
    want = fact.where(
        "month(date_sk) IN (6, 7, 8) AND dayofweek(date_sk) IN (1, 7) AND year(date_sk) % 4 = 0"
    )
    assert sorted(r["n"] for r in rows) == sorted(r["n"] for r in want.collect())
    assert _partitions_read(opened) == 3  # 2020, 2024, 2028 of nine years


def _partitions_read(frame):
    """Partitions that the file scan of an executed frame has read, from its own metrics."""
    node = frame._jdf.queryExecution().executedPlan()
    waiting = [node]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.finalPhysicalPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif name == "FileSourceScanExec" and "date_year" in node.toString():
            return node.metrics().apply("numPartitions").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    raise AssertionError("no file scan")


@pytest.fixture(scope="module")
def stories(spark, tmp_path_factory):
    loads = [("L1", 100, "Spot"), ("L2", 200, "Contract"), ("L3", 300, "Spot"), (None, 5, None)]
    trips = [("T1", "L1", 10), ("T2", "L1", 20), ("T3", "L2", None), ("T4", "-1", 7), ("T5", None, 8)]
    events = [("E1", "L1", True, 5), ("E2", "L1", None, 6), ("E3", "L3", False, None), ("E4", "-1", True, 9)]
    day = F.to_date(F.lit("2024-01-01")).alias("date_sk")
    frames = {
        "fact_load": spark.createDataFrame(loads, "load_id string, gross_revenue int, booking_type string"),
        "fact_trip": spark.createDataFrame(trips, "trip_id string, load_sk string, actual_distance_miles int"),
        "fact_delivery": spark.createDataFrame(
            events, "event_id string, load_sk string, on_time_flag boolean, detention_minutes int"
        ),
    }
    names = {}
    for name, frame in frames.items():
        names[name] = f"{name}_{uuid.uuid4().hex}"
        path = str(tmp_path_factory.mktemp(name))
        store_colocated(frame.select("*", day), name, names[name], path, 4)
    return load_stories(spark, *names.values())


def test_colocated_joins_have_no_exchange(stories):
    text = plan(stories)
    assert "Exchange" not in text and text.count("SortMergeJoin") == 2
    assert text.count("Bucketed: true") == 3
    # Per kind of booking one exchange, of sums.
    assert plan(stories.groupBy("booking_type").count()).count("Exchange hashpartitioning") == 1


def test_stories_of_loads(stories):
    got = {r["load_key"]: r for r in stories.collect()}
    assert len(got) == 4

    def story(key):
        return tuple(got[key][c] for c in ("trips", "miles", "events", "on_time", "detention_minutes"))

    assert story("L1") == (2, 30, 2, 1, 11)
    assert story("L2") == (1, 0, 0, 0, 0)
    assert story("L3") == (0, 0, 1, 0, 0)
    nowhere = next(k for k in got if k not in ("L1", "L2", "L3"))
    assert story(nowhere) == (0, 0, 0, 0, 0)
