from datetime import date

from pyspark.sql import functions as F

from roadledger.model import SOURCES
from roadledger.operators.history import as_of, merge_latest, upsert, versions
from roadledger.operators.staging import COPIES, REJECT
from roadledger.sources.tables import Warehouse
from roadledger.streaming.intake import arriving_rows, merge_batches
from tests import exports


def test_merge_latest_with_a_hot_key(spark):
    columns = "k string, v int, t int"
    base = spark.createDataFrame([("a", 1, -1), ("b", 2, 5)], columns)
    changes = spark.createDataFrame(
        [("a", i, i) for i in range(500)] + [("b", 9, 4), ("c", 7, 1)], columns
    )
    got = merge_latest(base, changes, ["k"], F.col("t")).collect()
    assert {(r.k, r.v) for r in got} == {("a", 499), ("b", 2), ("c", 7)}
    assert len(got) == 3


def stored(spark, rows):
    return spark.createDataFrame(rows, "k string, d date, v int").withColumns(
        {
            "year": F.year("d"),
            REJECT: F.lit(None).cast("string"),
            COPIES: F.lit(1).cast("bigint"),
        }
    )


def test_upsert_rewrites_touched_partitions_only_and_is_repeatable(spark, tmp_path):
    w = Warehouse(spark, f"{tmp_path}/wh")
    rows = [(f"k{i}", date(2020 + i % 4, 1, 1), i) for i in range(20)]
    w.write(stored(spark, rows), "silver", "t", ["year"])
    files_before = {r[0] for r in w.read_all("silver", "t").where("year = 2023").select(
        F.input_file_name()).distinct().collect()}
    changes = stored(
        spark,
        [
            ("k0", date(2020, 1, 1), 99),  # same partition
            ("k1", date(2022, 5, 5), 77),  # moves from 2021 to 2022
            ("k1", date(2020, 5, 5), 55),  # an older change of the same key
            ("new", date(2021, 1, 1), 1),
        ],
    ).drop(REJECT, COPIES)
    want = {k: (d, v) for k, d, v in rows}
    want.update(
        {"k0": (date(2020, 1, 1), 99), "k1": (date(2022, 5, 5), 77), "new": (date(2021, 1, 1), 1)}
    )
    for turn in range(2):
        upsert(
            w, "silver", "t", changes, ["k"], F.struct("d", "v"), ["year"],
            f"{tmp_path}/stage{turn}",
        )
        got = w.read("silver", "t").collect()
        assert {r.k: (r.d, r.v) for r in got} == want and len(got) == len(want)
        old = w.rejected("silver", "t").collect()
        assert [(r.k, r.v, r[REJECT]) for r in old] == [("k1", 1, "superseded")]
    files_after = {r[0] for r in w.read_all("silver", "t").where("year = 2023").select(
        F.input_file_name()).distinct().collect()}
    assert files_after == files_before


def test_an_older_change_never_replaces_a_newer_row(spark, tmp_path):
    w = Warehouse(spark, f"{tmp_path}/wh")
    changes = [("k", date(2020, 1, d), d) for d in (3, 9, 5)] + [("old", date(2019, 1, 1), 0)]
    tables = []
    for size in (1, 2, 4):
        name = f"t{size}"
        w.write(stored(spark, [("old", date(2020, 2, 2), 7)]), "silver", name, ["year"])
        for begin in range(0, len(changes), size):
            part = stored(spark, changes[begin : begin + size]).drop(REJECT, COPIES)
            upsert(w, "silver", name, part, ["k"], F.struct("d", "v"), ["year"],
                   f"{tmp_path}/stage-{size}-{begin}")
        tables.append({(r.k, r.d, r.v) for r in w.read("silver", name).collect()})
    assert tables[0] == {("k", date(2020, 1, 9), 9), ("old", date(2020, 2, 2), 7)}
    assert tables[1] == tables[0] and tables[2] == tables[0]


def test_versions_and_as_of(spark):
    seen = spark.createDataFrame(
        [
            ("d", "2022-01-01", "Active", 1),
            ("d", "2022-01-05", "Active", 1),
            ("d", "2022-02-01", "Active", 1),
            ("d", "2022-02-01", "Terminated", 2),
            ("d", "2022-03-01", "Active", 1),
            ("e", "2022-01-01", None, 1),
        ],
        "k string, day string, status string, o int",
    ).withColumn("day", F.col("day").cast("date"))
    got = versions(seen, "k", "day", ["status"], F.col("o"))
    rows = [(r.k, r.status, str(r.valid_from), str(r.valid_to), r.is_current)
            for r in got.orderBy("k", "valid_from").collect()]
    assert rows == [
        ("d", "Active", "2022-01-01", "2022-01-31", False),
        ("d", "Terminated", "2022-02-01", "2022-02-28", False),
        ("d", "Active", "2022-03-01", "None", True),
        ("e", None, "2022-01-01", "None", True),
    ]
    fact = spark.createDataFrame(
        [("d", "2021-12-31"), ("d", "2022-02-15"), ("d", "2030-01-01"), ("x", "2022-01-01")],
        "k string, on string",
    ).withColumn("on", F.col("on").cast("date"))
    found = {(r.k, str(r.on)): r.status for r in as_of(fact, got, "k", "on", ["status"]).collect()}
    assert found == {
        ("d", "2021-12-31"): None,
        ("d", "2022-02-15"): "Terminated",
        ("d", "2030-01-01"): "Active",
        ("x", "2022-01-01"): None,
    }


def test_file_stream_merges_late_and_repeated_rows(spark, tmp_path):
    landing = f"{tmp_path}/landing"
    w = Warehouse(spark, f"{tmp_path}/wh")
    rows = exports.rows()["fuel_purchases"]
    first, second = rows[:300], rows[200:]
    corrected = list(rows[10])
    corrected[9] = "1.00"
    source = SOURCES["fuel_purchases"]
    empty = spark.createDataFrame([], source.staging_schema())
    from roadledger.plans.silver import silver_rows

    start = silver_rows(empty, source).withColumns(
        {COPIES: F.lit(1).cast("bigint"), "year": F.year("purchase_date")}
    )
    w.write(start, "silver", "fact_fuel", ["year"])

    def arrive(name, lines):
        exports.write(f"{tmp_path}/{name}", {"fuel_purchases": lines})
        import os
        os.makedirs(landing, exist_ok=True)
        os.link(f"{tmp_path}/{name}/fuel_purchases.csv", f"{landing}/{name}.csv")

    def take():
        q = merge_batches(
            arriving_rows(spark, landing, "fuel_purchases"),
            w,
            "fuel_purchases",
            {"year": "year(purchase_date)"},
            f"{tmp_path}/cp",
        )
        q.awaitTermination()
        assert q.exception() is None

    arrive("a", first)
    take()
    assert w.read("silver", "fact_fuel").count() == 300
    arrive("b", [*second, ["FUELBAD", "", "", "", "no date", "", "", "", "", "", ""]])
    take()
    import time
    time.sleep(1.1)
    arrive("c", [corrected])
    take()
    got = w.read("silver", "fact_fuel")
    assert got.count() == len({r[0] for r in rows})
    assert str(got.where(F.col("fuel_purchase_id") == rows[10][0]).first()["total_cost"]) == "1.00"
    # A file with an older time that comes later replaces nothing.
    corrected[9] = "2.00"
    arrive("d", [corrected])
    import os
    os.utime(f"{landing}/d.csv", (1_000_000_000, 1_000_000_000))
    take()
    got = w.read("silver", "fact_fuel")
    assert str(got.where(F.col("fuel_purchase_id") == rows[10][0]).first()["total_cost"]) == "1.00"
    refused = w.read_all("audit", "refused_fact_fuel").collect()
    assert [r["fuel_purchase_id"] for r in refused] == ["FUELBAD"]
