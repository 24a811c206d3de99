import pytest
from pyspark.sql import functions as F

from roadledger.session import DEFAULTS, build_session
from roadledger.sources.calendar import BROADCAST_DAYS, calendar, fiscal_columns
from roadledger.sources.delimited import read_typed
from roadledger.sources.tables import Warehouse, shared_folder
from tests import exports


def test_facts_bucketed_alike_join_without_a_shuffle(spark):
    w = Warehouse(spark, "unused")
    w.create_schemas()
    ids = spark.range(2000).select(F.col("id").cast("string").alias("load_id"), "id")
    w.create_table_as(ids, "gold", "a", ["load_id"], 4)
    w.create_table_as(ids, "gold", "b", ["load_id"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("gold.a").join(spark.table("gold.b"), "load_id")
        assert "Exchange" not in joined._jdf.queryExecution().toString()
        assert joined.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    w.create_table_as(ids.limit(5), "gold", "a")
    assert spark.table("gold.a").count() == 5


def test_unknown_layer_is_refused(spark):
    with pytest.raises(ValueError):
        Warehouse(spark, "x").path("tin", "t")


class Session:
    """Stands for a session with given settings."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_shared_folder_comes_from_the_session():
    named = Session(spark_checkpoint_dir="/shared/cp/")
    assert shared_folder(named) == shared_folder(named, "/mine") == "/shared/cp"
    assert shared_folder(Session(), "/mine/") == "/mine"
    with pytest.raises(ValueError):
        shared_folder(Session())


def test_session_keeps_its_defaults_and_takes_overrides(spark):
    # getOrCreate hands back the running session with runtime settings applied.
    before = {k: spark.conf.get(k, None) for k in DEFAULTS}
    try:
        got = build_session(spark__sql__shuffle__partitions="8")
        assert got.conf.get("spark.sql.shuffle.partitions") == "8"
        assert got.conf.get("spark.sql.sources.fileCompressionFactor") == "4.0"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 1461
    row = days.where("date_id = '2024-02-29'").first()
    assert (row["weekday_nbr"], row["weekday_name"], row["season"]) == (5, "Thursday", "Winter")
    assert days.where("is_weekend").select("weekday_nbr").distinct().count() == 2
    plan = days._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan.lower()
    long = calendar(spark, "1000-01-01", "1999-12-31")
    assert long.count() > BROADCAST_DAYS
    assert "hint" not in long._jdf.queryExecution().logical().toString().lower()


def test_fiscal_columns(spark):
    days = spark.sql("SELECT DATE'2022-09-30' date_id UNION ALL SELECT DATE'2022-10-01'")
    got = [(r.fiscal_year, r.fiscal_quarter) for r in fiscal_columns(days).orderBy("date_id").collect()]
    assert got == [(2022, 4), (2023, 1)]
    plain = fiscal_columns(days, 1).orderBy("date_id").collect()
    assert [(r.fiscal_year, r.fiscal_quarter) for r in plain] == [(2022, 3), (2022, 4)]


def test_read_typed_skips_short_lines(spark, tmp_path):
    exports.write(str(tmp_path))
    loads = read_typed(spark, str(tmp_path), "loads")
    assert dict(loads.dtypes)["revenue"] == "decimal(12,2)"
    assert loads.count() == exports.LOADS
