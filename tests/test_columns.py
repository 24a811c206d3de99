from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roadledger import functions as R


def values(spark, texts, column):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("c"))).collect()]


def test_clean_strips_blanks_only(spark):
    got = values(spark, [" a ", "", "   ", None, "\t", "b"], R.clean)
    assert got == ["a", None, None, None, "\t", "b"]


def test_to_int(spark):
    texts = [" 12 ", "3.0", "abc", "", "+5", "99999999999", "-7", "1e3", None]
    assert values(spark, texts, R.to_int) == [12, None, None, None, 5, None, -7, None, None]


def test_to_decimal(spark):
    texts = ["1e3", "1,234", "1.005", "-1.005", "12345678901.23", ".5", "7.", " 3 ", "."]
    got = values(spark, texts, lambda c: R.to_decimal(c, 12, 2))
    want = [None, None, "1.01", "-1.01", None, "0.50", "7.00", "3.00", None]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_to_date(spark):
    texts = ["2022-01", "01/05/2022", "20220105", "2022-02-30", "2022-03-04 10:11:12", " 2022-01-05 "]
    assert values(spark, texts, R.to_date) == [
        None,
        None,
        None,
        None,
        date(2022, 3, 4),
        date(2022, 1, 5),
    ]


def test_prefix_date(spark):
    texts = ["2022-01-05 08:00:00", "2022-01-05junk", "", "2022-1-5"]
    assert values(spark, texts, R.prefix_date) == [
        date(2022, 1, 5),
        date(2022, 1, 5),
        None,
        None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_to_timestamp_rounds_without_a_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on this day does not exist in New York.
        texts = ["2022-03-13 02:30:00.4", "2022-12-31 23:59:59.5", "2022-01-01", "x"]
        assert values(spark, texts, R.to_timestamp) == [
            datetime(2022, 3, 13, 2, 30),
            datetime(2023, 1, 1),
            datetime(2022, 1, 1),
            None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_flag3(spark):
    texts = ["True", "FALSE", "true  ", "yes", "", None]
    assert values(spark, texts, R.flag3) == [True, False, True, None, None, None]


def test_status(spark):
    assert values(spark, ["Active", None], R.status_or_unknown) == ["Active", "Unknown"]
    assert values(spark, ["Active", "x", None], R.active_flag) == [True, False, False]


def test_join_text_keeps_null(spark):
    assert values(spark, ["a", None], lambda c: R.join_text(c, " -> ", c)) == ["a -> a", None]


def test_ratio_and_pct(spark):
    frame = spark.createDataFrame([(1, 3), (2, 3), (1, 0), (None, 4), (1, 8)], "a int, b int")
    got = [tuple(r) for r in frame.select(
        R.safe_ratio(F.col("a"), F.col("b")), R.pct(F.col("a"), F.col("b"))
    ).collect()]
    assert got == [
        (Decimal("0.3333"), Decimal("33.3")),
        (Decimal("0.6667"), Decimal("66.7")),
        (None, None),
        (None, None),
        (Decimal("0.1250"), Decimal("12.5")),
    ]


def test_ratio_does_not_round_twice(spark):
    # 0.00004999... must stay below the half, and an exact half goes up.
    frame = spark.createDataFrame([("0.4999", 10000), ("0.5", 10000)], "a string, b int")
    a = F.col("a").cast("decimal(12,4)")
    got = [r[0] for r in frame.select(R.safe_ratio(a, F.col("b"))).collect()]
    assert got == [Decimal("0.0000"), Decimal("0.0001")]


def test_format_n0_rounds_half_up(spark):
    texts = ["10.5", "1234567.49", "0", None]
    got = values(spark, texts, lambda c: R.format_n0(c.cast("decimal(12,2)")))
    assert got == ["11", "1,234,567", "0", None]


def test_late_minutes(spark):
    frame = spark.sql(
        "SELECT TIMESTAMP_NTZ'2022-01-01 10:00:00' s, TIMESTAMP_NTZ'2022-01-01 09:59:30' a"
    )
    assert frame.select(R.late_minutes(F.col("s"), F.col("a"))).first()[0] == Decimal("-0.50")
