"""Conformed calendar (SRC-6, FN-11..17, RM-6)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadledger.model import CALENDAR_END, CALENDAR_START

# A calendar of this many days is a few MB, whatever the facts grow to.
BROADCAST_DAYS = 100_000


def calendar(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """One row per day, both ends included.

    The size follows from the two arguments alone, so the frame carries a
    broadcast hint as long as it is at most ``BROADCAST_DAYS`` long.
    """
    days = spark.range(1).select(
        F.explode(
            F.sequence(
                F.lit(start).cast("date"),
                F.lit(end).cast("date"),
                F.expr("interval 1 day"),
            )
        ).alias("date_id")
    )
    d = F.col("date_id")
    weekday = F.dayofweek(d)
    month = F.month(d)
    frame = days.select(
        d,
        F.year(d).alias("year_nbr"),
        month.alias("month_nbr"),
        F.dayofmonth(d).alias("day_nbr"),
        F.quarter(d).alias("quarter_nbr"),
        weekday.alias("weekday_nbr"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("weekday_name"),
        weekday.isin(1, 7).alias("is_weekend"),
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
        .alias("season"),
    )
    length = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    return F.broadcast(frame) if length <= BROADCAST_DAYS else frame


def facts_on(fact: DataFrame, days: DataFrame, year: str = "date_year") -> DataFrame:
    """Fact rows of the calendar days in ``days``, with their calendar columns.

    The year by which stored facts lie takes part in the join. From a filter on any
    calendar column Spark then learns at run time which years are wanted and opens the
    files of those alone.
    """
    on_day = (F.col("date_sk") == F.col("date_id")) & (F.col(year) == F.col("year_nbr"))
    return fact.join(days, on_day).drop("date_id")


def fiscal_columns(frame: DataFrame, first_month: int = 10) -> DataFrame:
    """Add fiscal year and quarter for a fiscal year that opens in ``first_month``
    and is named after the calendar year it ends in."""
    if not 1 <= first_month <= 12:
        raise ValueError("first_month must be 1..12")
    month = F.month("date_id")
    ends_next_year = (month >= first_month) & F.lit(first_month > 1)
    return frame.withColumns(
        {
            "fiscal_year": F.year("date_id") + ends_next_year.cast("int"),
            "fiscal_quarter": (
                F.floor(F.pmod(month - F.lit(first_month), F.lit(12)) / 3) + 1
            ).cast("int"),
        }
    )


# Holidays by month, and either a day or a weekday (1 = Sunday) with its
# place in the month, -1 for the last.
HOLIDAYS = (
    ("New Year's Day", 1, 1, None),
    ("Martin Luther King Day", 1, 2, 3),
    ("Presidents' Day", 2, 2, 3),
    ("Memorial Day", 5, 2, -1),
    ("Juneteenth", 6, 19, None),
    ("Independence Day", 7, 4, None),
    ("Labor Day", 9, 2, 1),
    ("Columbus Day", 10, 2, 2),
    ("Veterans Day", 11, 11, None),
    ("Thanksgiving", 11, 5, 4),
    ("Christmas Day", 12, 25, None),
)


def holiday_columns(frame: DataFrame, holidays=HOLIDAYS) -> DataFrame:
    """Add the holiday's name (NULL on other days) and a flag."""
    d = F.col("date_id")
    place = F.floor((F.dayofmonth(d) - 1) / 7) + 1
    last = F.dayofmonth(d) + 7 > F.dayofmonth(F.last_day(d))
    names = []
    for name, month, day, nth in holidays:
        if nth is None:
            on = F.dayofmonth(d) == day
        else:
            on = (F.dayofweek(d) == day) & (last if nth == -1 else place == nth)
        names.append(F.when((F.month(d) == month) & on, F.lit(name)))
    return frame.withColumn("holiday", F.coalesce(*names)).withColumn(
        "is_holiday", F.col("holiday").isNotNull()
    )
