"""Monthly aggregate layer and finer calendars (RM-5, RM-6)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadledger.functions import sum0
from roadledger.operators.distinct import bitmaps, distinct_members
from roadledger.sources.calendar import fiscal_columns, holiday_columns
from roadledger.sources.tables import Warehouse

MONTH = "month"
YEAR = "date_year"
MEMBER = "member"


def monthly_loads(fact_load: DataFrame) -> DataFrame:
    """Star loads per month, customer and route."""
    return fact_load.groupBy(
        F.trunc("date_sk", "month").alias("month"), "customer_sk", "route_sk"
    ).agg(
        F.count("load_id").alias("loads"),
        sum0(F.col("gross_revenue")).alias("gross_revenue"),
        sum0(F.col("weight_lbs")).alias("weight_lbs"),
    )


def monthly_members(fact: DataFrame, surrogates: Sequence[str]) -> DataFrame:
    """Bitmaps of the known members of several dimensions per month, from one scan."""
    each = F.explode(
        F.array(
            *[
                F.struct(F.lit(sk).alias(MEMBER), F.col(sk).cast("bigint").alias("sk"))
                for sk in surrogates
            ]
        )
    )
    rows = fact.select(F.trunc("date_sk", "month").alias(MONTH), each.alias("_m"))
    return bitmaps(rows.select(MONTH, "_m.*"), [MONTH, MEMBER], "sk")


def members_per_period(layer: DataFrame, period: str) -> DataFrame:
    """Distinct members per ``period`` ('month', 'year' or 'all') from the monthly maps."""
    periods = {
        "month": F.col(MONTH).cast("string"),
        "year": F.year(MONTH).cast("string"),
        "all": F.lit("all"),
    }
    keys = [periods[period].alias("period"), F.col(MEMBER)]
    return distinct_members(layer, keys, "distinct_members", ["period", MEMBER])


@dataclass(frozen=True)
class MonthlyLayer:
    """An aggregate per month over a stored gold fact, renewed by month (RM-5).

    ``pending`` holds the months whose facts were changed since the layer took them. They
    are noted before the fact is rewritten and cleared after the layer is, so a run that
    breaks in between leaves months to renew, never stale ones. One run writes a layer at
    a time. ``build`` makes rows with a column ``month`` from fact rows, each month's from
    its own rows alone.
    """

    warehouse: Warehouse
    name: str
    fact: str
    build: Callable[[DataFrame], DataFrame]

    @property
    def pending(self) -> str:
        return f"pending_{self.name}"

    def note(self, months: Iterable[tuple] | None) -> None:
        """Mark months, one value per tuple, as changed; None marks every month."""
        noted = [(None, True)] if months is None else [(m, False) for (m,) in months if m]
        frame = self.warehouse.spark.createDataFrame(noted, "month date, everything boolean")
        self.warehouse.append(frame.coalesce(1), "audit", self.pending)

    def touched(self) -> list[date] | None:
        """Months to renew, None for all. The calendar bounds their number."""
        w = self.warehouse
        if not w.exists("gold", self.name) or not w.exists("audit", self.pending):
            return None
        noted = w.read_all("audit", self.pending).distinct().collect()
        if any(r["everything"] for r in noted):
            return None
        return sorted(r[MONTH] for r in noted)

    def rows_of(self, months: Sequence[date]) -> DataFrame:
        """Fact rows of some months: only their years' partitions are opened, and in those
        only row groups whose days fall into the months."""
        wanted = F.lit(False)
        for first in months:
            after = (first + timedelta(days=31)).replace(day=1)
            wanted = wanted | ((F.col("date_sk") >= first) & (F.col("date_sk") < after))
        years = sorted({m.year for m in months})
        return self.warehouse.read("gold", self.fact).where(F.col(YEAR).isin(years)).where(wanted)

    def refresh(self) -> list[date] | None:
        """Renew what is pending; returns the months renewed, None if all were.

        Spark replaces partitions that get rows and cannot empty one that gets none: if a
        month of the layer has lost its last row, the layer is built anew.
        """
        w = self.warehouse
        months = self.touched()
        if months:
            fresh = self.build(self.rows_of(months))
            w.replace_partitions(fresh, "gold", self.name, [MONTH])
            held = w.read_all("gold", self.name).where(F.col(MONTH).isin(months))
            left = {r[0] for r in held.select(MONTH).distinct().collect()}
            if left:
                filled = {
                    r[0]
                    for r in self.rows_of(sorted(left))
                    .select(F.trunc("date_sk", "month"))
                    .distinct()
                    .collect()
                }
                if left - filled:
                    months = None
        if months is None:
            w.write(self.build(w.read("gold", self.fact)), "gold", self.name, [MONTH])
        if months is None or months:
            none = w.spark.createDataFrame([], "month date, everything boolean")
            w.write(none, "audit", self.pending)
        return months


def monthly_layers(warehouse: Warehouse) -> list[MonthlyLayer]:
    """The layers a build keeps."""
    trip_members = ("driver_sk", "truck_sk", "trailer_sk")
    return [
        MonthlyLayer(warehouse, "monthly_layer", "fact_load", monthly_loads),
        MonthlyLayer(
            warehouse,
            "monthly_trip_members",
            "fact_trip",
            lambda trips: monthly_members(trips, trip_members),
        ),
    ]


def fiscal_revenue(
    fact_load: DataFrame, calendar: DataFrame, first_month: int = 10
) -> DataFrame:
    """Loads and revenue per fiscal year and quarter."""
    days = fiscal_columns(calendar, first_month).select(
        F.col("date_id").alias("date_sk"), "fiscal_year", "fiscal_quarter"
    )
    return (
        fact_load.join(days, "date_sk")
        .groupBy("fiscal_year", "fiscal_quarter")
        .agg(
            F.count("load_id").alias("loads"),
            sum0(F.col("gross_revenue")).alias("gross_revenue"),
        )
    )


def holiday_loads(fact_load: DataFrame, calendar: DataFrame) -> DataFrame:
    """Loads and revenue per year and holiday, other days under NULL."""
    days = holiday_columns(calendar).select(
        F.col("date_id").alias("date_sk"), "year_nbr", "holiday"
    )
    per_day = fact_load.groupBy("date_sk").agg(
        F.count("load_id").alias("_loads"), F.sum("gross_revenue").alias("_gross")
    )
    return (
        per_day.join(days, "date_sk")
        .groupBy("year_nbr", "holiday")
        .agg(F.sum("_loads").alias("loads"), sum0(F.col("_gross")).alias("gross_revenue"))
    )


def events_by_hour(fact_delivery: DataFrame) -> DataFrame:
    """Delivery events per hour of the scheduled day."""
    hour = F.hour("scheduled_datetime")
    shift = (
        F.when(hour < 6, "Night")
        .when(hour < 12, "Morning")
        .when(hour < 18, "Afternoon")
        .otherwise("Evening")
    )
    return fact_delivery.groupBy(
        hour.alias("hour_nbr"), shift.alias("day_part"), "event_type"
    ).agg(
        F.count("event_id").alias("events"),
        sum0(F.col("detention_minutes")).alias("detention_minutes"),
    )


def daily_loads(calendar: DataFrame, fact_load: DataFrame) -> DataFrame:
    """Every calendar day with its loads, days without any included."""
    per_day = fact_load.groupBy("date_sk").agg(F.count("load_id").alias("_loads"))
    return (
        calendar.join(per_day, F.col("date_id") == F.col("date_sk"), "left")
        .withColumn("loads", F.coalesce("_loads", F.lit(0)))
        .drop("date_sk", "_loads")
    )
