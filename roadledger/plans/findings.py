"""Findings FD-1..FD-10 over the silver tables, each a small frame.

On-time figures are about deliveries unless a name says otherwise. Percentages
carry one decimal. ``years`` are the full reporting years.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.functions import exact_mean, month_key, pct, safe_ratio, sum0
from roadledger.model import UNKNOWN_KEY
from roadledger.operators.ranking import top_k
from roadledger.operators.statistics import exact_median
from roadledger.plans.rollups import TYPES, _with_load_types
from roadledger.plans.views import DELIVERY, PICKUP, one_row


def _deliveries(fact_delivery: DataFrame) -> DataFrame:
    return fact_delivery.where(F.col("event_type") == DELIVERY)


def _flagged() -> Column:
    return F.col("on_time_flag").cast("int")


def _on_time_pct() -> Column:
    """Share of on-time among events whose flag is known."""
    return pct(F.sum(_flagged()), F.count("on_time_flag"))


def on_time_profile(
    fact_delivery: DataFrame, fact_load: DataFrame, years: Sequence[int]
) -> DataFrame:
    """FD-1: on-time share by year, best and worst month, pickups, load and
    booking type, as (measure, item, value)."""
    timed = fact_delivery.withColumns(
        {
            "year": F.year("scheduled_datetime"),
            "month": month_key(F.col("scheduled_datetime")),
        }
    )
    deliveries = _deliveries(timed)
    in_years = deliveries.where(F.col("year").isin(*years))
    by_year = in_years.groupBy("year").agg(_on_time_pct().alias("value"))
    by_month = in_years.groupBy("month").agg(_on_time_pct().alias("value"))
    pickups = timed.where(F.col("event_type") == PICKUP).agg(
        _on_time_pct().alias("value")
    )
    # One pass over the joined events serves both type breakdowns.
    by_types = (
        _with_load_types(deliveries, fact_load)
        .groupBy(*TYPES)
        .agg(F.sum(_flagged()).alias("_hit"), F.count("on_time_flag").alias("_n"))
        .select(
            "_hit",
            "_n",
            F.expr(
                "stack(2, 'load_type', load_type, 'booking_type', booking_type)"
                " AS (measure, item)"
            ),
        )
        .groupBy("measure", "item")
        .agg(pct(F.sum("_hit"), F.sum("_n")).alias("value"))
    )

    def labelled(frame: DataFrame, measure: str, item: Column) -> DataFrame:
        return frame.select(
            F.lit(measure).alias("measure"), item.cast("string").alias("item"), "value"
        )

    nothing = F.lit("")
    extremes = by_month.agg(
        F.min("value").alias("month_min"), F.max("value").alias("month_max")
    ).select(
        F.expr("stack(2, 'month_min', month_min, 'month_max', month_max) AS (measure, value)")
    )
    return (
        labelled(by_year, "year", F.col("year"))
        .unionByName(extremes.select("measure", nothing.alias("item"), "value"))
        .unionByName(labelled(pickups, "pickup", nothing))
        .unionByName(by_types.select("measure", "item", "value"))
    )


def late_median(fact_delivery: DataFrame) -> DataFrame:
    """FD-2: median lateness in minutes of deliveries that were not on time."""
    late = _deliveries(fact_delivery).where(~F.col("on_time_flag"))
    seconds = F.timestamp_diff(
        "SECOND", F.col("scheduled_datetime"), F.col("actual_datetime")
    )
    median = exact_median(late, seconds, "_median")
    return median.select(F.bround(F.col("_median") / 60, 0).alias("late_median_min"))


def driver_spread(fact_delivery: DataFrame, fact_trip: DataFrame) -> DataFrame:
    """FD-3: spread of driver on-time rates against pure chance.

    ``driver_sd`` is the sample deviation of the rates, ``driver_sd_chance`` the
    binomial one at the overall rate and the median number of deliveries.
    """
    deliveries = _deliveries(fact_delivery).where(F.col("on_time_flag").isNotNull())
    per_trip = (
        deliveries.where(F.col("trip_id") != UNKNOWN_KEY)
        .groupBy("trip_id")
        .agg(F.sum(_flagged()).alias("_hit"), F.count(F.lit(1)).alias("_n"))
    )
    trips = fact_trip.where(F.col("driver_id") != UNKNOWN_KEY).select(
        "trip_id", "driver_id"
    )
    per_driver = (
        per_trip.join(trips, "trip_id")
        .groupBy("driver_id")
        .agg(F.sum("_hit").alias("_hit"), F.sum("_n").alias("_n"))
    )
    rate = F.col("_hit") / F.col("_n")
    spread = per_driver.agg(
        F.stddev_samp(rate).alias("_sd"),
        F.min(rate).alias("_min"),
        F.max(rate).alias("_max"),
        F.count(F.lit(1)).alias("drivers"),
    )
    overall = deliveries.agg((F.sum(_flagged()) / F.count(F.lit(1))).alias("_p"))
    typical = exact_median(per_driver, F.col("_n"), "_median")
    p = F.col("_p")
    chance = F.sqrt(p * (1 - p) / F.col("_median"))
    return one_row([spread, overall, typical]).select(
        F.round(F.col("_sd") * 100, 2).alias("driver_sd"),
        F.round(chance * 100, 2).alias("driver_sd_chance"),
        F.round(F.col("_min") * 100, 1).alias("driver_min"),
        F.round(F.col("_max") * 100, 1).alias("driver_max"),
        "drivers",
    )


def facility_spread(fact_delivery: DataFrame) -> DataFrame:
    """FD-4: range of on-time shares and mean waits over known facilities."""
    per_facility = (
        _deliveries(fact_delivery)
        .where(F.col("facility_id") != UNKNOWN_KEY)
        .groupBy("facility_id")
        .agg(
            _on_time_pct().alias("_ot"),
            exact_mean(F.col("detention_minutes"), 1).alias("_det"),
        )
    )
    return per_facility.agg(
        F.min("_ot").alias("fac_ot_min"),
        F.max("_ot").alias("fac_ot_max"),
        F.min("_det").alias("fac_det_min"),
        F.max("_det").alias("fac_det_max"),
    )


def detention_means(fact_delivery: DataFrame) -> DataFrame:
    """FD-5: mean wait of deliveries, pickups, on-time and late deliveries."""
    minutes = F.col("detention_minutes")
    delivery = F.col("event_type") == DELIVERY
    pickup = F.col("event_type") == PICKUP
    on_time = F.col("on_time_flag")
    return fact_delivery.agg(
        exact_mean(F.when(delivery, minutes), 1).alias("det_delivery"),
        exact_mean(F.when(pickup, minutes), 1).alias("det_pickup"),
        exact_mean(F.when(delivery & on_time, minutes), 1).alias("det_on_time"),
        exact_mean(F.when(delivery & ~on_time, minutes), 1).alias("det_late"),
    )


def fuel_price_effect(
    fact_fuel: DataFrame, fact_trip: DataFrame, years: Sequence[int]
) -> DataFrame:
    """FD-6: unit price and mpg per year; for the last year also the price change
    and the saving against the first year at the gallons bought."""
    first, last = years[0], years[-1]
    fuel = (
        fact_fuel.withColumn("year", F.year("purchase_date"))
        .where(F.col("year").isin(*years))
        .groupBy("year")
        .agg(F.sum("total_cost").alias("_cost"), F.sum("gallons").alias("_gallons"))
    )
    mpg = (
        fact_trip.withColumn("year", F.year("dispatch_date"))
        .where(F.col("year").isin(*years))
        .groupBy("year")
        .agg(exact_mean(F.col("average_mpg"), 2).alias("mpg"))
    )

    def of(year: int, column: str) -> Column:
        return F.max(F.when(F.col("year") == year, F.col(column)))

    price = {y: of(y, "_cost").cast("double") / of(y, "_gallons") for y in (first, last)}
    effect = fuel.agg(
        F.lit(last).alias("year"),
        F.round((price[last] / price[first] - 1) * 100, 1).alias("ppg_change_pct"),
        F.bround(of(last, "_gallons") * (price[first] - price[last]), 0).alias("saving"),
    )
    price_rows = fuel.select(
        "year",
        safe_ratio(F.col("_cost"), F.col("_gallons"), 3).alias("ppg"),
        F.lit(True).alias("_bought"),
    )
    # The three frames hold at most one row per year each: stacked, not joined.
    stacked = price_rows.unionByName(mpg, allowMissingColumns=True).unionByName(
        effect, allowMissingColumns=True
    )
    columns = ["ppg", "mpg", "ppg_change_pct", "saving"]
    return (
        stacked.groupBy("year")
        .agg(F.max("_bought").alias("_bought"), *[F.max(c).alias(c) for c in columns])
        .where(F.col("_bought"))
        .select("year", *columns)
    )


def account_concentration(
    dim_customer: DataFrame, fact_load: DataFrame, shared_name: str
) -> DataFrame:
    """FD-7: accounts against names, the top account and its share, and the
    accounts and revenue behind one shared name."""
    accounts = dim_customer.select("customer_id", "customer_name")
    # Ids are unique in the dimension, names are not.
    counts = (
        accounts.groupBy("customer_name")
        .agg(F.count("customer_id").alias("_n"))
        .agg(
            sum0(F.col("_n")).alias("accounts"),
            F.count("customer_name").alias("names"),
            sum0(F.when(F.col("customer_name") == shared_name, F.col("_n"))).alias(
                "shared_name_accounts"
            ),
        )
    )
    gross = fact_load.groupBy("customer_id").agg(F.sum("gross_revenue").alias("_gross"))
    # Revenue without an account is neither ranked nor part of the total.
    keyed = gross.where(F.col("customer_id") != UNKNOWN_KEY)
    total = keyed.agg(F.sum("_gross").alias("_total"))
    known = keyed.join(accounts, "customer_id")
    top = top_k(known, "_gross", 1, ["customer_id"]).select(
        F.col("customer_id").alias("top_id"),
        F.col("customer_name").alias("top_name"),
        F.col("_gross").alias("_top_gross"),
    )
    shared = known.where(F.col("customer_name") == shared_name).agg(
        F.sum("_gross").alias("_shared_gross")
    )
    return one_row([counts, total, top, shared]).select(
        "accounts",
        "names",
        "top_id",
        "top_name",
        F.bround("_top_gross", 0).alias("top_gross"),
        pct(F.col("_top_gross"), F.col("_total"), 2).alias("top_share"),
        "shared_name_accounts",
        F.bround(F.coalesce("_shared_gross", F.lit(0)), 0).alias("shared_name_gross"),
    )


def unassigned_trips(fact_trip: DataFrame, fact_load: DataFrame) -> DataFrame:
    """FD-8 and DQ-15: share, number and revenue of trips without a known truck.

    Only those trips, about one in fifty, enter the join.
    """
    unknown = F.col("truck_id") == UNKNOWN_KEY
    counts = fact_trip.agg(
        F.count(F.lit(1)).alias("_trips"), F.count_if(unknown).alias("unassigned_trips")
    )
    per_load = (
        fact_trip.where(unknown & (F.col("load_id") != UNKNOWN_KEY))
        .groupBy("load_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    revenue = per_load.join(fact_load.select("load_id", "gross_revenue"), "load_id").agg(
        F.sum(F.col("gross_revenue") * F.col("_n")).alias("_revenue")
    )
    return one_row([counts, revenue]).select(
        pct(F.col("unassigned_trips"), F.col("_trips")).alias("unassigned_share"),
        "unassigned_trips",
        F.bround(F.coalesce("_revenue", F.lit(0)), 0).alias("unassigned_revenue"),
    )


def fleet_metrics(fact_truck_monthly: DataFrame, dim_truck: DataFrame) -> DataFrame:
    """FD-9: trucks with metrics against the fleet, utilization range and its
    correlation with mpg over trucks."""
    per_truck = fact_truck_monthly.groupBy("truck_id").agg(
        pct(F.sum("utilization_rate"), F.count("utilization_rate")).alias("_pct"),
        (F.sum("utilization_rate").cast("double") / F.count("utilization_rate")).alias("_u"),
        (F.sum("average_mpg").cast("double") / F.count("average_mpg")).alias("_m"),
    )
    metrics = per_truck.where(F.col("truck_id") != UNKNOWN_KEY).agg(
        F.count(F.lit(1)).alias("trucks_with_metrics"),
        F.min("_pct").alias("util_min"),
        F.max("_pct").alias("util_max"),
        F.round(F.corr("_u", "_m"), 2).alias("util_mpg_r"),
    )
    fleet = dim_truck.agg(F.count(F.lit(1)).alias("trucks_total"))
    return one_row([metrics, fleet])


def out_of_window(
    fact_fuel: DataFrame, fact_delivery: DataFrame, year: int
) -> DataFrame:
    """FD-10: fuel rows, fuel cost and events of the partial year."""
    fuel = fact_fuel.where(F.year("purchase_date") == year).agg(
        F.count(F.lit(1)).alias("fuel_rows"),
        F.bround(sum0(F.col("total_cost")), 0).alias("fuel_cost"),
    )
    events = fact_delivery.where(F.year("scheduled_datetime") == year).agg(
        F.count(F.lit(1)).alias("events")
    )
    return one_row([fuel, events])
