"""KPI queries KPI-1..KPI-11 over the star.

Money in the formatted reports is text with thousands separators. Every top-k
breaks ties by the displayed key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadledger.functions import exact_mean, format_n0, pct, safe_ratio
from roadledger.model import UNKNOWN_KEY
from roadledger.operators.conform import at_members, is_known
from roadledger.operators.ranking import top_k
from roadledger.plans.views import DELIVERY, one_row

TOP = 5


def _years(calendar: DataFrame) -> DataFrame:
    return calendar.select(F.col("date_id").alias("date_sk"), "year_nbr")


def _on_time() -> Column:
    return F.count_if(F.col("on_time_flag"))


def scorecard(overview: DataFrame) -> DataFrame:
    """KPI-1: the headline row, formatted."""
    return overview.select(
        "total_trips",
        "delivery_events",
        format_n0(F.col("gross_revenue")).alias("gross_revenue"),
        format_n0(F.col("total_miles")).alias("total_miles"),
        F.round("avg_mpg", 2).alias("avg_mpg"),
        format_n0(F.col("fuel_cost")).alias("fuel_cost"),
        format_n0(F.col("maintenance_cost")).alias("maintenance_cost"),
        format_n0(F.col("claims_total")).alias("claims_total"),
        "on_time_delivery_pct",
        "avg_utilization_pct",
        "active_drivers",
        "active_trucks",
    )


def on_time_by_year(fact_delivery: DataFrame, calendar: DataFrame) -> DataFrame:
    """KPI-2: deliveries and on-time share per year."""
    events = F.count("event_id")
    return (
        fact_delivery.where(F.col("event_type") == DELIVERY)
        .join(_years(calendar), "date_sk")
        .groupBy("year_nbr")
        .agg(
            events.alias("delivery_events"),
            _on_time().alias("on_time"),
            pct(_on_time(), events).alias("on_time_pct"),
        )
        .orderBy("year_nbr")
    )


def revenue_by_year(fact_load: DataFrame, calendar: DataFrame) -> DataFrame:
    """KPI-3: loads, gross and base revenue per year, formatted."""
    return (
        fact_load.join(_years(calendar), "date_sk")
        .groupBy("year_nbr")
        .agg(
            F.count("load_id").alias("loads"),
            format_n0(F.sum("gross_revenue")).alias("gross_revenue"),
            format_n0(F.sum("revenue")).alias("base_revenue"),
        )
        .orderBy("year_nbr")
    )


def _per_member(fact_load: DataFrame, sk: str) -> DataFrame:
    """Loads and revenue per dimension member, reduced before the dimension join."""
    return fact_load.groupBy(sk).agg(
        F.count("load_id").alias("_loads"), F.sum("gross_revenue").alias("_gross")
    )


def _best_by_revenue(frame: DataFrame, keys: list[str]) -> DataFrame:
    grouped = frame.groupBy(*keys).agg(
        F.sum("_loads").alias("loads"), F.sum("_gross").alias("_gross")
    )
    return top_k(grouped, "_gross", TOP, keys)


def top_corridors(fact_load: DataFrame, dim_route: DataFrame) -> DataFrame:
    """KPI-4: five corridors with the largest revenue."""
    miles = F.col("typical_distance_miles")
    best = _best_by_revenue(
        at_members(_per_member(fact_load, "route_sk"), dim_route, "route_sk"),
        ["corridor", "typical_distance_miles"],
    )
    return best.select(
        "corridor",
        "loads",
        format_n0(F.col("_gross")).alias("gross_revenue"),
        safe_ratio(F.col("_gross"), miles, 2).alias("revenue_per_mile"),
    )


def top_customer_names(fact_load: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """KPI-5: five customer names with the largest revenue (accounts that share
    a name and type count as one)."""
    best = _best_by_revenue(
        at_members(_per_member(fact_load, "customer_sk"), dim_customer, "customer_sk"),
        ["customer_name", "customer_type"],
    )
    return best.select(
        "customer_name",
        "customer_type",
        "loads",
        format_n0(F.col("_gross")).alias("gross_revenue"),
    )


def top_customer_accounts(fact_load: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """KPI-5 per account instead of per name."""
    best = _best_by_revenue(
        at_members(_per_member(fact_load, "customer_sk"), dim_customer, "customer_sk"),
        ["customer_id", "customer_name", "customer_type"],
    )
    return best.select(
        "customer_id",
        "customer_name",
        "customer_type",
        "loads",
        format_n0(F.col("_gross")).alias("gross_revenue"),
    )


def top_trucks(fact_truck_monthly: DataFrame, dim_truck: DataFrame) -> DataFrame:
    """KPI-6: five known trucks with the highest mean utilization."""
    per_truck = (
        fact_truck_monthly.where(is_known(fact_truck_monthly, "truck_sk"))
        .groupBy("truck_sk")
        .agg(
            pct(F.sum("utilization_rate"), F.count("utilization_rate"), 8).alias(
                "_utilization"
            ),
            pct(F.sum("utilization_rate"), F.count("utilization_rate")).alias(
                "avg_utilization_pct"
            ),
            F.sum("downtime_hours").alias("downtime_hours"),
            F.sum("maintenance_cost").alias("maintenance_cost"),
        )
    )
    best = top_k(
        per_truck.join(dim_truck, "truck_sk"), "_utilization", TOP, ["truck_id"]
    )
    return best.select(
        "truck_id",
        "make",
        "model_year",
        "avg_utilization_pct",
        "downtime_hours",
        "maintenance_cost",
    )


def fuel_by_year(fact_fuel: DataFrame, calendar: DataFrame) -> DataFrame:
    """KPI-7: gallons, cost and unit price per year."""
    gallons, cost = F.sum("gallons"), F.sum("total_cost")
    return (
        fact_fuel.join(_years(calendar), "date_sk")
        .groupBy("year_nbr")
        .agg(
            format_n0(gallons).alias("gallons"),
            format_n0(cost).alias("fuel_cost"),
            safe_ratio(cost, gallons, 3).alias("avg_price_per_gallon"),
        )
        .orderBy("year_nbr")
    )


def detention_hotspots(fact_delivery: DataFrame, dim_facility: DataFrame) -> DataFrame:
    """KPI-8: five facilities with the longest mean wait; both on-time shares."""
    delivery = F.col("event_type") == DELIVERY
    per_facility = fact_delivery.groupBy("facility_sk").agg(
        F.count("event_id").alias("_events"),
        F.sum("detention_minutes").alias("_minutes"),
        F.count("detention_minutes").alias("_timed"),
        _on_time().alias("_on_time"),
        F.count_if(delivery).alias("_deliveries"),
        F.count_if(delivery & F.col("on_time_flag")).alias("_on_time_deliveries"),
    )
    minutes, timed = F.sum("_minutes"), F.sum("_timed")
    per_name = (
        at_members(per_facility, dim_facility, "facility_sk")
        .groupBy("facility_name", "city")
        .agg(
            F.sum("_events").alias("events"),
            safe_ratio(minutes, timed, 8).alias("_mean"),
            safe_ratio(minutes, timed, 1).alias("avg_detention_min"),
            pct(F.sum("_on_time"), F.sum("_events")).alias("on_time_pct"),
            pct(F.sum("_on_time_deliveries"), F.sum("_deliveries")).alias(
                "delivery_on_time_pct"
            ),
        )
    )
    return top_k(per_name, "_mean", TOP, ["facility_name", "city"]).drop("_mean")


def on_time_by_corridor(
    fact_delivery: DataFrame, fact_load: DataFrame, dim_route: DataFrame
) -> DataFrame:
    """KPI-9: deliveries and on-time share per corridor, worst first.

    Events shrink to one row per load, loads to one row per route, and only then
    is the corridor looked up.
    """
    per_load = (
        fact_delivery.where(
            (F.col("event_type") == DELIVERY) & (F.col("load_sk") != UNKNOWN_KEY)
        )
        .groupBy("load_sk")
        .agg(F.count("event_id").alias("_events"), _on_time().alias("_on_time"))
    )
    lanes = fact_load.select(F.col("load_id").alias("load_sk"), "route_sk")
    per_route = (
        per_load.join(lanes, "load_sk")
        .groupBy("route_sk")
        .agg(F.sum("_events").alias("_events"), F.sum("_on_time").alias("_on_time"))
    )
    events, on_time = F.sum("_events"), F.sum("_on_time")
    return (
        at_members(per_route, dim_route, "route_sk")
        .groupBy("corridor")
        .agg(
            events.alias("events"),
            on_time.alias("on_time"),
            pct(on_time, events).alias("on_time_pct"),
        )
        .orderBy("on_time_pct", "corridor")
    )


def derived_kpis(
    fact_trip: DataFrame,
    fact_maintenance: DataFrame,
    fact_incident: DataFrame,
    fact_fuel: DataFrame,
    fact_load: DataFrame,
    fact_delivery: DataFrame,
) -> DataFrame:
    """KPI-10: documented fleet-wide ratios in one row."""
    totals = one_row(
        [
            fact_trip.agg(
                F.count(F.lit(1)).alias("_trips"),
                F.sum("actual_distance_miles").alias("_miles"),
            ),
            fact_maintenance.agg(
                F.count(F.lit(1)).alias("_services"),
                F.sum("total_cost").alias("_service_cost"),
            ),
            fact_incident.agg(
                F.count(F.lit(1)).alias("_incidents"),
                F.count_if(F.col("preventable_flag")).alias("_preventable"),
                F.count_if(F.col("at_fault_flag")).alias("_at_fault"),
            ),
            fact_fuel.agg(F.sum("total_cost").alias("_fuel")),
            fact_load.agg(F.sum("gross_revenue").alias("_gross")),
            fact_delivery.agg(
                exact_mean(F.col("detention_minutes"), 1).alias("avg_detention_min")
            ),
        ]
    )
    c = F.col
    return totals.select(
        safe_ratio(c("_miles"), c("_trips"), 1).alias("avg_miles_per_trip"),
        safe_ratio(c("_service_cost"), c("_services"), 2).alias(
            "avg_cost_per_maintenance_event"
        ),
        safe_ratio(c("_service_cost"), c("_miles")).alias("maintenance_cost_per_mile"),
        safe_ratio(c("_incidents").cast("decimal(20,0)") * 1000000, c("_miles"), 2).alias(
            "incidents_per_million_miles"
        ),
        pct(c("_preventable"), c("_incidents")).alias("preventable_pct"),
        pct(c("_at_fault"), c("_incidents")).alias("at_fault_pct"),
        pct(c("_fuel"), c("_gross")).alias("fuel_pct_of_gross"),
        "avg_detention_min",
    )


def underused_trucks(
    fact_truck_monthly: DataFrame, dim_truck: DataFrame, floor_pct: float = 75.0
) -> DataFrame:
    """KPI-11: known trucks whose mean utilization is under the floor."""
    per_truck = (
        fact_truck_monthly.where(is_known(fact_truck_monthly, "truck_sk"))
        .groupBy("truck_sk")
        .agg(
            pct(F.sum("utilization_rate"), F.count("utilization_rate"), 4).alias(
                "avg_utilization_pct"
            )
        )
        .where(F.col("avg_utilization_pct") < F.lit(floor_pct).cast("decimal(9,4)"))
    )
    return per_truck.join(dim_truck, "truck_sk").select(
        "truck_id", "make", "model_year", "avg_utilization_pct"
    )


def costly_trucks(maintenance: DataFrame, cap: float = 0.10) -> DataFrame:
    """KPI-11: trucks of the maintenance view that cost more per mile than the cap."""
    return maintenance.where(
        F.col("cost_per_mile") > F.lit(cap).cast("decimal(9,4)")
    ).select("truck_id", "make", "model_year", "maintenance_cost", "cost_per_mile")


def low_mpg_truck_months(fact_truck_monthly: DataFrame, dim_truck: DataFrame) -> DataFrame:
    """KPI-11: per month the fifth of known trucks with the lowest mpg.

    Trucks are counted per month and mpg value, so the running total covers the
    values of a month, not its fleet. Values wholly under the fifth need no
    ranking; only the trucks of the one value that crosses it are ranked, by id.
    """
    known = fact_truck_monthly.where(
        is_known(fact_truck_monthly, "truck_sk") & F.col("average_mpg").isNotNull()
    ).join(dim_truck.select("truck_sk", "truck_id"), "truck_sk")
    value = ["date_sk", "average_mpg"]
    month = Window.partitionBy("date_sk")
    counted = known.groupBy(*value).agg(F.count(F.lit(1)).alias("_n"))
    fifth = F.ceil(F.sum("_n").over(month) / 5)
    upto = F.sum("_n").over(month.orderBy("average_mpg"))
    room = counted.select(*value, "_n", (fifth - upto + F.col("_n")).alias("_room"))
    low = known.join(room.where("_room > 0"), value)
    whole = low.where("_n <= _room")
    ranked = Window.partitionBy(*value).orderBy("truck_id")
    crossing = (
        low.where("_n > _room")
        .withColumn("_rank", F.row_number().over(ranked))
        .where("_rank <= _room")
    )
    columns = ["truck_id", "date_sk", "average_mpg"]
    return whole.select(*columns).unionByName(crossing.select(*columns))
