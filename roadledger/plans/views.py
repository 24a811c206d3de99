"""Business views VW-1..VW-11 over the star.

Each view reduces a fact to the view's key before it meets a dimension or
another fact. That keeps the joined sides small, removes hot keys, and avoids
the row multiplication a direct fact-to-fact join would cause. The ``_as_written``
forms give the multiplied totals some reports still quote; they too are computed
from reduced sides, by weighting, never by building the multiplied rows.

Surrogate -1 is the Unknown member: ``sk > 0`` keeps known members only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.functions import pct, safe_ratio
from roadledger.model import UNKNOWN_KEY
from roadledger.operators.conform import at_members, is_known, with_attributes

DELIVERY = "Delivery"
PICKUP = "Pickup"


def _rows() -> Column:
    return F.count(F.lit(1))


def _is_delivery() -> Column:
    return F.col("event_type") == DELIVERY


def _events_per(fact_delivery: DataFrame, *keys: str, detention: bool = False) -> DataFrame:
    """Event counts at the grain of ``keys``, reduced before any join; on demand with the
    sum and number of waiting times."""
    waiting = [
        F.sum("detention_minutes").alias("_minutes"),
        F.count("detention_minutes").alias("_timed"),
    ]
    return fact_delivery.groupBy(*keys).agg(
        *(waiting if detention else []),
        F.count("event_id").alias("_events"),
        F.count_if(F.col("on_time_flag")).alias("_on_time"),
        F.count_if(_is_delivery()).alias("_deliveries"),
        F.count_if(_is_delivery() & F.col("on_time_flag")).alias("_on_time_deliveries"),
    )


def _fan_out() -> Column:
    """Rows one fact row becomes in a left join to its events."""
    return F.greatest(F.coalesce("_events", F.lit(0)), F.lit(1))


def _on_time_pct() -> Column:
    return pct(F.sum("_on_time"), F.sum("_events"))


def _delivery_on_time_pct() -> Column:
    return pct(F.sum("_on_time_deliveries"), F.sum("_deliveries"))


def one_row(frames: list[DataFrame]) -> DataFrame:
    """One-row aggregates side by side, without a join."""
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), frames
    )
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def kpi_overview(
    fact_load: DataFrame,
    fact_trip: DataFrame,
    fact_delivery: DataFrame,
    fact_fuel: DataFrame,
    fact_maintenance: DataFrame,
    fact_incident: DataFrame,
    fact_truck_monthly: DataFrame,
    members: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """VW-1: twelve headline numbers (and all events) in one row.

    ``members`` has the dimensions by surrogate name if the trips carry natural keys.
    """

    def known(per_key: DataFrame, sk: str) -> DataFrame:
        if members is None:
            return per_key.withColumn("_known", is_known(per_key, sk))
        own = members[sk].select(F.col(sk), F.lit(True).alias("_known"))
        return per_key.join(own, sk, "left")

    # Distinct drivers fall out of the totals when those are summed per driver
    # first; two distinct counts in one aggregate would expand every row.
    per_driver = fact_trip.groupBy("driver_sk").agg(
        _rows().alias("_trips"),
        F.sum("actual_distance_miles").alias("_miles"),
        F.sum("average_mpg").alias("_mpg"),
        F.count("average_mpg").alias("_measured"),
    )
    trips = (
        known(per_driver, "driver_sk")
        .agg(
            F.coalesce(F.sum("_trips"), F.lit(0)).alias("total_trips"),
            F.sum("_miles").alias("total_miles"),
            safe_ratio(F.sum("_mpg"), F.sum("_measured")).alias("avg_mpg"),
            F.count_if("_known").alias("active_drivers"),
        )
    )
    per_truck = fact_trip.groupBy("truck_sk").agg(_rows().alias("_trips"))
    trucks = known(per_truck, "truck_sk").agg(F.count_if("_known").alias("active_trucks"))
    events = fact_delivery.agg(
        F.count_if(_is_delivery()).alias("delivery_events"),
        _rows().alias("all_events"),
        pct(
            F.count_if(_is_delivery() & F.col("on_time_flag")),
            F.count_if(_is_delivery()),
        ).alias("on_time_delivery_pct"),
    )
    loads = fact_load.agg(F.sum("gross_revenue").alias("gross_revenue"))
    fuel = fact_fuel.agg(F.sum("total_cost").alias("fuel_cost"))
    maintenance = fact_maintenance.agg(F.sum("total_cost").alias("maintenance_cost"))
    claims = fact_incident.agg(F.sum("claim_amount").alias("claims_total"))
    utilization = fact_truck_monthly.agg(
        pct(F.sum("utilization_rate"), F.count("utilization_rate")).alias(
            "avg_utilization_pct"
        )
    )
    return one_row(
        [trips, trucks, events, loads, fuel, maintenance, claims, utilization]
    ).select(
        "total_trips",
        "delivery_events",
        "all_events",
        "gross_revenue",
        "total_miles",
        "avg_mpg",
        "fuel_cost",
        "maintenance_cost",
        "claims_total",
        "on_time_delivery_pct",
        "avg_utilization_pct",
        "active_drivers",
        "active_trucks",
    )


def load_profitability(
    fact_load: DataFrame,
    dim_customer: DataFrame,
    dim_route: DataFrame,
    calendar: DataFrame,
) -> DataFrame:
    """VW-2: one row per load with its money and revenue per 1,000 lbs."""
    named = with_attributes(
        fact_load, dim_customer, "customer_sk", ["customer_name"], ["load_id"]
    )
    return (
        with_attributes(named, dim_route, "route_sk", ["corridor"], ["load_id"])
        .join(
            calendar.select(F.col("date_id").alias("date_sk"), "year_nbr"), "date_sk"
        )
        .select(
            "load_id",
            "customer_name",
            "corridor",
            "year_nbr",
            "load_type",
            "booking_type",
            "weight_lbs",
            "revenue",
            "fuel_surcharge",
            "accessorial_charges",
            "gross_revenue",
            safe_ratio(F.col("gross_revenue") * 1000, F.col("weight_lbs")).alias(
                "revenue_per_1k_lbs"
            ),
        )
    )


def route_performance(fact_load: DataFrame, dim_route: DataFrame) -> DataFrame:
    """VW-3: loads and revenue per route.

    ``load_id`` is the fact's primary key, so counting rows counts loads without
    the shuffle a distinct count needs. ``revenue_per_mile`` divides by the lane
    length; ``revenue_per_loaded_mile`` by lane length times loads.
    """
    per_route = fact_load.groupBy("route_sk").agg(
        F.count("load_id").alias("loads"),
        F.sum("gross_revenue").alias("gross_revenue"),
    )
    miles = F.col("typical_distance_miles")
    return at_members(per_route, dim_route, "route_sk").select(
        "route_id",
        "corridor",
        "typical_distance_miles",
        "loads",
        "gross_revenue",
        safe_ratio(F.col("gross_revenue"), miles).alias("revenue_per_mile"),
        safe_ratio(F.col("gross_revenue"), miles * F.col("loads")).alias(
            "revenue_per_loaded_mile"
        ),
    )


def _loads_with_events(fact_load: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    known = fact_delivery.where(F.col("load_sk") != UNKNOWN_KEY)
    per_load = _events_per(known, "load_sk")
    return fact_load.join(
        per_load, fact_load["load_id"] == per_load["load_sk"], "left"
    )


def _service_per_customer(
    fact_load: DataFrame, fact_delivery: DataFrame
) -> DataFrame:
    """Trips and event counts per customer, one fact-to-fact join.

    Distinct trips come from grouping by customer and trip first, which keeps a
    customer with a third of all events from meeting in one task.
    """
    owner = fact_load.select(F.col("load_id").alias("load_sk"), "customer_sk")
    owned = fact_delivery.where(F.col("load_sk") != UNKNOWN_KEY).join(owner, "load_sk")
    return (
        _events_per(owned, "customer_sk", "trip_sk")
        .groupBy("customer_sk")
        .agg(
            F.count("trip_sk").alias("_trips"),
            _on_time_pct().alias("on_time_pct"),
            _delivery_on_time_pct().alias("delivery_on_time_pct"),
        )
    )


def _customer_service(
    per_customer: DataFrame, service: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    return (
        per_customer.join(service, "customer_sk", "left")
        .join(dim_customer, "customer_sk")
        .select(
            "customer_id",
            "customer_name",
            "customer_type",
            "loads",
            "gross_revenue",
            F.coalesce("_trips", F.lit(0)).alias("trips"),
            "on_time_pct",
            "delivery_on_time_pct",
        )
    )


def customer_service(
    fact_load: DataFrame, fact_delivery: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """VW-4: loads, revenue, trips and on-time share per customer."""
    per_customer = fact_load.groupBy("customer_sk").agg(
        F.count("load_id").alias("loads"),
        F.sum("gross_revenue").alias("gross_revenue"),
    )
    service = _service_per_customer(fact_load, fact_delivery)
    return _customer_service(per_customer, service, dim_customer)


def customer_service_as_written(
    fact_load: DataFrame, fact_delivery: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """VW-4 with revenue counted once per delivery event of the load."""
    per_customer = (
        _loads_with_events(fact_load, fact_delivery)
        .groupBy("customer_sk")
        .agg(
            F.count("load_id").alias("loads"),
            F.sum(F.col("gross_revenue") * _fan_out()).alias("gross_revenue"),
        )
    )
    service = _service_per_customer(fact_load, fact_delivery)
    return _customer_service(per_customer, service, dim_customer)


def _trips_with_events(fact_trip: DataFrame, fact_delivery: DataFrame, how: str) -> DataFrame:
    known = fact_delivery.where(F.col("trip_sk") != UNKNOWN_KEY)
    per_trip = _events_per(known, "trip_sk")
    return fact_trip.where(is_known(fact_trip, "driver_sk")).join(
        per_trip, fact_trip["trip_id"] == per_trip["trip_sk"], how
    )


def _driving(times: Column) -> list[Column]:
    """Trip measures of a group, each trip counted ``times`` times."""
    miles = F.sum(F.col("actual_distance_miles") * times)
    hours = F.sum(F.col("actual_duration_hours") * times)
    counted = F.when(F.col("average_mpg").isNotNull(), times)
    return [
        F.sum(times).alias("trips"),
        miles.alias("total_miles"),
        safe_ratio(F.sum(F.col("average_mpg") * times), F.sum(counted)).alias("avg_mpg"),
        F.sum(F.col("idle_time_hours") * times).alias("idle_hours"),
        safe_ratio(miles, hours).alias("avg_speed_mph"),
    ]


def _service() -> list[Column]:
    return [
        _on_time_pct().alias("on_time_pct"),
        _delivery_on_time_pct().alias("delivery_on_time_pct"),
    ]


def _named_drivers(per_driver: DataFrame, dim_driver: DataFrame) -> DataFrame:
    return per_driver.join(dim_driver, "driver_sk").select(
        "driver_id",
        "full_name",
        "home_terminal",
        "years_experience",
        "trips",
        "total_miles",
        "avg_mpg",
        "idle_hours",
        "avg_speed_mph",
        "on_time_pct",
        "delivery_on_time_pct",
    )


def driver_performance(
    fact_trip: DataFrame, fact_delivery: DataFrame, dim_driver: DataFrame
) -> DataFrame:
    """VW-5: trips, miles, mpg, idle time, speed and on-time share per driver."""
    driving = (
        fact_trip.where(is_known(fact_trip, "driver_sk"))
        .groupBy("driver_sk")
        .agg(*_driving(F.lit(1)))
    )
    service = (
        _trips_with_events(fact_trip, fact_delivery, "inner")
        .groupBy("driver_sk")
        .agg(*_service())
    )
    return _named_drivers(driving.join(service, "driver_sk", "left"), dim_driver)


def driver_performance_as_written(
    fact_trip: DataFrame, fact_delivery: DataFrame, dim_driver: DataFrame
) -> DataFrame:
    """VW-5 with each trip counted once per delivery event."""
    both = (
        _trips_with_events(fact_trip, fact_delivery, "left")
        .groupBy("driver_sk")
        .agg(*_driving(_fan_out()), *_service())
    )
    return _named_drivers(both, dim_driver)


def _fleet(
    fact_truck_monthly: DataFrame, fact_trip: DataFrame, dim_truck: DataFrame
) -> DataFrame:
    months = (
        fact_truck_monthly.where(is_known(fact_truck_monthly, "truck_sk"))
        .groupBy("truck_sk")
        .agg(
            _rows().alias("_months"),
            pct(
                F.sum("utilization_rate"), F.count("utilization_rate"), 4
            ).alias("avg_utilization_pct"),
            F.sum("downtime_hours").alias("_downtime"),
            F.sum("maintenance_cost").alias("_maintenance"),
        )
    )
    trips = (
        fact_trip.where(is_known(fact_trip, "truck_sk"))
        .groupBy("truck_sk")
        .agg(
            F.count("trip_id").alias("_trips"),
            F.sum("actual_distance_miles").alias("_miles"),
            F.sum("actual_duration_hours").alias("_hours"),
        )
    )
    return months.join(trips, "truck_sk", "left").join(dim_truck, "truck_sk")


def _fleet_columns(per_trip: Column, per_month: Column) -> list[Column | str]:
    return [
        "truck_id",
        "unit_number",
        "make",
        "model_year",
        "status",
        (F.coalesce("_trips", F.lit(0)) * per_trip).alias("trips"),
        (F.col("_miles") * per_trip).alias("total_miles"),
        (F.col("_hours") * per_trip).alias("total_hours"),
        "avg_utilization_pct",
        (F.col("_downtime") * per_month).alias("downtime_hours"),
        (F.col("_maintenance") * per_month).alias("maintenance_cost"),
    ]


def fleet_utilization(
    fact_truck_monthly: DataFrame, fact_trip: DataFrame, dim_truck: DataFrame
) -> DataFrame:
    """VW-6: trips, miles, hours, utilization, downtime and cost per truck."""
    fleet = _fleet(fact_truck_monthly, fact_trip, dim_truck)
    return fleet.select(*_fleet_columns(F.lit(1), F.lit(1)))


def fleet_utilization_as_written(
    fact_truck_monthly: DataFrame, fact_trip: DataFrame, dim_truck: DataFrame
) -> DataFrame:
    """VW-6 with trips counted once per month row, months once per trip."""
    fleet = _fleet(fact_truck_monthly, fact_trip, dim_truck)
    once_per_trip = F.greatest(F.coalesce("_trips", F.lit(0)), F.lit(1))
    return fleet.select(*_fleet_columns(F.col("_months"), once_per_trip))


def fuel_efficiency(fact_fuel: DataFrame, calendar: DataFrame) -> DataFrame:
    """VW-7: purchases, gallons, cost and unit price per month."""
    days = calendar.select(
        F.col("date_id").alias("date_sk"), "year_nbr", "month_nbr", "month_name"
    )
    gallons, cost = F.sum("gallons"), F.sum("total_cost")
    purchases = F.count("fuel_purchase_id")
    return (
        fact_fuel.join(days, "date_sk")
        .groupBy("year_nbr", "month_nbr", "month_name")
        .agg(
            purchases.alias("purchases"),
            gallons.alias("gallons"),
            cost.alias("fuel_cost"),
            safe_ratio(gallons, purchases).alias("avg_gallons_per_purchase"),
            safe_ratio(cost, gallons).alias("avg_price_per_gallon"),
        )
    )


def _maintenance(
    fact_maintenance: DataFrame, fact_trip: DataFrame, dim_truck: DataFrame
) -> DataFrame:
    events = (
        fact_maintenance.where(is_known(fact_maintenance, "truck_sk"))
        .groupBy("truck_sk")
        .agg(
            F.count("maintenance_id").alias("maintenance_events"),
            F.sum("total_cost").alias("maintenance_cost"),
            F.sum("downtime_hours").alias("downtime_hours"),
        )
    )
    miles = (
        fact_trip.where(is_known(fact_trip, "truck_sk"))
        .groupBy("truck_sk")
        .agg(F.sum("actual_distance_miles").alias("_miles"))
    )
    return events.join(miles, "truck_sk", "left").join(dim_truck, "truck_sk")


def _maintenance_columns(miles: Column) -> list[Column | str]:
    return [
        "truck_id",
        "make",
        "model_year",
        "maintenance_events",
        "maintenance_cost",
        "downtime_hours",
        safe_ratio(F.col("maintenance_cost"), miles).alias("cost_per_mile"),
    ]


def maintenance_analysis(
    fact_maintenance: DataFrame, fact_trip: DataFrame, dim_truck: DataFrame
) -> DataFrame:
    """VW-8: events, cost, downtime and cost per mile driven, per truck."""
    joined = _maintenance(fact_maintenance, fact_trip, dim_truck)
    return joined.select(*_maintenance_columns(F.col("_miles")))


def maintenance_analysis_as_written(
    fact_maintenance: DataFrame, fact_trip: DataFrame, dim_truck: DataFrame
) -> DataFrame:
    """VW-8 with the truck's miles counted once per maintenance event."""
    joined = _maintenance(fact_maintenance, fact_trip, dim_truck)
    return joined.select(
        *_maintenance_columns(F.col("_miles") * F.col("maintenance_events"))
    )


def safety_dashboard(fact_incident: DataFrame, calendar: DataFrame) -> DataFrame:
    """VW-9: incidents, flag counts, damages and claims per year."""
    days = calendar.select(F.col("date_id").alias("date_sk"), "year_nbr")
    return (
        fact_incident.join(days, "date_sk")
        .groupBy("year_nbr")
        .agg(
            F.count("incident_id").alias("incidents"),
            F.count_if(F.col("at_fault_flag")).alias("at_fault"),
            F.count_if(F.col("injury_flag")).alias("with_injury"),
            F.count_if(F.col("preventable_flag")).alias("preventable"),
            F.sum("vehicle_damage_cost").alias("vehicle_damage"),
            F.sum("cargo_damage_cost").alias("cargo_damage"),
            F.sum("claim_amount").alias("claims"),
        )
    )


def monthly_trend(fact_load: DataFrame, calendar: DataFrame) -> DataFrame:
    """VW-10: loads, revenue and weight per month and season."""
    keys = ["year_nbr", "month_nbr", "month_name", "season"]
    days = calendar.select(F.col("date_id").alias("date_sk"), *keys)
    return (
        fact_load.join(days, "date_sk")
        .groupBy(*keys)
        .agg(
            F.count("load_id").alias("loads"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("weight_lbs").alias("total_weight_lbs"),
        )
    )


def _detention(
    fact_delivery: DataFrame,
    dim_facility: DataFrame,
    mean: Callable[[Column, Column], Column],
) -> DataFrame:
    """``mean`` makes the shown mean from a sum and a number of values."""
    per_facility = _events_per(fact_delivery, "facility_sk", detention=True)
    return at_members(per_facility, dim_facility, "facility_sk").select(
        "facility_id",
        "facility_name",
        "city",
        "state",
        F.col("_events").alias("events"),
        F.col("_minutes").alias("detention_minutes"),
        mean(F.col("_minutes"), F.col("_timed")).alias("avg_detention_min"),
        pct(F.col("_on_time"), F.col("_events")).alias("on_time_pct"),
        pct(F.col("_on_time_deliveries"), F.col("_deliveries")).alias("delivery_on_time_pct"),
    )


def truncated_mean(c: Column) -> Column:
    """Integer mean, fraction cut off; NULL for no values."""
    return truncated_ratio(F.sum(c), F.count(c))


def truncated_ratio(total: Column, n: Column) -> Column:
    """Integer part of total / n; NULL for n = 0."""
    quotient = F.try_divide(total.cast("decimal(20,0)"), n.cast("decimal(20,0)"))
    return F.when(quotient < 0, F.ceil(quotient)).otherwise(F.floor(quotient)).cast(
        "bigint"
    )


def detention_analysis(
    fact_delivery: DataFrame, dim_facility: DataFrame
) -> DataFrame:
    """VW-11: events, waiting time and on-time share per facility."""
    return _detention(fact_delivery, dim_facility, safe_ratio)


def detention_analysis_as_written(
    fact_delivery: DataFrame, dim_facility: DataFrame
) -> DataFrame:
    """VW-11 with the mean cut to whole minutes."""
    return _detention(fact_delivery, dim_facility, truncated_ratio)


# View name -> (builder, star tables it reads, in argument order).
VIEWS = {
    "v_kpi_overview": (
        kpi_overview,
        (
            "fact_load",
            "fact_trip",
            "fact_delivery",
            "fact_fuel",
            "fact_maintenance",
            "fact_incident",
            "fact_truck_monthly",
        ),
    ),
    "v_load_profitability": (
        load_profitability,
        ("fact_load", "dim_customer", "dim_route", "dim_date"),
    ),
    "v_route_performance": (route_performance, ("fact_load", "dim_route")),
    "v_customer_service": (
        customer_service,
        ("fact_load", "fact_delivery", "dim_customer"),
    ),
    "v_driver_performance": (
        driver_performance,
        ("fact_trip", "fact_delivery", "dim_driver"),
    ),
    "v_fleet_utilization": (
        fleet_utilization,
        ("fact_truck_monthly", "fact_trip", "dim_truck"),
    ),
    "v_fuel_efficiency": (fuel_efficiency, ("fact_fuel", "dim_date")),
    "v_maintenance_analysis": (
        maintenance_analysis,
        ("fact_maintenance", "fact_trip", "dim_truck"),
    ),
    "v_safety_dashboard": (safety_dashboard, ("fact_incident", "dim_date")),
    "v_monthly_trend": (monthly_trend, ("fact_load", "dim_date")),
    "v_detention_analysis": (detention_analysis, ("fact_delivery", "dim_facility")),
}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Create or replace a temporary view per business view (SNK-8)."""
    for name, (build, inputs) in VIEWS.items():
        build(*[tables[t] for t in inputs]).createOrReplaceTempView(name)
