"""Dashboard roll-ups RU-1..RU-12 over the silver tables.

Attribution is deliberate and differs per roll-up: bookings use the load year,
facilities the event year, drivers the dispatch year. A group that has no
delivery shows 0, not NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.functions import join_text, month_key, sum0
from roadledger.model import UNKNOWN_KEY
from roadledger.plans.views import DELIVERY

TYPES = ["load_type", "booking_type"]


def _rows() -> Column:
    return F.count(F.lit(1))


def _on_time() -> Column:
    return F.count_if(F.col("on_time_flag"))


def _typed_only(frame: DataFrame, *keys: str) -> DataFrame:
    """Rows whose grouping keys are all present; the others form no group."""
    for key in keys:
        frame = frame.where(F.col(key).isNotNull())
    return frame


def _deliveries(fact_delivery: DataFrame) -> DataFrame:
    return fact_delivery.where(F.col("event_type") == DELIVERY)


def _with_load_types(events: DataFrame, fact_load: DataFrame, *extra: str) -> DataFrame:
    """Events with the load's types. Unknown loads have none and leave before
    the shuffle."""
    loads = fact_load.select("load_id", *TYPES, *extra)
    known = events.where(F.col("load_id") != UNKNOWN_KEY)
    return _typed_only(known.join(loads, "load_id"), *TYPES)


def loads_by_month(fact_load: DataFrame) -> DataFrame:
    """RU-1: month x load type x booking type."""
    return (
        _typed_only(fact_load.withColumn("month", month_key(F.col("load_date"))), "month", *TYPES)
        .groupBy("month", *TYPES)
        .agg(
            F.count("load_id").alias("loads"),
            sum0(F.col("gross_revenue")).alias("gross"),
            sum0(F.col("revenue")).alias("revenue"),
            sum0(F.col("fuel_surcharge")).alias("surcharge"),
            sum0(F.col("accessorial_charges")).alias("accessorial"),
        )
    )


def _events_by(events: DataFrame, *keys: str) -> DataFrame:
    """Events counted per load or trip before they meet it."""
    return events.groupBy(*keys).agg(
        F.count("event_id").alias("events"),
        _on_time().alias("on_time"),
        sum0(F.col("detention_minutes")).alias("det"),
    )


def _added(counted: DataFrame, *keys: str) -> DataFrame:
    return counted.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("events", "on_time", "det")])


def deliveries_by_month(fact_delivery: DataFrame, fact_load: DataFrame) -> DataFrame:
    """RU-2: event month x load type x booking type x event type."""
    keys = ["month", *TYPES, "event_type"]
    events = fact_delivery.withColumn("month", month_key(F.col("scheduled_datetime")))
    per_load = _events_by(_typed_only(events, "month", "event_type"), "load_id", "month", "event_type")
    return _added(_with_load_types(per_load, fact_load), *keys)


def _service_per_load(fact_delivery: DataFrame) -> DataFrame:
    """Delivery service of each load, one row per load."""
    return (
        _deliveries(fact_delivery)
        .where(F.col("load_id") != UNKNOWN_KEY)
        .groupBy("load_id")
        .agg(
            F.count("event_id").alias("_deliveries"),
            _on_time().alias("_on_time"),
            sum0(F.col("detention_minutes")).alias("_det"),
        )
    )


def _booked(fact_load: DataFrame, fact_delivery: DataFrame, key: str) -> DataFrame:
    """Loads with their service, grouped by load year, ``key`` and types."""
    loads = fact_load.select(
        "load_id", key, *TYPES, F.year("load_date").alias("year"), "gross_revenue"
    )
    keys = ["year", key, *TYPES]
    return (
        _typed_only(loads, *keys)
        .join(_service_per_load(fact_delivery), "load_id", "left")
        .groupBy(*keys)
        .agg(
            F.count("load_id").alias("loads"),
            sum0(F.col("gross_revenue")).alias("gross"),
            sum0(F.col("_deliveries")).alias("deliveries"),
            sum0(F.col("_on_time")).alias("on_time"),
            sum0(F.col("_det")).alias("det"),
        )
    )


def customers_by_year(fact_load: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    """RU-3: load year x customer x types."""
    return _booked(fact_load, fact_delivery, "customer_id")


def lanes_by_year(fact_load: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    """RU-4: load year x route x types."""
    return _booked(fact_load, fact_delivery, "route_id").drop("det")


def facilities_by_year(fact_delivery: DataFrame, fact_load: DataFrame) -> DataFrame:
    """RU-5: event year x facility x types, deliveries only."""
    keys = ["year", "facility_id", *TYPES]
    events = _deliveries(fact_delivery).withColumn("year", F.year("scheduled_datetime"))
    per_load = _events_by(_typed_only(events, "year", "facility_id"), "load_id", "year", "facility_id")
    return _added(_with_load_types(per_load, fact_load), *keys)


def _trips_with_types(fact_trip: DataFrame, fact_load: DataFrame, *extra: str) -> DataFrame:
    loads = fact_load.select("load_id", *TYPES, *extra)
    known = fact_trip.where(F.col("load_id") != UNKNOWN_KEY)
    return _typed_only(known.join(loads, "load_id"), *TYPES)


def trips_by_month(fact_trip: DataFrame, fact_load: DataFrame) -> DataFrame:
    """RU-6: dispatch month x types, with the unassigned trips and their revenue."""
    unassigned = F.col("truck_id") == UNKNOWN_KEY
    trips = _trips_with_types(fact_trip, fact_load, "gross_revenue").withColumn(
        "month", month_key(F.col("dispatch_date"))
    )
    at_risk = F.when(unassigned, F.col("gross_revenue")).otherwise(F.lit(0))
    return (
        _typed_only(trips, "month")
        .groupBy("month", *TYPES)
        .agg(
            F.count("trip_id").alias("trips"),
            sum0(F.col("actual_distance_miles")).alias("miles"),
            sum0(F.col("average_mpg")).alias("mpg"),
            sum0(F.col("idle_time_hours")).alias("idle"),
            F.count_if(unassigned).alias("unassigned"),
            sum0(at_risk).alias("un_rev"),
        )
    )


def drivers_by_year(
    fact_trip: DataFrame, fact_load: DataFrame, fact_delivery: DataFrame
) -> DataFrame:
    """RU-7: dispatch year x driver x types, deliveries attributed to the trip.

    A delivery counts under the types of its own load, so trips and deliveries
    are grouped apart and joined on the full group key.
    """
    keys = ["year", "driver_id", *TYPES]
    assigned = fact_trip.where(F.col("driver_id") != UNKNOWN_KEY).withColumn(
        "year", F.year("dispatch_date")
    )
    driven = (
        _typed_only(_trips_with_types(assigned, fact_load), "year")
        .groupBy(*keys)
        .agg(
            F.count("trip_id").alias("trips"),
            sum0(F.col("actual_distance_miles")).alias("miles"),
            sum0(F.col("average_mpg")).alias("mpg"),
            sum0(F.col("idle_time_hours")).alias("idle"),
        )
    )
    trips = assigned.select("trip_id", "driver_id", "year")
    events = _deliveries(fact_delivery).where(F.col("trip_id") != UNKNOWN_KEY)
    per_trip = _events_by(events, "trip_id", "load_id").join(trips, "trip_id")
    per_load = _added(per_trip, "load_id", "driver_id", "year")
    served = (
        _added(_with_load_types(per_load, fact_load), *keys)
        .drop("det")
        .withColumnRenamed("events", "deliveries")
    )
    return driven.join(served, keys, "left").fillna(0, ["deliveries", "on_time"])


def trucks_by_year(fact_truck_monthly: DataFrame) -> DataFrame:
    """RU-8: year x truck."""
    return (
        fact_truck_monthly.withColumn("year", F.year("month"))
        .groupBy("year", "truck_id")
        .agg(
            F.count("month").alias("months"),
            sum0(F.col("utilization_rate")).alias("util"),
            sum0(F.col("average_mpg")).alias("mpg"),
            sum0(F.col("trips_completed")).alias("trips"),
            sum0(F.col("total_miles")).alias("miles"),
            sum0(F.col("total_revenue")).alias("revenue"),
            sum0(F.col("maintenance_events")).alias("maint_events"),
            sum0(F.col("maintenance_cost")).alias("maint_cost"),
            sum0(F.col("downtime_hours")).alias("downtime"),
        )
    )


def fuel_by_month(fact_fuel: DataFrame) -> DataFrame:
    """RU-9: month."""
    return (
        _typed_only(fact_fuel.withColumn("month", month_key(F.col("purchase_date"))), "month")
        .groupBy("month")
        .agg(
            F.count("fuel_purchase_id").alias("purchases"),
            sum0(F.col("gallons")).alias("gallons"),
            sum0(F.col("total_cost")).alias("cost"),
        )
    )


def maintenance_by_year(fact_maintenance: DataFrame) -> DataFrame:
    """RU-10: year x maintenance type."""
    frame = fact_maintenance.withColumn("year", F.year("maintenance_date"))
    return (
        _typed_only(frame, "year", "maintenance_type")
        .groupBy("year", "maintenance_type")
        .agg(
            F.count("maintenance_id").alias("events"),
            sum0(F.col("total_cost")).alias("cost"),
            sum0(F.col("downtime_hours")).alias("downtime"),
        )
    )


def safety_rows(fact_incident: DataFrame) -> DataFrame:
    """RU-11: incident rows."""
    return fact_incident.select(
        F.year("incident_date").alias("year"),
        "incident_type",
        "at_fault_flag",
        "injury_flag",
        "preventable_flag",
        "claim_amount",
    )


def customer_lookup(dim_customer: DataFrame) -> DataFrame:
    """RU-12: customer name, type and status."""
    return dim_customer.select(
        "customer_id",
        F.col("customer_name").alias("name"),
        F.col("customer_type").alias("type"),
        F.col("account_status").alias("status"),
    )


def route_lookup(dim_route: DataFrame) -> DataFrame:
    """RU-12: corridor with an arrow, length and full end points."""
    return dim_route.select(
        "route_id",
        join_text(F.col("origin_city"), " → ", F.col("destination_city")).alias(
            "corridor"
        ),
        F.col("typical_distance_miles").alias("miles"),
        join_text(F.col("origin_city"), ", ", F.col("origin_state")).alias("origin"),
        join_text(F.col("destination_city"), ", ", F.col("destination_state")).alias(
            "destination"
        ),
    )


def facility_lookup(dim_facility: DataFrame) -> DataFrame:
    """RU-12: facility name, place and type."""
    return dim_facility.select(
        "facility_id",
        F.col("facility_name").alias("name"),
        "city",
        "state",
        F.col("facility_type").alias("type"),
    )


def driver_lookup(dim_driver: DataFrame) -> DataFrame:
    """RU-12: driver name, terminal, experience and status."""
    return dim_driver.select(
        "driver_id",
        join_text(F.col("first_name"), " ", F.col("last_name")).alias("name"),
        F.col("home_terminal").alias("terminal"),
        F.col("years_experience").alias("experience"),
        F.col("employment_status").alias("status"),
    )


def truck_lookup(dim_truck: DataFrame) -> DataFrame:
    """RU-12: truck unit, make, year, terminal and status."""
    return dim_truck.select(
        "truck_id",
        F.col("unit_number").alias("unit"),
        "make",
        "model_year",
        F.col("home_terminal").alias("terminal"),
        "status",
    )


# Export name -> (builder, silver tables it reads, in argument order).
ROLLUPS = {
    "loads_m": (loads_by_month, ("fact_load",)),
    "deliv_m": (deliveries_by_month, ("fact_delivery", "fact_load")),
    "trips_m": (trips_by_month, ("fact_trip", "fact_load")),
    "cust": (customers_by_year, ("fact_load", "fact_delivery")),
    "lanes": (lanes_by_year, ("fact_load", "fact_delivery")),
    "fac": (facilities_by_year, ("fact_delivery", "fact_load")),
    "drv": (drivers_by_year, ("fact_trip", "fact_load", "fact_delivery")),
    "trucks_y": (trucks_by_year, ("fact_truck_monthly",)),
    "fuel_m": (fuel_by_month, ("fact_fuel",)),
    "maint_y": (maintenance_by_year, ("fact_maintenance",)),
    "safety": (safety_rows, ("fact_incident",)),
    "dim_customers": (customer_lookup, ("dim_customer",)),
    "dim_routes": (route_lookup, ("dim_route",)),
    "dim_facilities": (facility_lookup, ("dim_facility",)),
    "dim_drivers": (driver_lookup, ("dim_driver",)),
    "dim_trucks": (truck_lookup, ("dim_truck",)),
}
