"""Declared data model: 14 source tables and the star built from them.

``SOURCES`` holds the names, kinds and text widths the source exports fix.
``DIMENSIONS`` and ``FACTS`` say how silver tables narrow to the star.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

UNKNOWN_KEY = "-1"
UNKNOWN_SK = -1

# The calendar every fact joins to, and the reporting years.
CALENDAR_START = "2022-01-01"
CALENDAR_END = "2025-12-31"
REPORT_YEARS = (2022, 2023, 2024)


@dataclass(frozen=True)
class Source:
    """One source table.

    ``columns``: (name, kind, text width) in file order; kinds as in
    ``functions.typed``. ``key``: natural key. ``required``: columns that must
    hold a value. ``parents``: foreign key column -> parent source table.
    """

    name: str
    target: str
    key: tuple[str, ...]
    columns: tuple[tuple[str, str, int], ...]
    required: tuple[str, ...] = ()
    parents: dict[str, str] = field(default_factory=dict)

    @property
    def column_names(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    def staging_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, T.StringType()) for name in self.column_names]
        )


# Source layouts.
SOURCES = {
    s.name: s
    for s in (
        Source(
            "drivers",
            "dim_driver",
            ("driver_id",),
            (
                ("driver_id", "key", 20),
                ("first_name", "text", 50),
                ("last_name", "text", 50),
                ("hire_date", "date", 20),
                ("termination_date", "date", 20),
                ("license_number", "text", 30),
                ("license_state", "text", 5),
                ("date_of_birth", "date", 20),
                ("home_terminal", "text", 50),
                ("employment_status", "text", 20),
                ("cdl_class", "text", 5),
                ("years_experience", "int", 10),
            ),
            required=("first_name", "last_name"),
        ),
        Source(
            "trucks",
            "dim_truck",
            ("truck_id",),
            (
                ("truck_id", "key", 20),
                ("unit_number", "text", 20),
                ("make", "text", 50),
                ("model_year", "int", 10),
                ("vin", "text", 30),
                ("acquisition_date", "date", 20),
                ("acquisition_mileage", "int", 15),
                ("fuel_type", "text", 20),
                ("tank_capacity_gallons", "int", 10),
                ("status", "text", 20),
                ("home_terminal", "text", 50),
            ),
        ),
        Source(
            "trailers",
            "dim_trailer",
            ("trailer_id",),
            (
                ("trailer_id", "key", 20),
                ("trailer_number", "text", 20),
                ("trailer_type", "text", 50),
                ("length_feet", "int", 10),
                ("model_year", "int", 10),
                ("vin", "text", 30),
                ("acquisition_date", "date", 20),
                ("status", "text", 20),
                ("current_location", "text", 50),
            ),
        ),
        Source(
            "customers",
            "dim_customer",
            ("customer_id",),
            (
                ("customer_id", "key", 20),
                ("customer_name", "text", 100),
                ("customer_type", "text", 30),
                ("credit_terms_days", "int", 10),
                ("primary_freight_type", "text", 30),
                ("account_status", "text", 20),
                ("contract_start_date", "date", 20),
                ("annual_revenue_potential", "decimal(12,0)", 15),
            ),
            required=("customer_name",),
        ),
        Source(
            "facilities",
            "dim_facility",
            ("facility_id",),
            (
                ("facility_id", "key", 20),
                ("facility_name", "text", 100),
                ("facility_type", "text", 30),
                ("city", "text", 50),
                ("state", "text", 5),
                ("latitude", "decimal(9,6)", 15),
                ("longitude", "decimal(9,6)", 15),
                ("dock_doors", "int", 10),
                ("operating_hours", "text", 20),
            ),
            required=("facility_name",),
        ),
        Source(
            "routes",
            "dim_route",
            ("route_id",),
            (
                ("route_id", "key", 20),
                ("origin_city", "text", 50),
                ("origin_state", "text", 5),
                ("destination_city", "text", 50),
                ("destination_state", "text", 5),
                ("typical_distance_miles", "int", 10),
                ("base_rate_per_mile", "decimal(6,2)", 10),
                ("fuel_surcharge_rate", "decimal(6,3)", 10),
                ("typical_transit_days", "int", 10),
            ),
        ),
        Source(
            "loads",
            "fact_load",
            ("load_id",),
            (
                ("load_id", "key", 20),
                ("customer_id", "key", 20),
                ("route_id", "key", 20),
                ("load_date", "date", 20),
                ("load_type", "text", 30),
                ("weight_lbs", "decimal(10,0)", 15),
                ("pieces", "int", 10),
                ("revenue", "decimal(12,2)", 15),
                ("fuel_surcharge", "decimal(12,2)", 15),
                ("accessorial_charges", "decimal(12,2)", 15),
                ("load_status", "text", 20),
                ("booking_type", "text", 20),
            ),
            required=("load_date",),
            parents={"customer_id": "customers", "route_id": "routes"},
        ),
        Source(
            "trips",
            "fact_trip",
            ("trip_id",),
            (
                ("trip_id", "key", 20),
                ("load_id", "key", 20),
                ("driver_id", "key", 20),
                ("truck_id", "key", 20),
                ("trailer_id", "key", 20),
                ("dispatch_date", "date", 20),
                ("actual_distance_miles", "decimal(10,1)", 15),
                ("actual_duration_hours", "decimal(7,2)", 10),
                ("fuel_gallons_used", "decimal(10,2)", 15),
                ("average_mpg", "decimal(6,2)", 10),
                ("idle_time_hours", "decimal(7,2)", 10),
                ("trip_status", "text", 20),
            ),
            required=("dispatch_date",),
            parents={
                "load_id": "loads",
                "driver_id": "drivers",
                "truck_id": "trucks",
                "trailer_id": "trailers",
            },
        ),
        Source(
            "fuel_purchases",
            "fact_fuel",
            ("fuel_purchase_id",),
            (
                ("fuel_purchase_id", "key", 20),
                ("trip_id", "key", 20),
                ("truck_id", "key", 20),
                ("driver_id", "key", 20),
                ("purchase_date", "date10", 25),
                ("location_city", "text", 50),
                ("location_state", "text", 5),
                ("gallons", "decimal(10,2)", 15),
                ("price_per_gallon", "decimal(6,3)", 15),
                ("total_cost", "decimal(12,2)", 15),
                ("fuel_card_number", "text", 20),
            ),
            required=("purchase_date",),
            parents={"trip_id": "trips", "truck_id": "trucks", "driver_id": "drivers"},
        ),
        Source(
            "maintenance_records",
            "fact_maintenance",
            ("maintenance_id",),
            (
                ("maintenance_id", "key", 20),
                ("truck_id", "key", 20),
                ("maintenance_date", "date", 20),
                ("maintenance_type", "text", 30),
                ("odometer_reading", "decimal(12,0)", 15),
                ("labor_hours", "decimal(7,2)", 10),
                ("labor_cost", "decimal(12,2)", 15),
                ("parts_cost", "decimal(12,2)", 15),
                ("total_cost", "decimal(12,2)", 15),
                ("facility_location", "text", 50),
                ("downtime_hours", "decimal(7,2)", 10),
                ("service_description", "text", 200),
            ),
            parents={"truck_id": "trucks"},
        ),
        Source(
            "delivery_events",
            "fact_delivery",
            ("event_id",),
            (
                ("event_id", "key", 20),
                ("load_id", "key", 20),
                ("trip_id", "key", 20),
                ("event_type", "text", 20),
                ("facility_id", "key", 20),
                ("scheduled_datetime", "timestamp", 30),
                ("actual_datetime", "timestamp", 30),
                ("detention_minutes", "int", 10),
                ("on_time_flag", "flag", 10),
                ("location_city", "text", 50),
                ("location_state", "text", 5),
            ),
            required=("event_type",),
            parents={
                "load_id": "loads",
                "trip_id": "trips",
                "facility_id": "facilities",
            },
        ),
        Source(
            "safety_incidents",
            "fact_incident",
            ("incident_id",),
            (
                ("incident_id", "key", 20),
                ("trip_id", "key", 20),
                ("truck_id", "key", 20),
                ("driver_id", "key", 20),
                ("incident_date", "date", 20),
                ("incident_type", "text", 30),
                ("location_city", "text", 50),
                ("location_state", "text", 5),
                ("at_fault_flag", "flag", 10),
                ("injury_flag", "flag", 10),
                ("vehicle_damage_cost", "decimal(12,2)", 15),
                ("cargo_damage_cost", "decimal(12,2)", 15),
                ("claim_amount", "decimal(12,2)", 15),
                ("preventable_flag", "flag", 10),
                ("description", "text", 500),
            ),
            parents={"trip_id": "trips", "truck_id": "trucks", "driver_id": "drivers"},
        ),
        Source(
            "driver_monthly_metrics",
            "fact_driver_monthly",
            ("driver_id", "month"),
            (
                ("driver_id", "key", 20),
                ("month", "date", 20),
                ("trips_completed", "int", 10),
                ("total_miles", "decimal(12,1)", 15),
                ("total_revenue", "decimal(12,2)", 15),
                ("average_mpg", "decimal(6,2)", 10),
                ("total_fuel_gallons", "decimal(12,2)", 15),
                ("on_time_delivery_rate", "decimal(6,2)", 10),
                ("average_idle_hours", "decimal(7,2)", 10),
            ),
            required=("month",),
            parents={"driver_id": "drivers"},
        ),
        Source(
            "truck_utilization_metrics",
            "fact_truck_monthly",
            ("truck_id", "month"),
            (
                ("truck_id", "key", 20),
                ("month", "date", 20),
                ("trips_completed", "int", 10),
                ("total_miles", "decimal(12,1)", 15),
                ("total_revenue", "decimal(12,2)", 15),
                ("average_mpg", "decimal(6,2)", 10),
                ("maintenance_events", "int", 10),
                ("maintenance_cost", "decimal(12,2)", 15),
                ("downtime_hours", "decimal(7,2)", 10),
                ("utilization_rate", "decimal(6,3)", 10),
            ),
            required=("month",),
            parents={"truck_id": "trucks"},
        ),
    )
}

# Parents are built before their children.
DIMENSION_SOURCES = (
    "drivers",
    "trucks",
    "trailers",
    "customers",
    "facilities",
    "routes",
)
FACT_SOURCES = (
    "loads",
    "trips",
    "delivery_events",
    "fuel_purchases",
    "maintenance_records",
    "safety_incidents",
    "driver_monthly_metrics",
    "truck_utilization_metrics",
)


@dataclass(frozen=True)
class Dimension:
    """A star dimension: surrogate key, natural key, kept attributes and the
    values its Unknown member shows (attributes not named are NULL)."""

    name: str
    key: str
    sk: str
    attributes: tuple[str, ...]
    unknown: dict[str, str] = field(default_factory=dict)


DIMENSIONS = {
    d.name: d
    for d in (
        Dimension(
            "dim_driver",
            "driver_id",
            "driver_sk",
            (
                "full_name",
                "home_terminal",
                "employment_status",
                "cdl_class",
                "years_experience",
                "is_active",
            ),
            {"full_name": "Unknown Driver"},
        ),
        Dimension(
            "dim_truck",
            "truck_id",
            "truck_sk",
            (
                "unit_number",
                "make",
                "model_year",
                "fuel_type",
                "status",
                "home_terminal",
                "is_active",
            ),
        ),
        Dimension(
            "dim_trailer",
            "trailer_id",
            "trailer_sk",
            (
                "trailer_number",
                "trailer_type",
                "length_feet",
                "status",
                "current_location",
                "is_active",
            ),
        ),
        Dimension(
            "dim_customer",
            "customer_id",
            "customer_sk",
            (
                "customer_name",
                "customer_type",
                "credit_terms_days",
                "primary_freight_type",
                "account_status",
                "annual_revenue_potential",
                "is_active",
            ),
            {"customer_name": "Unknown Customer"},
        ),
        Dimension(
            "dim_facility",
            "facility_id",
            "facility_sk",
            (
                "facility_name",
                "facility_type",
                "city",
                "state",
                "dock_doors",
                "operating_hours",
            ),
            {"facility_name": "Unknown Facility"},
        ),
        Dimension(
            "dim_route",
            "route_id",
            "route_sk",
            (
                "origin_city",
                "origin_state",
                "destination_city",
                "destination_state",
                "corridor",
                "typical_distance_miles",
                "base_rate_per_mile",
                "fuel_surcharge_rate",
                "typical_transit_days",
            ),
        ),
    )
}


@dataclass(frozen=True)
class Fact:
    """A star fact.

    ``dims``: natural key column -> dimension. ``degenerate``: natural key ->
    name it carries in the star. ``date``: column that becomes ``date_sk``.
    ``drops``: silver columns the star leaves out.
    """

    name: str
    dims: dict[str, str]
    date: str
    degenerate: dict[str, str] = field(default_factory=dict)
    drops: tuple[str, ...] = ()
    keep_date: bool = False


FACTS = {
    f.name: f
    for f in (
        Fact(
            "fact_load",
            {"customer_id": "dim_customer", "route_id": "dim_route"},
            "load_date",
            drops=("load_status",),
        ),
        Fact(
            "fact_trip",
            {
                "driver_id": "dim_driver",
                "truck_id": "dim_truck",
                "trailer_id": "dim_trailer",
            },
            "dispatch_date",
            degenerate={"load_id": "load_sk"},
        ),
        Fact(
            "fact_delivery",
            {"facility_id": "dim_facility"},
            "scheduled_datetime",
            degenerate={"load_id": "load_sk", "trip_id": "trip_sk"},
            keep_date=True,
        ),
        Fact(
            "fact_fuel",
            {"truck_id": "dim_truck", "driver_id": "dim_driver"},
            "purchase_date",
            degenerate={"trip_id": "trip_sk"},
            drops=("fuel_card_number",),
        ),
        Fact(
            "fact_maintenance",
            {"truck_id": "dim_truck"},
            "maintenance_date",
            drops=("service_description",),
        ),
        Fact(
            "fact_incident",
            {"truck_id": "dim_truck", "driver_id": "dim_driver"},
            "incident_date",
            degenerate={"trip_id": "trip_sk"},
            drops=("location_city", "location_state", "description"),
        ),
        Fact("fact_driver_monthly", {"driver_id": "dim_driver"}, "month"),
        Fact("fact_truck_monthly", {"truck_id": "dim_truck"}, "month"),
    )
}
