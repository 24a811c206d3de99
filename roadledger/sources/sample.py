"""The warehouse over the TPC-H-like sample tables.

Maps ``orders``, ``lineitem``, ``events``, ``customer``, ``supplier`` and
``nation`` to the 14 typed source tables. The samples hold no missing values, so
blank keys, keys without a parent, missing measures and zero denominators are
put in by arithmetic on the row's own key. Every row of a sample table yields one
row: parents are whole, and a key without a parent is one that a child row spells
differently (``reference``). Key ranges grow with the samples, so no group is fixed
in number.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadledger.model import DIMENSIONS, FACTS, SOURCES
from roadledger.operators.staging import derive
from roadledger.plans.silver import check_references
from roadledger.plans.star import build_dimension, build_fact, keyed_dimension, keyed_fact
from roadledger.sources.calendar import calendar

SAMPLE_START = "1995-01-01"
SAMPLE_END = "2024-12-31"
# Years every fact covers in full, and the partial one after them.
SAMPLE_YEARS = (1996, 1997, 1998, 1999, 2000)
SAMPLE_PARTIAL_YEAR = 2001



def reference(key: str, every: int, rest: int, prefix: str = "") -> str:
    """Text of a foreign key; one in ``every`` keys is spelled as no parent is."""
    return (
        f"concat(CASE WHEN ({key}) % {every} = {rest} THEN 'X' ELSE '{prefix}' END,"
        f" {key})"
    )


LANE = "(o_orderkey % 25) * 25 + o_custkey % 25"
# Source name -> (sample table, column expressions).
MAPPING = {
    "customers": (
        "customer",
        [
            "CAST(c_custkey AS STRING) AS customer_id",
            "concat(c_mktsegment, ' ', c_nationkey) AS customer_name",
            "CASE c_custkey % 3 WHEN 0 THEN 'Dedicated' WHEN 1 THEN 'Contract'"
            " ELSE 'Spot' END AS customer_type",
            "CAST(15 * (1 + c_custkey % 4) AS INT) AS credit_terms_days",
            "c_mktsegment AS primary_freight_type",
            "CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 5 = 1"
            " THEN 'Inactive' ELSE 'Active' END AS account_status",
            "CAST(NULL AS DATE) AS contract_start_date",
            "CAST(c_custkey * 1000 AS DECIMAL(12,0)) AS annual_revenue_potential",
        ],
    ),
    "drivers": (
        "supplier",
        [
            "CAST(s_suppkey AS STRING) AS driver_id",
            "concat('First', s_suppkey) AS first_name",
            "concat('Last', s_nationkey) AS last_name",
            "CAST(NULL AS DATE) AS hire_date",
            "CAST(NULL AS DATE) AS termination_date",
            "concat('L', s_suppkey) AS license_number",
            "concat('S', s_nationkey % 5) AS license_state",
            "CAST(NULL AS DATE) AS date_of_birth",
            "concat('NATION_', s_nationkey) AS home_terminal",
            "CASE WHEN s_suppkey % 7 = 3 THEN 'Terminated' ELSE 'Active' END"
            " AS employment_status",
            "'A' AS cdl_class",
            "CAST(s_suppkey % 30 AS INT) AS years_experience",
        ],
    ),
    "trucks": (
        "supplier",
        [
            "CAST(s_suppkey AS STRING) AS truck_id",
            "concat('U', s_suppkey) AS unit_number",
            "CASE s_suppkey % 4 WHEN 0 THEN 'Volvo' WHEN 1 THEN 'Mack'"
            " WHEN 2 THEN 'Peterbilt' ELSE 'Kenworth' END AS make",
            "CAST(2010 + s_suppkey % 12 AS INT) AS model_year",
            "concat('V', s_suppkey) AS vin",
            "CAST(NULL AS DATE) AS acquisition_date",
            "CAST(s_suppkey % 1000 AS INT) AS acquisition_mileage",
            "'Diesel' AS fuel_type",
            "CAST(200 AS INT) AS tank_capacity_gallons",
            "CASE s_suppkey % 6 WHEN 0 THEN 'Maintenance' WHEN 1 THEN 'Inactive'"
            " WHEN 2 THEN NULL ELSE 'Active' END AS status",
            "concat('NATION_', s_nationkey) AS home_terminal",
        ],
    ),
    "trailers": (
        "supplier",
        [
            "CAST(s_suppkey AS STRING) AS trailer_id",
            "concat('N', s_suppkey) AS trailer_number",
            "CASE s_suppkey % 3 WHEN 0 THEN 'Dry Van' WHEN 1 THEN 'Reefer'"
            " ELSE 'Flatbed' END AS trailer_type",
            "CAST(53 AS INT) AS length_feet",
            "CAST(2012 + s_suppkey % 10 AS INT) AS model_year",
            "concat('V', s_suppkey) AS vin",
            "CAST(NULL AS DATE) AS acquisition_date",
            "CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'Active' END AS status",
            "concat('NATION_', s_nationkey) AS current_location",
        ],
    ),
    "facilities": (
        "supplier",
        [
            "CAST(s_suppkey AS STRING) AS facility_id",
            "s_name AS facility_name",
            "CASE s_suppkey % 2 WHEN 0 THEN 'Warehouse' ELSE 'Terminal' END"
            " AS facility_type",
            "concat('NATION_', s_nationkey) AS city",
            "concat('S', s_nationkey % 5) AS state",
            "CAST(NULL AS DECIMAL(9,6)) AS latitude",
            "CAST(NULL AS DECIMAL(9,6)) AS longitude",
            "CAST(s_suppkey % 60 AS INT) AS dock_doors",
            "'24/7' AS operating_hours",
        ],
    ),
    "loads": (
        "orders",
        [
            "CAST(o_orderkey AS STRING) AS load_id",
            f"CASE WHEN o_orderkey % 97 <> 0 THEN {reference('o_custkey', 40, 39)} END"
            " AS customer_id",
            f"CASE WHEN o_orderkey % 101 <> 0 THEN {reference(LANE, 50, 49, 'R')} END"
            " AS route_id",
            "CAST(o_orderdate AS DATE) AS load_date",
            "o_orderpriority AS load_type",
            "CAST(((o_orderkey * 37) % 450) * 100 AS DECIMAL(10,0)) AS weight_lbs",
            "CAST(o_orderkey % 40 + 1 AS INT) AS pieces",
            "CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2))"
            " END AS revenue",
            "CAST(o_orderkey % 500 AS DECIMAL(12,2)) AS fuel_surcharge",
            "CAST(o_orderkey % 70 AS DECIMAL(12,2)) AS accessorial_charges",
            "'Completed' AS load_status",
            "o_orderstatus AS booking_type",
        ],
    ),
    "trips": (
        "orders",
        [
            "concat('T', o_orderkey) AS trip_id",
            "CASE WHEN o_orderkey % 103 <> 0 THEN CAST(o_orderkey AS STRING) END"
            " AS load_id",
            "CASE WHEN o_orderkey % 49 <> 0 THEN"
            f" {reference('o_custkey div 15', 25, 9)} END AS driver_id",
            "CASE WHEN o_orderkey % 50 <> 0 THEN"
            f" {reference('o_orderkey div 150', 30, 29)} END AS truck_id",
            "CASE WHEN o_orderkey % 48 <> 0 THEN"
            f" {reference('o_orderkey div 150', 20, 4)} END AS trailer_id",
            "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 3 AS INT))"
            " AS dispatch_date",
            "CAST(abs(o_orderkey % 25 - o_custkey % 25) * 100 + o_orderkey % 90"
            " AS DECIMAL(10,1)) AS actual_distance_miles",
            "CAST(CAST(o_orderkey % 400 AS DECIMAL(10,2)) / 10 AS DECIMAL(7,2))"
            " AS actual_duration_hours",
            "CAST(o_orderkey % 300 AS DECIMAL(10,2)) AS fuel_gallons_used",
            "CASE WHEN o_orderkey % 151 <> 0 THEN"
            " CAST(CAST(500 + o_orderkey % 300 AS DECIMAL(10,2)) / 100 AS DECIMAL(6,2))"
            " END AS average_mpg",
            "CAST(CAST(o_orderkey % 80 AS DECIMAL(10,2)) / 10 AS DECIMAL(7,2))"
            " AS idle_time_hours",
            "'Completed' AS trip_status",
        ],
    ),
    "delivery_events": (
        "lineitem",
        [
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id",
            "CASE WHEN (l_orderkey + l_linenumber) % 83 <> 0 THEN"
            " CAST(l_orderkey AS STRING) END AS load_id",
            "CASE WHEN l_partkey % 79 <> 0 THEN concat('T', l_orderkey) END AS trip_id",
            "CASE l_linestatus WHEN 'O' THEN 'Delivery' ELSE 'Pickup' END AS event_type",
            f"CASE WHEN l_partkey % 61 <> 0 THEN {reference('l_suppkey', 20, 19)} END"
            " AS facility_id",
            "l_shipdate + make_dt_interval(0, CAST(l_partkey % 24 AS INT))"
            " AS scheduled_datetime",
            "l_shipdate + make_dt_interval(0, CAST(l_partkey % 24 AS INT),"
            " CAST((l_orderkey * 13 + l_linenumber * 7) % 400 - 150 AS INT))"
            " AS actual_datetime",
            "CAST(l_quantity AS INT) AS detention_minutes",
            "CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END"
            " AS on_time_flag",
            "concat('C', l_suppkey % 25) AS location_city",
            "concat('S', l_suppkey % 5) AS location_state",
        ],
    ),
    "fuel_purchases": (
        "lineitem",
        [
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
            " AS fuel_purchase_id",
            "concat('T', l_orderkey) AS trip_id",
            "CASE WHEN (l_orderkey * 7 + l_linenumber) % 50 <> 0 THEN"
            f" {reference('l_suppkey', 30, 29)} END AS truck_id",
            "CASE WHEN (l_orderkey * 3 + l_linenumber) % 51 <> 0 THEN"
            f" {reference('l_partkey div 20', 25, 9)} END AS driver_id",
            "CAST(l_shipdate AS DATE) AS purchase_date",
            "concat('C', l_suppkey % 25) AS location_city",
            "concat('S', l_suppkey % 5) AS location_state",
            "CAST(l_quantity AS DECIMAL(10,2)) AS gallons",
            "CAST(l_extendedprice / l_quantity AS DECIMAL(12,3)) AS price_per_gallon",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS total_cost",
            "concat('F', l_suppkey) AS fuel_card_number",
        ],
    ),
    "maintenance_records": (
        "events",
        [
            "CAST(event_id AS STRING) AS maintenance_id",
            f"{reference('user_id', 30, 29)} AS truck_id",
            "CAST(ts AS DATE) AS maintenance_date",
            "event_type AS maintenance_type",
            "CAST(event_id * 10 AS DECIMAL(12,0)) AS odometer_reading",
            "CAST(event_id % 9 AS DECIMAL(7,2)) AS labor_hours",
            "CAST(event_id % 300 AS DECIMAL(12,2)) AS labor_cost",
            "CAST(event_id % 200 AS DECIMAL(12,2)) AS parts_cost",
            "CAST(value AS DECIMAL(12,2)) AS total_cost",
            "concat('C', user_id % 25) AS facility_location",
            "CAST(CAST(event_id % 240 AS DECIMAL(10,2)) / 10 AS DECIMAL(7,2))"
            " AS downtime_hours",
            "props AS service_description",
        ],
    ),
    "safety_incidents": (
        "events",
        [
            "CAST(event_id AS STRING) AS incident_id",
            "CASE WHEN event_id % 90 <> 0 THEN concat('T', event_id) END AS trip_id",
            f"{reference('user_id', 30, 29)} AS truck_id",
            "CASE WHEN event_id % 45 <> 0 THEN"
            f" {reference('user_id', 25, 9)} END AS driver_id",
            "CAST(ts AS DATE) AS incident_date",
            "event_type AS incident_type",
            "concat('C', user_id % 25) AS location_city",
            "concat('S', user_id % 5) AS location_state",
            "CASE WHEN {k} % 11 <> 0 THEN {k} % 2 = 0 END AS at_fault_flag",
            "{k} % 5 = 0 AS injury_flag",
            "CAST(CAST(value AS DECIMAL(12,2)) * 10 AS DECIMAL(12,2))"
            " AS vehicle_damage_cost",
            "CAST(CAST(value AS DECIMAL(12,2)) * 3 AS DECIMAL(12,2))"
            " AS cargo_damage_cost",
            "CAST(CAST(value AS DECIMAL(12,2)) * 13 AS DECIMAL(12,2)) AS claim_amount",
            "CASE WHEN {k} % 13 <> 0 THEN {k} % 3 = 0 END AS preventable_flag",
            "props AS description",
        ],
    ),
}
# Layout of the sample tables; stating it saves a footer scan per read.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING,"
    " p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,"
    " o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT,"
    " l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE,"
    " l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
}
INCIDENT_K = "CAST(get_json_object(props, '$.k') AS INT)"


class SampleWarehouse:
    """Lazy silver and star frames over one sample directory.

    A frame asked for twice is the same plan, so Spark can reuse its exchange.
    """

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._plans: dict[tuple[str, str], DataFrame] = {}

    def _once(self, kind: str, name: str, build) -> DataFrame:
        if (kind, name) not in self._plans:
            self._plans[kind, name] = build()
        return self._plans[kind, name]

    def table(self, name: str) -> DataFrame:
        return self._once("table", name, lambda: self._read(name))

    def _read(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(SCHEMAS[name])
        return reader.parquet(f"{self.directory}/{name}.parquet")

    def calendar(self) -> DataFrame:
        return calendar(self.spark, SAMPLE_START, SAMPLE_END)

    def rows(self, source: str) -> DataFrame:
        """Typed and derived rows of a source, references not yet checked."""
        return self._once("rows", source, lambda: self._rows(source))

    def _rows(self, source: str) -> DataFrame:
        if source == "routes":
            frame = self._routes()
        elif source == "truck_utilization_metrics":
            frame = self._truck_months()
        elif source == "driver_monthly_metrics":
            frame = self._driver_months()
        else:
            table, columns = MAPPING[source]
            frame = self.table(table).selectExpr(*[c.replace("{k}", INCIDENT_K) for c in columns])
        return derive(frame, SOURCES[source])

    def _routes(self) -> DataFrame:
        """Lanes that orders use, as ordered pairs of nations."""
        lanes = self.table("orders").selectExpr(
            "CAST(o_orderkey % 25 AS INT) AS _o", "CAST(o_custkey % 25 AS INT) AS _d"
        )
        nation = self.table("nation")
        origin = nation.select(
            F.col("n_nationkey").alias("_o"),
            F.col("n_name").alias("origin_city"),
            F.concat(F.lit("S"), F.col("n_regionkey")).alias("origin_state"),
        )
        destination = nation.select(
            F.col("n_nationkey").alias("_d"),
            F.col("n_name").alias("destination_city"),
            F.concat(F.lit("S"), F.col("n_regionkey")).alias("destination_state"),
        )
        return (
            lanes.distinct()
            .join(origin, "_o")
            .join(destination, "_d")
            .selectExpr(
                "concat('R', _o * 25 + _d) AS route_id",
                "origin_city",
                "origin_state",
                "destination_city",
                "destination_state",
                "CAST(abs(_o - _d) * 100 AS INT) AS typical_distance_miles",
                "CAST(1 + (_o + _d) % 3 AS DECIMAL(6,2)) AS base_rate_per_mile",
                "CAST(0.25 AS DECIMAL(6,3)) AS fuel_surcharge_rate",
                "CAST(1 + abs(_o - _d) % 5 AS INT) AS typical_transit_days",
            )
        )

    def _truck_months(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy(
                F.expr(reference("l_suppkey", 30, 29)).alias("truck_id"),
                F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"),
            )
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
                F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("r"),
            )
            .selectExpr(
                "truck_id",
                "month",
                "CAST(n AS INT) AS trips_completed",
                "CAST(q * 10 AS DECIMAL(12,1)) AS total_miles",
                "CAST(r AS DECIMAL(12,2)) AS total_revenue",
                "CAST(CAST(500 + q % 300 AS DECIMAL(10,2)) / 100 AS DECIMAL(6,2))"
                " AS average_mpg",
                "CAST(n % 3 AS INT) AS maintenance_events",
                "CAST((q * 7) % 900 AS DECIMAL(12,2)) AS maintenance_cost",
                "CAST(q % 48 AS DECIMAL(7,2)) AS downtime_hours",
                "CAST(CAST(600 + q % 500 AS DECIMAL(10,3)) / 1000 AS DECIMAL(6,3))"
                " AS utilization_rate",
            )
        )

    def _driver_months(self) -> DataFrame:
        return (
            self.table("orders")
            .groupBy(
                F.expr(reference("o_custkey div 15", 25, 9)).alias("driver_id"),
                F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
            )
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("o_orderkey") % 1000).alias("q"),
                F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("r"),
            )
            .selectExpr(
                "driver_id",
                "month",
                "CAST(n AS INT) AS trips_completed",
                "CAST(q AS DECIMAL(12,1)) AS total_miles",
                "CAST(r AS DECIMAL(12,2)) AS total_revenue",
                "CAST(CAST(500 + q % 300 AS DECIMAL(10,2)) / 100 AS DECIMAL(6,2))"
                " AS average_mpg",
                "CAST(q AS DECIMAL(12,2)) AS total_fuel_gallons",
                "CAST(q % 100 AS DECIMAL(6,2)) AS on_time_delivery_rate",
                "CAST(q % 12 AS DECIMAL(7,2)) AS average_idle_hours",
            )
        )

    def silver(self, target: str, only: Iterable[str] | None = None) -> DataFrame:
        """Silver table; ``only`` names the foreign keys the caller uses."""
        source = next(s for s in SOURCES.values() if s.target == target)
        keys = list(source.parents if only is None else only)
        parents = {source.parents[k]: self.rows(source.parents[k]) for k in keys}
        return self._once(
            "silver",
            " ".join([target, *keys]),
            lambda: check_references(self.rows(source.name), source, parents, keys),
        )

    def dimension(self, name: str) -> DataFrame:
        source = next(s for s in SOURCES.values() if s.target == name)
        return self._once(
            "dim", name, lambda: build_dimension(self.rows(source.name), name)
        )

    def star(
        self,
        name: str,
        dims: Iterable[str] = (),
        refs: Iterable[str] = (),
        show_keys: bool = False,
    ) -> DataFrame:
        """Star fact with the surrogates of ``dims``, and their natural keys if shown.

        A surrogate lookup already sends keys without a member to Unknown, so
        only the degenerate keys in ``refs`` need their own reference check.
        """
        wanted = list(dims)
        built = {d: self.dimension(d) for d in wanted}
        return build_fact(self.silver(name, refs), name, built, wanted, show_keys)

    def keyed(self, name: str, refs: Iterable[str] = ()) -> DataFrame:
        """Star fact with natural keys under the surrogates' names; no dimension is met."""
        return keyed_fact(self.silver(name, refs), name)

    def members(self, name: str) -> DataFrame:
        """Known members of a dimension, for facts from ``keyed``."""
        source = next(s for s in SOURCES.values() if s.target == name)
        return keyed_dimension(self.rows(source.name), name)

    def tables(self) -> dict[str, DataFrame]:
        """Every star table under its name."""
        dims = {d: self.dimension(d) for d in DIMENSIONS}
        facts = {
            f: self.star(f, spec.dims.values(), spec.degenerate)
            for f, spec in FACTS.items()
        }
        return {**dims, **facts, "dim_date": self.calendar()}
