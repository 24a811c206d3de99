"""SQL that must give the registered queries' results (DuckDB dialect).

Written from the query definitions, not from the library: facts join dimensions
and each other directly, exact fractions come from integer arithmetic.
"""

from __future__ import annotations

import re

from roadledger.model import SOURCES

ORACLE: dict[str, str] = {}

DIRTY_SQL = {
    "blank_null": "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '   '"
    " WHEN 2 THEN '  ' || c_name || ' ' ELSE c_name END",
    "int": "CASE p_partkey % 9 WHEN 0 THEN ' ' || p_size || ' ' WHEN 1 THEN '3.0'"
    " WHEN 2 THEN 'abc' WHEN 3 THEN '' WHEN 4 THEN '+' || p_size"
    " WHEN 5 THEN '99999999999' WHEN 6 THEN '-' || p_size WHEN 7 THEN '1e3'"
    " ELSE CAST(p_size AS VARCHAR) END",
    "decimal": "CASE o_orderkey % 9 WHEN 0 THEN '1e3' WHEN 1 THEN '1,234' WHEN 2 THEN ''"
    " WHEN 3 THEN '1.005' WHEN 4 THEN '12345678901.23' WHEN 5 THEN '.5'"
    " WHEN 6 THEN ' ' || o_custkey || '. ' WHEN 7 THEN '-' || o_custkey || '.125'"
    " ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END",
    "date": "CASE o_orderkey % 7 WHEN 0 THEN '2022-01' WHEN 1 THEN '01/05/2022'"
    " WHEN 2 THEN ' ' WHEN 3 THEN '2022-02-30'"
    " WHEN 4 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 10:11:12'"
    " WHEN 5 THEN '20220105' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END",
    "timestamp": "CASE event_id % 5 WHEN 0 THEN '2024-01-05' WHEN 1 THEN 'soon'"
    " WHEN 2 THEN '2024-01-05 23:59:59.6'"
    " ELSE ' ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '.'"
    " || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') END",
    "prefix_date": "CASE l_linenumber % 3 WHEN 0 THEN ''"
    " WHEN 1 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || 'x17:30'"
    " ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' 08:00:00.5' END",
    "flag3": "CASE l_returnflag WHEN 'N' THEN 'True' || repeat(' ', l_linenumber % 3)"
    " WHEN 'R' THEN CASE l_linenumber % 2 WHEN 0 THEN 'FALSE' ELSE 'False' END"
    " ELSE CASE l_linenumber % 2 WHEN 0 THEN 'yes' END END",
}

INT_OK = "'^[+-]?[0-9]+$'"
DEC_OK = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$'"
DATE_OK = (
    "'^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,7})?)?)?$'"
)


def as_text(x: str) -> str:
    return f"NULLIF(TRIM({x}, ' '), '')"


def as_int(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({as_text(x)}, {INT_OK})"
        f" THEN TRY_CAST({as_text(x)} AS INTEGER) END"
    )


def as_decimal(x: str, p: int, s: int) -> str:
    return (
        f"CASE WHEN regexp_matches({as_text(x)}, {DEC_OK})"
        f" THEN TRY_CAST({as_text(x)} AS DECIMAL({p},{s})) END"
    )


def as_date(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({as_text(x)}, {DATE_OK})"
        f" THEN TRY_CAST(substr({as_text(x)}, 1, 10) AS DATE) END"
    )


def ratio(a: str, b: str, scale: int = 4) -> str:
    """a / b to ``scale`` digits, half up, by integer arithmetic; a, b >= 0."""
    top = f"CAST(CAST({a} AS DECIMAL(30,4)) * 10000 AS HUGEINT)"
    low = f"CAST(CAST({b} AS DECIMAL(26,4)) * 10000 AS HUGEINT)"
    whole = f"(2 * {top} * {10**scale} + {low}) // (2 * {low})"
    return f"(CASE WHEN {b} <> 0 THEN CAST({whole} AS DOUBLE) / {10**scale} END)"


def pct(a: str, b: str, scale: int = 1) -> str:
    return ratio(f"(100 * {a})", b, scale)


def n0(x: str) -> str:
    """Whole number with thousands separators, half up, for x >= 0."""
    cents = f"CAST(CAST({x} AS DECIMAL(30,4)) * 10000 AS HUGEINT)"
    return f"format('{{:,}}', CAST((2 * {cents} + 10000) // 20000 AS BIGINT))"


ON = "SUM(CASE WHEN e.on_time_flag THEN 1 ELSE 0 END)"
ON_D = (
    "SUM(CASE WHEN e.on_time_flag AND e.event_type = 'Delivery' THEN 1 ELSE 0 END)"
)
N_D = "SUM(CASE WHEN e.event_type = 'Delivery' THEN 1 ELSE 0 END)"


def child(key: str, every: int, rest: int, prefix: str = "") -> str:
    """A child's spelling of a key; one in ``every`` keys has no parent."""
    return f"(if(({key}) % {every} = {rest}, 'X', '{prefix}') || ({key}))"


def known(alias: str, key: str, parent: str, parent_key: str | None = None) -> str:
    parent_key = parent_key or key
    return (
        f"CASE WHEN {alias}.{key} IN (SELECT p.{parent_key} FROM {parent} p"
        f" WHERE p.{parent_key} IS NOT NULL) THEN {alias}.{key} ELSE '-1' END AS {key}"
    )


# Named subqueries. x_: typed source rows; s_: references checked; d_: dimensions
# with their Unknown member.
CTE = {
    "x_customers": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       c_mktsegment || ' ' || c_nationkey AS customer_name,
       CASE c_custkey % 3 WHEN 0 THEN 'Dedicated' WHEN 1 THEN 'Contract' ELSE 'Spot' END
         AS customer_type,
       15 * (1 + c_custkey % 4) AS credit_terms_days,
       c_mktsegment AS primary_freight_type,
       CASE WHEN c_custkey % 10 = 0 THEN 'Unknown' WHEN c_custkey % 5 = 1 THEN 'Inactive'
            ELSE 'Active' END AS account_status,
       c_custkey * 1000 AS annual_revenue_potential,
       (c_custkey % 10 <> 0 AND c_custkey % 5 <> 1) AS is_active
FROM customer""",
    "x_drivers": """
SELECT CAST(s_suppkey AS VARCHAR) AS driver_id,
       'First' || s_suppkey AS first_name, 'Last' || s_nationkey AS last_name,
       'First' || s_suppkey || ' Last' || s_nationkey AS full_name,
       'NATION_' || s_nationkey AS home_terminal,
       CASE WHEN s_suppkey % 7 = 3 THEN 'Terminated' ELSE 'Active' END
         AS employment_status,
       'A' AS cdl_class, s_suppkey % 30 AS years_experience,
       s_suppkey % 7 <> 3 AS is_active
FROM supplier""",
    "x_trucks": """
SELECT CAST(s_suppkey AS VARCHAR) AS truck_id, 'U' || s_suppkey AS unit_number,
       CASE s_suppkey % 4 WHEN 0 THEN 'Volvo' WHEN 1 THEN 'Mack' WHEN 2 THEN 'Peterbilt'
            ELSE 'Kenworth' END AS make,
       2010 + s_suppkey % 12 AS model_year, 'Diesel' AS fuel_type,
       CASE s_suppkey % 6 WHEN 0 THEN 'Maintenance' WHEN 1 THEN 'Inactive'
            WHEN 2 THEN 'Unknown' ELSE 'Active' END AS status,
       'NATION_' || s_nationkey AS home_terminal, s_suppkey % 6 >= 3 AS is_active
FROM supplier""",
    "x_trailers": """
SELECT CAST(s_suppkey AS VARCHAR) AS trailer_id, 'N' || s_suppkey AS trailer_number,
       CASE s_suppkey % 3 WHEN 0 THEN 'Dry Van' WHEN 1 THEN 'Reefer' ELSE 'Flatbed' END
         AS trailer_type,
       53 AS length_feet,
       CASE WHEN s_suppkey % 9 = 0 THEN 'Unknown' ELSE 'Active' END AS status,
       'NATION_' || s_nationkey AS current_location, s_suppkey % 9 <> 0 AS is_active
FROM supplier""",
    "x_facilities": """
SELECT CAST(s_suppkey AS VARCHAR) AS facility_id, s_name AS facility_name,
       CASE s_suppkey % 2 WHEN 0 THEN 'Warehouse' ELSE 'Terminal' END AS facility_type,
       'NATION_' || s_nationkey AS city, 'S' || (s_nationkey % 5) AS state,
       s_suppkey % 60 AS dock_doors, '24/7' AS operating_hours
FROM supplier""",
    "x_routes": """
SELECT 'R' || (o.n_nationkey * 25 + d.n_nationkey) AS route_id,
       o.n_name AS origin_city, 'S' || o.n_regionkey AS origin_state,
       d.n_name AS destination_city, 'S' || d.n_regionkey AS destination_state,
       o.n_name || ', S' || o.n_regionkey AS origin_full,
       d.n_name || ', S' || d.n_regionkey AS destination_full,
       o.n_name || ' -> ' || d.n_name AS corridor,
       abs(o.n_nationkey - d.n_nationkey) * 100 AS typical_distance_miles,
       CAST(1 + (o.n_nationkey + d.n_nationkey) % 3 AS DECIMAL(6,2)) AS base_rate_per_mile,
       CAST(0.25 AS DECIMAL(6,3)) AS fuel_surcharge_rate,
       1 + abs(o.n_nationkey - d.n_nationkey) % 5 AS typical_transit_days
FROM (SELECT DISTINCT o_orderkey % 25 AS a, o_custkey % 25 AS z FROM orders) lane
JOIN nation o ON o.n_nationkey = lane.a
JOIN nation d ON d.n_nationkey = lane.z""",
    "x_loads": f"""
SELECT *, revenue + fuel_surcharge + accessorial_charges AS gross_revenue
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS load_id,
       CASE WHEN o_orderkey % 97 <> 0 THEN {child('o_custkey', 40, 39)} END AS customer_id,
       CASE WHEN o_orderkey % 101 <> 0
            THEN {child('(o_orderkey % 25) * 25 + o_custkey % 25', 50, 49, 'R')} END
         AS route_id,
       CAST(o_orderdate AS DATE) AS load_date, o_orderpriority AS load_type,
       CAST(((o_orderkey * 37) % 450) * 100 AS DECIMAL(10,0)) AS weight_lbs,
       o_orderkey % 40 + 1 AS pieces,
       CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END
         AS revenue,
       CAST(o_orderkey % 500 AS DECIMAL(12,2)) AS fuel_surcharge,
       CAST(o_orderkey % 70 AS DECIMAL(12,2)) AS accessorial_charges,
       o_orderstatus AS booking_type
FROM orders)""",
    "x_trips": f"""
SELECT 'T' || o_orderkey AS trip_id,
       CASE WHEN o_orderkey % 103 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS load_id,
       CASE WHEN o_orderkey % 49 <> 0 THEN {child('o_custkey // 15', 25, 9)} END AS driver_id,
       CASE WHEN o_orderkey % 50 <> 0 THEN {child('o_orderkey // 150', 30, 29)} END
         AS truck_id,
       CASE WHEN o_orderkey % 48 <> 0 THEN {child('o_orderkey // 150', 20, 4)} END
         AS trailer_id,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS dispatch_date,
       CAST(abs(o_orderkey % 25 - o_custkey % 25) * 100 + o_orderkey % 90
            AS DECIMAL(10,1)) AS actual_distance_miles,
       CAST(CAST(o_orderkey % 400 AS DECIMAL(10,2)) * 0.1 AS DECIMAL(7,2))
         AS actual_duration_hours,
       CAST(o_orderkey % 300 AS DECIMAL(10,2)) AS fuel_gallons_used,
       CASE WHEN o_orderkey % 151 <> 0
            THEN CAST(CAST(500 + o_orderkey % 300 AS DECIMAL(10,2)) * 0.01 AS DECIMAL(6,2))
       END AS average_mpg,
       CAST(CAST(o_orderkey % 80 AS DECIMAL(10,2)) * 0.1 AS DECIMAL(7,2))
         AS idle_time_hours,
       'Completed' AS trip_status
FROM orders""",
    "x_events": f"""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
         AS event_id,
       CASE WHEN (l_orderkey + l_linenumber) % 83 <> 0 THEN CAST(l_orderkey AS VARCHAR)
       END AS load_id,
       CASE WHEN l_partkey % 79 <> 0 THEN 'T' || l_orderkey END AS trip_id,
       CASE l_linestatus WHEN 'O' THEN 'Delivery' ELSE 'Pickup' END AS event_type,
       CASE WHEN l_partkey % 61 <> 0 THEN {child('l_suppkey', 20, 19)} END AS facility_id,
       l_shipdate + to_hours(CAST(l_partkey % 24 AS BIGINT)) AS scheduled_datetime,
       l_shipdate + to_hours(CAST(l_partkey % 24 AS BIGINT))
         + to_minutes(CAST((l_orderkey * 13 + l_linenumber * 7) % 400 - 150 AS BIGINT))
         AS actual_datetime,
       CAST(l_quantity AS INTEGER) AS detention_minutes,
       CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END AS on_time_flag,
       'S' || (l_suppkey % 5) AS location_state
FROM lineitem""",
    "x_fuel": f"""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
         AS fuel_purchase_id,
       'T' || l_orderkey AS trip_id,
       CASE WHEN (l_orderkey * 7 + l_linenumber) % 50 <> 0 THEN {child('l_suppkey', 30, 29)}
       END AS truck_id,
       CASE WHEN (l_orderkey * 3 + l_linenumber) % 51 <> 0
            THEN {child('l_partkey // 20', 25, 9)} END AS driver_id,
       CAST(l_shipdate AS DATE) AS purchase_date,
       CAST(l_quantity AS DECIMAL(10,2)) AS gallons,
       CAST(l_extendedprice / l_quantity AS DECIMAL(12,3)) AS price_per_gallon,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS total_cost
FROM lineitem""",
    "x_maintenance": f"""
SELECT CAST(event_id AS VARCHAR) AS maintenance_id, {child('user_id', 30, 29)} AS truck_id,
       CAST(ts AS DATE) AS maintenance_date, event_type AS maintenance_type,
       event_id * 10 AS odometer_reading, event_id % 9 AS labor_hours,
       event_id % 300 AS labor_cost, event_id % 200 AS parts_cost,
       CAST(value AS DECIMAL(12,2)) AS total_cost,
       'C' || (user_id % 25) AS facility_location,
       CAST(CAST(event_id % 240 AS DECIMAL(10,2)) * 0.1 AS DECIMAL(7,2)) AS downtime_hours
FROM events""",
    "x_incidents": f"""
SELECT CAST(event_id AS VARCHAR) AS incident_id,
       CASE WHEN event_id % 90 <> 0 THEN 'T' || event_id END AS trip_id,
       {child('user_id', 30, 29)} AS truck_id,
       CASE WHEN event_id % 45 <> 0 THEN {child('user_id', 25, 9)} END AS driver_id,
       CAST(ts AS DATE) AS incident_date,
       event_type AS incident_type,
       CASE WHEN k % 11 <> 0 THEN k % 2 = 0 END AS at_fault_flag,
       k % 5 = 0 AS injury_flag,
       CAST(value AS DECIMAL(12,2)) * 10 AS vehicle_damage_cost,
       CAST(value AS DECIMAL(12,2)) * 3 AS cargo_damage_cost,
       CAST(value AS DECIMAL(12,2)) * 13 AS claim_amount,
       CASE WHEN k % 13 <> 0 THEN k % 3 = 0 END AS preventable_flag
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
    "x_truck_months": f"""
SELECT truck_id, month, n AS trips_completed, CAST(q * 10 AS DECIMAL(12,1)) AS total_miles,
       CAST(r AS DECIMAL(12,2)) AS total_revenue,
       CAST(CAST(500 + q % 300 AS DECIMAL(10,2)) * 0.01 AS DECIMAL(6,2)) AS average_mpg,
       n % 3 AS maintenance_events, CAST((q * 7) % 900 AS DECIMAL(12,2)) AS maintenance_cost,
       CAST(q % 48 AS DECIMAL(7,2)) AS downtime_hours,
       CAST(CAST(600 + q % 500 AS DECIMAL(10,3)) * 0.001 AS DECIMAL(6,3))
         AS utilization_rate
FROM (SELECT {child('l_suppkey', 30, 29)} AS truck_id,
             CAST(date_trunc('month', l_shipdate) AS DATE) AS month, COUNT(*) AS n,
             CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q,
             SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS r
      FROM lineitem GROUP BY 1, 2)""",
    "x_driver_months": f"""
SELECT driver_id, month, n AS trips_completed, CAST(q AS DECIMAL(12,1)) AS total_miles,
       CAST(r AS DECIMAL(12,2)) AS total_revenue,
       CAST(CAST(500 + q % 300 AS DECIMAL(10,2)) * 0.01 AS DECIMAL(6,2)) AS average_mpg,
       q AS total_fuel_gallons, q % 100 AS on_time_delivery_rate, q % 12 AS average_idle_hours
FROM (SELECT {child('o_custkey // 15', 25, 9)} AS driver_id,
             CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n,
             CAST(SUM(o_orderkey % 1000) AS BIGINT) AS q,
             SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS r
      FROM orders GROUP BY 1, 2)""",
    "s_loads": f"""
SELECT l.* REPLACE ({known("l", "customer_id", "x_customers")},
                    {known("l", "route_id", "x_routes")}) FROM x_loads l""",
    "s_trips": f"""
SELECT t.* REPLACE ({known("t", "load_id", "x_loads")},
                    {known("t", "driver_id", "x_drivers")},
                    {known("t", "truck_id", "x_trucks")},
                    {known("t", "trailer_id", "x_trailers")}) FROM x_trips t""",
    "s_events": f"""
SELECT e.* REPLACE ({known("e", "load_id", "x_loads")},
                    {known("e", "trip_id", "x_trips")},
                    {known("e", "facility_id", "x_facilities")}) FROM x_events e""",
    "s_fuel": f"""
SELECT f.* REPLACE ({known("f", "trip_id", "x_trips")},
                    {known("f", "truck_id", "x_trucks")},
                    {known("f", "driver_id", "x_drivers")}) FROM x_fuel f""",
    "s_maintenance": f"""
SELECT m.* REPLACE ({known("m", "truck_id", "x_trucks")}) FROM x_maintenance m""",
    "s_incidents": f"""
SELECT i.* REPLACE ({known("i", "trip_id", "x_trips")},
                    {known("i", "truck_id", "x_trucks")},
                    {known("i", "driver_id", "x_drivers")}) FROM x_incidents i""",
    "s_truck_months": f"""
SELECT m.* REPLACE ({known("m", "truck_id", "x_trucks")}) FROM x_truck_months m""",
    "s_driver_months": f"""
SELECT m.* REPLACE ({known("m", "driver_id", "x_drivers")}) FROM x_driver_months m""",
    "d_customers": """
SELECT * FROM x_customers UNION ALL BY NAME
SELECT '-1' AS customer_id, 'Unknown Customer' AS customer_name""",
    "d_drivers": """
SELECT * FROM x_drivers UNION ALL BY NAME
SELECT '-1' AS driver_id, 'Unknown Driver' AS full_name""",
    "d_trucks": "SELECT * FROM x_trucks UNION ALL BY NAME SELECT '-1' AS truck_id",
    "d_trailers": "SELECT * FROM x_trailers UNION ALL BY NAME SELECT '-1' AS trailer_id",
    "d_facilities": """
SELECT * FROM x_facilities UNION ALL BY NAME
SELECT '-1' AS facility_id, 'Unknown Facility' AS facility_name""",
    "d_routes": "SELECT * FROM x_routes UNION ALL BY NAME SELECT '-1' AS route_id",
    "cal": """
SELECT d AS date_id, year(d) AS year_nbr, month(d) AS month_nbr, day(d) AS day_nbr,
       quarter(d) AS quarter_nbr, dayofweek(d) + 1 AS weekday_nbr,
       monthname(d) AS month_name, dayname(d) AS weekday_name,
       dayofweek(d) IN (0, 6) AS is_weekend,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
            WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(
        TIMESTAMP '1995-01-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY) AS t(g))""",
}

CASTS = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR"}


def add(name: str, out: str, body: str) -> None:
    """Register ``body`` under ``name``.

    ``out`` lists the result columns as ``column:type`` (i, d or s); the named
    subqueries the body mentions come along.
    """
    needed: list[str] = []

    def visit(text: str) -> None:
        for cte in CTE:
            if cte not in needed and re.search(rf"\b{cte}\b", text):
                visit(CTE[cte])
                if cte not in needed:
                    needed.append(cte)

    visit(body)
    columns = ", ".join(
        f"CAST({c} AS {CASTS[t]}) AS {c}" for c, t in (x.split(":") for x in out.split())
    )
    head = ",\n".join(f"{c} AS ({CTE[c].strip()})" for c in needed)
    prefix = f"WITH {head}\n" if head else ""
    ORACLE[name] = f"{prefix}SELECT {columns}\nFROM ({body.strip()}) AS result"


# --- Cleaning -------------------------------------------------------------

add(
    "src_split_limit",
    "id:i second:s rest:s short:s",
    """
SELECT event_id AS id, event_type AS second,
       CASE WHEN event_id % 37 <> 0 THEN props || ', ' || value || ',' END AS rest,
       event_id % 37 = 0 AS short
FROM events""",
)
for _name, _kind, _key, _table, _expr, _type in (
    ("clean_blank_null", "blank_null", "c_custkey", "customer", as_text("raw"), "s"),
    ("clean_cast_int", "int", "p_partkey", "part", as_int("raw"), "i"),
    ("clean_cast_decimal", "decimal", "o_orderkey", "orders", as_decimal("raw", 12, 2), "d"),
    ("clean_cast_date", "date", "o_orderkey", "orders", as_date("raw"), "s"),
    (
        "clean_cast_timestamp",
        "timestamp",
        "event_id",
        "events",
        f"CASE WHEN regexp_matches({as_text('raw')}, {DATE_OK}) THEN date_trunc('second',"
        f" TRY_CAST({as_text('raw')} AS TIMESTAMP) + INTERVAL 500 MILLISECONDS) END",
        "s",
    ),
):
    add(
        _name,
        f"id:i cleaned:{_type}",
        f"SELECT id, {_expr} AS cleaned FROM (SELECT {_key} AS id,"
        f" {DIRTY_SQL[_kind]} AS raw FROM {_table})",
    )
add(
    "clean_prefix_date",
    "raw:s cleaned:s rows:i",
    f"SELECT raw, {as_date('substr(raw, 1, 10)')} AS cleaned, COUNT(*) AS rows"
    f" FROM (SELECT {DIRTY_SQL['prefix_date']} AS raw FROM lineitem) GROUP BY raw",
)
add(
    "clean_flag3",
    "raw:s cleaned:s rows:i",
    f"SELECT raw, CASE lower(rtrim(raw)) WHEN 'true' THEN true WHEN 'false' THEN false END"
    f" AS cleaned, COUNT(*) AS rows"
    f" FROM (SELECT {DIRTY_SQL['flag3']} AS raw FROM lineitem) GROUP BY raw",
)
add(
    "concat_corridor",
    "route_id:s origin_full:s destination_full:s corridor:s",
    "SELECT * FROM x_routes",
)
add("status_default_active", "truck_id:s status:s is_active:s", "SELECT * FROM x_trucks")

CTE["x_load_text"] = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 71 = 0 THEN ' ' ELSE CAST(o_orderkey AS VARCHAR) END
         AS load_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       'R' || ((o_orderkey % 25) * 25 + o_custkey % 25) AS route_id,
       CASE o_orderkey % 53 WHEN 0 THEN 'n/a' WHEN 1 THEN ''
            ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS load_date,
       ' ' || o_orderpriority || ' ' AS load_type,
       CASE o_orderkey % 31 WHEN 0 THEN '1e3'
            ELSE CAST(((o_orderkey * 37) % 450) * 100 AS VARCHAR) END AS weight_lbs,
       CASE o_orderkey % 29 WHEN 0 THEN '4.0'
            ELSE CAST(o_orderkey % 40 + 1 AS VARCHAR) END AS pieces,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS revenue,
       CASE o_orderkey % 23 WHEN 0 THEN '' ELSE CAST(o_orderkey % 500 AS VARCHAR) END
         AS fuel_surcharge,
       CAST(o_orderkey % 70 AS VARCHAR) AS accessorial_charges,
       'Completed' AS load_status,
       CASE o_orderkey % 19 WHEN 0 THEN '  ' ELSE o_orderstatus END AS booking_type
FROM orders"""
CTE["x_load_typed"] = f"""
SELECT *, revenue + fuel_surcharge + accessorial_charges AS gross_revenue,
       CASE WHEN load_date IS NULL THEN 'missing load_date'
            WHEN load_id IS NULL THEN 'missing load_id' END AS reject
FROM (SELECT {as_text("load_id")} AS load_id, customer_id, route_id,
             {as_date("load_date")} AS load_date, {as_text("load_type")} AS load_type,
             {as_decimal("weight_lbs", 10, 0)} AS weight_lbs, {as_int("pieces")} AS pieces,
             {as_decimal("revenue", 12, 2)} AS revenue,
             {as_decimal("fuel_surcharge", 12, 2)} AS fuel_surcharge,
             {as_decimal("accessorial_charges", 12, 2)} AS accessorial_charges,
             {as_text("booking_type")} AS booking_type
      FROM x_load_text)"""
add(
    "silver_load_from_text",
    "load_id:s customer_id:s route_id:s load_date:s load_type:s weight_lbs:d pieces:i"
    " revenue:d fuel_surcharge:d accessorial_charges:d booking_type:s gross_revenue:d"
    " reject:s",
    "SELECT * FROM x_load_typed",
)
add(
    "silver_reject_reasons",
    "reason:s rows:i",
    "SELECT reject AS reason, COUNT(*) AS rows FROM x_load_typed"
    " WHERE reject IS NOT NULL GROUP BY 1",
)
add(
    "gross_revenue",
    "load_id:s revenue:d fuel_surcharge:d accessorial_charges:d gross_revenue:d",
    "SELECT * FROM x_loads",
)
add(
    "per_1k_ratio",
    "load_id:s revenue_per_1k_lbs:d",
    f"SELECT load_id, {ratio('gross_revenue * 1000', 'weight_lbs')} AS revenue_per_1k_lbs"
    " FROM x_loads",
)
add(
    "late_minutes",
    "event_type:s late_min:d events:i",
    "SELECT event_type, date_diff('second', scheduled_datetime, actual_datetime) / 60.0"
    " AS late_min, COUNT(*) AS events FROM x_events GROUP BY 1, 2",
)
add(
    "month_keys",
    "year:i month:s purchases:i",
    "SELECT year(purchase_date) AS year, strftime(purchase_date, '%Y-%m') AS month,"
    " COUNT(*) AS purchases FROM x_fuel GROUP BY 1, 2",
)
add(
    "format_n0",
    "load_id:s gross_text:s",
    f"SELECT load_id, {n0('gross_revenue')} AS gross_text FROM x_loads",
)

# --- Filters --------------------------------------------------------------

add(
    "flt_known_member",
    "trips:i miles:d",
    "SELECT COUNT(*) AS trips, SUM(actual_distance_miles) AS miles FROM s_trips"
    " WHERE truck_id <> '-1'",
)
add(
    "flt_event_type",
    "location_state:s events:i",
    "SELECT location_state, COUNT(*) AS events FROM x_events"
    " WHERE event_type = 'Delivery' GROUP BY 1",
)
add(
    "flt_in_list",
    "month_nbr:i loads:i",
    "SELECT month(load_date) AS month_nbr, COUNT(*) AS loads FROM x_loads"
    " WHERE month(load_date) IN (12, 1, 2) AND dayofweek(load_date) IN (0, 6) GROUP BY 1",
)
add(
    "flt_list_membership",
    "loads:i gross:d",
    "SELECT COUNT(*) AS loads, SUM(gross_revenue) AS gross FROM x_loads WHERE customer_id"
    " IN (SELECT customer_id FROM x_customers WHERE customer_name = 'BUILDING 1')",
)
add(
    "flt_late_only",
    "event_type:s events:i det:i",
    "SELECT event_type, COUNT(*) AS events, SUM(detention_minutes) AS det FROM x_events"
    " WHERE on_time_flag = false GROUP BY 1",
)
add(
    "flt_year_slice",
    "year:i gross:d",
    "SELECT year(load_date) AS year, SUM(gross_revenue) AS gross FROM x_loads"
    " WHERE year(load_date) BETWEEN 1996 AND 2000 GROUP BY 1",
)
add(
    "flt_calendar_pruning",
    "year_nbr:i month_nbr:i trips:i miles:d",
    "SELECT year(dispatch_date) AS year_nbr, month(dispatch_date) AS month_nbr,"
    " COUNT(*) AS trips, SUM(actual_distance_miles) AS miles FROM x_trips"
    " WHERE month(dispatch_date) BETWEEN 6 AND 8 AND isodow(dispatch_date) >= 6"
    " AND year(dispatch_date) % 4 = 0 GROUP BY 1, 2",
)

# --- Reference checks -----------------------------------------------------

add(
    "fk_resolve_load",
    "load_id:s customer_id:s route_id:s gross_revenue:d",
    "SELECT * FROM s_loads",
)
add(
    "fk_resolve_trip",
    "trip_id:s load_id:s driver_id:s truck_id:s trailer_id:s actual_distance_miles:d",
    "SELECT * FROM s_trips",
)
add(
    "fk_missing_keys",
    "key:s member:s rows:i",
    " UNION ALL ".join(
        f"SELECT '{key}' AS key, t.{key} AS member, COUNT(*) AS rows FROM x_trips t"
        f" LEFT JOIN {parent} p ON p.{key} = t.{key}"
        f" WHERE t.{key} IS NOT NULL AND p.{key} IS NULL GROUP BY 2"
        for key, parent in (
            ("load_id", "x_loads"),
            ("driver_id", "x_drivers"),
            ("truck_id", "x_trucks"),
            ("trailer_id", "x_trailers"),
        )
    ),
)
add(
    "fk_apply_missing",
    "trip_id:s load_id:s driver_id:s truck_id:s trailer_id:s actual_distance_miles:d",
    "SELECT * FROM s_trips",
)
add(
    "fk_resolve_delivery",
    "load_id:s trip_id:s facility_id:s rows:i",
    "SELECT load_id, trip_id, facility_id, COUNT(*) AS rows FROM s_events GROUP BY 1, 2, 3",
)
add(
    "fk_resolve_fuel",
    "trip_id:s truck_id:s driver_id:s rows:i",
    "SELECT trip_id, truck_id, driver_id, COUNT(*) AS rows FROM s_fuel GROUP BY 1, 2, 3",
)
add(
    "fk_resolve_maintenance",
    "maintenance_id:s truck_id:s total_cost:d",
    "SELECT * FROM s_maintenance",
)
add(
    "fk_resolve_incident",
    "incident_id:s trip_id:s truck_id:s driver_id:s claim_amount:d",
    "SELECT * FROM s_incidents",
)
add(
    "fk_resolve_monthly",
    "asset:s asset_id:s month:s trips_completed:i",
    "SELECT 'driver' AS asset, driver_id AS asset_id, month, trips_completed"
    " FROM s_driver_months UNION ALL"
    " SELECT 'truck', truck_id, month, trips_completed FROM s_truck_months",
)


def numbered(table: str, key: str, sk: str) -> str:
    return (
        f"SELECT *, row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {key}) AS {sk}"
        f" FROM {table}"
    )


add(
    "sk_dim_customer",
    "customer_sk:i customer_id:s customer_name:s",
    numbered("x_customers", "customer_id", "customer_sk"),
)
NUMBER = "row_number() OVER (ORDER BY substr(md5(customer_id), 1, 3), customer_id)"
add(
    "sk_lasting_customer",
    "customer_sk:i customer_id:s added:i",
    f"WITH early AS (SELECT customer_id, {NUMBER} AS customer_sk FROM x_customers"
    f" WHERE CAST(customer_id AS BIGINT) % 3 <> 0)"
    " SELECT *, 0 AS added FROM early UNION ALL BY NAME"
    f" SELECT customer_id, {NUMBER} + (SELECT COUNT(*) FROM early) AS customer_sk, 1 AS added"
    " FROM x_customers WHERE CAST(customer_id AS BIGINT) % 3 = 0",
)
add(
    "dim_with_unknown",
    "driver_sk:i driver_id:s full_name:s home_terminal:s employment_status:s cdl_class:s"
    " years_experience:i is_active:s",
    numbered("x_drivers", "driver_id", "driver_sk")
    + " UNION ALL BY NAME SELECT -1 AS driver_sk, '-1' AS driver_id,"
    " 'Unknown Driver' AS full_name",
)
for _name, _cte, _out in (
    (
        "dim_customer",
        "d_customers",
        "customer_id:s customer_name:s customer_type:s credit_terms_days:i"
        " primary_freight_type:s account_status:s annual_revenue_potential:d is_active:s",
    ),
    (
        "dim_facility",
        "d_facilities",
        "facility_id:s facility_name:s facility_type:s city:s state:s dock_doors:i"
        " operating_hours:s",
    ),
    (
        "dim_route",
        "d_routes",
        "route_id:s origin_city:s origin_state:s destination_city:s destination_state:s"
        " corridor:s typical_distance_miles:i base_rate_per_mile:d fuel_surcharge_rate:d"
        " typical_transit_days:i",
    ),
    (
        "dim_trailer",
        "d_trailers",
        "trailer_id:s trailer_number:s trailer_type:s length_feet:i status:s"
        " current_location:s is_active:s",
    ),
    (
        "dim_truck",
        "d_trucks",
        "truck_id:s unit_number:s make:s model_year:i fuel_type:s status:s"
        " home_terminal:s is_active:s",
    ),
):
    add(f"gold_{_name}", _out, f"SELECT * FROM {_cte}")

CTE["n_customers"] = numbered("x_customers", "customer_id", "customer_sk")
CTE["n_routes"] = numbered("x_routes", "route_id", "route_sk")
add(
    "sk_resolve_fact",
    "load_id:s customer_sk:i route_sk:i date_sk:s",
    "SELECT l.load_id, COALESCE(c.customer_sk, -1) AS customer_sk,"
    " COALESCE(r.route_sk, -1) AS route_sk, l.load_date AS date_sk FROM x_loads l"
    " LEFT JOIN n_customers c ON c.customer_id = l.customer_id"
    " LEFT JOIN n_routes r ON r.route_id = l.route_id",
)
add(
    "gold_fact_load",
    "load_id:s customer_id:s route_id:s date_sk:s load_type:s weight_lbs:d pieces:i"
    " revenue:d fuel_surcharge:d accessorial_charges:d booking_type:s gross_revenue:d",
    "SELECT *, load_date AS date_sk FROM s_loads",
)
add(
    "gold_fact_trip",
    "trip_id:s load_sk:s driver_id:s truck_id:s trailer_id:s date_sk:s"
    " actual_distance_miles:d actual_duration_hours:d fuel_gallons_used:d average_mpg:d"
    " idle_time_hours:d trip_status:s",
    "SELECT *, load_id AS load_sk, dispatch_date AS date_sk FROM s_trips",
)
add(
    "gold_fact_delivery",
    "trip_sk:s load_sk:s facility_id:s date_sk:s rows:i total:i",
    "SELECT trip_id AS trip_sk, load_id AS load_sk, facility_id,"
    " CAST(scheduled_datetime AS DATE) AS date_sk, COUNT(*) AS rows,"
    " SUM(detention_minutes) AS total FROM s_events GROUP BY 1, 2, 3, 4",
)
add(
    "gold_fact_fuel",
    "trip_sk:s truck_id:s driver_id:s date_sk:s rows:i total:d",
    "SELECT trip_id AS trip_sk, truck_id, driver_id, purchase_date AS date_sk,"
    " COUNT(*) AS rows, SUM(total_cost) AS total FROM s_fuel GROUP BY 1, 2, 3, 4",
)
add(
    "gold_fact_maintenance",
    "maintenance_id:s truck_id:s date_sk:s maintenance_type:s odometer_reading:d"
    " labor_hours:d labor_cost:d parts_cost:d total_cost:d facility_location:s"
    " downtime_hours:d",
    "SELECT *, maintenance_date AS date_sk FROM s_maintenance",
)
add(
    "gold_fact_incident",
    "incident_id:s trip_sk:s truck_id:s driver_id:s date_sk:s incident_type:s"
    " at_fault_flag:s injury_flag:s vehicle_damage_cost:d cargo_damage_cost:d"
    " claim_amount:d preventable_flag:s",
    "SELECT *, trip_id AS trip_sk, incident_date AS date_sk FROM s_incidents",
)
add(
    "gold_fact_driver_monthly",
    "driver_id:s date_sk:s trips_completed:i total_miles:d total_revenue:d average_mpg:d"
    " total_fuel_gallons:d on_time_delivery_rate:d average_idle_hours:d",
    "SELECT *, month AS date_sk FROM s_driver_months",
)
add(
    "gold_fact_truck_monthly",
    "truck_id:s date_sk:s trips_completed:i total_miles:d total_revenue:d average_mpg:d"
    " maintenance_events:i maintenance_cost:d downtime_hours:d utilization_rate:d",
    "SELECT *, month AS date_sk FROM s_truck_months",
)

# --- Joins ----------------------------------------------------------------

add(
    "join_star",
    "home_terminal:s make:s trailer_type:s trips:i",
    "SELECT d.home_terminal, k.make, r.trailer_type, COUNT(*) AS trips FROM s_trips t"
    " JOIN d_drivers d ON d.driver_id = t.driver_id"
    " JOIN d_trucks k ON k.truck_id = t.truck_id"
    " JOIN d_trailers r ON r.trailer_id = t.trailer_id GROUP BY 1, 2, 3",
)
add(
    "join_fact_fact",
    "load_type:s booking_type:s events:i",
    "SELECT l.load_type, l.booking_type, COUNT(e.event_id) AS events FROM s_events e"
    " JOIN s_loads l ON l.load_id = e.load_id WHERE e.event_type = 'Delivery'"
    " GROUP BY 1, 2",
)
add(
    "join_derived_agg",
    "truck_id:s miles:d",
    "SELECT k.truck_id, m.miles FROM d_trucks k LEFT JOIN (SELECT truck_id,"
    " SUM(actual_distance_miles) AS miles FROM s_trips GROUP BY 1) m"
    " ON m.truck_id = k.truck_id",
)
add(
    "join_agg_pair_fill0",
    "truck_id:s trips:i services:i cost:d",
    "SELECT t.truck_id, t.trips, COALESCE(m.services, 0) AS services,"
    " COALESCE(m.cost, 0) AS cost FROM (SELECT truck_id, COUNT(*) AS trips FROM s_trips"
    " GROUP BY 1) t LEFT JOIN (SELECT truck_id, COUNT(*) AS services,"
    " SUM(total_cost) AS cost FROM s_maintenance GROUP BY 1) m ON m.truck_id = t.truck_id",
)
add(
    "join_year_pair",
    "year:i year_evt:i events:i",
    "SELECT year(l.load_date) AS year, year(e.scheduled_datetime) AS year_evt,"
    " COUNT(*) AS events FROM x_events e JOIN x_loads l ON l.load_id = e.load_id"
    " GROUP BY 1, 2",
)
add(
    "join_anti_integrity",
    "fact:s key:s dangling:i",
    "SELECT 'fact_maintenance' AS fact, 'truck_id' AS key, COUNT(*) AS dangling"
    " FROM x_maintenance m LEFT JOIN x_trucks k ON k.truck_id = m.truck_id"
    " WHERE k.truck_id IS NULL",
)

# --- Aggregates -----------------------------------------------------------

add(
    "agg_conditional_pct",
    "facility_id:s events:i on_time:i on_time_pct:d",
    f"SELECT facility_id, COUNT(e.event_id) AS events, {ON} AS on_time,"
    f" {pct(ON, 'COUNT(e.event_id)')} AS on_time_pct FROM x_events e GROUP BY 1",
)
add(
    "agg_ratio_of_sums",
    "truck_id:s price:d",
    f"SELECT truck_id, {ratio('SUM(total_cost)', 'SUM(gallons)')} AS price FROM x_fuel"
    " GROUP BY 1",
)
add(
    "agg_distinct",
    "year:i trucks:i trips:i",
    "SELECT year(dispatch_date) AS year, COUNT(DISTINCT truck_id) AS trucks,"
    " COUNT(*) AS trips FROM x_trips GROUP BY 1",
)
MEAN_DET = ratio("SUM(e.detention_minutes)", "COUNT(e.detention_minutes)")
add(
    "agg_avg_exact",
    "facility_id:s avg_detention_min:d",
    f"SELECT facility_id, {MEAN_DET} AS avg_detention_min FROM x_events e GROUP BY 1",
)
add(
    "agg_avg_int_trunc",
    "facility_id:s avg_detention_min:i",
    "SELECT facility_id, SUM(detention_minutes) // COUNT(detention_minutes)"
    " AS avg_detention_min FROM x_events GROUP BY 1",
)
add(
    "agg_std_median_corr",
    "sd:d r:d months_min:i months_max:i months_median:d",
    "SELECT ROUND(stddev_samp(u), 8) AS sd, ROUND(corr(u, m), 8) AS r,"
    " MIN(n) AS months_min, MAX(n) AS months_max, median(n) AS months_median FROM ("
    "SELECT truck_id, CAST(SUM(utilization_rate) AS DOUBLE) / COUNT(*) AS u,"
    " CAST(SUM(average_mpg) AS DOUBLE) / COUNT(*) AS m, COUNT(*) AS n"
    " FROM x_truck_months GROUP BY 1)",
)
add(
    "agg_share_of_total",
    "booking_type:s g:d share:d",
    f"SELECT booking_type, g, {pct('g', 't', 2)} AS share FROM (SELECT booking_type,"
    " SUM(gross_revenue) AS g FROM x_loads GROUP BY 1),"
    " (SELECT SUM(gross_revenue) AS t FROM x_loads)",
)
add(
    "calendar",
    "date_id:s year_nbr:i month_nbr:i day_nbr:i quarter_nbr:i weekday_nbr:i month_name:s"
    " weekday_name:s is_weekend:s season:s loads:i",
    "SELECT d.*, (SELECT COUNT(*) FROM x_loads l WHERE l.load_date = d.date_id) AS loads"
    " FROM cal d",
)
add(
    "calendar_fiscal",
    "fiscal_year:i fiscal_quarter:i loads:i gross_revenue:d",
    "SELECT year(load_date + INTERVAL 3 MONTH) AS fiscal_year,"
    " quarter(load_date + INTERVAL 3 MONTH) AS fiscal_quarter, COUNT(*) AS loads,"
    " COALESCE(SUM(gross_revenue), 0) AS gross_revenue FROM x_loads GROUP BY 1, 2",
)
add(
    "calendar_holidays",
    "year_nbr:i holiday:s loads:i gross_revenue:d",
    "SELECT year(load_date) AS year_nbr, holiday, COUNT(*) AS loads,"
    " COALESCE(SUM(gross_revenue), 0) AS gross_revenue FROM (SELECT *, CASE"
    " WHEN strftime(load_date, '%m-%d') = '01-01' THEN 'New Year''s Day'"
    " WHEN strftime(load_date, '%m-%d') = '06-19' THEN 'Juneteenth'"
    " WHEN strftime(load_date, '%m-%d') = '07-04' THEN 'Independence Day'"
    " WHEN strftime(load_date, '%m-%d') = '11-11' THEN 'Veterans Day'"
    " WHEN strftime(load_date, '%m-%d') = '12-25' THEN 'Christmas Day'"
    " WHEN dayname(load_date) = 'Monday' THEN CASE"
    " WHEN month(load_date) = 1 AND day(load_date) BETWEEN 15 AND 21"
    " THEN 'Martin Luther King Day'"
    " WHEN month(load_date) = 2 AND day(load_date) BETWEEN 15 AND 21 THEN 'Presidents'' Day'"
    " WHEN month(load_date) = 5 AND day(load_date) >= 25 THEN 'Memorial Day'"
    " WHEN month(load_date) = 9 AND day(load_date) <= 7 THEN 'Labor Day'"
    " WHEN month(load_date) = 10 AND day(load_date) BETWEEN 8 AND 14 THEN 'Columbus Day' END"
    " WHEN dayname(load_date) = 'Thursday' AND month(load_date) = 11"
    " AND day(load_date) BETWEEN 22 AND 28 THEN 'Thanksgiving' END AS holiday FROM x_loads)"
    " GROUP BY 1, 2",
)
add(
    "calendar_hours",
    "hour_nbr:i day_part:s event_type:s events:i detention_minutes:i",
    "SELECT hour(scheduled_datetime) AS hour_nbr, CASE hour(scheduled_datetime) // 6"
    " WHEN 0 THEN 'Night' WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon' ELSE 'Evening' END"
    " AS day_part, event_type, COUNT(*) AS events,"
    " SUM(detention_minutes) AS detention_minutes FROM x_events GROUP BY 1, 2, 3",
)
add(
    "monthly_layer",
    "month:s customer_id:s route_id:s loads:i gross_revenue:d weight_lbs:d",
    "SELECT CAST(date_trunc('month', load_date) AS DATE) AS month, customer_id, route_id,"
    " COUNT(*) AS loads, COALESCE(SUM(gross_revenue), 0) AS gross_revenue,"
    " SUM(weight_lbs) AS weight_lbs FROM s_loads GROUP BY 1, 2, 3",
)
add(
    "monthly_layer_renewed",
    "month:s customer_id:s route_id:s loads:i gross_revenue:d weight_lbs:d renewed:i",
    "SELECT CAST(date_trunc('month', load_date) AS DATE) AS month, customer_id, route_id,"
    " COUNT(*) AS loads, COALESCE(SUM(gross_revenue), 0) AS gross_revenue,"
    " SUM(weight_lbs) AS weight_lbs, MAX(CASE WHEN date_trunc('month', load_date) IN"
    " (SELECT date_trunc('month', load_date) FROM x_loads WHERE year(load_date) = 1997"
    " AND CAST(load_id AS BIGINT) % 3 = 0) THEN 1 ELSE 0 END) AS renewed"
    " FROM s_loads GROUP BY 1, 2, 3",
)
_SEEN = " UNION ALL ".join(
    f"SELECT {period} AS period, '{dim}_sk' AS member, NULLIF({dim}_id, '-1') AS id FROM s_trips"
    for period in (
        "CAST(CAST(date_trunc('month', dispatch_date) AS DATE) AS VARCHAR)",
        "CAST(year(dispatch_date) AS VARCHAR)",
        "'all'",
    )
    for dim in ("driver", "truck", "trailer")
)
add(
    "agg_distinct_rolled_up",
    "period:s member:s distinct_members:i",
    "SELECT period, member, COUNT(DISTINCT id) AS distinct_members"
    f" FROM ({_SEEN}) WHERE id IS NOT NULL GROUP BY 1, 2",
)
add("sorted_distinct", "load_type:s", "SELECT DISTINCT load_type FROM x_loads ORDER BY 1")
add(
    "topk_corridor",
    "route_id:s gross:d",
    "SELECT route_id, SUM(gross_revenue) AS gross FROM s_loads GROUP BY 1"
    " ORDER BY 2 DESC, 1 LIMIT 10",
)
FACT_CTES = {
    "fact_load": "x_loads",
    "fact_trip": "x_trips",
    "fact_delivery": "x_events",
    "fact_fuel": "x_fuel",
    "fact_maintenance": "x_maintenance",
    "fact_incident": "x_incidents",
    "fact_driver_monthly": "x_driver_months",
    "fact_truck_monthly": "x_truck_months",
}
DIM_CTES = {
    "dim_driver": "x_drivers",
    "dim_truck": "x_trucks",
    "dim_trailer": "x_trailers",
    "dim_customer": "x_customers",
    "dim_facility": "x_facilities",
    "dim_route": "x_routes",
}


def counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS object_name, COUNT(*) AS rows FROM {c}" for n, c in tables.items()
    )


add("union_counts", "object_name:s rows:i", counts(FACT_CTES))

# --- Views ----------------------------------------------------------------

# Facts summed per key once; the views below only put such sums together. v_: sums per
# load, trip, customer, driver, truck or facility.
PUNCTUAL = (
    "COUNT(*) AS seen, COUNT(*) FILTER (on_time_flag) AS good,"
    " COUNT(*) FILTER (event_type = 'Delivery') AS drops,"
    " COUNT(*) FILTER (event_type = 'Delivery' AND on_time_flag) AS good_drops"
)
CTE["v_load_events"] = f"SELECT load_id, {PUNCTUAL} FROM s_events GROUP BY ALL"
CTE["v_trip_events"] = f"SELECT trip_id, {PUNCTUAL} FROM s_events GROUP BY ALL"
CTE["v_truck_miles"] = """
SELECT truck_id, COUNT(*) AS n, SUM(actual_distance_miles) AS miles,
       SUM(actual_duration_hours) AS hours
FROM s_trips WHERE truck_id <> '-1' GROUP BY ALL"""
# Each load and trip with the number of rows that a join to its events gives.
CTE["v_loads_fanned"] = """
SELECT s_loads.*, CAST(GREATEST(COALESCE(seen, 0), 1) AS INTEGER) AS fan
FROM s_loads LEFT JOIN v_load_events USING (load_id)"""
CTE["v_trips_fanned"] = """
SELECT s_trips.*, CAST(GREATEST(COALESCE(seen, 0), 1) AS INTEGER) AS fan
FROM s_trips LEFT JOIN v_trip_events USING (trip_id) WHERE driver_id <> '-1'"""
CTE["v_customer_events"] = """
SELECT customer_id, SUM(seen) AS seen, SUM(good) AS good, SUM(drops) AS drops,
       SUM(good_drops) AS good_drops
FROM v_load_events JOIN s_loads USING (load_id) GROUP BY ALL"""
CTE["v_customer_trips"] = """
SELECT customer_id, COUNT(*) AS trips
FROM (SELECT DISTINCT customer_id, trip_id FROM s_events JOIN s_loads USING (load_id))
GROUP BY ALL"""
CTE["v_driver_events"] = """
SELECT driver_id, SUM(seen) AS seen, SUM(good) AS good, SUM(drops) AS drops,
       SUM(good_drops) AS good_drops
FROM v_trip_events JOIN s_trips USING (trip_id) GROUP BY ALL"""
ON_TIME = (
    f"{pct('good', 'seen')} AS on_time_pct,"
    f" {pct('good_drops', 'drops')} AS delivery_on_time_pct"
)

OVERVIEW = f"""
SELECT * FROM
  (SELECT COUNT(DISTINCT NULLIF(truck_id, '-1')) AS active_trucks,
          COUNT(DISTINCT NULLIF(driver_id, '-1')) AS active_drivers,
          COUNT(*) AS total_trips, SUM(actual_distance_miles) AS total_miles,
          {ratio("SUM(average_mpg)", "COUNT(average_mpg)")} AS avg_mpg
   FROM s_trips),
  (SELECT seen AS all_events, drops AS delivery_events,
          {pct("good_drops", "drops")} AS on_time_delivery_pct
   FROM (SELECT {PUNCTUAL} FROM s_events)),
  (SELECT {pct("SUM(utilization_rate)", "COUNT(utilization_rate)")} AS avg_utilization_pct
   FROM s_truck_months),
  (SELECT SUM(total_cost) AS fuel_cost FROM s_fuel),
  (SELECT SUM(total_cost) AS maintenance_cost FROM s_maintenance),
  (SELECT SUM(claim_amount) AS claims_total FROM s_incidents),
  (SELECT SUM(gross_revenue) AS gross_revenue FROM s_loads)"""
add(
    "v_kpi_overview",
    "total_trips:i delivery_events:i all_events:i gross_revenue:d total_miles:d avg_mpg:d"
    " fuel_cost:d maintenance_cost:d claims_total:d on_time_delivery_pct:d"
    " avg_utilization_pct:d active_drivers:i active_trucks:i",
    OVERVIEW,
)
add(
    "v_load_profitability",
    "load_id:s customer_name:s corridor:s year_nbr:i load_type:s booking_type:s"
    " weight_lbs:d revenue:d fuel_surcharge:d accessorial_charges:d gross_revenue:d"
    " revenue_per_1k_lbs:d",
    f"SELECT *, {ratio('1000 * gross_revenue', 'weight_lbs')} AS revenue_per_1k_lbs,"
    " year(load_date) AS year_nbr,"
    " (SELECT any_value(corridor) FROM d_routes q WHERE q.route_id = s_loads.route_id)"
    " AS corridor,"
    " (SELECT any_value(customer_name) FROM d_customers q"
    " WHERE q.customer_id = s_loads.customer_id) AS customer_name FROM s_loads",
)
add(
    "v_route_performance",
    "route_id:s corridor:s typical_distance_miles:i loads:i gross_revenue:d"
    " revenue_per_mile:d revenue_per_loaded_mile:d",
    "SELECT *,"
    f" {ratio('gross_revenue', 'typical_distance_miles')} AS revenue_per_mile,"
    f" {ratio('gross_revenue', '(loads * typical_distance_miles)')}"
    " AS revenue_per_loaded_mile FROM d_routes JOIN (SELECT route_id, COUNT(*) AS loads,"
    " SUM(gross_revenue) AS gross_revenue FROM s_loads GROUP BY ALL) USING (route_id)",
)


def customer_service(weight: str) -> str:
    """``weight``: how often a load's revenue counts."""
    return (
        "WITH own AS (SELECT customer_id, COUNT(*) AS loads,"
        f" SUM(gross_revenue * {weight}) AS gross_revenue FROM v_loads_fanned GROUP BY ALL)"
        f" SELECT *, {ON_TIME} FROM (SELECT own.*, customer_name, customer_type,"
        " COALESCE(v_customer_trips.trips, 0) AS trips, good, seen, good_drops, drops"
        " FROM own JOIN d_customers USING (customer_id)"
        " LEFT JOIN v_customer_events USING (customer_id)"
        " LEFT JOIN v_customer_trips USING (customer_id))"
    )


SERVICE_OUT = (
    "customer_id:s customer_name:s customer_type:s loads:i gross_revenue:d trips:i"
    " on_time_pct:d delivery_on_time_pct:d"
)
add("v_customer_service", SERVICE_OUT, customer_service("1"))
add("v_customer_service_as_written", SERVICE_OUT, customer_service("fan"))


def driver_performance(weight: str) -> str:
    """``weight``: how often a trip counts."""
    return (
        f"WITH own AS (SELECT driver_id, SUM({weight}) AS trips,"
        f" SUM(actual_distance_miles * {weight}) AS total_miles,"
        f" SUM(idle_time_hours * {weight}) AS idle_hours,"
        f" SUM(actual_duration_hours * {weight}) AS driven_hours,"
        f" SUM(average_mpg * {weight}) AS mpg,"
        f" SUM({weight}) FILTER (average_mpg IS NOT NULL) AS mpg_trips"
        " FROM v_trips_fanned GROUP BY ALL)"
        f" SELECT *, {ratio('mpg', 'mpg_trips')} AS avg_mpg,"
        f" {ratio('total_miles', 'driven_hours')} AS avg_speed_mph, {ON_TIME}"
        " FROM d_drivers JOIN own USING (driver_id)"
        " LEFT JOIN v_driver_events USING (driver_id)"
    )


DRIVER_OUT = (
    "driver_id:s full_name:s home_terminal:s years_experience:i trips:i total_miles:d"
    " avg_mpg:d idle_hours:d avg_speed_mph:d on_time_pct:d delivery_on_time_pct:d"
)
add("v_driver_performance", DRIVER_OUT, driver_performance("1"))
add("v_driver_performance_as_written", DRIVER_OUT, driver_performance("fan"))


def fleet(per_month: str, per_trip: str) -> str:
    """Factors on sums of trips and on sums of months: the other side's row count."""
    return (
        "WITH months AS (SELECT truck_id, COUNT(*) AS month_rows,"
        f" {pct('SUM(utilization_rate)', 'COUNT(utilization_rate)', 4)}"
        " AS avg_utilization_pct, SUM(downtime_hours) AS idle,"
        " SUM(maintenance_cost) AS upkeep FROM s_truck_months GROUP BY ALL)"
        " SELECT *, COALESCE(n, 0) * " + per_month + " AS trips,"
        f" miles * {per_month} AS total_miles, hours * {per_month} AS total_hours,"
        f" idle * {per_trip} AS downtime_hours, upkeep * {per_trip} AS maintenance_cost"
        " FROM x_trucks JOIN months USING (truck_id)"
        " LEFT JOIN v_truck_miles USING (truck_id)"
    )


FLEET_OUT = (
    "truck_id:s unit_number:s make:s model_year:i status:s trips:i total_miles:d"
    " total_hours:d avg_utilization_pct:d downtime_hours:d maintenance_cost:d"
)
add("v_fleet_utilization", FLEET_OUT, fleet("1", "1"))
add(
    "v_fleet_utilization_as_written",
    FLEET_OUT,
    fleet("month_rows", "GREATEST(COALESCE(n, 0), 1)"),
)
MONTH_OF = (
    "year({0}) AS year_nbr, month({0}) AS month_nbr, monthname({0}) AS month_name"
)
add(
    "v_fuel_efficiency",
    "year_nbr:i month_nbr:i month_name:s purchases:i gallons:d fuel_cost:d"
    " avg_gallons_per_purchase:d avg_price_per_gallon:d",
    f"SELECT *, {ratio('gallons', 'purchases')} AS avg_gallons_per_purchase,"
    f" {ratio('fuel_cost', 'gallons')} AS avg_price_per_gallon FROM ("
    f"SELECT {MONTH_OF.format('purchase_date')}, SUM(total_cost) AS fuel_cost,"
    " SUM(gallons) AS gallons, COUNT(*) AS purchases FROM x_fuel GROUP BY ALL)",
)
MAINT_OUT = (
    "truck_id:s make:s model_year:i maintenance_events:i maintenance_cost:d"
    " downtime_hours:d cost_per_mile:d"
)


def maintenance(times: str) -> str:
    """``times``: how often a truck's miles count in the divisor."""
    return (
        "WITH jobs AS (SELECT truck_id, COUNT(*) AS maintenance_events,"
        " SUM(downtime_hours) AS downtime_hours, SUM(total_cost) AS maintenance_cost"
        " FROM s_maintenance GROUP BY ALL)"
        f" SELECT *, {ratio('maintenance_cost', f'(miles * {times})')} AS cost_per_mile"
        " FROM x_trucks JOIN jobs USING (truck_id) LEFT JOIN v_truck_miles USING (truck_id)"
    )


add("v_maintenance_analysis", MAINT_OUT, maintenance("1"))
add("v_maintenance_analysis_as_written", MAINT_OUT, maintenance("maintenance_events"))
add(
    "v_safety_dashboard",
    "year_nbr:i incidents:i at_fault:i with_injury:i preventable:i vehicle_damage:d"
    " cargo_damage:d claims:d",
    "SELECT year(incident_date) AS year_nbr, SUM(claim_amount) AS claims,"
    " SUM(cargo_damage_cost) AS cargo_damage, SUM(vehicle_damage_cost) AS vehicle_damage,"
    " COUNT(*) FILTER (preventable_flag) AS preventable,"
    " COUNT(*) FILTER (injury_flag) AS with_injury,"
    " COUNT(*) FILTER (at_fault_flag) AS at_fault, COUNT(*) AS incidents"
    " FROM x_incidents GROUP BY ALL",
)
add(
    "v_monthly_trend",
    "year_nbr:i month_nbr:i month_name:s season:s loads:i gross_revenue:d"
    " total_weight_lbs:d",
    f"SELECT {MONTH_OF.format('load_date')}, COUNT(*) AS loads,"
    " ['Winter', 'Spring', 'Summer', 'Fall'][1 + (month(load_date) % 12) // 3] AS season,"
    " SUM(weight_lbs) AS total_weight_lbs, SUM(gross_revenue) AS gross_revenue"
    " FROM x_loads GROUP BY ALL",
)


def detention(mean: str) -> str:
    """``mean`` of ``total`` minutes over the ``timed`` events."""
    return (
        f"WITH stops AS (SELECT facility_id, {PUNCTUAL},"
        " SUM(detention_minutes) AS total, COUNT(detention_minutes) AS timed"
        " FROM s_events GROUP BY ALL)"
        f" SELECT *, seen AS events, total AS detention_minutes, {mean}"
        f" AS avg_detention_min, {ON_TIME} FROM d_facilities JOIN stops USING (facility_id)"
    )


DETENTION_OUT = (
    "facility_id:s facility_name:s city:s state:s events:i detention_minutes:i"
    " avg_detention_min:{t} on_time_pct:d delivery_on_time_pct:d"
)
add("v_detention_analysis", DETENTION_OUT.format(t="d"), detention(ratio("total", "timed")))
add(
    "v_detention_analysis_as_written",
    DETENTION_OUT.format(t="i"),
    detention("total // timed"),
)

# --- KPI queries ----------------------------------------------------------

add(
    "kpi_1",
    "total_trips:i delivery_events:i gross_revenue:s total_miles:s avg_mpg:d fuel_cost:s"
    " maintenance_cost:s claims_total:s on_time_delivery_pct:d avg_utilization_pct:d"
    " active_drivers:i active_trucks:i",
    f"SELECT total_trips, delivery_events, {n0('gross_revenue')} AS gross_revenue,"
    f" {n0('total_miles')} AS total_miles, ROUND(avg_mpg, 2) AS avg_mpg,"
    f" {n0('fuel_cost')} AS fuel_cost, {n0('maintenance_cost')} AS maintenance_cost,"
    f" {n0('claims_total')} AS claims_total, on_time_delivery_pct, avg_utilization_pct,"
    f" active_drivers, active_trucks FROM ({OVERVIEW})",
)
add(
    "kpi_2",
    "year_nbr:i delivery_events:i on_time:i on_time_pct:d",
    f"SELECT d.year_nbr, COUNT(*) AS delivery_events, {ON} AS on_time,"
    f" {pct(ON, 'COUNT(*)')} AS on_time_pct FROM s_events e"
    " JOIN cal d ON d.date_id = CAST(e.scheduled_datetime AS DATE)"
    " WHERE e.event_type = 'Delivery' GROUP BY 1 ORDER BY 1",
)
add(
    "kpi_3",
    "year_nbr:i loads:i gross_revenue:s base_revenue:s",
    f"SELECT d.year_nbr, COUNT(*) AS loads, {n0('SUM(f.gross_revenue)')} AS gross_revenue,"
    f" {n0('SUM(f.revenue)')} AS base_revenue FROM s_loads f"
    " JOIN cal d ON d.date_id = f.load_date GROUP BY 1 ORDER BY 1",
)
add(
    "kpi_4",
    "corridor:s loads:i gross_revenue:s revenue_per_mile:d",
    f"SELECT corridor, loads, {n0('g')} AS gross_revenue,"
    f" {ratio('g', 'miles', 2)} AS revenue_per_mile FROM (SELECT r.corridor,"
    " r.typical_distance_miles AS miles, COUNT(*) AS loads, SUM(f.gross_revenue) AS g"
    " FROM s_loads f JOIN d_routes r ON r.route_id = f.route_id GROUP BY 1, 2"
    " ORDER BY g DESC, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 5)",
)
add(
    "kpi_5",
    "customer_name:s customer_type:s loads:i gross_revenue:s",
    f"SELECT customer_name, customer_type, loads, {n0('g')} AS gross_revenue FROM"
    " (SELECT c.customer_name, c.customer_type, COUNT(*) AS loads,"
    " SUM(f.gross_revenue) AS g FROM s_loads f"
    " JOIN d_customers c ON c.customer_id = f.customer_id GROUP BY 1, 2"
    " ORDER BY g DESC, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 5)",
)
add(
    "kpi_5_by_account",
    "customer_id:s customer_name:s customer_type:s loads:i gross_revenue:s",
    f"SELECT customer_id, customer_name, customer_type, loads, {n0('g')} AS gross_revenue"
    " FROM (SELECT c.customer_id, c.customer_name, c.customer_type, COUNT(*) AS loads,"
    " SUM(f.gross_revenue) AS g FROM s_loads f"
    " JOIN d_customers c ON c.customer_id = f.customer_id GROUP BY 1, 2, 3"
    " ORDER BY g DESC, 1 LIMIT 5)",
)
add(
    "kpi_6",
    "truck_id:s make:s model_year:i avg_utilization_pct:d downtime_hours:d"
    " maintenance_cost:d",
    "SELECT t.truck_id, t.make, t.model_year,"
    f" {pct('SUM(m.utilization_rate)', 'COUNT(*)')} AS avg_utilization_pct,"
    " SUM(m.downtime_hours) AS downtime_hours, SUM(m.maintenance_cost) AS maintenance_cost"
    " FROM s_truck_months m JOIN d_trucks t ON t.truck_id = m.truck_id"
    " WHERE t.truck_id <> '-1' GROUP BY 1, 2, 3"
    f" ORDER BY {pct('SUM(m.utilization_rate)', 'COUNT(*)', 8)} DESC, 1 LIMIT 5",
)
add(
    "kpi_7",
    "year_nbr:i gallons:s fuel_cost:s avg_price_per_gallon:d",
    f"SELECT d.year_nbr, {n0('SUM(f.gallons)')} AS gallons,"
    f" {n0('SUM(f.total_cost)')} AS fuel_cost,"
    f" {ratio('SUM(f.total_cost)', 'SUM(f.gallons)', 3)} AS avg_price_per_gallon"
    " FROM s_fuel f JOIN cal d ON d.date_id = f.purchase_date GROUP BY 1 ORDER BY 1",
)
add(
    "kpi_8",
    "facility_name:s city:s events:i avg_detention_min:d on_time_pct:d"
    " delivery_on_time_pct:d",
    "SELECT g.facility_name, g.city, COUNT(*) AS events,"
    f" {ratio('SUM(e.detention_minutes)', 'COUNT(*)', 1)} AS avg_detention_min,"
    f" {pct(ON, 'COUNT(*)')} AS on_time_pct, {pct(ON_D, N_D)} AS delivery_on_time_pct"
    " FROM s_events e JOIN d_facilities g ON g.facility_id = e.facility_id GROUP BY 1, 2"
    f" ORDER BY {ratio('SUM(e.detention_minutes)', 'COUNT(*)', 8)} DESC, 1, 2 LIMIT 5",
)
add(
    "kpi_9",
    "corridor:s events:i on_time:i on_time_pct:d",
    f"SELECT r.corridor, COUNT(*) AS events, {ON} AS on_time,"
    f" {pct(ON, 'COUNT(*)')} AS on_time_pct FROM s_events e"
    " JOIN s_loads f ON f.load_id = e.load_id JOIN d_routes r ON r.route_id = f.route_id"
    " WHERE e.event_type = 'Delivery' GROUP BY 1",
)
add(
    "kpi_10",
    "avg_miles_per_trip:d avg_cost_per_maintenance_event:d maintenance_cost_per_mile:d"
    " incidents_per_million_miles:d preventable_pct:d at_fault_pct:d fuel_pct_of_gross:d"
    " avg_detention_min:d",
    f"SELECT {ratio('miles', 'trips', 1)} AS avg_miles_per_trip,"
    f" {ratio('service', 'services', 2)} AS avg_cost_per_maintenance_event,"
    f" {ratio('service', 'miles')} AS maintenance_cost_per_mile,"
    f" {ratio('incidents * 1000000', 'miles', 2)} AS incidents_per_million_miles,"
    f" {pct('preventable', 'incidents')} AS preventable_pct,"
    f" {pct('at_fault', 'incidents')} AS at_fault_pct,"
    f" {pct('fuel', 'gross')} AS fuel_pct_of_gross,"
    f" {ratio('det', 'timed', 1)} AS avg_detention_min FROM"
    " (SELECT COUNT(*) AS trips, SUM(actual_distance_miles) AS miles FROM s_trips),"
    " (SELECT COUNT(*) AS services, SUM(total_cost) AS service FROM s_maintenance),"
    " (SELECT COUNT(*) AS incidents, COUNT(*) FILTER (preventable_flag) AS preventable,"
    " COUNT(*) FILTER (at_fault_flag) AS at_fault FROM x_incidents),"
    " (SELECT SUM(total_cost) AS fuel FROM s_fuel),"
    " (SELECT SUM(gross_revenue) AS gross FROM s_loads),"
    " (SELECT SUM(detention_minutes) AS det, COUNT(detention_minutes) AS timed"
    " FROM s_events)",
)
TRUCK_UTIL = (
    "SELECT t.truck_id, t.make, t.model_year,"
    f" {pct('SUM(m.utilization_rate)', 'COUNT(*)', 4)} AS avg_utilization_pct"
    " FROM s_truck_months m JOIN d_trucks t ON t.truck_id = m.truck_id"
    " WHERE t.truck_id <> '-1' GROUP BY 1, 2, 3"
)
add(
    "kpi_11_underused",
    "truck_id:s make:s model_year:i avg_utilization_pct:d",
    f"SELECT * FROM ({TRUCK_UTIL}) WHERE avg_utilization_pct < 84.0",
)
add(
    "kpi_11_costly",
    "truck_id:s make:s model_year:i maintenance_cost:d cost_per_mile:d",
    f"SELECT * FROM ({maintenance('1')}) WHERE cost_per_mile > 0.03",
)
add(
    "kpi_11_low_mpg",
    "truck_id:s date_sk:s average_mpg:d",
    "SELECT truck_id, month AS date_sk, average_mpg FROM (SELECT *, ntile(5) OVER"
    " (PARTITION BY month ORDER BY average_mpg, truck_id) AS q FROM s_truck_months WHERE truck_id <> '-1') WHERE q = 1",
)

# --- Roll-ups -------------------------------------------------------------

TYPES = "load_type, booking_type"
DET = "COALESCE(SUM(e.detention_minutes), 0)"
add(
    "ru_loads_m",
    "month:s load_type:s booking_type:s loads:i gross:d revenue:d surcharge:d accessorial:d",
    f"SELECT strftime(load_date, '%Y-%m') AS month, {TYPES}, COUNT(*) AS loads,"
    " COALESCE(SUM(gross_revenue), 0) AS gross, COALESCE(SUM(revenue), 0) AS revenue,"
    " COALESCE(SUM(fuel_surcharge), 0) AS surcharge,"
    " COALESCE(SUM(accessorial_charges), 0) AS accessorial FROM s_loads GROUP BY 1, 2, 3",
)
add(
    "ru_deliv_m",
    "month:s load_type:s booking_type:s event_type:s events:i on_time:i det:i",
    f"SELECT strftime(e.scheduled_datetime, '%Y-%m') AS month, {TYPES}, e.event_type,"
    f" COUNT(*) AS events, {ON} AS on_time, {DET} AS det FROM s_events e"
    " JOIN s_loads l ON l.load_id = e.load_id GROUP BY 1, 2, 3, 4",
)
add(
    "ru_trips_m",
    "month:s load_type:s booking_type:s trips:i miles:d mpg:d idle:d unassigned:i un_rev:d",
    f"SELECT strftime(t.dispatch_date, '%Y-%m') AS month, {TYPES}, COUNT(*) AS trips,"
    " SUM(t.actual_distance_miles) AS miles, COALESCE(SUM(t.average_mpg), 0) AS mpg,"
    " SUM(t.idle_time_hours) AS idle,"
    " SUM(CASE WHEN t.truck_id = '-1' THEN 1 ELSE 0 END) AS unassigned,"
    " COALESCE(SUM(CASE WHEN t.truck_id = '-1' THEN l.gross_revenue ELSE 0 END), 0)"
    " AS un_rev FROM s_trips t JOIN s_loads l ON l.load_id = t.load_id GROUP BY 1, 2, 3",
)


def booked(key: str) -> str:
    return (
        f"SELECT a.*, COALESCE(b.deliveries, 0) AS deliveries,"
        " COALESCE(b.on_time, 0) AS on_time, COALESCE(b.det, 0) AS det FROM"
        f" (SELECT year(load_date) AS year, {key}, {TYPES}, COUNT(*) AS loads,"
        " COALESCE(SUM(gross_revenue), 0) AS gross FROM s_loads GROUP BY 1, 2, 3, 4) a"
        f" LEFT JOIN (SELECT year(l.load_date) AS year, l.{key}, {TYPES},"
        f" COUNT(*) AS deliveries, {ON} AS on_time, {DET} AS det FROM s_events e"
        " JOIN s_loads l ON l.load_id = e.load_id WHERE e.event_type = 'Delivery'"
        f" GROUP BY 1, 2, 3, 4) b USING (year, {key}, {TYPES})"
    )


add(
    "ru_cust",
    "year:i customer_id:s load_type:s booking_type:s loads:i gross:d deliveries:i"
    " on_time:i det:i",
    booked("customer_id"),
)
add(
    "ru_lanes",
    "year:i route_id:s load_type:s booking_type:s loads:i gross:d deliveries:i on_time:i",
    booked("route_id"),
)
add(
    "ru_fac",
    "year:i facility_id:s load_type:s booking_type:s events:i on_time:i det:i",
    f"SELECT year(e.scheduled_datetime) AS year, e.facility_id, {TYPES},"
    f" COUNT(*) AS events, {ON} AS on_time, {DET} AS det FROM s_events e"
    " JOIN s_loads l ON l.load_id = e.load_id WHERE e.event_type = 'Delivery'"
    " GROUP BY 1, 2, 3, 4",
)
add(
    "ru_drv",
    "year:i driver_id:s load_type:s booking_type:s trips:i miles:d mpg:d idle:d"
    " deliveries:i on_time:i",
    f"SELECT a.*, COALESCE(b.deliveries, 0) AS deliveries,"
    " COALESCE(b.on_time, 0) AS on_time FROM (SELECT year(t.dispatch_date) AS year,"
    f" t.driver_id, {TYPES}, COUNT(*) AS trips, SUM(t.actual_distance_miles) AS miles,"
    " COALESCE(SUM(t.average_mpg), 0) AS mpg, SUM(t.idle_time_hours) AS idle"
    " FROM s_trips t JOIN s_loads l ON l.load_id = t.load_id WHERE t.driver_id <> '-1'"
    " GROUP BY 1, 2, 3, 4) a LEFT JOIN (SELECT year(t.dispatch_date) AS year,"
    f" t.driver_id, {TYPES}, COUNT(*) AS deliveries, {ON} AS on_time FROM s_events e"
    " JOIN s_trips t ON t.trip_id = e.trip_id JOIN s_loads l ON l.load_id = e.load_id"
    " WHERE e.event_type = 'Delivery' AND t.driver_id <> '-1' GROUP BY 1, 2, 3, 4) b"
    f" USING (year, driver_id, {TYPES})",
)
TRUCKS_Y = (
    "SELECT year(month) AS year, truck_id, COUNT(*) AS months,"
    " SUM(utilization_rate) AS util, SUM(average_mpg) AS mpg,"
    " SUM(trips_completed) AS trips, SUM(total_miles) AS miles,"
    " SUM(total_revenue) AS revenue, SUM(maintenance_events) AS maint_events,"
    " SUM(maintenance_cost) AS maint_cost, SUM(downtime_hours) AS downtime"
    " FROM s_truck_months GROUP BY 1, 2"
)
add(
    "ru_trucks_y",
    "year:i truck_id:s months:i util:d mpg:d trips:i miles:d revenue:d maint_events:i"
    " maint_cost:d downtime:d",
    TRUCKS_Y,
)
add(
    "ru_fuel_m",
    "month:s purchases:i gallons:d cost:d",
    "SELECT strftime(purchase_date, '%Y-%m') AS month, COUNT(*) AS purchases,"
    " SUM(gallons) AS gallons, SUM(total_cost) AS cost FROM s_fuel GROUP BY 1",
)
add(
    "ru_maint_y",
    "year:i maintenance_type:s events:i cost:d downtime:d",
    "SELECT year(maintenance_date) AS year, maintenance_type, COUNT(*) AS events,"
    " SUM(total_cost) AS cost, SUM(downtime_hours) AS downtime FROM s_maintenance"
    " GROUP BY 1, 2",
)
add(
    "ru_safety",
    "year:i incident_type:s at_fault_flag:s injury_flag:s preventable_flag:s"
    " claim_amount:d",
    "SELECT *, year(incident_date) AS year FROM s_incidents",
)
add(
    "ru_dim_customers",
    "customer_id:s name:s type:s status:s",
    "SELECT customer_id, customer_name AS name, customer_type AS type,"
    " account_status AS status FROM x_customers",
)
add(
    "ru_dim_routes",
    "route_id:s corridor:s miles:i origin:s destination:s",
    "SELECT route_id, origin_city || ' → ' || destination_city AS corridor,"
    " typical_distance_miles AS miles, origin_full AS origin,"
    " destination_full AS destination FROM x_routes",
)
add(
    "ru_dim_facilities",
    "facility_id:s name:s city:s state:s type:s",
    "SELECT *, facility_name AS name, facility_type AS type FROM x_facilities",
)
add(
    "ru_dim_drivers",
    "driver_id:s name:s terminal:s experience:i status:s",
    "SELECT driver_id, full_name AS name, home_terminal AS terminal,"
    " years_experience AS experience, employment_status AS status FROM x_drivers",
)
add(
    "ru_dim_trucks",
    "truck_id:s unit:s make:s model_year:i terminal:s status:s",
    "SELECT *, unit_number AS unit, home_terminal AS terminal FROM x_trucks",
)
add(
    "export_columnar",
    "value:s",
    "SELECT '[' || year || ',\"' || truck_id || '\",' || CAST(CAST(util AS DOUBLE) AS"
    f" VARCHAR) || ',' || CAST(CAST(mpg AS DOUBLE) AS VARCHAR) || ']' AS value"
    f" FROM ({TRUCKS_Y})",
)

# --- Findings -------------------------------------------------------------

HIT = "SUM(CASE WHEN e.on_time_flag THEN 1 ELSE 0 END)"
KNOWN = "COUNT(e.on_time_flag)"
DLV = "e.event_type = 'Delivery'"
PICKUP = "e.event_type = 'Pickup'"
DLV_YEARS = f"{DLV} AND year(e.scheduled_datetime) BETWEEN 1996 AND 2000"
BY_MONTH = (
    f"SELECT strftime(e.scheduled_datetime, '%Y-%m') AS m, {pct(HIT, KNOWN)} AS value"
    f" FROM s_events e WHERE {DLV_YEARS} GROUP BY 1"
)
add(
    "fd_on_time",
    "measure:s item:s value:d",
    f"SELECT 'year' AS measure, CAST(year(e.scheduled_datetime) AS VARCHAR) AS item,"
    f" {pct(HIT, KNOWN)} AS value FROM s_events e WHERE {DLV_YEARS} GROUP BY 2"
    f" UNION ALL SELECT 'month_min', '', MIN(value) FROM ({BY_MONTH})"
    f" UNION ALL SELECT 'month_max', '', MAX(value) FROM ({BY_MONTH})"
    f" UNION ALL SELECT 'pickup', '', {pct(HIT, KNOWN)} FROM s_events e"
    " WHERE e.event_type = 'Pickup'"
    f" UNION ALL SELECT 'load_type', l.load_type, {pct(HIT, KNOWN)} FROM s_events e"
    f" JOIN s_loads l ON l.load_id = e.load_id WHERE {DLV} GROUP BY 2"
    f" UNION ALL SELECT 'booking_type', l.booking_type, {pct(HIT, KNOWN)} FROM s_events e"
    f" JOIN s_loads l ON l.load_id = e.load_id WHERE {DLV} GROUP BY 2",
)
add(
    "fd_late_median",
    "late_median_min:d",
    "SELECT round_even(median(date_diff('second', scheduled_datetime, actual_datetime))"
    f" / 60, 0) AS late_median_min FROM s_events e WHERE {DLV} AND on_time_flag = false",
)
add(
    "fd_driver_spread",
    "driver_sd:d driver_sd_chance:d driver_min:d driver_max:d drivers:i",
    "SELECT ROUND(stddev_samp(rate) * 100, 2) AS driver_sd,"
    " ROUND(sqrt(MIN(p) * (1 - MIN(p)) / median(n)) * 100, 2) AS driver_sd_chance,"
    " ROUND(MIN(rate) * 100, 1) AS driver_min, ROUND(MAX(rate) * 100, 1) AS driver_max,"
    " COUNT(*) AS drivers FROM (SELECT t.driver_id, COUNT(*) AS n,"
    f" CAST({HIT} AS DOUBLE) / COUNT(*) AS rate FROM s_events e"
    " JOIN s_trips t ON t.trip_id = e.trip_id"
    f" WHERE {DLV} AND e.on_time_flag IS NOT NULL AND t.driver_id <> '-1' GROUP BY 1),"
    f" (SELECT CAST({HIT} AS DOUBLE) / COUNT(*) AS p FROM s_events e"
    f" WHERE {DLV} AND e.on_time_flag IS NOT NULL)",
)
add(
    "fd_facility_spread",
    "fac_ot_min:d fac_ot_max:d fac_det_min:d fac_det_max:d",
    "SELECT MIN(ot) AS fac_ot_min, MAX(ot) AS fac_ot_max, MIN(det) AS fac_det_min,"
    f" MAX(det) AS fac_det_max FROM (SELECT e.facility_id, {pct(HIT, KNOWN)} AS ot,"
    f" {ratio('SUM(e.detention_minutes)', 'COUNT(e.detention_minutes)', 1)} AS det"
    f" FROM s_events e WHERE {DLV} AND e.facility_id <> '-1' GROUP BY 1)",
)


def det_mean(where: str) -> str:
    return (
        f"(SELECT {ratio('SUM(e.detention_minutes)', 'COUNT(e.detention_minutes)', 1)}"
        f" FROM s_events e WHERE {where})"
    )


add(
    "fd_detention",
    "det_delivery:d det_pickup:d det_on_time:d det_late:d",
    f"SELECT {det_mean(DLV)} AS det_delivery,"
    f" {det_mean(PICKUP)} AS det_pickup,"
    f" {det_mean(DLV + ' AND e.on_time_flag = true')} AS det_on_time,"
    f" {det_mean(DLV + ' AND e.on_time_flag = false')} AS det_late",
)
FUEL_YEAR = (
    "(SELECT CAST(SUM(total_cost) AS DOUBLE) / CAST(SUM(gallons) AS DOUBLE) AS p,"
    " CAST(SUM(gallons) AS DOUBLE) AS g FROM s_fuel WHERE year(purchase_date) = {y})"
)
add(
    "fd_fuel_price",
    "year:i ppg:d mpg:d ppg_change_pct:d saving:d",
    f"SELECT f.year, f.ppg, t.mpg,"
    " CASE WHEN f.year = 2000 THEN ROUND((b.p / a.p - 1) * 100, 1) END AS ppg_change_pct,"
    " CASE WHEN f.year = 2000 THEN round_even(b.g * (a.p - b.p), 0) END AS saving FROM"
    f" (SELECT year(purchase_date) AS year, {ratio('SUM(total_cost)', 'SUM(gallons)', 3)}"
    " AS ppg FROM s_fuel WHERE year(purchase_date) BETWEEN 1996 AND 2000 GROUP BY 1) f"
    " LEFT JOIN (SELECT year(dispatch_date) AS year,"
    f" {ratio('SUM(average_mpg)', 'COUNT(average_mpg)', 2)} AS mpg FROM s_trips GROUP BY 1) t"
    f" ON t.year = f.year, {FUEL_YEAR.format(y=1996)} a, {FUEL_YEAR.format(y=2000)} b",
)
GROSS_BY_ACCOUNT = (
    "SELECT c.customer_id, c.customer_name, SUM(l.gross_revenue) AS g FROM s_loads l"
    " JOIN x_customers c ON c.customer_id = l.customer_id GROUP BY 1, 2"
)
add(
    "fd_accounts",
    "accounts:i names:i top_id:s top_name:s top_gross:d top_share:d"
    " shared_name_accounts:i shared_name_gross:d",
    "SELECT (SELECT COUNT(DISTINCT customer_id) FROM x_customers) AS accounts,"
    " (SELECT COUNT(DISTINCT customer_name) FROM x_customers) AS names,"
    " t.customer_id AS top_id, t.customer_name AS top_name, round_even(CAST(t.g AS DOUBLE), 0) AS top_gross,"
    f" {pct('t.g', 'a.total', 2)} AS top_share,"
    " (SELECT COUNT(*) FROM x_customers WHERE customer_name = 'BUILDING 1')"
    " AS shared_name_accounts, (SELECT round_even(CAST(COALESCE(SUM(g), 0) AS DOUBLE), 0) FROM"
    f" ({GROSS_BY_ACCOUNT}) WHERE customer_name = 'BUILDING 1') AS shared_name_gross"
    f" FROM (SELECT * FROM ({GROSS_BY_ACCOUNT}) ORDER BY g DESC, customer_id LIMIT 1) t,"
    " (SELECT SUM(gross_revenue) AS total FROM s_loads WHERE customer_id <> '-1') a",
)
add(
    "fd_unassigned",
    "unassigned_share:d unassigned_trips:i unassigned_revenue:d",
    f"SELECT {pct('n', 'trips')} AS unassigned_share, n AS unassigned_trips,"
    " round_even(CAST(COALESCE(g, 0) AS DOUBLE), 0) AS unassigned_revenue FROM (SELECT COUNT(*) AS trips,"
    " SUM(CASE WHEN t.truck_id = '-1' THEN 1 ELSE 0 END) AS n,"
    " SUM(CASE WHEN t.truck_id = '-1' THEN l.gross_revenue END) AS g FROM s_trips t"
    " LEFT JOIN s_loads l ON l.load_id = t.load_id)",
)
add(
    "fd_fleet_metrics",
    "trucks_with_metrics:i util_min:d util_max:d util_mpg_r:d trucks_total:i",
    "SELECT COUNT(*) AS trucks_with_metrics, MIN(p) AS util_min, MAX(p) AS util_max,"
    " ROUND(corr(u, m), 2) AS util_mpg_r, (SELECT COUNT(*) FROM x_trucks) AS trucks_total"
    f" FROM (SELECT truck_id, {pct('SUM(utilization_rate)', 'COUNT(*)')} AS p,"
    " CAST(SUM(utilization_rate) AS DOUBLE) / COUNT(*) AS u,"
    " CAST(SUM(average_mpg) AS DOUBLE) / COUNT(*) AS m FROM s_truck_months"
    " WHERE truck_id <> '-1' GROUP BY 1)",
)
add(
    "fd_out_of_window",
    "fuel_rows:i fuel_cost:d events:i",
    "SELECT (SELECT COUNT(*) FROM s_fuel WHERE year(purchase_date) = 2001) AS fuel_rows,"
    " (SELECT round_even(CAST(COALESCE(SUM(total_cost), 0) AS DOUBLE), 0) FROM s_fuel"
    " WHERE year(purchase_date) = 2001)"
    " AS fuel_cost,"
    " (SELECT COUNT(*) FROM s_events WHERE year(scheduled_datetime) = 2001) AS events",
)

# --- Data quality ---------------------------------------------------------

# Key of each object by which its staged lines are cut short: those ending in 7.
OBJECT_KEYS = {
    "dim_driver": "driver_id",
    "dim_truck": "truck_id",
    "dim_trailer": "trailer_id",
    "dim_customer": "customer_id",
    "dim_facility": "facility_id",
    "dim_route": "route_id",
    "fact_load": "load_id",
    "fact_trip": "trip_id",
    "fact_delivery": "event_id",
    "fact_fuel": "fuel_purchase_id",
    "fact_maintenance": "maintenance_id",
    "fact_incident": "incident_id",
    "fact_driver_monthly": "driver_id",
    "fact_truck_monthly": "truck_id",
}
STAGED = " UNION ALL ".join(
    f"SELECT '{n}' AS object_name, COUNT(*) FILTER (NOT suffix({OBJECT_KEYS[n]}, '7'))"
    f" AS good, COUNT(*) FILTER (suffix({OBJECT_KEYS[n]}, '7')) AS bad FROM {c}"
    for n, c in {**DIM_CTES, **FACT_CTES}.items()
)
add(
    "dq_audit",
    "layer:s object_name:s rows_loaded:i rows_rejected:i status:s",
    "SELECT unnest(['bronze', 'silver']) AS layer, object_name, good AS rows_loaded,"
    f" bad AS rows_rejected, 'DONE' AS status FROM ({STAGED})",
)
REFS = {
    "fact_load": ("loads", ["customer_id", "route_id"], "load_date"),
    "fact_trip": (
        "trips",
        ["load_id", "driver_id", "truck_id", "trailer_id"],
        "dispatch_date",
    ),
    "fact_delivery": (
        "events",
        ["load_id", "trip_id", "facility_id"],
        "scheduled_datetime",
    ),
    "fact_fuel": ("fuel", ["trip_id", "truck_id", "driver_id"], "purchase_date"),
    "fact_maintenance": ("maintenance", ["truck_id"], "maintenance_date"),
    "fact_incident": ("incidents", ["trip_id", "truck_id", "driver_id"], "incident_date"),
    "fact_driver_monthly": ("driver_months", ["driver_id"], "month"),
    "fact_truck_monthly": ("truck_months", ["truck_id"], "month"),
}
PARENT = {
    "customer_id": "x_customers",
    "route_id": "x_routes",
    "load_id": "x_loads",
    "trip_id": "x_trips",
    "driver_id": "x_drivers",
    "truck_id": "x_trucks",
    "trailer_id": "x_trailers",
    "facility_id": "x_facilities",
}
add(
    "dq_orphans",
    "fact:s fk:s orphans:i",
    " UNION ALL ".join(
        f"SELECT '{fact}' AS fact, '{key.removesuffix('_id')}' AS fk,"
        f" SUM(CASE WHEN {key} = '-1' THEN 1 ELSE 0 END) AS orphans FROM s_{base}"
        for fact, (base, keys, _) in REFS.items()
        for key in keys
    ),
)
add(
    "dq_integrity",
    "fact:s key:s dangling:i",
    " UNION ALL ".join(
        [
            f"SELECT '{fact}' AS fact, '{key}' AS key, COUNT(*) AS dangling FROM"
            f" x_{base} f LEFT JOIN {PARENT[key]} p ON p.{key} = f.{key}"
            f" WHERE p.{key} IS NULL"
            for fact, (base, keys, _) in REFS.items()
            for key in keys
        ]
        + [
            f"SELECT '{fact}' AS fact, '{day}' AS key, COUNT(*) AS dangling FROM"
            f" x_{base} f LEFT JOIN cal d ON d.date_id = CAST(f.{day} AS DATE)"
            " WHERE d.date_id IS NULL"
            for fact, (base, _, day) in REFS.items()
        ]
    ),
)
DIM_OF = {
    "customer_id": "d_customers",
    "route_id": "d_routes",
    "driver_id": "d_drivers",
    "truck_id": "d_trucks",
    "trailer_id": "d_trailers",
    "facility_id": "d_facilities",
}
add(
    "dq_integrity_star",
    "fact:s key:s dangling:i",
    " UNION ALL ".join(
        [
            f"SELECT '{fact}' AS fact, '{key.removesuffix('_id')}_sk' AS key,"
            f" COUNT(*) FILTER (day({day}) = 13 AND {key} <> '-1') AS dangling"
            f" FROM s_{base}"
            for fact, (base, keys, day) in REFS.items()
            for key in keys
            if key in DIM_OF
        ]
        + [
            f"SELECT '{fact}' AS fact, 'date_sk' AS key, COUNT(*) AS dangling FROM"
            f" s_{base} f LEFT JOIN cal d ON d.date_id = CAST(f.{day} AS DATE)"
            " WHERE d.date_id IS NULL"
            for fact, (base, _, day) in REFS.items()
        ]
    ),
)
KEYS = {
    "dim_driver": "driver_id",
    "dim_truck": "truck_id",
    "dim_trailer": "trailer_id",
    "dim_customer": "customer_id",
    "dim_facility": "facility_id",
    "dim_route": "route_id",
    "fact_load": "load_id",
    "fact_trip": "trip_id",
    "fact_delivery": "event_id",
    "fact_fuel": "fuel_purchase_id",
    "fact_maintenance": "maintenance_id",
    "fact_incident": "incident_id",
    "fact_driver_monthly": "driver_id, month",
    "fact_truck_monthly": "truck_id, month",
}
add(
    "dq_duplicates",
    "object_name:s repeated_keys:i surplus_rows:i",
    " UNION ALL ".join(
        f"SELECT '{name}' AS object_name, SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END)"
        f" AS repeated_keys, SUM(n - 1) AS surplus_rows FROM (SELECT COUNT(*) AS n"
        f" FROM {({**DIM_CTES, **FACT_CTES})[name]} GROUP BY {key})"
        for name, key in KEYS.items()
    ),
)
add(
    "dq_duplicate_keys",
    "fuel_purchase_id:s copies:i",
    "SELECT fuel_purchase_id, COUNT(*) AS copies FROM x_fuel GROUP BY 1 HAVING COUNT(*) > 1",
)
LOAD_COLUMNS = [
    "load_id",
    "customer_id",
    "route_id",
    "load_date",
    "load_type",
    "weight_lbs",
    "pieces",
    "revenue",
    "fuel_surcharge",
    "accessorial_charges",
    "load_status",
    "booking_type",
]
add(
    "dq_null_profile",
    "column_name:s rows:i nulls:i blanks:i",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,"
        f" SUM(CASE WHEN {c} IS NOT NULL AND trim({c}) = '' THEN 1 ELSE 0 END) AS blanks"
        " FROM x_load_text"
        for c in LOAD_COLUMNS
    ),
)
LOAD_CASTS = {
    "load_date": as_date("load_date"),
    "weight_lbs": as_decimal("weight_lbs", 10, 0),
    "pieces": as_int("pieces"),
    "revenue": as_decimal("revenue", 12, 2),
    "fuel_surcharge": as_decimal("fuel_surcharge", 12, 2),
    "accessorial_charges": as_decimal("accessorial_charges", 12, 2),
}
add(
    "dq_uncastable",
    "object_name:s column_name:s uncastable:i",
    " UNION ALL ".join(
        f"SELECT 'loads' AS object_name, '{c}' AS column_name,"
        f" SUM(CASE WHEN {as_text(c)} IS NOT NULL AND ({cast}) IS NULL THEN 1 ELSE 0 END)"
        " AS uncastable FROM x_load_text"
        for c, cast in LOAD_CASTS.items()
    ),
)
LOAD_WIDTHS = dict(
    zip(LOAD_COLUMNS, (20, 20, 20, 20, 30, 15, 10, 15, 15, 15, 20, 20), strict=True)
)
add(
    "dq_overlong",
    "object_name:s column_name:s overlong:i",
    " UNION ALL ".join(
        f"SELECT 'loads' AS object_name, '{c}' AS column_name,"
        f" SUM(CASE WHEN length({c}) > {w} THEN 1 ELSE 0 END) AS overlong FROM x_load_text"
        for c, w in LOAD_WIDTHS.items()
    ),
)

# Columns the subqueries above leave out: never a value in the sample, or always one.
NO_VALUES = (
    "hire_date termination_date date_of_birth acquisition_date contract_start_date"
    " latitude longitude"
).split()
ALL_VALUES = (
    "license_number license_state vin acquisition_mileage tank_capacity_gallons model_year"
    " load_status location_city location_state fuel_card_number service_description"
    " description"
).split()


def _profile(target: str, cte: str) -> str:
    """Counts per column of one source, its faults going by the last digit of the key."""
    source = next(x for x in SOURCES.values() if x.target == target)
    digit = f"right(COALESCE({OBJECT_KEYS[target]}, ''), 1)"
    cells = []
    for column, kind, _ in source.columns:
        free, text = column not in source.key, kind in ("key", "text")
        spoilt = "9" if text else "5"
        kept = f"{digit} NOT IN ('3', '7', '{spoilt}')" if free else f"{digit} <> '7'"
        value = f"CAST({column} AS VARCHAR)"
        if column in NO_VALUES:
            value = "''"
        elif column in ALL_VALUES:
            value = "'x'"
        blank = f"COUNT(*) FILTER ({kept} AND COALESCE({value}, '') = '')"
        if free:
            blank += f" + COUNT(*) FILTER ({digit} = '3')"
        spoilt_rows = f"COUNT(*) FILTER ({digit} = '{spoilt}')" if free else "0"
        if kind.startswith("decimal") and column not in (*NO_VALUES, *ALL_VALUES):
            digits, scale = map(int, re.findall(r"\d+", kind))
            spoilt_rows += f" + COUNT(*) FILTER ({kept} AND abs({column}) >= 1e{digits - scale})"
        cells.append(
            f"{{'column_name': '{column}', 'nulls': COUNT(*) FILTER ({digit} = '7'),"
            f" 'blanks': {blank}, 'uncastable': {'0' if text else spoilt_rows},"
            f" 'overlong': {spoilt_rows if text else '0'}}}"
        )
    return (
        f"SELECT object_name, rows, UNNEST(cells, recursive := true) FROM (SELECT"
        f" '{source.name}' AS object_name, COUNT(*) AS rows, [{', '.join(cells)}] AS cells"
        f" FROM {cte})"
    )


add(
    "dq_source_profile",
    "object_name:s column_name:s rows:i nulls:i blanks:i uncastable:i overlong:i",
    " UNION ALL ".join(_profile(n, c) for n, c in {**DIM_CTES, **FACT_CTES}.items()),
)
add(
    "join_colocated",
    "booking_type:s loads:i trips:i miles:d events:i on_time:i detention_minutes:i",
    "SELECT booking_type, COUNT(*) AS loads, COALESCE(SUM(t.n), 0) AS trips,"
    " COALESCE(SUM(t.miles), 0) AS miles, COALESCE(SUM(e.n), 0) AS events,"
    " COALESCE(SUM(e.good), 0) AS on_time, COALESCE(SUM(e.det), 0) AS detention_minutes"
    " FROM x_loads l LEFT JOIN (SELECT load_id, COUNT(*) AS n,"
    " SUM(actual_distance_miles) AS miles FROM x_trips GROUP BY 1) t USING (load_id)"
    " LEFT JOIN (SELECT load_id, COUNT(*) AS n, COUNT(*) FILTER (on_time_flag) AS good,"
    " SUM(detention_minutes) AS det FROM x_events GROUP BY 1) e USING (load_id) GROUP BY 1",
)
add(
    "dq_trip_events",
    "object_name:s rule:s violations:i",
    "SELECT 'fact_delivery' AS object_name, rule, COALESCE(SUM(bad), 0) AS violations FROM"
    " (SELECT UNNEST(['flag_of_open_trip', 'finished_without_flag']) AS rule,"
    " UNNEST([CASE WHEN o % 11 = 0 OR o % 13 = 0 THEN 1 ELSE 0 END * CASE WHEN on_time_flag"
    " IS NULL THEN 0 ELSE 1 END, CASE WHEN o % 11 = 0 OR o % 13 = 0 THEN 0 ELSE 1 END *"
    " CASE WHEN on_time_flag IS NULL THEN 1 ELSE 0 END]) AS bad FROM (SELECT on_time_flag,"
    " CAST(substr(t.trip_id, 2) AS BIGINT) AS o FROM x_events e JOIN x_trips t"
    " ON e.trip_id = t.trip_id)) GROUP BY 2",
)
add(
    "dq_cross_field",
    "object_name:s rule:s violations:i",
    "SELECT 'fact_delivery' AS object_name, 'on_time_not_late' AS rule, COUNT(*) AS"
    " violations FROM x_events WHERE on_time_flag AND actual_datetime > scheduled_datetime"
    " UNION ALL SELECT 'fact_delivery', 'detention_not_negative', COUNT(*) FROM x_events"
    " WHERE detention_minutes < 0"
    " UNION ALL SELECT 'fact_fuel', 'cost_matches_price', COUNT(*) FROM x_fuel"
    " WHERE abs(gallons * price_per_gallon - total_cost) > 0.50"
    " UNION ALL SELECT 'fact_trip', 'completed_has_miles', COUNT(*) FROM x_trips"
    " WHERE trip_status = 'Completed' AND actual_distance_miles <= 0"
    " UNION ALL SELECT 'fact_trip', 'idle_within_duration', COUNT(*) FROM x_trips"
    " WHERE idle_time_hours > actual_duration_hours",
)
add(
    "dq_conservation",
    "object_name:s bronze:i silver:i silver_accepted:i gold:i conserved:s",
    "SELECT object_name, good + bad AS bronze, good + bad AS silver,"
    f" good AS silver_accepted, good AS gold, true AS conserved FROM ({STAGED})",
)
KPI_YEARS = (1996, 1997, 1998)
DROPS = "FROM s_events WHERE event_type = 'Delivery'"
OPEN_LINES = "FROM lineitem WHERE l_linestatus = 'O'"
SHIP_YEAR = "year(l_shipdate + to_hours(CAST(l_partkey % 24 AS BIGINT)))"
RAW_GROSS = (
    "SUM(CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2))"
    " + o_orderkey % 500 + o_orderkey % 70 END)"
)
# label, figure of the warehouse, the same from the sample tables, tolerance
KPI_PAIRS = [
    ("gross_revenue", "(SELECT SUM(gross_revenue) FROM s_loads)",
     f"(SELECT {RAW_GROSS} FROM orders)", 0.005),
    *[
        (f"gross_revenue_{y}",
         f"(SELECT SUM(gross_revenue) FROM s_loads WHERE year(load_date) = {y})",
         f"(SELECT {RAW_GROSS} FROM orders WHERE year(o_orderdate) = {y})", 0.005)
        for y in KPI_YEARS
    ],
    ("total_trips", "(SELECT COUNT(*) FROM s_trips)", "(SELECT COUNT(*) FROM orders)", 0),
    ("delivery_events", f"(SELECT COUNT(*) {DROPS})", f"(SELECT COUNT(*) {OPEN_LINES})", 0),
    ("on_time_deliveries", f"(SELECT COUNT(*) {DROPS} AND on_time_flag)",
     f"(SELECT COUNT(*) {OPEN_LINES} AND l_returnflag = 'N')", 0),
    ("on_time_pct",
     f"(SELECT {pct('COUNT(*) FILTER (on_time_flag)', 'COUNT(*)')} {DROPS})",
     f"(SELECT 100.0 * COUNT(*) FILTER (l_returnflag = 'N') / COUNT(*) {OPEN_LINES})", 0.05),
    *[
        (f"on_time_pct_{y}",
         f"(SELECT {pct('COUNT(*) FILTER (on_time_flag)', 'COUNT(*)')} {DROPS}"
         f" AND year(scheduled_datetime) = {y})",
         f"(SELECT 100.0 * COUNT(*) FILTER (l_returnflag = 'N') / nullif(COUNT(*), 0)"
         f" {OPEN_LINES} AND {SHIP_YEAR} = {y})", 0.05)
        for y in KPI_YEARS
    ],
    ("total_miles", "(SELECT SUM(actual_distance_miles) FROM s_trips)",
     "(SELECT SUM(abs(o_orderkey % 25 - o_custkey % 25) * 100 + o_orderkey % 90)"
     " FROM orders)", 0),
    ("avg_mpg", f"(SELECT {ratio('SUM(average_mpg)', 'COUNT(average_mpg)')} FROM s_trips)",
     "(SELECT AVG(500 + o_orderkey % 300) / 100 FROM orders WHERE o_orderkey % 151 <> 0)",
     0.0001),
    ("avg_utilization_pct",
     f"(SELECT {pct('SUM(utilization_rate)', 'COUNT(utilization_rate)')} FROM s_truck_months)",
     "(SELECT AVG(600 + q % 500) / 10 FROM (SELECT CAST(SUM(CAST(l_quantity AS BIGINT))"
     " AS BIGINT) AS q FROM lineitem GROUP BY l_suppkey, date_trunc('month', l_shipdate)))",
     0.05),
    ("fuel_cost", "(SELECT SUM(total_cost) FROM s_fuel)",
     "(SELECT SUM(CAST(l_extendedprice AS DECIMAL(12,2))) FROM lineitem)", 0.005),
    ("claims_total", "(SELECT SUM(claim_amount) FROM s_incidents)",
     "(SELECT 13 * SUM(CAST(value AS DECIMAL(12,2))) FROM events)", 0.005),
    ("incidents", "(SELECT COUNT(*) FROM s_incidents)", "(SELECT COUNT(*) FROM events)", 0),
    ("preventable", "(SELECT COUNT(*) FROM s_incidents WHERE preventable_flag)",
     "(SELECT COUNT(*) FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) % 13"
     " <> 0 AND CAST(json_extract(props, '$.k') AS INTEGER) % 3 = 0)", 0),
]
add(
    "dq_kpi_check",
    "label:s actual:d expected:d tolerance:d ok:s",
    "SELECT label, actual, ROUND(expected, 6) AS expected, tolerance,"
    " COALESCE(abs(actual - expected) <= tolerance, false) AS ok FROM ("
    + " UNION ALL ".join(
        f"SELECT '{label}' AS label, CAST({a} AS DOUBLE) AS actual,"
        f" CAST({e} AS DOUBLE) AS expected, CAST({t} AS DOUBLE) AS tolerance"
        for label, a, e, t in KPI_PAIRS
    )
    + ")",
)
add(
    "dq_completeness",
    "object_name:s missing:i complete:s",
    "SELECT object_name, missing, missing = 0 AS complete FROM ("
    "SELECT 'fact_delivery' AS object_name, COUNT(*) AS missing FROM x_events e"
    " LEFT JOIN x_loads l ON l.load_id = e.load_id WHERE l.load_type IS NULL UNION ALL"
    " SELECT 'fact_trip', COUNT(*) FROM x_trips e"
    " LEFT JOIN x_loads l ON l.load_id = e.load_id WHERE l.load_type IS NULL)",
)
add(
    "dq_unassigned",
    "key:s rows:i blank:i unmatched:i unknown_pct:d",
    f"SELECT key, rows, blank, unmatched, {pct('(blank + unmatched)', 'rows')}"
    " AS unknown_pct FROM ("
    + " UNION ALL ".join(
        f"SELECT '{key}' AS key, COUNT(*) AS rows,"
        f" SUM(CASE WHEN t.{key} IS NULL THEN 1 ELSE 0 END) AS blank,"
        f" SUM(CASE WHEN t.{key} IS NOT NULL AND p.{key} IS NULL THEN 1 ELSE 0 END)"
        f" AS unmatched FROM x_trips t LEFT JOIN {PARENT[key]} p ON p.{key} = t.{key}"
        for key in ("driver_id", "truck_id", "trailer_id")
    )
    + ")",
)

# --- Incremental merge and history ----------------------------------------

add(
    "inc_upsert",
    "load_id:s load_date:s revenue:d",
    "SELECT DISTINCT ON (load_id) load_id, load_date, revenue FROM"
    " (SELECT load_id, load_date, revenue FROM x_loads UNION ALL"
    " SELECT CAST(l_orderkey AS VARCHAR),"
    " CAST(l_shipdate AS DATE) - CAST(l_orderkey % 3 * 400 AS INTEGER),"
    " CAST(l_extendedprice AS DECIMAL(12,2)) FROM lineitem)"
    " ORDER BY load_id, load_date DESC, revenue DESC NULLS LAST",
)
CTE["x_versions"] = """
SELECT driver_id, status, seen_on AS valid_from,
       CAST(lead(seen_on) OVER w AS DATE) - 1 AS valid_to,
       lead(seen_on) OVER w IS NULL AS is_current
FROM (SELECT *, lag(status) OVER (PARTITION BY driver_id ORDER BY seen_on) AS before
      FROM (SELECT CAST(o_custkey // 15 AS VARCHAR) AS driver_id,
                   CAST(o_orderdate AS DATE) AS seen_on,
                   arg_max(o_orderstatus, o_orderkey) AS status
            FROM orders GROUP BY 1, 2))
WHERE before IS NULL OR before <> status
WINDOW w AS (PARTITION BY driver_id ORDER BY seen_on)"""
add(
    "scd2_versions",
    "driver_id:s status:s valid_from:s valid_to:s is_current:s",
    "SELECT * FROM x_versions",
)
add(
    "scd2_as_of",
    "driver_id:s month:s trips_completed:i status:s",
    "SELECT m.driver_id, m.month, m.trips_completed, v.status FROM x_driver_months m"
    " LEFT JOIN x_versions v ON v.driver_id = m.driver_id AND m.month >= v.valid_from"
    " AND (v.valid_to IS NULL OR m.month <= v.valid_to)",
)
add(
    "scd2_star_trips",
    "driver_id:s trips:i miles:d status:s valid_from:s",
    "SELECT t.driver_id, COUNT(*) AS trips, SUM(t.actual_distance_miles) AS miles, v.status,"
    " v.valid_from FROM s_trips t LEFT JOIN"
    " (SELECT *, min(valid_from) OVER (PARTITION BY driver_id) AS earliest FROM x_versions) v"
    " ON v.driver_id = t.driver_id"
    " AND (t.dispatch_date >= v.valid_from OR v.valid_from = v.earliest)"
    " AND (v.valid_to IS NULL OR t.dispatch_date <= v.valid_to)"
    " GROUP BY t.driver_id, v.status, v.valid_from",
)
