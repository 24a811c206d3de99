"""Registered queries: name -> callable(spark, directory) -> DataFrame.

Results leave in plain types (text, bigint, double) so that they compare with
any engine's result: see ``plain``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadledger import functions as R
from roadledger.model import DIMENSIONS, FACTS, SOURCES, Source
from roadledger.operators import history, quality, statistics
from roadledger.operators.conform import apply_missing, missing_keys, surrogate_key
from roadledger.operators.keymap import new_numbers
from roadledger.operators.ranking import distinct_values, top_k
from roadledger.operators.staging import (
    MALFORMED,
    REJECT,
    duplicate_keys,
    silver_reasons,
    type_source,
)
from roadledger.plans import colocated, findings, kpis, monthly, rollups, views
from roadledger.plans.silver import check_references, silver_rows
from roadledger.plans.star import build_dimension
from roadledger.queries.dirty import LOAD_LINE, TEXTS
from roadledger.sources.calendar import facts_on
from roadledger.sources.delimited import split_line, stage_lines
from roadledger.sources.export import json_rows, rounded
from roadledger.sources.sample import (
    SAMPLE_PARTIAL_YEAR,
    SAMPLE_YEARS,
    SampleWarehouse,
)
from roadledger.sources.tables import Warehouse, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(frame: DataFrame) -> DataFrame:
    """Decimals as double, integers as bigint, dates and flags as text."""
    columns = []
    for f in frame.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(
            f.dataType,
            (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType),
        ):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return frame.select(*columns)


def query(name: str):
    """Register a function of a ``SampleWarehouse`` under ``name``."""

    def add(build):
        QUERIES[name] = lambda spark, directory: plain(
            build(SampleWarehouse(spark, directory))
        )
        return build

    return add


def _text(w: SampleWarehouse, kind: str) -> DataFrame:
    """Rows with their dirty text; keyless tables yield value counts instead."""
    table, key, expression = TEXTS[kind]
    keys = [F.col(key).alias("id")] if key else []
    return w.table(table).select(*keys, F.expr(expression).alias("raw"))


def _counted(frame: DataFrame, result) -> DataFrame:
    return frame.groupBy("raw", result.alias("cleaned")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# --- Cleaning -------------------------------------------------------------


@query("src_split_limit")
def _(w):
    parts = _text(w, "line").select("id", split_line(F.col("raw"), 3).alias("p"))
    return parts.select(
        "id",
        F.get("p", F.lit(1)).alias("second"),
        F.get("p", F.lit(2)).alias("rest"),
        (F.size("p") < 3).alias("short"),
    )


@query("clean_blank_null")
def _(w):
    return _text(w, "blank_null").select("id", R.clean(F.col("raw")).alias("cleaned"))


@query("clean_cast_int")
def _(w):
    return _text(w, "int").select("id", R.to_int(F.col("raw")).alias("cleaned"))


@query("clean_cast_decimal")
def _(w):
    return _text(w, "decimal").select(
        "id", R.to_decimal(F.col("raw"), 12, 2).alias("cleaned")
    )


@query("clean_cast_date")
def _(w):
    return _text(w, "date").select("id", R.to_date(F.col("raw")).alias("cleaned"))


@query("clean_cast_timestamp")
def _(w):
    return _text(w, "timestamp").select(
        "id", R.to_timestamp(F.col("raw")).alias("cleaned")
    )


@query("clean_prefix_date")
def _(w):
    return _counted(_text(w, "prefix_date"), R.prefix_date(F.col("raw")))


@query("clean_flag3")
def _(w):
    return _counted(_text(w, "flag3"), R.flag3(F.col("raw")))


@query("concat_corridor")
def _(w):
    return w.rows("routes").select(
        "route_id", "origin_full", "destination_full", "corridor"
    )


@query("status_default_active")
def _(w):
    return w.rows("trucks").select("truck_id", "status", "is_active")


def _staged_loads(w: SampleWarehouse) -> DataFrame:
    lines = w.table("orders").select(F.expr(LOAD_LINE).alias("value"))
    return stage_lines(lines, SOURCES["loads"])


@query("silver_load_from_text")
def _(w):
    rows = silver_rows(_staged_loads(w), SOURCES["loads"])
    return rows.select(
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
        "booking_type",
        "gross_revenue",
        F.col("_reject").alias("reject"),
    )


@query("silver_reject_reasons")
def _(w):
    return silver_reasons(type_source(_staged_loads(w), SOURCES["loads"]))


@query("gross_revenue")
def _(w):
    return w.rows("loads").select(
        "load_id", "revenue", "fuel_surcharge", "accessorial_charges", "gross_revenue"
    )


@query("per_1k_ratio")
def _(w):
    gross, weight = F.col("gross_revenue"), F.col("weight_lbs")
    return w.rows("loads").select(
        "load_id", R.safe_ratio(gross * 1000, weight).alias("revenue_per_1k_lbs")
    )


@query("late_minutes")
def _(w):
    late = R.late_minutes(F.col("scheduled_datetime"), F.col("actual_datetime"))
    return (
        w.rows("delivery_events")
        .groupBy("event_type", late.alias("late_min"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query("month_keys")
def _(w):
    day = F.col("purchase_date")
    return (
        w.rows("fuel_purchases")
        .groupBy(F.year(day).alias("year"), R.month_key(day).alias("month"))
        .agg(F.count(F.lit(1)).alias("purchases"))
    )


@query("format_n0")
def _(w):
    return w.rows("loads").select(
        "load_id", R.format_n0(F.col("gross_revenue")).alias("gross_text")
    )


# --- Filters --------------------------------------------------------------


@query("flt_known_member")
def _(w):
    trips = w.star("fact_trip", ["dim_truck"])
    return trips.where("truck_sk > 0").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("actual_distance_miles").alias("miles"),
    )


@query("flt_event_type")
def _(w):
    events = w.rows("delivery_events").where(F.col("event_type") == "Delivery")
    return events.groupBy("location_state").agg(F.count(F.lit(1)).alias("events"))


@query("flt_in_list")
def _(w):
    day = F.to_date("load_date")
    chosen = w.rows("loads").where(
        F.month(day).isin(12, 1, 2) & F.dayofweek(day).isin(1, 7)
    )
    return chosen.groupBy(F.month(day).alias("month_nbr")).agg(
        F.count(F.lit(1)).alias("loads")
    )


@query("flt_list_membership")
def _(w):
    accounts = w.rows("customers").where(F.col("customer_name") == "BUILDING 1")
    members = w.rows("loads").join(accounts.select("customer_id"), "customer_id", "left_semi")
    return members.agg(
        F.count(F.lit(1)).alias("loads"), F.sum("gross_revenue").alias("gross")
    )


@query("flt_late_only")
def _(w):
    late = w.rows("delivery_events").where(~F.col("on_time_flag"))
    return late.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("detention_minutes").alias("det")
    )


@query("flt_year_slice")
def _(w):
    loads = w.rows("loads").where(F.year("load_date").isin(*SAMPLE_YEARS))
    return loads.groupBy(F.year("load_date").alias("year")).agg(
        F.sum("gross_revenue").alias("gross")
    )


def _by_year(w: SampleWarehouse, fact: DataFrame, name: str) -> Warehouse:
    """A warehouse of its own that holds a star fact by year, as the build stores it."""
    stored = Warehouse(w.spark, scratch_folder(w.spark, "queries"))
    stored.write(fact.withColumn(monthly.YEAR, F.year("date_sk")), "gold", name, [monthly.YEAR])
    return stored


@query("flt_calendar_pruning")
def _(w):
    """Trips on summer weekends of leap years: only those years' files are opened."""
    stored = _by_year(w, w.star("fact_trip"), "fact_trip")
    days = w.calendar().where(
        (F.col("season") == "Summer") & F.col("is_weekend") & (F.col("year_nbr") % 4 == 0)
    )
    trips = facts_on(stored.read("gold", "fact_trip"), days.select("date_id", "year_nbr", "month_nbr"))
    return trips.groupBy("year_nbr", "month_nbr").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("actual_distance_miles").alias("miles")
    )


# --- Reference checks -----------------------------------------------------


def _fk_query(name: str, target: str, key: str, columns: list[str], counted: bool):
    @query(name)
    def _(w):
        silver = w.silver(target)
        keys = list(next(s for s in SOURCES.values() if s.target == target).parents)
        if counted:
            return silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        return silver.select(key, *[k for k in keys if k != key], *columns)


_fk_query("fk_resolve_load", "fact_load", "load_id", ["gross_revenue"], False)
_fk_query("fk_resolve_trip", "fact_trip", "trip_id", ["actual_distance_miles"], False)
_fk_query("fk_resolve_delivery", "fact_delivery", "event_id", [], True)
_fk_query("fk_resolve_fuel", "fact_fuel", "fuel_purchase_id", [], True)
_fk_query("fk_resolve_maintenance", "fact_maintenance", "maintenance_id", ["total_cost"], False)
_fk_query("fk_resolve_incident", "fact_incident", "incident_id", ["claim_amount"], False)


@query("fk_resolve_monthly")
def _(w):
    drivers = w.silver("fact_driver_monthly").select(
        F.lit("driver").alias("asset"),
        F.col("driver_id").alias("asset_id"),
        "month",
        "trips_completed",
    )
    trucks = w.silver("fact_truck_monthly").select(
        F.lit("truck").alias("asset"),
        F.col("truck_id").alias("asset_id"),
        "month",
        "trips_completed",
    )
    return drivers.unionByName(trucks)


def _trip_parents(w: SampleWarehouse):
    return {
        key: (w.rows(parent), SOURCES[parent].key[0])
        for key, parent in SOURCES["trips"].parents.items()
    }


@query("fk_missing_keys")
def _(w):
    return missing_keys(w.rows("trips"), _trip_parents(w))


@query("fk_apply_missing")
def _(w):
    parents = _trip_parents(w)
    missing = missing_keys(w.rows("trips"), parents)
    return apply_missing(w.rows("trips"), missing, list(parents)).select(
        "trip_id", *parents, "actual_distance_miles"
    )


@query("sk_dim_customer")
def _(w):
    return surrogate_key(
        w.rows("customers").select("customer_id", "customer_name"),
        "customer_id",
        "customer_sk",
    )


@query("sk_lasting_customer")
def _(w):
    """Members of a first build keep their numbers when the others come."""
    members = w.rows("customers").select("customer_id")
    early = F.col("customer_id").cast("bigint") % 3 != 0
    known = surrogate_key(members.where(early), "customer_id", "customer_sk")
    last = known.agg(F.coalesce(F.max("customer_sk"), F.lit(0))).first()[0]
    added = new_numbers(members, known, "customer_id", "customer_sk", last)
    return known.withColumn("added", F.lit(0)).unionByName(added.withColumn("added", F.lit(1)))


@query("dim_with_unknown")
def _(w):
    return w.dimension("dim_driver")


for _dim in ("dim_customer", "dim_facility", "dim_route", "dim_trailer", "dim_truck"):
    QUERIES[f"gold_{_dim}"] = lambda spark, directory, d=_dim: plain(
        SampleWarehouse(spark, directory).dimension(d).drop(DIMENSIONS[d].sk)
    )


@query("sk_resolve_fact")
def _(w):
    loads = w.star("fact_load", ["dim_customer", "dim_route"])
    return loads.select("load_id", "customer_sk", "route_sk", "date_sk")


for _fact in FACTS:
    # Every star fact, its surrogates shown as the natural keys they stand for.
    def _star(w, name=_fact):
        spec = FACTS[name]
        frame = w.star(name, spec.dims.values(), spec.degenerate, show_keys=True)
        surrogates = [DIMENSIONS[dim].sk for dim in spec.dims.values()]
        own = [c for c in frame.columns if c not in (*surrogates, *spec.dims)]
        frame = frame.select(*own, *spec.dims)
        if name in ("fact_delivery", "fact_fuel"):
            # These rows have no unique key in the samples: compare per member.
            keys = [c for c in ("trip_sk", "load_sk", *spec.dims, "date_sk") if c in frame.columns]
            measure = "detention_minutes" if name == "fact_delivery" else "total_cost"
            return frame.groupBy(*keys).agg(
                F.count(F.lit(1)).alias("rows"), F.sum(measure).alias("total")
            )
        return frame

    query(f"gold_{_fact}")(_star)


# --- Joins ----------------------------------------------------------------


@query("join_star")
def _(w):
    trips = w.star("fact_trip", ["dim_driver", "dim_truck", "dim_trailer"])
    drivers, trucks = w.dimension("dim_driver"), w.dimension("dim_truck")
    trailers = w.dimension("dim_trailer")
    per_key = trips.groupBy("driver_sk", "truck_sk", "trailer_sk").agg(
        F.count(F.lit(1)).alias("_n")
    )
    return (
        per_key.join(drivers.select("driver_sk", "home_terminal"), "driver_sk")
        .join(trucks.select("truck_sk", "make"), "truck_sk")
        .join(trailers.select("trailer_sk", "trailer_type"), "trailer_sk")
        .groupBy("home_terminal", "make", "trailer_type")
        .agg(F.sum("_n").alias("trips"))
    )


@query("join_fact_fact")
def _(w):
    events = w.star("fact_delivery").where(F.col("event_type") == "Delivery")
    loads = w.star("fact_load").select(
        F.col("load_id").alias("load_sk"), "load_type", "booking_type"
    )
    return (
        events.where(F.col("load_sk").isNotNull())
        .join(loads, "load_sk")
        .groupBy("load_type", "booking_type")
        .agg(F.count("event_id").alias("events"))
    )


@query("join_derived_agg")
def _(w):
    miles = (
        w.star("fact_trip", ["dim_truck"])
        .groupBy("truck_sk")
        .agg(F.sum("actual_distance_miles").alias("miles"))
    )
    trucks = w.dimension("dim_truck").select("truck_sk", "truck_id")
    return trucks.join(miles, "truck_sk", "left").select("truck_id", "miles")


@query("join_agg_pair_fill0")
def _(w):
    trips = w.silver("fact_trip", ["truck_id"]).groupBy("truck_id").agg(
        F.count(F.lit(1)).alias("trips")
    )
    service = w.silver("fact_maintenance").groupBy("truck_id").agg(
        F.count(F.lit(1)).alias("services"), R.sum0(F.col("total_cost")).alias("cost")
    )
    return trips.join(service, "truck_id", "left").select(
        "truck_id",
        "trips",
        F.coalesce("services", F.lit(0)).alias("services"),
        F.coalesce("cost", F.lit(0).cast("decimal(12,2)")).alias("cost"),
    )


@query("join_colocated")
def _(w):
    """Loads with their trips and events per kind of booking, from co-located copies."""
    tables = {}
    for name in colocated.COPIES:
        path = scratch_folder(w.spark, "queries")
        tables[name] = f"{name}_{path.rsplit('/', 1)[-1]}"
        fact = w.star(name, [], [k for k in FACTS[name].degenerate if k == "load_id"])
        colocated.store_colocated(fact, name, tables[name], path, 8)
    stories = colocated.load_stories(w.spark, *tables.values())
    return stories.groupBy("booking_type").agg(
        F.count(F.lit(1)).alias("loads"),
        F.sum("trips").alias("trips"),
        F.sum("miles").alias("miles"),
        F.sum("events").alias("events"),
        F.sum("on_time").alias("on_time"),
        F.sum("detention_minutes").alias("detention_minutes"),
    )


@query("join_year_pair")
def _(w):
    # Both sides have a year: the event's and the load's.
    events = w.rows("delivery_events").select(
        "load_id", F.year("scheduled_datetime").alias("year_evt")
    )
    loads = w.rows("loads").select("load_id", F.year("load_date").alias("year"))
    return (
        events.where(F.col("load_id").isNotNull())
        .join(loads, "load_id")
        .groupBy("year", "year_evt")
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query("join_anti_integrity")
def _(w):
    rows = w.rows("maintenance_records")
    trucks = w.rows("trucks")
    return quality.dangling_keys(
        rows, "fact_maintenance", {"truck_id": (trucks, "truck_id")}
    )


# --- Aggregates -----------------------------------------------------------


@query("agg_conditional_pct")
def _(w):
    return w.rows("delivery_events").groupBy("facility_id").agg(
        F.count("event_id").alias("events"),
        F.count_if(F.col("on_time_flag")).alias("on_time"),
        R.pct(F.count_if(F.col("on_time_flag")), F.count("event_id")).alias("on_time_pct"),
    )


@query("agg_ratio_of_sums")
def _(w):
    return w.rows("fuel_purchases").groupBy("truck_id").agg(
        R.safe_ratio(F.sum("total_cost"), F.sum("gallons")).alias("price")
    )


@query("agg_distinct")
def _(w):
    trips = w.rows("trips")
    return (
        trips.groupBy(F.year("dispatch_date").alias("year"), "truck_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("year")
        .agg(F.count("truck_id").alias("trucks"), F.sum("_n").alias("trips"))
    )


@query("agg_avg_exact")
def _(w):
    return w.rows("delivery_events").groupBy("facility_id").agg(
        R.exact_mean(F.col("detention_minutes")).alias("avg_detention_min")
    )


@query("agg_avg_int_trunc")
def _(w):
    return w.rows("delivery_events").groupBy("facility_id").agg(
        views.truncated_mean(F.col("detention_minutes")).alias("avg_detention_min")
    )


@query("agg_std_median_corr")
def _(w):
    per_truck = w.rows("truck_utilization_metrics").groupBy("truck_id").agg(
        (F.sum("utilization_rate").cast("double") / F.count("utilization_rate")).alias("u"),
        (F.sum("average_mpg").cast("double") / F.count("average_mpg")).alias("m"),
        F.count(F.lit(1)).alias("months"),
    )
    stats = per_truck.agg(
        F.round(F.stddev_samp("u"), 8).alias("sd"),
        F.round(F.corr("u", "m"), 8).alias("r"),
        F.min("months").alias("months_min"),
        F.max("months").alias("months_max"),
    )
    median = statistics.exact_median(per_truck, F.col("months"), "months_median")
    return views.one_row([stats, median])


@query("agg_share_of_total")
def _(w):
    gross = w.rows("loads").groupBy("booking_type").agg(F.sum("gross_revenue").alias("g"))
    total = gross.agg(F.sum("g").alias("total"))  # one row
    share = R.pct(F.col("g"), F.col("total"), 2).alias("share")
    return gross.join(F.broadcast(total)).select("booking_type", "g", share)


@query("calendar")
def _(w):
    return monthly.daily_loads(w.calendar(), w.star("fact_load"))


@query("calendar_fiscal")
def _(w):
    return monthly.fiscal_revenue(w.star("fact_load"), w.calendar())


@query("calendar_holidays")
def _(w):
    return monthly.holiday_loads(w.star("fact_load"), w.calendar())


@query("calendar_hours")
def _(w):
    return monthly.events_by_hour(w.star("fact_delivery"))


@query("monthly_layer")
def _(w):
    layer = monthly.monthly_loads(w.star("fact_load", ["dim_customer", "dim_route"]))
    customers = w.dimension("dim_customer").select("customer_sk", "customer_id")
    routes = w.dimension("dim_route").select("route_sk", "route_id")
    return (
        layer.join(customers, "customer_sk")
        .join(routes, "route_sk")
        .drop("customer_sk", "route_sk")
    )


@query("monthly_layer_renewed")
def _(w):
    """The stored layer after a third of one year's loads has come late.

    ``renewed`` marks the months that were computed again.
    """
    loads = w.star("fact_load", ["dim_customer", "dim_route"]).withColumn(
        monthly.YEAR, F.year("date_sk")
    )
    late = (F.col(monthly.YEAR) == 1997) & (F.col("load_id").cast("bigint") % 3 == 0)
    stored = _by_year(w, loads.where(~late), "fact_load")
    layer = monthly.monthly_layers(stored)[0]
    layer.refresh()
    stored.replace_changed(
        loads,
        "gold",
        "fact_load",
        [monthly.YEAR],
        {"month": F.trunc("date_sk", "month")},
        layer.note,
    )
    renewed = layer.refresh() or []
    customers = w.dimension("dim_customer").select("customer_sk", "customer_id")
    routes = w.dimension("dim_route").select("route_sk", "route_id")
    return (
        stored.read_all("gold", layer.name)
        .join(customers, "customer_sk")
        .join(routes, "route_sk")
        .drop("customer_sk", "route_sk")
        .withColumn("renewed", F.col("month").isin(renewed).cast("int"))
    )


@query("agg_distinct_rolled_up")
def _(w):
    """Drivers, trucks and trailers per month, year and in all, from the monthly maps."""
    stored = _by_year(
        w, w.star("fact_trip", ["dim_driver", "dim_truck", "dim_trailer"]), "fact_trip"
    )
    layer = monthly.monthly_layers(stored)[1]
    layer.refresh()
    maps = stored.read_all("gold", layer.name)
    return quality.union_all(
        [monthly.members_per_period(maps, period) for period in ("month", "year", "all")]
    )


@query("sorted_distinct")
def _(w):
    return distinct_values(w.rows("loads"), "load_type")


@query("topk_corridor")
def _(w):
    lanes = w.star("fact_load", ["dim_route"]).groupBy("route_sk").agg(
        F.sum("gross_revenue").alias("gross")
    )
    named = lanes.join(w.dimension("dim_route").select("route_sk", "route_id"), "route_sk")
    return top_k(named, "gross", 10, ["route_id"]).select("route_id", "gross")


@query("union_counts")
def _(w):
    return quality.row_counts(
        {s.target: w.rows(s.name) for s in SOURCES.values() if s.target in FACTS}
    )


# --- Views ----------------------------------------------------------------

# View -> per input table the dimensions and references it needs resolved.
VIEW_INPUTS = {
    "v_kpi_overview": {
        "fact_trip": (["dim_driver", "dim_truck"], []),
    },
    "v_load_profitability": {"fact_load": (["dim_customer", "dim_route"], [])},
    "v_route_performance": {"fact_load": (["dim_route"], [])},
    "v_customer_service": {
        "fact_load": (["dim_customer"], []),
        "fact_delivery": ([], ["trip_id"]),
    },
    "v_driver_performance": {"fact_trip": (["dim_driver"], [])},
    "v_fleet_utilization": {
        "fact_truck_monthly": (["dim_truck"], []),
        "fact_trip": (["dim_truck"], []),
    },
    "v_maintenance_analysis": {
        "fact_maintenance": (["dim_truck"], []),
        "fact_trip": (["dim_truck"], []),
    },
    "v_detention_analysis": {"fact_delivery": (["dim_facility"], [])},
}


# Trips are counted per customer, Unknown included, so members are looked up before that.
SURROGATES_FIRST = ("v_customer_service",)


def _view(w: SampleWarehouse, name: str, build=None) -> DataFrame:
    """The view over the sample; natural keys are looked up after the grouping."""
    default, inputs = views.VIEWS[name]
    needs = VIEW_INPUTS.get(name, {})
    keyed = name not in SURROGATES_FIRST
    frames = []
    for table in inputs:
        dims, refs = needs.get(table, ([], []))
        if table == "dim_date":
            frames.append(w.calendar())
        elif table.startswith("dim_"):
            frames.append(w.members(table) if keyed else w.dimension(table))
        elif keyed and dims:
            frames.append(w.keyed(table, refs))
        else:
            frames.append(w.star(table, dims, refs))
    if name == "v_kpi_overview":
        frames.append({DIMENSIONS[d].sk: w.members(d) for d in ("dim_driver", "dim_truck")})
    return (build or default)(*frames)


for _name in views.VIEWS:
    query(_name)(lambda w, n=_name: _view(w, n))

AS_WRITTEN = {
    "v_customer_service": views.customer_service_as_written,
    "v_driver_performance": views.driver_performance_as_written,
    "v_fleet_utilization": views.fleet_utilization_as_written,
    "v_maintenance_analysis": views.maintenance_analysis_as_written,
    "v_detention_analysis": views.detention_analysis_as_written,
}
for _name, _build in AS_WRITTEN.items():
    query(f"{_name}_as_written")(lambda w, n=_name, b=_build: _view(w, n, b))


# --- KPI queries ----------------------------------------------------------


@query("kpi_1")
def _(w):
    return kpis.scorecard(_view(w, "v_kpi_overview"))


@query("kpi_2")
def _(w):
    return kpis.on_time_by_year(w.star("fact_delivery"), w.calendar())


@query("kpi_3")
def _(w):
    return kpis.revenue_by_year(w.star("fact_load"), w.calendar())


@query("kpi_4")
def _(w):
    return kpis.top_corridors(w.keyed("fact_load", []), w.members("dim_route"))


@query("kpi_5")
def _(w):
    return kpis.top_customer_names(
        w.keyed("fact_load", []), w.members("dim_customer")
    )


@query("kpi_5_by_account")
def _(w):
    return kpis.top_customer_accounts(
        w.keyed("fact_load", []), w.members("dim_customer")
    )


@query("kpi_6")
def _(w):
    return kpis.top_trucks(
        w.keyed("fact_truck_monthly", []), w.members("dim_truck")
    )


@query("kpi_7")
def _(w):
    return kpis.fuel_by_year(w.star("fact_fuel"), w.calendar())


@query("kpi_8")
def _(w):
    return kpis.detention_hotspots(
        w.keyed("fact_delivery", []), w.members("dim_facility")
    )


@query("kpi_9")
def _(w):
    return kpis.on_time_by_corridor(
        w.star("fact_delivery", []),
        w.keyed("fact_load", []),
        w.members("dim_route"),
    )


@query("kpi_10")
def _(w):
    return kpis.derived_kpis(
        *[
            w.star(f)
            for f in (
                "fact_trip",
                "fact_maintenance",
                "fact_incident",
                "fact_fuel",
                "fact_load",
                "fact_delivery",
            )
        ]
    )


@query("kpi_11_underused")
def _(w):
    return kpis.underused_trucks(
        w.keyed("fact_truck_monthly", []), w.members("dim_truck"), 84.0
    )


@query("kpi_11_costly")
def _(w):
    return kpis.costly_trucks(_view(w, "v_maintenance_analysis"), 0.03)


@query("kpi_11_low_mpg")
def _(w):
    return kpis.low_mpg_truck_months(
        w.keyed("fact_truck_monthly", []), w.members("dim_truck")
    )


# --- Roll-ups and findings ------------------------------------------------

# Roll-up -> per silver table the foreign keys it uses.
ROLLUP_KEYS = {
    "trips_m": {"fact_trip": ["truck_id"]},
    "cust": {"fact_load": ["customer_id"]},
    "lanes": {"fact_load": ["route_id"]},
    "fac": {"fact_delivery": ["facility_id"]},
    "drv": {"fact_trip": ["driver_id"]},
    "trucks_y": {"fact_truck_monthly": ["truck_id"]},
}


def _rollup(w: SampleWarehouse, name: str) -> DataFrame:
    build, inputs = rollups.ROLLUPS[name]
    keys = ROLLUP_KEYS.get(name, {})
    return build(*[w.silver(t, keys.get(t, [])) for t in inputs])


for _name in rollups.ROLLUPS:
    query(f"ru_{_name}")(lambda w, n=_name: _rollup(w, n))


@query("export_columnar")
def _(w):
    return json_rows(rounded(_rollup(w, "trucks_y")).select("year", "truck_id", "util", "mpg"))


@query("fd_on_time")
def _(w):
    return findings.on_time_profile(
        w.silver("fact_delivery", []), w.silver("fact_load", []), SAMPLE_YEARS
    )


@query("fd_late_median")
def _(w):
    return findings.late_median(w.silver("fact_delivery", []))


@query("fd_driver_spread")
def _(w):
    return findings.driver_spread(
        w.silver("fact_delivery", []), w.silver("fact_trip", ["driver_id"])
    )


@query("fd_facility_spread")
def _(w):
    return findings.facility_spread(w.silver("fact_delivery", ["facility_id"]))


@query("fd_detention")
def _(w):
    return findings.detention_means(w.silver("fact_delivery", []))


@query("fd_fuel_price")
def _(w):
    return findings.fuel_price_effect(
        w.silver("fact_fuel", []), w.silver("fact_trip", []), SAMPLE_YEARS
    )


@query("fd_accounts")
def _(w):
    return findings.account_concentration(
        w.silver("dim_customer", []), w.silver("fact_load", ["customer_id"]), "BUILDING 1"
    )


@query("fd_unassigned")
def _(w):
    return findings.unassigned_trips(
        w.silver("fact_trip", ["truck_id", "load_id"]), w.silver("fact_load", [])
    )


@query("fd_fleet_metrics")
def _(w):
    return findings.fleet_metrics(
        w.silver("fact_truck_monthly"), w.silver("dim_truck", [])
    )


@query("fd_out_of_window")
def _(w):
    return findings.out_of_window(
        w.silver("fact_fuel", []), w.silver("fact_delivery", []), SAMPLE_PARTIAL_YEAR
    )


# --- Data quality ---------------------------------------------------------


def _staged(w: SampleWarehouse, name: str) -> DataFrame:
    """Text lines of a source as staged; every key that ends in 7 comes cut short."""
    source = SOURCES[name]
    rows = w.rows(name)
    cells = [
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in source.column_names
    ]
    short = F.col(source.key[0]).endswith("7")
    line = F.when(short, F.col(source.column_names[0])).otherwise(F.concat_ws(",", *cells))
    return stage_lines(rows.select(line.alias("value")), source)


def _layer_counts(w: SampleWarehouse, name: str) -> DataFrame:
    """(layer, object_name, rows_loaded, rows_rejected) of bronze and silver, one scan."""
    source = SOURCES[name]
    staged = _staged(w, name).withColumn("_short", F.col(MALFORMED))
    return _counts_by_layer(type_source(staged, source), source)


def _counts_by_layer(rows: DataFrame, source: Source) -> DataFrame:
    counts = rows.agg(
        F.count_if(~F.col("_short")).alias("a"),
        F.count_if("_short").alias("b"),
        F.count_if(F.col(REJECT).isNull()).alias("c"),
        F.count_if(F.col(REJECT).isNotNull()).alias("d"),
    )
    cells = "'bronze', a, b, 'silver', c, d"
    return counts.select(
        F.lit(source.target).alias("object_name"),
        F.expr(f"stack(2, {cells}) AS (layer, rows_loaded, rows_rejected)"),
    )


@query("dq_audit")
def _(w):
    """One line per layer and object, as the audit keeps them."""
    lines = quality.union_all([_layer_counts(w, name) for name in SOURCES])
    return lines.withColumn("status", F.lit("DONE"))


@query("dq_orphans")
def _(w):
    return quality.union_all(
        [
            quality.orphan_report(w.silver(s.target), s.target, list(s.parents))
            for s in SOURCES.values()
            if s.parents
        ]
    )


@query("dq_integrity")
def _(w):
    """Raw references and dates that no member backs, before Unknown takes them."""
    frames = []
    for s in SOURCES.values():
        if not s.parents:
            continue
        parents = {
            key: (w.rows(parent), SOURCES[parent].key[0])
            for key, parent in s.parents.items()
        }
        day = FACTS[s.target].date
        rows = w.rows(s.name).withColumn(day, F.to_date(F.col(day)))
        frames.append(
            quality.dangling_by_column(
                rows, s.target, {**parents, day: (w.calendar(), "date_id")}
            )
        )
    return quality.union_all(frames)


@query("dq_integrity_star")
def _(w):
    """Star references without a member, in facts whose keys of every 13th day broke."""
    frames = []
    broken = F.dayofmonth("date_sk") == 13
    for name, spec in FACTS.items():
        dims = {d: w.dimension(d) for d in spec.dims.values()}
        keys = {DIMENSIONS[d].sk: (frame, DIMENSIONS[d].sk) for d, frame in dims.items()}
        fact = w.star(name, spec.dims.values()).withColumns(
            {sk: F.when(broken, -2 - F.col(sk)).otherwise(F.col(sk)) for sk in keys}
        )
        keys["date_sk"] = (w.calendar(), "date_id")
        frames.append(quality.dangling_keys(fact, name, keys))
    return quality.union_all(frames)


@query("dq_duplicates")
def _(w):
    return quality.union_all(
        [
            quality.duplicate_summary(w.rows(s.name), s.target, s.key)
            for s in SOURCES.values()
        ]
    )


@query("dq_duplicate_keys")
def _(w):
    return duplicate_keys(w.rows("fuel_purchases"), ["fuel_purchase_id"])


@query("dq_null_profile")
def _(w):
    return quality.blank_profile(_staged_loads(w), SOURCES["loads"].column_names)


@query("dq_uncastable")
def _(w):
    return quality.uncastable(_staged_loads(w), SOURCES["loads"])


@query("dq_overlong")
def _(w):
    return quality.overlong(_staged_loads(w), SOURCES["loads"])


def _soiled(w: SampleWarehouse, name: str) -> DataFrame:
    """Staged text of a source with faults that follow from the last digit of its key.

    7: the line is cut short; 3: other columns are blank; 5: their numbers, dates and
    flags are 'n/a'; 9: their texts are one character too long.
    """
    source = SOURCES[name]
    key = F.coalesce(F.col(source.key[0]), F.lit(""))
    cells = []
    for column, kind, width in source.columns:
        cell = F.coalesce(F.col(column).cast("string"), F.lit(""))
        if column not in source.key:
            if kind in ("key", "text"):
                cell = F.when(key.endswith("9"), F.lit("x" * (width + 1))).otherwise(cell)
            else:
                cell = F.when(key.endswith("5"), F.lit("n/a")).otherwise(cell)
            cell = F.when(key.endswith("3"), F.lit("  ")).otherwise(cell)
        cells.append(cell)
    line = F.when(key.endswith("7"), F.col(source.column_names[0])).otherwise(
        F.concat_ws(",", *cells)
    )
    return stage_lines(w.rows(name).select(line.alias("value")), source)


@query("dq_source_profile")
def _(w):
    """All columns of all 14 sources, one scan a source."""
    return quality.union_all(
        [quality.source_profile(_soiled(w, n), s) for n, s in SOURCES.items()]
    )


@query("dq_trip_events")
def _(w):
    """On-time flags against trips, of which every eleventh and thirteenth is not finished."""
    order = F.col("trip_id").substr(2, 20).cast("bigint")
    status = (
        F.when(order % 11 == 0, "Cancelled").when(order % 13 == 0, "In Transit").otherwise("Completed")
    )
    trips = w.rows("trips").withColumn("trip_status", status)
    return quality.trip_event_violations(w.rows("delivery_events"), trips, "Completed")


@query("dq_cross_field")
def _(w):
    return quality.union_all(
        [
            quality.rule_violations(
                w.rows("delivery_events"), "fact_delivery", quality.delivery_rules()
            ),
            quality.rule_violations(
                w.rows("fuel_purchases"), "fact_fuel", quality.fuel_rules()
            ),
            quality.rule_violations(w.rows("trips"), "fact_trip", quality.trip_rules()),
        ]
    )


def _stored_silver(w: SampleWarehouse, kept: Warehouse, name: str) -> DataFrame:
    """Silver rows of a source with their references, stored: its lines are parsed once.

    Refused rows stay in the table with their reason, those of short lines with ``_short``.
    """
    source = SOURCES[name]
    staged = _staged(w, name).withColumn("_short", F.col(MALFORMED))
    rows = silver_rows(staged, source)
    if source.target in FACTS:
        used = dict.fromkeys([*source.key, *rows.columns[:2], *source.parents])
        rows = rows.select(*used, "_short", REJECT)
    kept.write(rows, "silver", source.target)
    return kept.read_all("silver", source.target)


@query("dq_conservation")
def _(w):
    """Rows of each object as staged, accepted, and after keys and Unknown members."""
    kept = Warehouse(w.spark, scratch_folder(w.spark, "queries"))
    silver = {name: _stored_silver(w, kept, name) for name in SOURCES}
    accepted = {n: rows.where(F.col(REJECT).isNull()).drop(REJECT, "_short") for n, rows in silver.items()}
    frames = []
    for name, source in SOURCES.items():
        frames.append(_counts_by_layer(silver[name], source))
        if source.target in FACTS:
            parents = {p: accepted[p] for p in source.parents.values()}
            gold = check_references(accepted[name], source, parents)
        else:
            gold = build_dimension(accepted[name], source.target)
        frames.append(
            gold.agg(F.count(F.lit(1)).alias("rows_loaded")).select(
                F.lit(source.target).alias("object_name"),
                F.lit("gold").alias("layer"),
                "rows_loaded",
                F.lit(0).cast("bigint").alias("rows_rejected"),
            )
        )
    return quality.conservation(quality.union_all(frames))


KPI_YEARS = SAMPLE_YEARS[:3]
KPI_TOLERANCES = {
    "gross_revenue": 0.005,
    **{f"gross_revenue_{y}": 0.005 for y in KPI_YEARS},
    "total_trips": 0.0,
    "delivery_events": 0.0,
    "on_time_deliveries": 0.0,
    "on_time_pct": 0.05,
    **{f"on_time_pct_{y}": 0.05 for y in KPI_YEARS},
    "total_miles": 0.0,
    "avg_mpg": 0.0001,
    "avg_utilization_pct": 0.05,
    "fuel_cost": 0.005,
    "claims_total": 0.005,
    "incidents": 0.0,
    "preventable": 0.0,
}


def _pick(value, condition) -> Column:
    return F.sum(F.when(condition, value))


@query("dq_kpi_check")
def _(w):
    """Headline figures of the warehouse against the sample tables themselves."""
    overview = _view(w, "v_kpi_overview")
    loads, events = w.silver("fact_load"), w.silver("fact_delivery")
    dropped = F.col("event_type") == "Delivery"
    hit = dropped & F.col("on_time_flag")
    day = F.year("scheduled_datetime")
    actual = views.one_row(
        [
            overview.withColumnRenamed("on_time_delivery_pct", "on_time_pct"),
            loads.agg(
                *[
                    _pick(F.col("gross_revenue"), F.year("load_date") == y).alias(
                        f"gross_revenue_{y}"
                    )
                    for y in KPI_YEARS
                ]
            ),
            events.agg(
                F.count_if(hit).alias("on_time_deliveries"),
                *[
                    R.pct(F.count_if(hit & (day == y)), F.count_if(dropped & (day == y))).alias(
                        f"on_time_pct_{y}"
                    )
                    for y in KPI_YEARS
                ],
            ),
            w.silver("fact_incident").agg(
                F.count(F.lit(1)).alias("incidents"),
                F.count_if("preventable_flag").alias("preventable"),
            ),
        ]
    )
    orders, lines = w.table("orders"), w.table("lineitem")
    gross = F.expr(
        "CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2))"
        " + o_orderkey % 500 + o_orderkey % 70 END"
    )
    share = lambda good, every: 100 * good / every
    sent, kept = F.col("l_linestatus") == "O", F.col("l_returnflag") == "N"
    at = F.year(F.expr("l_shipdate + make_dt_interval(0, CAST(l_partkey % 24 AS INT))"))
    k = F.expr("CAST(get_json_object(props, '$.k') AS INT)")
    months = lines.groupBy("l_suppkey", F.date_trunc("month", "l_shipdate").alias("m")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q")
    )
    expected = views.one_row(
        [
            orders.agg(
                F.sum(gross).alias("gross_revenue"),
                *[
                    _pick(gross, F.year("o_orderdate") == y).alias(f"gross_revenue_{y}")
                    for y in KPI_YEARS
                ],
                F.count(F.lit(1)).alias("total_trips"),
                F.expr(
                    "sum(abs(o_orderkey % 25 - o_custkey % 25) * 100 + o_orderkey % 90)"
                ).alias("total_miles"),
                F.expr(
                    "avg(CASE WHEN o_orderkey % 151 <> 0 THEN (500 + o_orderkey % 300) / 100 END)"
                ).alias("avg_mpg"),
            ),
            lines.agg(
                F.count_if(sent).alias("delivery_events"),
                F.count_if(sent & kept).alias("on_time_deliveries"),
                share(F.count_if(sent & kept), F.count_if(sent)).alias("on_time_pct"),
                *[
                    share(
                        F.count_if(sent & kept & (at == y)), F.nullif(F.count_if(sent & (at == y)), F.lit(0))
                    ).alias(f"on_time_pct_{y}")
                    for y in KPI_YEARS
                ],
                F.expr("sum(CAST(l_extendedprice AS DECIMAL(12,2)))").alias("fuel_cost"),
            ),
            months.agg(F.avg((600 + F.col("q") % 500) / 10).alias("avg_utilization_pct")),
            w.table("events").agg(
                F.count(F.lit(1)).alias("incidents"),
                F.count_if((k % 13 != 0) & (k % 3 == 0)).alias("preventable"),
                F.expr("sum(CAST(value AS DECIMAL(12,2)) * 13)").alias("claims_total"),
            ),
        ]
    )
    figures = quality.compare_figures(actual, expected, KPI_TOLERANCES)
    # Two ways of dividing agree to six digits, not to the last bit.
    return figures.withColumn("expected", F.round("expected", 6))


@query("dq_completeness")
def _(w):
    loads = w.rows("loads").select("load_id", "load_type")
    frames = []
    for source, target in (("delivery_events", "fact_delivery"), ("trips", "fact_trip")):
        # Count per key first: a blank key is one row at the join, however frequent.
        per_load = w.rows(source).groupBy("load_id").agg(F.count(F.lit(1)).alias("_n"))
        joined = per_load.join(loads, "load_id", "left")
        frames.append(quality.completeness(joined, target, "load_type", "_n"))
    return quality.union_all(frames)


@query("dq_unassigned")
def _(w):
    trips = w.rows("trips")
    return quality.union_all(
        [
            quality.unassigned_keys(trips, w.rows("drivers"), "driver_id"),
            quality.unassigned_keys(trips, w.rows("trucks"), "truck_id"),
            quality.unassigned_keys(trips, w.rows("trailers"), "trailer_id"),
        ]
    )


# --- Incremental merge and history ----------------------------------------


def _price_history(w: SampleWarehouse) -> DataFrame:
    """Shipments as corrections of a load's date and amount, some older than it."""
    return w.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("load_id"),
        F.expr(
            "date_sub(CAST(l_shipdate AS DATE), CAST(l_orderkey % 3 * 400 AS INT))"
        ).alias("load_date"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("revenue"),
    )


@query("inc_upsert")
def _(w):
    base = w.rows("loads").select("load_id", "load_date", "revenue")
    return history.merge_latest(
        base, _price_history(w), ["load_id"], F.struct("load_date", "revenue")
    )


def _driver_versions(w: SampleWarehouse) -> DataFrame:
    seen = w.table("orders").select(
        F.expr("CAST(o_custkey div 15 AS STRING)").alias("driver_id"),
        F.col("o_orderdate").cast("date").alias("seen_on"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("_order"),
    )
    return history.versions(seen, "driver_id", "seen_on", ["status"], F.col("_order"))


@query("scd2_versions")
def _(w):
    return _driver_versions(w)


@query("scd2_as_of")
def _(w):
    months = w.rows("driver_monthly_metrics").select(
        "driver_id", "month", "trips_completed"
    )
    return history.as_of(months, _driver_versions(w), "driver_id", "month", ["status"])


@query("scd2_star_trips")
def _(w):
    """Trips and miles per version of their driver, whichever was valid on the day."""
    versions = _driver_versions(w).withColumn(
        "driver_version_sk", F.xxhash64("driver_id", "valid_from")
    )
    trips = history.with_version(
        w.silver("fact_trip", ["driver_id"]),
        versions,
        "driver_id",
        "dispatch_date",
        "driver_version_sk",
        ["trip_id"],
    )
    per_version = trips.groupBy("driver_id", "driver_version_sk").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("actual_distance_miles").alias("miles")
    )
    return per_version.join(
        versions.select("driver_version_sk", "status", "valid_from"), "driver_version_sk", "left"
    ).drop("driver_version_sk")
