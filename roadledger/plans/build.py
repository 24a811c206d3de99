"""Full reload of the warehouse: exports -> bronze -> silver -> gold -> views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadledger.model import (
    CALENDAR_END,
    CALENDAR_START,
    DIMENSION_SOURCES,
    DIMENSIONS,
    FACT_SOURCES,
    FACTS,
    SOURCES,
    UNKNOWN_KEY,
    UNKNOWN_SK,
    Source,
)
from roadledger.operators import quality
from roadledger.operators.audit import RunAudit
from roadledger.operators.conform import apply_missing, missing_keys
from roadledger.operators.history import versions, with_version
from roadledger.operators.keymap import KeyMap
from roadledger.operators.staging import (
    REJECT,
    duplicate_keys,
    refuse_duplicates,
    refuse_outside,
    single_copies,
)
from roadledger.plans.monthly import YEAR, monthly_layers
from roadledger.plans.rollups import ROLLUPS
from roadledger.plans.silver import silver_rows
from roadledger.plans.star import build_dimension, build_fact
from roadledger.plans.views import register_views
from roadledger.sources.calendar import calendar
from roadledger.sources.delimited import read_delimited, source_row_counts
from roadledger.sources.export import write_columnar
from roadledger.sources.tables import Warehouse


# Dimensions whose changes are kept, with the attributes that make a version.
VERSIONED = {
    "dim_driver": ["employment_status", "home_terminal"],
    "dim_truck": ["status", "home_terminal"],
}


def version_sk(dim: str) -> str:
    """Surrogate of a dimension's versions, as facts carry it."""
    return DIMENSIONS[dim].sk.replace("_sk", "_version_sk")


class WarehouseBuild:
    """One run over one source folder.

    Every step reads stored tables and replaces one stored table, so a lost
    executor repeats tasks of one step and a failed run is simply started again.
    """

    def __init__(
        self,
        spark: SparkSession,
        source_dir: str,
        root: str,
        start: str = CALENDAR_START,
        end: str = CALENDAR_END,
    ):
        self.spark = spark
        self.source_dir = source_dir
        self.warehouse = Warehouse(spark, root)
        self.start, self.end = start, end
        self.audit = RunAudit(self.warehouse)

    def bronze(self) -> None:
        for name in (*DIMENSION_SOURCES, *FACT_SOURCES):
            staged = read_delimited(self.spark, self.source_dir, name)
            self.audit.write(staged, "bronze", name)

    def silver(self) -> None:
        self.audit.write(
            calendar(self.spark, self.start, self.end), "silver", "dim_date"
        )
        for name in (*DIMENSION_SOURCES, *FACT_SOURCES):
            source = SOURCES[name]
            rows = silver_rows(self.warehouse.read_all("bronze", name), source)
            # Stored, so that the next plan knows its size; without any repeated
            # key the rows pass in a single scan.
            self.warehouse.write(
                duplicate_keys(rows, source.key), "audit", f"repeated_{source.target}"
            )
            repeated = self.warehouse.read_all("audit", f"repeated_{source.target}")
            if repeated.isEmpty():
                rows = single_copies(rows)
            else:
                rows = refuse_duplicates(rows, repeated, source.key)
            if source.parents:
                rows = self._check_references(rows, source)
            self.audit.write(rows, "silver", source.target)

    def _check_references(self, rows: DataFrame, source: Source) -> DataFrame:
        """Store the keys without a parent, then blank them out by that list.

        The list is normally short whatever the parents' size, so the wide fact
        rows are not shuffled to meet their parents.
        """
        parents = {
            key: (self.warehouse.read("silver", SOURCES[p].target), SOURCES[p].key[0])
            for key, p in source.parents.items()
        }
        name = f"missing_{source.target}"
        self.warehouse.write(missing_keys(rows, parents), "audit", name)
        missing = self.warehouse.read_all("audit", name)
        spread_by = list(dict.fromkeys([*source.key, *rows.columns[:2]]))
        return apply_missing(rows, missing, list(parents), spread_by)

    def missing(self, target: str) -> DataFrame:
        """Keys of a silver fact that had no parent, with their rows."""
        return self.warehouse.read_all("audit", f"missing_{target}")

    def gold(self) -> None:
        """Dimensions under lasting surrogates, facts by year, the monthly layers.

        A year whose rows come out the same is not rewritten, and of the monthly layers
        only months whose facts differ are.
        """
        layers = monthly_layers(self.warehouse)
        w = self.warehouse
        self.audit.write(w.read("silver", "dim_date"), "gold", "dim_date")
        for name, dim in DIMENSIONS.items():
            members = w.read("silver", name)
            keys = KeyMap(w, name, dim.key, dim.sk)
            keys.extend(members)
            self.audit.write(build_dimension(members, name, keys.read()), "gold", name)
        for name, fact in FACTS.items():
            dims = {d: w.read("gold", d) for d in fact.dims.values()}
            rows = single_copies(w.read("silver", name)).withColumn(
                REJECT, F.lit(None).cast("string")
            )
            rows = refuse_outside(rows, fact.date, self.start, self.end)
            identity = rows.columns[:2]
            for key, dim in fact.dims.items():
                if dim in VERSIONED:
                    history = w.read_all("gold", f"{dim}_versions")
                    rows = with_version(
                        rows, history, key, fact.date, version_sk(dim), identity
                    )
            # By year, so that a query over some years reads those alone.
            rows = build_fact(rows, name, dims).withColumn(YEAR, F.year("date_sk"))
            above = [layer for layer in layers if layer.fact == name]
            month = {"month": F.trunc("date_sk", "month")} if above else {}

            def note(months, above=above):
                for layer in above:
                    layer.note(months)

            self.audit.refresh(rows, "gold", name, (YEAR,), month, note)
        for layer in layers:
            layer.refresh()

    def history(self, day: date | None = None) -> None:
        """Note today's members and store the versions of drivers and trucks (RM-4).

        A day seen twice is replaced, so a repeated run changes nothing. A version keeps
        its surrogate for good.
        """
        w, seen_on = self.warehouse, F.lit(day or date.today())
        for dim, attributes in VERSIONED.items():
            key, sk = DIMENSIONS[dim].key, version_sk(dim)
            seen = w.read("silver", dim).select(key, *attributes)
            w.replace_partitions(
                seen.withColumn("seen_on", seen_on), "silver", f"{dim}_seen", ["seen_on"]
            )
            order = F.struct(*[F.col(c) for c in attributes])
            known = w.read_all("silver", f"{dim}_seen")
            found = versions(known, key, "seen_on", attributes, order).withColumn(
                "version", F.concat_ws("@", key, F.col("valid_from").cast("string"))
            )
            keys = KeyMap(w, f"{dim}_versions", "version", sk)
            keys.extend(found)
            numbered = found.join(keys.read(), "version").drop("version")
            unknown = self.spark.range(1).select(
                F.lit(UNKNOWN_SK).cast("bigint").alias(sk), F.lit(UNKNOWN_KEY).alias(key)
            )
            w.write(
                numbered.unionByName(unknown, allowMissingColumns=True),
                "gold",
                f"{dim}_versions",
            )

    def tables(self) -> dict[str, DataFrame]:
        names = ("dim_date", *DIMENSIONS, *FACTS)
        return {n: self.warehouse.read("gold", n) for n in names}

    def silver_tables(self) -> dict[str, DataFrame]:
        names = [s.target for s in SOURCES.values()]
        return {n: self.warehouse.read("silver", n) for n in names}

    def orphans(self) -> DataFrame:
        """DQ-3 over the silver facts."""
        return quality.union_all(
            [
                quality.orphan_report(
                    self.warehouse.read("silver", s.target), s.target, list(s.parents)
                )
                for s in SOURCES.values()
                if s.parents
            ]
        )

    def integrity(self) -> DataFrame:
        """DQ-4, DQ-8 over the star facts, dates included."""
        tables = self.tables()
        frames = []
        for name, fact in FACTS.items():
            keys = {
                DIMENSIONS[d].sk: (tables[d], DIMENSIONS[d].sk)
                for d in fact.dims.values()
            }
            keys["date_sk"] = (tables["dim_date"], "date_id")
            for dim in fact.dims.values():
                if dim in VERSIONED:
                    stored = self.warehouse.read_all("gold", f"{dim}_versions")
                    keys[version_sk(dim)] = (stored, version_sk(dim))
            frames.append(quality.dangling_keys(tables[name], name, keys))
        return quality.union_all(frames)

    def conservation(self) -> DataFrame:
        """DQ-12 over this run's audit lines."""
        lines = self.audit.frame().where(F.col("object_name") != "dim_date")
        renamed = F.col("object_name")
        for source in SOURCES.values():
            renamed = F.when(
                F.col("object_name") == source.name, source.target
            ).otherwise(renamed)
        return quality.conservation(lines.withColumn("object_name", renamed))

    def export(self, path: str) -> None:
        """Write every roll-up as columnar JSON."""
        silver = self.silver_tables()
        for name, (build, inputs) in ROLLUPS.items():
            write_columnar(build(*[silver[t] for t in inputs]), f"{path}/{name}")

    def source_rows(self) -> DataFrame:
        """Data lines of every source's files against what bronze took."""
        frames = []
        for name in SOURCES:
            counts = source_row_counts(self.spark, f"{self.source_dir}/{name}*")
            frames.append(
                counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("source_rows")).select(
                    F.lit(name).alias("object_name"), "source_rows"
                )
            )
        taken = self.audit.frame().where("layer = 'bronze'")
        loaded = F.col("rows_loaded") + F.coalesce("rows_rejected", F.lit(0))
        return (
            quality.union_all(frames)
            .join(taken.select("object_name", loaded.alias("bronze_rows")), "object_name")
            .withColumn("same", F.col("source_rows") == F.col("bronze_rows"))
        )

    def column_profile(self) -> DataFrame:
        """DQ-10, DQ-16 over the staged text of every source."""
        return quality.union_all(
            [
                quality.source_profile(self.warehouse.read_all("bronze", name), source)
                for name, source in SOURCES.items()
            ]
        )

    def trip_events(self) -> DataFrame:
        """DQ-11 between delivery events and their trips."""
        events, trips = (self.warehouse.read("silver", t) for t in ("fact_delivery", "fact_trip"))
        return quality.trip_event_violations(events, trips, "Completed")

    def checks(self) -> None:
        """Orphans, integrity, conservation, source counts, column profiles and rules
        across tables, kept in the audit layer."""
        for name, frame in (
            ("check_orphans", self.orphans()),
            ("check_integrity", self.integrity()),
            ("check_conservation", self.conservation()),
            ("check_source_rows", self.source_rows()),
            ("check_columns", self.column_profile()),
            ("check_trip_events", self.trip_events()),
        ):
            self.warehouse.write(
                frame.withColumn("run_id", F.lit(self.audit.run_id)), "audit", name
            )

    def run(self, day: date | None = None) -> str:
        """All layers, their checks, the audit lines and the views; returns the run id.

        ``day`` is the day on which the members are seen, by default today.
        """
        self.bronze()
        self.silver()
        self.history(day)
        self.gold()
        self.checks()
        self.audit.flush()
        register_views(self.tables())
        return self.audit.run_id
