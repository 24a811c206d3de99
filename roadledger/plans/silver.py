"""Silver layer: typed, derived, reference-checked tables (JOIN-1..7)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from roadledger.model import SOURCES, Source
from roadledger.operators.conform import apply_missing, missing_keys
from roadledger.operators.staging import derive, type_source
from roadledger.sources.tables import Warehouse, scratch_folder


def silver_rows(staged: DataFrame, source: Source) -> DataFrame:
    """Typed and derived rows of one source, refused ones marked."""
    return derive(type_source(staged, source), source)


def check_references(
    rows: DataFrame,
    source: Source,
    parents: Mapping[str, DataFrame],
    only: Iterable[str] | None = None,
) -> DataFrame:
    """Turn every foreign key without a parent into '-1'.

    ``parents`` maps a parent source name to its silver table. ``only`` limits
    the work to the foreign keys a caller goes on to use. The keys without a parent
    are found and stored first, as in the build: the list is normally short whatever
    the parents' size, so the wide rows stay where they are when they meet it.
    """
    wanted = source.parents if only is None else {k: source.parents[k] for k in only}
    if not wanted:
        return rows
    kept = Warehouse(rows.sparkSession, scratch_folder(rows.sparkSession, "references"))
    listed = {k: (parents[p], SOURCES[p].key[0]) for k, p in wanted.items()}
    kept.write(missing_keys(rows, listed), "audit", f"missing_{source.target}")
    missing = kept.read_all("audit", f"missing_{source.target}")
    spread_by = list(dict.fromkeys([*source.key, *rows.columns[:2]]))
    return apply_missing(rows, missing, list(wanted), spread_by)
