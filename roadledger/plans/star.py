"""Star schema: keyed dimensions with an Unknown member, facts with surrogates
(JOIN-8, PRJ-13..15, SET-3)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadledger.model import DIMENSIONS, FACTS, Fact
from roadledger.operators.conform import resolve_sk, surrogate_key, with_unknown


def build_dimension(
    silver: DataFrame, name: str, keys: DataFrame | None = None
) -> DataFrame:
    """Narrow a silver dimension, number its members, add the Unknown member.

    ``keys`` has the lasting surrogates of all members; without it they are numbered anew.
    """
    dim = DIMENSIONS[name]
    members = silver.select(dim.key, *dim.attributes)
    if keys is None:
        numbered = surrogate_key(members, dim.key, dim.sk)
    else:
        numbered = members.join(keys, dim.key).select(dim.sk, *members.columns)
    return with_unknown(numbered, dim)


def build_fact(
    silver: DataFrame,
    name: str,
    dims: Mapping[str, DataFrame],
    only: Iterable[str] | None = None,
    show_keys: bool = False,
) -> DataFrame:
    """Resolve surrogates, name degenerate keys and the date key, narrow.

    ``only`` lists the dimensions a caller goes on to use; the natural keys of
    the others are left out instead of being joined for nothing. ``show_keys`` adds the
    natural key of the member to each surrogate.
    """
    fact = FACTS[name]
    wanted = list(dims) if only is None else list(only)
    rows = silver.drop(*fact.drops)
    for key, dim_name in fact.dims.items():
        if dim_name in wanted:
            rows = resolve_sk(
                rows, dims[dim_name], key, DIMENSIONS[dim_name].sk, show_key=show_keys
            )
        else:
            rows = rows.drop(key)
    return _narrowed(rows, fact)


def keyed_fact(silver: DataFrame, name: str) -> DataFrame:
    """A star fact before its lookups: natural keys stand under the surrogates' names.

    For a report that shrinks the fact to one row per key and looks up that.
    """
    fact = FACTS[name]
    names = {key: DIMENSIONS[dim].sk for key, dim in fact.dims.items()}
    return _narrowed(silver.drop(*fact.drops).withColumnsRenamed(names), fact)


def keyed_dimension(silver: DataFrame, name: str) -> DataFrame:
    """The known members with their natural key under the surrogate's name too."""
    dim = DIMENSIONS[name]
    return silver.select(F.col(dim.key).alias(dim.sk), dim.key, *dim.attributes)


def _narrowed(rows: DataFrame, fact: Fact) -> DataFrame:
    day = F.to_date(F.col(fact.date)).alias("date_sk")
    columns = []
    for c in rows.columns:
        if c in fact.degenerate:
            columns.append(F.col(c).alias(fact.degenerate[c]))
        elif c != fact.date:
            columns.append(F.col(c))
        elif fact.keep_date:
            columns += [day, F.col(c)]
        else:
            columns.append(day)
    return rows.select(*columns)
