"""Reusable DataFrame operators of the warehouse."""

from roadledger.operators.conform import (
    apply_missing,
    missing_keys,
    resolve_fk,
    resolve_sk,
    surrogate_key,
    with_unknown,
)
from roadledger.operators.ranking import distinct_values, first_by, top_k
from roadledger.operators.statistics import exact_median

__all__ = [
    "apply_missing",
    "distinct_values",
    "exact_median",
    "first_by",
    "missing_keys",
    "resolve_fk",
    "resolve_sk",
    "surrogate_key",
    "top_k",
    "with_unknown",
]
