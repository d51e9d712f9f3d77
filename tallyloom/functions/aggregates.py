"""Aggregate expressions, as Spark SQL text, with the missing-value rules of the families.

Means and shares are written as sum over count: the engine keeps equal aggregates
once, so a column with mean and sum, or a category list over one row set, needs
about half the aggregation buffer (and half the shuffled bytes) of separate averages.
"""

from __future__ import annotations

from collections.abc import Callable

from tallyloom.functions.scalars import nan_to_null


def total(x: str) -> str:
    """Sum in which a group without any value is 0, not missing."""
    return f"coalesce(sum(double({x})), 0.0D)"


def mean(x: str) -> str:
    return nan_to_null(f"try_divide(sum(double({x})), double(count({x})))")


def share(hit: str) -> str:
    """Mean of a 0/1 indicator; an unknown comparison counts as 0."""
    return f"try_divide(double(count_if({hit})), double(count(1)))"


def hits(hit: str) -> str:
    return f"count_if({hit})"


def latest_present(x: str, order: str) -> str:
    """Value at the largest ``order`` among rows where the value is present.

    Rows of equal order are settled by the value itself, rows without an order
    come last, so the result does not depend on row arrival.
    """
    return f"max_by({x}, CASE WHEN {x} IS NOT NULL THEN struct({order}, {x}) END)"


def latest_code(code: str, codes: int, order: str) -> str:
    """Like ``latest_present`` for a small code 0..codes-1 and a whole-number order.

    Order and code are packed into one long, so the group needs a plain hash
    aggregate where ``max_by`` over a struct would have every row sorted first.
    """
    packed = f"coalesce(bigint({order}), -{1 << 40}) * {codes} + {code}"
    return f"pmod(max({packed}), {codes})"


def pearson(x: str, y: str) -> str:
    """Pairwise-complete correlation; missing when either side is constant or holds infinities."""
    xd = f"(CASE WHEN {y} IS NOT NULL THEN double({x}) END)"
    yd = f"(CASE WHEN {x} IS NOT NULL THEN double({y}) END)"
    return nan_to_null(f"try_divide(covar_pop({xd}, {yd}), sqrt(var_pop({xd}) * var_pop({yd})))")


# name of the function in an aggregate specification -> expression over one column
AGGREGATES: dict[str, Callable[[str], str]] = {
    "count": lambda x: f"count({x})",
    "nunique": lambda x: f"count(DISTINCT {x})",
    "sum": total,
    "mean": mean,
    "min": lambda x: f"min({x})",
    "max": lambda x: f"max({x})",
    "var": lambda x: nan_to_null(f"var_samp(double({x}))"),
}

# these give a number even for a group without rows, so a subset has to null them
NEVER_NULL = frozenset({"count", "nunique", "sum"})
