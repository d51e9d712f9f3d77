"""Multi-function aggregation of a child table to one row per key.

Subsets (active loans, refused applications, ...) are conditional aggregates of
the same ``groupBy``: one scan and one shuffle instead of a filter, a group and a
join per subset. Every aggregate has a map-side partial form, so a key holding a
large part of the rows reaches the shuffle as one buffer per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.aggregates import AGGREGATES, NEVER_NULL, hits, share
from tallyloom.functions.scalars import called, literal, name

Spec = Mapping[str, Sequence[str]]


def output_name(prefix: str, column: str, function: str) -> str:
    return f"{prefix}{column}_{function.upper()}"


def agg_exprs(spec: Spec, prefix: str = "", where: str | None = None) -> list[Column]:
    """Aliased aggregates for ``{column: [function, ...]}``.

    With ``where`` (a condition as SQL text) only matching rows take part, and a key
    without any matching row gets NULL throughout, also for sums and counts.
    """
    out = []
    for column, functions in spec.items():
        value = name(column) if where is None else f"CASE WHEN {where} THEN {name(column)} END"
        for function in functions:
            text = AGGREGATES[function](value)
            if where is not None and function in NEVER_NULL:
                text = f"CASE WHEN {hits(where)} > 0 THEN {text} END"
            out.append(F.expr(called(text, output_name(prefix, column, function))))
    return out


def category_exprs(
    column: str,
    categories: Iterable[str],
    prefix: str = "",
    functions: Sequence[str] = ("mean",),
    nan_as_category: bool = False,
) -> list[Column]:
    """Share (``mean``) and count (``sum``) per category without building indicator columns."""
    tests = [(str(v), f"{name(column)} = {literal(v)}") for v in categories]
    if nan_as_category:
        tests.append(("nan", f"{name(column)} IS NULL"))
    shapes = {"mean": share, "sum": hits}
    return [
        F.expr(called(shapes[f](test), output_name(prefix, f"{column}_{label}", f)))
        for label, test in tests
        for f in functions
    ]


def size_expr(alias: str, where: str | None = None) -> Column:
    if where is None:
        return F.expr(called("count(1)", alias))
    return F.expr(called(f"CASE WHEN {hits(where)} > 0 THEN {hits(where)} END", alias))


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which every key is present; grouping never forms a group of missing keys."""
    return df.filter(" AND ".join(f"{name(k)} IS NOT NULL" for k in keys))


def group_by_present(df: DataFrame, *keys: str):
    return keyed(df, *keys).groupBy(*keys)


def with_exprs(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``withColumns`` for expression text."""
    return df.withColumns({n: F.expr(text) for n, text in columns.items()})
