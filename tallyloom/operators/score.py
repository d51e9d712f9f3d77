"""Piecewise range scores: a column over its global range, weighted below and above bounds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import INFINITY, literal, name, nan_to_null, ratio
from tallyloom.operators.staging import stage


@dataclass(frozen=True)
class ScoreTerm:
    """One term: v = x / (max - min) of the whole column (the minimum is not subtracted).

    v below ``low`` gives ``low_weight * v``, above ``high`` gives ``high_weight * v``,
    between them ``other``; a missing v gives 0.
    """

    column: str
    low: float = 0.0
    low_weight: float = 0.0
    high: float = 1.0
    high_weight: float = 0.0
    other: float = 0.0


def term_value(term: ScoreTerm, v: str, keep_infinite: bool = False) -> str:
    """Value of a term given its v."""
    low, low_weight, high, high_weight, other = (
        literal(float(x)) for x in (term.low, term.low_weight, term.high, term.high_weight, term.other)
    )
    # a constant column has range 0, which makes v infinite
    known = f"{v} IS NOT NULL" if keep_infinite else f"abs({v}) < {INFINITY}"
    return (
        f"CASE WHEN NOT coalesce({known}, false) THEN 0.0D WHEN {v} < {low} THEN {low_weight} * {v}"
        f" WHEN {v} > {high} THEN {high_weight} * {v} ELSE {other} END"
    )


def with_scores(
    df: DataFrame,
    scores: Mapping[str, Sequence[ScoreTerm]],
    keep_infinite: bool = False,
    staged: bool = True,
) -> DataFrame:
    """Add one column per score, each the sum of its terms in order.

    All global ranges come from one aggregate with a single result row, used as
    a scalar subquery. The table is staged first (unless it already is one) so
    that its own aggregation runs once, not once for the ranges and once for the rows.
    """
    columns = list(dict.fromkeys(t.column for terms in scores.values() for t in terms))
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"score columns that do not exist: {missing}")
    table = stage(df) if staged else df
    spans = ", ".join(
        nan_to_null(f"double(max({name(c)})) - double(min({name(c)}))") + f" AS s{i}"
        for i, c in enumerate(columns)
    )
    span_row = table.agg(F.expr(f"struct({spans})")).scalar()
    values = ", ".join(ratio(name(c), f"__spans.s{i}") + f" AS v{i}" for i, c in enumerate(columns))
    scored = table.withColumn("__spans", span_row).withColumn("__v", F.expr(f"struct({values})"))
    position = {c: f"__v.v{i}" for i, c in enumerate(columns)}
    sums = {
        s: nan_to_null(
            " + ".join(["0.0D", *[term_value(t, position[t.column], keep_infinite) for t in terms]])
        )
        for s, terms in scores.items()
    }
    return scored.withColumns({s: F.expr(text) for s, text in sums.items()}).drop("__spans", "__v")
