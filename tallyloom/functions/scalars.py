"""Null-preserving scalar expressions as Spark SQL text.

Every function takes expression text (a column name, or any SQL expression) and
returns expression text for ``F.expr`` / ``selectExpr``. A feature family has
hundreds of expressions; one parsed text each keeps building the plan cheap.

Missing values are SQL NULL everywhere and NaN is never stored, so whatever could
give NaN (0/0, inf/inf, inf-inf) yields NULL instead. Infinities are ordinary values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

INFINITY, MINUS_INFINITY, NAN = "double('Infinity')", "double('-Infinity')", "double('NaN')"


def name(column: str) -> str:
    """Column by exact name, whatever characters the name holds."""
    return "`" + column.replace("`", "``") + "`"


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def called(expression: str, alias: str) -> str:
    return f"{expression} AS {name(alias)}"


def nan_to_null(x: str) -> str:
    return f"nullif({x}, {NAN})"


# --- predicates -----------------------------------------------------------


def differs(x: str, *others) -> str:
    """``x`` is none of ``others``; a missing value differs from all of them."""
    return "(" + " AND ".join(f"NOT ({x} <=> {literal(o)})" for o in others) + ")"


def one_of(x: str, values: Sequence) -> str:
    return f"({x} IN ({', '.join(map(literal, values))}))"


# --- cleaning -------------------------------------------------------------


def sentinel_to_null(x: str, sentinel) -> str:
    return f"nullif({x}, {literal(sentinel)})"


def null_when(x: str, condition: str) -> str:
    """NULL where the condition holds; an unknown condition leaves the value alone."""
    return f"CASE WHEN {condition} THEN NULL ELSE {x} END"


def zero_when_negative(x: str) -> str:
    return f"CASE WHEN {x} < 0 THEN 0.0D ELSE double({x}) END"


def collapse(x: str, keep: Sequence[str], other: str) -> str:
    """Keep the listed categories; everything else, missing included, becomes ``other``."""
    return f"CASE WHEN {one_of(x, keep)} THEN {x} ELSE {literal(other)} END"


def count_labels(x: str, labels: Mapping[int, str], over: str) -> str:
    """Integer counts to labels; counts above the largest listed one become ``over``.

    Values that are neither listed nor above stay as their own text, missing stays missing.
    """
    cases = "".join(f" WHEN {x} = {n} THEN {literal(label)}" for n, label in sorted(labels.items()))
    return f"CASE WHEN {x} > {max(labels)} THEN {literal(over)}{cases} ELSE string({x}) END"


def filled(x: str, default) -> str:
    return f"coalesce({x}, {literal(default)})"


def one_unless(condition: str) -> str:
    """0 where the condition holds, 1 where it fails or is unknown."""
    return f"CASE WHEN {condition} THEN 0 ELSE 1 END"


def capped_at_one(x: str) -> str:
    """Missing counts as 1."""
    return f"CASE WHEN {x} < 1 THEN {x} ELSE 1.0D END"


def positive_part(x: str) -> str:
    """Missing counts as 0."""
    return f"CASE WHEN {x} > 0 THEN double({x}) ELSE 0.0D END"


# --- arithmetic -----------------------------------------------------------


def ratio(a: str, b: str) -> str:
    """IEEE division: x/0 is a signed infinity, 0/0 and inf/inf are NULL."""
    at_zero = f"CASE WHEN {a} > 0 THEN {INFINITY} WHEN {a} < 0 THEN {MINUS_INFINITY} END"
    divided = nan_to_null(f"try_divide(double({a}), double({b}))")
    return f"CASE WHEN {b} = 0 THEN {at_zero} ELSE {divided} END"


def shifted_ratio(a: str, b: str, shift: float) -> str:
    return ratio(a, f"(double({b}) + {float(shift)!r}D)")


def null_strict_sum(values: Sequence[str]) -> str:
    """Sum over columns; one missing value makes the sum missing."""
    return "(" + " + ".join(values) + ")"


def decay(base: float, exponent: str) -> str:
    return f"power({float(base)!r}D, double({exponent}))"


def _present(values: Sequence[str]) -> str:
    return "(" + " + ".join(f"int({v} IS NOT NULL)" for v in values) + ")"


def row_mean(values: Sequence[str]) -> str:
    """Mean over the columns that are present in the row."""
    total = " + ".join(f"coalesce(double({v}), 0.0D)" for v in values)
    return f"CASE WHEN {_present(values)} > 0 THEN ({total}) / {_present(values)} END"


def row_std(values: Sequence[str]) -> str:
    """Sample standard deviation over the present columns; needs two of them."""
    centre = row_mean(values)
    squares = " + ".join(f"coalesce(power(double({v}) - {centre}, 2), 0.0D)" for v in values)
    return f"CASE WHEN {_present(values)} > 1 THEN sqrt(({squares}) / ({_present(values)} - 1)) END"


def row_max(first: str, second: str) -> str:
    """Larger of two columns; a missing first one gives missing, a missing second one is skipped."""
    return f"CASE WHEN {first} IS NOT NULL THEN greatest({first}, {second}) END"
