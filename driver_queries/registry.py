"""Registry of queries: a Spark function and, where SQL can say it, a DuckDB text."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.scalars import called, name

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Columns whose floating sums depend on row order, rounded."""
    return df.selectExpr(
        *[called(f"round({name(c)}, {digits[c]})", c) if c in digits else name(c) for c in df.columns]
    )


def rounded_sql(text: str, digits: Mapping[str, int]) -> str:
    if not digits:
        return text
    parts = ", ".join(f'round("{c}", {d}) AS "{c}"' for c, d in digits.items())
    return f"SELECT * REPLACE ({parts}) FROM ({text})"


def query(sql: str | None = None, digits: Mapping[str, int] | None = None):
    """Register the decorated function under its own name."""

    def register(function):
        key = function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = function(spark, folder)
            return rounded(out, digits) if digits else out

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = rounded_sql(sql, digits or {})
        return function

    return register
