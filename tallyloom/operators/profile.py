"""Data profiling: missingness, correlation with a label, class-wise summaries, densities.

Per-column statistics are aggregates of a single pass; the one result row is
unpivoted to one row per column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.aggregates import hits, mean, pearson, share
from tallyloom.functions.columns import quoted
from tallyloom.functions.scalars import called, literal, name, nan_to_null
from tallyloom.operators.aggregate import keyed, size_expr
from tallyloom.operators.joins import lookup
from tallyloom.operators.ordered import median, quantiles
from tallyloom.operators.schema import string_columns


COLUMNS_AT_ONCE = 40


def per_column(
    df: DataFrame, columns: Sequence[str], statistics: Mapping[str, Callable[[str], str]]
) -> DataFrame:
    """One row per column with ``{output: function of column text}`` aggregates."""
    cells = [
        "struct("
        + ", ".join([called(literal(c), "column"), *[called(f(name(c)), n) for n, f in statistics.items()]])
        + ")"
        for c in columns
    ]
    return df.agg(F.expr(f"array({', '.join(cells)}) AS __cells")).select(F.inline("__cells"))


def cells_of(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    """(column, value) rows, one per cell of the listed columns."""
    cells = [f"struct({literal(c)} AS column, {cast}({name(c)}) AS value)" for c in columns]
    return df.selectExpr(f"inline(array({', '.join(cells)}))")


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values, their number and percentage, worst first."""
    return (
        per_column(
            df,
            df.columns,
            {
                "missing_values": lambda c: f"count_if({c} IS NULL)",
                "total_rows": lambda c: "count(1)",
            },
        )
        .filter(F.col("missing_values") > 0)
        .select(
            "column",
            "missing_values",
            F.round(F.lit(100.0) * F.col("missing_values") / F.col("total_rows"), 1).alias("percent_missing"),
        )
        .orderBy(F.desc("percent_missing"), "column")
    )


def label_correlations(df: DataFrame, label: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of every column with the label, strongest first; undefined ones last.

    A wide table is handled some columns at a time, so that no aggregate outgrows
    generated code; it should be a written one, of which each part reads its own columns.
    """
    columns = list(columns or df.columns)
    parts = [
        per_column(df, columns[i : i + COLUMNS_AT_ONCE], {"corr": lambda c: pearson(c, name(label))})
        for i in range(0, len(columns), COLUMNS_AT_ONCE)
    ]
    return reduce(DataFrame.unionByName, parts).orderBy(F.abs("corr").desc_nulls_last(), "column")


def strongest(correlations: DataFrame, n: int = 15) -> DataFrame:
    return correlations.orderBy(F.abs("corr").desc_nulls_last(), "column").limit(n)


def extremes(correlations: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most negative and the ``n`` most positive correlations."""
    known = correlations.filter(F.col("corr").isNotNull())
    low = known.orderBy("corr", "column").limit(n).withColumn("side", F.lit("negative"))
    high = known.orderBy(F.desc("corr"), "column").limit(n).withColumn("side", F.lit("positive"))
    return low.unionByName(high)


def class_summary(df: DataFrame, column: str, label: str) -> DataFrame:
    """Exact median per label value and the correlation of the column with the label."""
    link = df.agg(F.expr(pearson(name(column), name(label)))).scalar()
    return median(keyed(df, label), column, [label]).withColumn("corr", link)


def scott_bandwidth(df: DataFrame, column: str, by: str) -> DataFrame:
    """Per class: sample standard deviation times n^(-1/5)."""
    x = f"double({name(column)})"
    spread = nan_to_null(f"stddev_samp({x})")
    return df.groupBy(by).agg(F.expr(f"{spread} * power(double(count({x})), -0.2D) AS bandwidth"))


def class_density(
    df: DataFrame,
    column: str,
    label: str,
    points: Sequence[float],
    bandwidth: float | None = None,
) -> DataFrame:
    """Gaussian kernel density of a column per label value at given points.

    Each grid point is one partial aggregate, so no row is multiplied by the grid.
    Without a bandwidth Scott's rule is applied per class.
    """
    known = keyed(df, column, label)
    if bandwidth is None:
        known = lookup(known.select(label, column), scott_bandwidth(known, column, label), label)
        width = "bandwidth"
    else:
        width = literal(float(bandwidth))
    cells = []
    for point in points:
        z = f"(({literal(float(point))} - double({name(column)})) / {width})"
        kernel = f"exp({z} * {z} / -2.0D) / ({width} * sqrt(2.0D * pi()))"
        cells.append(f"struct({literal(float(point))} AS point, avg({kernel}) AS density)")
    return (
        known.groupBy(label)
        .agg(F.expr(f"array({', '.join(cells)}) AS __cells"))
        .select(label, F.inline("__cells"))
    )


def class_density_grid(
    df: DataFrame, column: str, label: str, low: float, high: float, points: int, bandwidth: float, fine: int = 8, reach: float = 8.0
) -> DataFrame:
    """Gaussian kernel density per label value at ``points`` places from ``low`` to ``high``, for grids of any size.

    A value's weight goes to the two bins beside it (``fine`` bins between two points), so a row costs two sums and not one
    for each point; the bins' sums, whose number depends on the grid alone, are then folded with the kernel, up to ``reach``
    bandwidths off. The density is off by (bin width / bandwidth)^2 / 8 of the kernel's height at most. Values outside the
    grid count too, in bins of their own.
    """
    step = (high - low) / (points - 1)
    bin_width = step / fine
    at = f"((double({name(column)}) - {literal(float(low))}) / {literal(bin_width)})"
    near = int(reach * bandwidth / bin_width) + 1  # bins farther off the grid than this reach no point
    last = (points - 1) * fine
    known = keyed(df, column, label).select(label, F.expr(f"{at} AS __at"))
    total = known.groupBy(label).agg(size_expr("__total"))
    inside = known.where(f"__at BETWEEN {-near} AND {last + near}").select(label, F.expr("floor(__at) AS __bin"), F.expr("__at - floor(__at) AS __share"))
    cells = inside.select(label, F.inline(F.expr("array(struct(__bin, 1 - __share AS w), struct(__bin + 1 AS __bin, __share AS w))")))
    bins = cells.groupBy(label, "__bin").agg(F.sum("w").alias("w"))
    first, stop = f"greatest(0, ceil((__bin - {near}) / {fine}))", f"least({points - 1}, floor((__bin + {near}) / {fine}))"
    met = bins.where(f"{first} <= {stop}").select(label, "__bin", "w", F.explode(F.expr(f"sequence(cast({first} AS int), cast({stop} AS int))")).alias("__point"))
    z = f"((__point * {fine} - __bin) * {literal(bin_width / bandwidth)})"
    summed = met.groupBy(label, "__point").agg(F.expr(f"sum(w * exp({z} * {z} / -2.0D)) AS __sum"))
    grid = total.withColumn("__point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    density = f"coalesce(__sum, 0D) / (__total * {literal(float(bandwidth))} * sqrt(2.0D * pi())) AS density"
    return grid.join(summed, [label, "__point"], "left").selectExpr(name(label), f"{literal(float(low))} + __point * {literal(step)} AS point", density)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        keyed(df, column)
        .groupBy(column)
        .agg(size_expr("n"))
        .orderBy(F.desc("n"), column)
    )


def class_shares(df: DataFrame, label: str, tests: Mapping[str, str]) -> DataFrame:
    """Per label value: how many rows pass each test and what share of the class that is."""
    out: list[Column] = [size_expr("n")]
    for alias, test in tests.items():
        out += [F.expr(called(hits(test), f"{alias}_n")), F.expr(called(share(test), f"{alias}_share"))]
    return df.groupBy(label).agg(*out)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct present values per string column.

    Values are grouped as (column, value) cells first: repeats vanish map-side and
    no column's values meet in one task.
    """
    columns = list(columns or string_columns(df))
    # missing cells are kept until after the count so that all-missing columns report 0
    return (
        cells_of(df, columns, "string")
        .distinct()
        .groupBy("column")
        .agg(F.count("value").alias("distinct_values"))
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles (exact) and max per numeric column."""
    basics = per_column(
        df,
        columns,
        {
            "count": lambda c: f"count({c})",
            "mean": mean,
            "std": lambda c: nan_to_null(f"stddev_samp(double({c}))"),
            "min": lambda c: f"min(double({c}))",
            "max": lambda c: f"max(double({c}))",
        },
    )
    cells = cells_of(df, columns, "double")
    quarters = quantiles(cells, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"])
    return basics.join(quarters, "column", "left")

