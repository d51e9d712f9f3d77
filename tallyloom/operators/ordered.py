"""Order-dependent operators that never sort one unbounded group in one task.

Equal values are counted together first; the distinct values are then cut into
value ranges of about equal size, so that ranks are "rows in earlier ranges"
(a small table) plus "rows earlier in the same range" (many parallel windows).
The cut points only steer the balance: results are exact for any cut points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.aggregates import latest_present
from tallyloom.functions.columns import quoted
from tallyloom.functions.scalars import called
from tallyloom.functions.scalars import name as col_name
from tallyloom.operators.staging import stage

_V, _C, _B, _LO = "__value", "__count", "__range", "__before"


def with_range(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """Add the index of the value range a numeric column falls in.

    There are as many ranges as the session has shuffle partitions, unless their number is given.
    """
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if ranges < 2:
        return df.withColumn(_B, F.lit(0.0))
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(df.stat.approxQuantile(column, probabilities, 0.5 / ranges)))
    splits = [float("-inf"), *[c for c in cuts if abs(c) != float("inf")], float("inf")]
    if len(splits) < 3:
        return df.withColumn(_B, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=column, outputCol=_B).transform(df)


def with_prefix_sum(
    df: DataFrame, order: str, amount: str, name: str, by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Add the sum of ``amount`` over all rows of smaller ``order``.

    ``order`` is unique within ``by``; ``by`` has few groups (folds, classes) or none.
    ``df`` is read twice, so it should be a written table.
    """
    by = list(by)
    cut = with_range(df.withColumn(_V, quoted(order).cast("double")), _V, ranges).drop(_V)
    inside = Window.partitionBy(*by, _B).orderBy(quoted(order)).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*by).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    # at most `ranges` rows per group
    starts = cut.groupBy(*by, _B).agg(F.sum(amount).alias(_C))
    starts = starts.select(*by, _B, F.coalesce(F.sum(_C).over(across), F.lit(0)).alias(_LO))
    return (
        cut.join(starts, [*by, _B])
        .withColumn(name, F.col(_LO) + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop(_LO, _B)
    )


def quantiles(
    df: DataFrame,
    column: str,
    probabilities: dict[str, float],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles of one column per group.

    ``probabilities`` maps output names to probabilities. Missing values are
    skipped; groups without any value do not appear.
    """
    by = list(by)
    # read three times below (cut points, range totals, values): written once
    counts = stage(
        df.filter(quoted(column).isNotNull())
        .groupBy(*by, quoted(column).cast("double").alias(_V))
        .agg(F.count(F.lit(1)).alias(_C))
    )
    cut = with_range(counts, _V, ranges)
    per_range = cut.groupBy(*by, _B).agg(F.sum(_C).alias(_C))
    group = Window.partitionBy(*by)
    running = group.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    places = {n: (F.col("__n") - 1).cast("double") * F.lit(float(p)) for n, p in probabilities.items()}
    ranks = F.array(*[f(x).cast("long") for x in places.values() for f in (F.floor, F.ceil)])
    touched = (
        per_range.withColumn(_LO, F.coalesce(F.sum(_C).over(running), F.lit(0)))
        .withColumn("__n", F.sum(_C).over(group))
        .withColumn("__ranks", ranks)
        .filter(
            F.exists("__ranks", lambda r: (r >= F.col(_LO)) & (r < F.col(_LO) + F.col(_C)))
        )
        .drop(_C)
    )
    inside = Window.partitionBy(*by, _B).orderBy(_V).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.join(touched, [*by, _B]).withColumn(
        _LO, F.col(_LO) + F.coalesce(F.sum(_C).over(inside), F.lit(0))
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col(_LO)) & (rank < F.col(_LO) + F.col(_C)), F.col(_V)))

    ends = []
    for i, name in enumerate(probabilities):
        ends += [
            value_at(F.col("__ranks")[2 * i]).alias(f"__lo_{name}"),
            value_at(F.col("__ranks")[2 * i + 1]).alias(f"__hi_{name}"),
        ]
    found = placed.groupBy(*by).agg(F.max("__n").alias("__n"), *ends)
    out = []
    for name, place in places.items():
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        part = place - F.floor(place)
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * part).alias(name))
    return found.select(*by, *out)


def median(df: DataFrame, column: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return quantiles(df, column, {name: 0.5}, by)


def _gap(
    df: DataFrame, key: str, order: str, row_id: str, name: str, descending: bool, among: Column | None
) -> DataFrame:
    rows = df if among is None else df.filter(among)
    # One row per distinct (key, offset): as many as there are days in the calendar,
    # however many rows the key owns.
    points = (
        rows.filter(quoted(key).isNotNull() & quoted(order).isNotNull())
        .groupBy(key, order)
        .agg(F.min(row_id).alias(row_id))
    )
    direction = quoted(order).desc() if descending else quoted(order).asc()
    before = F.lag(quoted(order)).over(Window.partitionBy(key).orderBy(direction))
    gap = (before - quoted(order)) if descending else (quoted(order) - before)
    gaps = points.withColumn(name, gap.cast("long"))
    # joined on the unique row id, so no key can crowd a task; only the first row of
    # equal offsets carries the gap, its ties are 0 apart
    joined = df.join(gaps, [key, order, row_id], "left")
    known = quoted(key).isNotNull()
    counted = known if among is None else known & F.coalesce(among, F.lit(False))
    return joined.withColumn(name, F.when(counted, F.coalesce(F.col(name), F.lit(0))))


def gap_from_later(df: DataFrame, key: str, order: str, row_id: str, name: str) -> DataFrame:
    """Distance to the previous row when a key's rows run from latest to earliest; first is 0.

    ``order`` is a whole day or month offset, ``row_id`` is unique; ties run by id.
    """
    return _gap(df, key, order, row_id, name, True, None)


def gap_from_earlier(
    df: DataFrame, key: str, order: str, row_id: str, name: str, among: Column | None = None
) -> DataFrame:
    """Distance to the previous row when a key's rows run from earliest to latest; first is 0.

    With ``among`` only those rows take part and the others get NULL.
    """
    return _gap(df, key, order, row_id, name, False, among)


def latest_state(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Per key, each column's latest present value (not the latest row)."""
    return df.groupBy(*keys).agg(
        *[F.expr(called(latest_present(col_name(c), col_name(order)), c)) for c in columns]
    )
