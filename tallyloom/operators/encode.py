"""Category encodings with an explicit vocabulary and an explicit order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import quoted
from tallyloom.functions.scalars import called, literal
from tallyloom.functions.scalars import name as col_name
from tallyloom.operators.joins import _N, attach, lookup
from tallyloom.operators.ordered import with_prefix_sum
from tallyloom.operators.schema import string_columns
from tallyloom.operators.staging import stage

# One output column per category: a wider vocabulary than this is not a category
# column and is refused, never cut.
MAX_CATEGORIES = 5_000


def discover_vocabulary(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct values per column, from one scan; meant to be run once and pinned.

    A column of more than ``limit`` values is refused.
    """
    columns = list(columns)
    if not columns:
        return {}
    cells = ", ".join(f"struct({literal(c)} AS c, {col_name(c)} AS v)" for c in columns)
    values = stage(df.selectExpr(f"inline(array({cells}))").filter("v IS NOT NULL").distinct())
    wide = [r.c for r in values.groupBy("c").count().filter(F.col("count") > limit).collect()]
    if wide:
        raise ValueError(f"more than {limit} categories in {sorted(wide)}; declare a vocabulary")
    found = values.collect()
    return {c: sorted(r.v for r in found if r.c == c) for c in columns}


def one_hot(
    df: DataFrame,
    nan_as_category: bool = True,
    vocabulary: Mapping[str, Sequence[str]] | None = None,
    limit: int = MAX_CATEGORIES,
) -> tuple[DataFrame, list[str]]:
    """Replace every string column by ``COLUMN_value`` indicators.

    Returns the table and the new column names. With ``nan_as_category`` each
    column also gets ``COLUMN_nan``, whether or not values are missing.
    """
    encoded = string_columns(df)
    vocabulary = dict(vocabulary or {})
    vocabulary.update(discover_vocabulary(df, [c for c in encoded if c not in vocabulary], limit))
    new: dict[str, str] = {}
    for column in encoded:
        for value in vocabulary[column]:
            new[f"{column}_{value}"] = f"int({col_name(column)} <=> {literal(value)})"
        if nan_as_category:
            new[f"{column}_nan"] = f"int({col_name(column)} IS NULL)"
    kept = [col_name(c) for c in df.columns if c not in set(encoded)]
    return df.selectExpr(*kept, *[called(text, n) for n, text in new.items()]), list(new)


def factorize(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """Replace columns by codes 0, 1, ... in order of first appearance; missing is -1.

    ``order`` is a unique number per row. One pass finds the first appearance of every
    value of all columns; the codes are joined back column by column.
    """
    cells = ", ".join(
        f"struct({literal(c)} AS c, string({col_name(c)}) AS v, {col_name(order)} AS o)" for c in columns
    )
    first = stage(
        df.selectExpr(f"inline(array({cells}))")
        .filter("v IS NOT NULL")
        .groupBy("c", "v")
        .agg(F.count(F.lit(1)).alias(_N), F.min("o").alias("o"))
    )
    ranked = with_prefix_sum(first.withColumn("one", F.lit(1)), "o", "one", "code", ["c"])
    codes = stage(ranked.drop("one"))
    for column in columns:
        own = codes.filter(F.col("c") == column).selectExpr("v AS __v", _N, "int(code) AS __code")
        coded = attach(df.withColumn("__v", quoted(column).cast("string")), own, ["__v"])
        df = coded.selectExpr(
            *[
                called("coalesce(__code, -1)", c) if c == column else col_name(c)
                for c in df.columns
            ]
        )
    return df


def label_encode_binary(
    train: DataFrame, others: Sequence[DataFrame]
) -> tuple[DataFrame, list[DataFrame], list[str]]:
    """Replace string columns of at most two distinct values by their alphabetical index.

    The codes come from ``train``; a value in another table that ``train`` lacks
    raises, and so does a missing one if ``train`` has none. In ``train`` a missing
    value counts as a distinct one (and sorts last).
    """
    candidates = string_columns(train)
    if not candidates:
        return train, list(others), []
    ends = train.agg(
        *[F.min(quoted(c)).alias(f"lo_{i}") for i, c in enumerate(candidates)],
        *[F.max(quoted(c)).alias(f"hi_{i}") for i, c in enumerate(candidates)],
        *[F.count_if(quoted(c).isNull()).alias(f"no_{i}") for i, c in enumerate(candidates)],
    ).first()
    narrow = {}
    for i, c in enumerate(candidates):
        values = [v for v in dict.fromkeys([ends[f"lo_{i}"], ends[f"hi_{i}"]]) if v is not None]
        if len(values) + (ends[f"no_{i}"] > 0) <= 2:
            narrow[c] = values
    if not narrow:
        return train, list(others), []
    # a column is binary if nothing lies strictly between its ends
    between = train.agg(
        *[F.count_if(~quoted(c).isin(*v)).alias(f"n_{i}") if v else F.lit(0).alias(f"n_{i}")
          for i, (c, v) in enumerate(narrow.items())]
    ).first()
    chosen = {c: v for i, (c, v) in enumerate(narrow.items()) if between[f"n_{i}"] == 0}
    with_missing = {c for i, c in enumerate(candidates) if ends[f"no_{i}"] > 0}

    def encode(df: DataFrame) -> DataFrame:
        codes = {}
        for c, values in chosen.items():
            missing = F.lit(len(values)) if c in with_missing else F.raise_error(F.lit(f"missing label in {c}")).cast("int")
            chain = F.when(quoted(c).isNull(), missing)
            for code, value in enumerate(values):
                chain = chain.when(quoted(c) == value, F.lit(code))
            codes[c] = chain.otherwise(
                F.raise_error(F.concat(F.lit(f"unseen label in {c}: "), quoted(c))).cast("int")
            )
        return df.withColumns({c: e for c, e in codes.items() if c in df.columns})

    return encode(train), [encode(o) for o in others], list(chosen)


def value_index(df: DataFrame, column: str) -> DataFrame:
    """value, position: each distinct present value with its rank from 0, for any number of values.

    Values are sorted by ranges; a range's first rank is the number of values in earlier ranges, one row for each range.
    """
    values = df.select(quoted(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    ranged = stage(values.repartitionByRange("value").withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").count().select("__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy("value")) - 1
    placed = ranged.withColumn("__inside", inside).join(F.broadcast(starts), "__range")  # as many rows as ranges
    return placed.select("value", (F.col("__first") + F.col("__inside")).alias("position"))


def sparse_indicators(df: DataFrame, columns: Sequence[str], name: str = "indicators", nan_as_category: bool = True) -> tuple[DataFrame, int]:
    """Add an array with the positions of the row's indicators, and return how many indicators there are in all.

    The wide counterpart of ``one_hot``: a column may have any number of values, which are indexed by a distributed sort
    and joined back with hot values dealt among tasks. A column's indicators follow those of the columns before it, in
    order of value; with ``nan_as_category`` its last one stands for a missing value, else a missing value has none.
    """
    width, parts = 0, []
    for number, column in enumerate(columns):
        key = f"__value{number}"
        index = stage(value_index(df, column))
        size = index.count()
        df = df.withColumn(key, quoted(column).cast("string"))
        df = lookup(df, index.select(F.col("value").alias(key), (F.col("position") + width).alias(f"__place{number}")), key, "left").drop(key)
        missing = str(width + size) if nan_as_category else "CAST(NULL AS BIGINT)"
        parts.append(f"coalesce(__place{number}, {missing})")
        width += size + (1 if nan_as_category else 0)
    out = df.withColumn(name, F.expr(f"array_compact(array({', '.join(parts)}))"))
    return out.drop(*[f"__place{i}" for i in range(len(parts))]), width
