"""Joins back onto detail rows, left and outer assembly, existence flags.

A key may own a large part of the detail. A plain shuffle would send all its rows
to one task, so every join back onto detail looks at the row counts first: rows of
the few keys above a share of all rows, and rows without a key, are dealt among
several tasks, and a hot key's row of the table is copied to each of them. The plan
is the same at all sizes; whether a table is broadcast is left to Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import quoted
from tallyloom.functions.scalars import name
from tallyloom.operators.aggregate import group_by_present, size_expr
from tallyloom.operators.staging import stage

# A key is hot above 1/HOT_PARTS of all rows: at most HOT_PARTS keys can be, which
# bounds what is broadcast whatever the size of the data.
HOT_PARTS = 20_000
_N, _COPIES, _PART = "__rows", "__copies", "__part"


def per_key(detail: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates plus the row count per key, staged for repeated use."""
    return stage(group_by_present(detail, *keys).agg(size_expr(_N), *aggregates))


def _hot(counts: DataFrame, keys: Sequence[str], hot_parts: int) -> DataFrame:
    """Keys above 1/hot_parts of all rows and among how many tasks each is dealt; their sum is at most hot_parts."""
    everything = counts.agg(F.sum(_N)).scalar()
    share = F.col(_N) * F.lit(hot_parts)
    copies = F.floor(share / everything).cast("int").alias(_COPIES)
    return counts.filter(share > everything).select(*[quoted(k) for k in keys], copies)


def _dealt_join(
    detail: DataFrame, table: DataFrame, hot: DataFrame, keys: Sequence[str], how: str, hot_parts: int
) -> DataFrame:
    """Join on keys of which ``hot`` are dealt; a row's task depends on its content alone, so a repeated task agrees."""
    keys = list(keys)
    hot = F.broadcast(hot)  # at most hot_parts rows
    missing = " OR ".join(f"{name(k)} IS NULL" for k in keys)
    parts = f"IF({missing}, {hot_parts}, coalesce({_COPIES}, 1))"
    place = f"pmod(xxhash64({', '.join(name(c) for c in detail.columns)}), {parts})"
    dealt = detail.join(hot, keys, "left").withColumn(_PART, F.expr(f"int({place})")).drop(_COPIES)
    copied = table.join(hot, keys, "left")
    copied = copied.withColumn(_PART, F.expr(f"explode(sequence(0, coalesce({_COPIES}, 1) - 1))")).drop(_COPIES)
    return dealt.join(copied, [*keys, _PART], how).drop(_PART)


def attach(
    detail: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    semi: bool = False,
    hot_parts: int = HOT_PARTS,
    wanted: Column | None = None,
) -> DataFrame:
    """Left join (or left-semi filter) of detail rows with a ``per_key`` table.

    ``wanted`` restricts which keys of the table match. Detail is read once.
    """
    matching = table.filter(wanted) if wanted is not None else table
    hot = _hot(table, keys, hot_parts)
    return _dealt_join(detail, matching.drop(_N), hot, keys, "left_semi" if semi else "left", hot_parts)


def merge_back(
    detail: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], **attach_options
) -> DataFrame:
    """Detail rows with their key's aggregates as new columns."""
    return attach(detail, per_key(detail, keys, aggregates), keys, **attach_options)


def keep_groups(
    detail: DataFrame, keys: Sequence[str], condition: Column, **attach_options
) -> DataFrame:
    """Rows of the groups whose aggregate ``condition`` is true."""
    table = per_key(detail, keys, [condition.alias("__keep")])
    return attach(detail, table, keys, semi=True, wanted=F.col("__keep"), **attach_options)


def lookup(
    detail: DataFrame, table: DataFrame, key: str, how: str = "inner", hot_parts: int = HOT_PARTS
) -> DataFrame:
    """Many-to-one join of detail rows with a table that is unique on the key.

    Detail is read twice: its key column is counted, then all of it is joined.
    """
    return _dealt_join(detail, table, _hot(per_key(detail, [key], []), [key], hot_parts), [key], how, hot_parts)


def left_assemble(base: DataFrame, key: str, families: Sequence[DataFrame]) -> DataFrame:
    """Base rows with every family's columns; families hold one row per key."""
    return reduce(lambda acc, family: acc.join(family, key, "left"), families, base)


def outer_assemble(key: str, families: Sequence[DataFrame]) -> DataFrame:
    """Full outer join on one coalesced key."""
    return reduce(lambda acc, family: acc.join(family, key, "full_outer"), families)


def exists_flag(df: DataFrame, key: str, marked: DataFrame, flag: str) -> DataFrame:
    """1 where the key occurs in ``marked``, else 0. ``df`` should be unique on the key."""
    flags = marked.select(key).distinct().withColumn(flag, F.lit(1))
    return df.join(flags, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))
