"""Schema-level operators: strict drops, types, alignment, unions, samples."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.columns import quoted
from tallyloom.functions.scalars import name

# modulus and multiplier of the minimal standard generator
_MODULUS, _MULTIPLIER = 2147483647, 48271


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop by name. Repeated names are fine, an unknown name is an error."""
    unknown = sorted(set(names) - set(df.columns))
    if unknown:
        raise ValueError(f"cannot drop columns that do not exist: {unknown}")
    return df.drop(*names)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def type_histogram(df: DataFrame) -> dict[str, int]:
    return dict(Counter(f.dataType.simpleString() for f in df.schema.fields))


def align_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables cut to the columns they share, in the order of the left one."""
    shared = [c for c in left.columns if c in set(right.columns)]
    return left.selectExpr(*map(name, shared)), right.selectExpr(*map(name, shared))


def append_unlabelled(labelled: DataFrame, unlabelled: DataFrame) -> DataFrame:
    """Stack two tables; columns only one of them has (the label) become NULL."""
    return labelled.unionByName(unlabelled, allowMissingColumns=True)


def split_by_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.filter(quoted(label).isNotNull()), df.filter(quoted(label).isNull())


def feature_columns(df: DataFrame, excluded: Collection[str]) -> list[str]:
    return [c for c in df.columns if c not in set(excluded)]


def scrambled(key: Column, seed: int) -> Column:
    """A number below 2^31 - 1 of an integer key; two rounds of a multiplicative hash."""
    x = F.pmod(key.cast("long"), F.lit(_MODULUS))
    for step in (1, 2):
        x = F.pmod(x * F.lit(_MULTIPLIER) + F.lit(seed * step), F.lit(_MODULUS))
        x = F.pmod(x * x, F.lit(_MODULUS))
    return x


def random_rows(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly ``n`` random rows (all of them if there are fewer), the same ones however the rows are partitioned.

    ``key`` is a unique integer.
    """
    return df.orderBy(scrambled(quoted(key), seed), quoted(key)).limit(n)


def first_rows(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The first ``n`` rows by key; ``None`` means the whole table."""
    return df if n is None else df.orderBy(quoted(key)).limit(n)
