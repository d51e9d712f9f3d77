"""Scans (CSV, Parquet), the feature-table cache, and the result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.functions.columns import quoted
from tallyloom.functions.scalars import NAN, called, name
from tallyloom.operators.schema import first_rows
from tallyloom.sources.schemas import SCAN_KEYS, TABLES

_FLOATING = (T.DoubleType, T.FloatType)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column; other columns pass through unchanged."""
    return df.selectExpr(
        *[
            called(f"nullif({name(f.name)}, {NAN})", f.name)
            if isinstance(f.dataType, _FLOATING)
            else name(f.name)
            for f in df.schema.fields
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order and type; absent ones are NULL."""
    have = set(df.columns)
    return without_nan(
        df.selectExpr(
            *[
                called(
                    f"cast({name(f.name) if f.name in have else 'NULL'} AS {f.dataType.simpleString()})",
                    f.name,
                )
                for f in schema.fields
            ]
        )
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, columns in any order.

    Only the header line is read to order the declared types; there is no inference
    pass. Columns that are not declared stay text.
    """
    header = spark.read.option("header", True).csv(path).columns
    declared = {f.name: f.dataType for f in schema.fields}
    ordered = T.StructType([T.StructField(c, declared.get(c, T.StringType())) for c in header])
    return without_nan(spark.read.schema(ordered).option("header", True).csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return without_nan(spark.read.parquet(path))


def read_table(
    spark: SparkSession, folder: str, table: str, rows: int | None = None, format: str = "csv"
) -> DataFrame:
    """One of the input tables by file stem, optionally only its first rows by key."""
    path = f"{folder.rstrip('/')}/{table}.{format}"
    if format == "csv":
        df = read_csv(spark, path, TABLES[table])
    elif format == "parquet":
        df = read_parquet(spark, path)
    else:
        raise ValueError(f"unknown table format: {format}")
    # the external-loan tables are always read whole, also in a limited run
    return df if table in ("bureau", "bureau_balance") else first_rows(df, SCAN_KEYS[table], rows)


def read_tables(
    spark: SparkSession, folder: str, rows: int | None = None, format: str = "csv"
) -> dict[str, DataFrame]:
    return {t: read_table(spark, folder, t, rows, format) for t in TABLES}


def write_cached(df: DataFrame, folder: str, label: str) -> DataFrame:
    """Write a feature table under a name and return it read back."""
    path = f"{folder.rstrip('/')}/{label}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_cached(spark: SparkSession, folder: str, label: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{label}")


def write_bucketed(df: DataFrame, label: str, key: str = "SK_ID_CURR", buckets: int = 64) -> DataFrame:
    """Keep a feature table in the warehouse, dealt and sorted by its key: joins of such tables on the key move no row."""
    dealt = df.repartition(buckets, quoted(key))  # one file for each bucket
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(label)
    return df.sparkSession.table(label)


def drop_bucketed(spark: SparkSession, *labels: str) -> None:
    for label in labels:
        spark.sql(f"DROP TABLE IF EXISTS {name(label)}")


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_predictions(df: DataFrame, path: str, key: str = "SK_ID_CURR", score: str = "TARGET") -> None:
    _write_csv(df.selectExpr(name(key), name(score)), path)


def write_importances(importances: DataFrame, top: DataFrame, all_path: str, top_path: str) -> None:
    """All feature x fold rows, and the rows of the leading features only."""
    for table, path in ((importances, all_path), (top, top_path)):
        _write_csv(table.select("feature", "importance", "fold"), path)
