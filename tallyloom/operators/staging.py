"""Cutting a plan at a written table.

An aggregate that is read more than once (global statistics and then the rows,
hot-key detection and then the join) would be recomputed from the detail scan
for each use. Writing it once as Parquet gives later reads column pruning, exact
sizes for join planning and a result that outlives lost executors.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}
_open_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder the cluster names for cut lineage; a temporary one only on a local master that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="tallyloom-")
    return _fallback[app]


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tallyloom/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` to the shared folder, with the writer's ``options``, and return the table read back."""
    spark = df.sparkSession
    path = f"{_application_folder(spark)}/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    if _open_scopes:
        _open_scopes[-1].append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end; results must have been collected or written by then."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            _delete(spark, path)


@contextmanager
def _set_inside(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def large_rows(spark: SparkSession, rows: int = 8):
    """Scans and Python workers take few rows at once inside, for tables whose rows are megabytes."""
    return _set_inside(spark, {"spark.sql.parquet.columnarReaderBatchSize": rows, "spark.sql.execution.arrow.maxRecordsPerBatch": rows})


def wide_aggregates(spark: SparkSession):
    """For jobs inside that work out many columns a row.

    The JVM never compiles a method of more than 8,000 bytes, which the generated code of a wide aggregate exceeds; below that
    limit it is made of smaller ones. A file of few megabytes, but many rows, is read by more than one or two tasks.
    """
    return _set_inside(spark, {"spark.sql.codegen.hugeMethodLimit": 8_000, "spark.sql.files.openCostInBytes": 256 << 10})


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(table: DataFrame) -> None:
    """Remove the files of a staged table; nothing may read it afterwards."""
    _delete(table.sparkSession, table.staged_at)


def remove_written(spark: SparkSession) -> None:
    """Remove all that this application staged; call it when its results are written elsewhere."""
    _delete(spark, _application_folder(spark))
