"""Small helpers that the operators share: a written cut, text batches, 64-bit mixing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; an own one only on a local master that names none (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="tallyloom-llm-")
    return _own_folder[app]


def written(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: lineage is cut, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows and bytes that become Python objects at once; a single row may be longer.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1_000, 4 << 20


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded rows and bytes; memory that Arrow keeps for later goes back at the end."""
    for batch in batches:
        start, rows = 0, ROWS_AT_ONCE
        while start < batch.num_rows:
            part = batch.slice(start, rows)
            while part.num_rows > 1 and part.nbytes > BYTES_AT_ONCE:
                part = part.slice(0, part.num_rows // 2)
            yield part
            start += part.num_rows
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, as a worker is kept for later tasks; where the C library has no such call, Arrow's part only."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands a Python step no more at once than ``parts`` takes of it; lower limits stay.

    A batch of Spark's own limits holds most of a file split, in the JVM and in the worker, and both keep much of such memory.
    """
    for name, most in (("Records", ROWS_AT_ONCE), ("Bytes", BYTES_AT_ONCE)):
        key = f"spark.sql.execution.arrow.max{name}PerBatch"
        now = int((spark.conf.get(key, None) or "0").rstrip("b"))
        if not 0 < now <= most:
            spark.conf.set(key, most)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Applies ``function`` to each Arrow batch; it yields dicts of columns, which become batches of ``schema``."""
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [_ARROW[part.split(" ", 1)[1]] for part in schema.split(", ")]
    out = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            for columns in function(batch):
                arrays = [pa.array(columns[name], type=kind) for name, kind in zip(names, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.mapInArrow(run, schema)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}
_SPARK = {"double": DoubleType(), "string": StringType(), "boolean": BooleanType()}


def free_names(columns: Sequence[str], names: Sequence[str]) -> dict[str, str]:
    """``names``, with underscores where ``columns`` has one already (case ignored, as Spark does)."""
    taken, out = {c.lower() for c in columns}, {}
    for name in names:
        out[name] = name
        while out[name].lower() in taken:
            out[name] += "_"
        taken.add(out[name].lower())
    return out


def add_columns(
    docs: DataFrame, keep: Sequence[str], text: str, function: Callable[..., Iterator[dict]], schema: str
) -> DataFrame:
    """The columns ``keep`` of ``docs``, unchanged, and those of ``schema`` that ``function`` makes of each batch.

    The function gets the batch and, as ``text``, the place of the text column: its place in ``keep`` if it is a string and
    kept, else the last. Columns of ``docs`` that are not in ``keep`` are not read. A new column that clashes with one of
    ``keep`` is named by ``free_names``.
    """
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [_ARROW[part.split(" ", 1)[1]] for part in schema.split(", ")]
    width = len(keep)
    once = text in keep and kept.schema[text].dataType == StringType()  # a kept text need not travel twice
    place = list(keep).index(text) if once else width
    called = free_names(keep, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            for columns in function(batch, text=place):
                made = [pa.array(columns[name], type=kind) for name, kind in zip(names, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], *made], names=[*batch.schema.names[:width], *called.values()])

    apart = F.col(f"`{text}`").cast("string").alias(free_names(keep, ["__text"])["__text"])
    source = kept if once else docs.select(*[F.col(f"`{c}`") for c in keep], apart)
    fields = [StructField(called[part.split()[0]], _SPARK[part.split(" ", 1)[1]]) for part in schema.split(", ")]
    return source.mapInArrow(run, StructType([*kept.schema.fields, *fields]))


#: Bits of the map in ``perhaps_among``, of 4 KB in each of its rows: 16 MB at most.
MAP_BITS = 1 << 27


def perhaps_among(table: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``column`` may be in ``ids`` (one column of the same name): all that are, few others.

    A bit map of hashes of the ids is broadcast; its size has a bound that does not depend on their number.
    """
    placed, found = _placed(table, column, ids, "inner")
    return placed.where(found).select(*[F.col(f"`{c}`") for c in table.columns])


def split_among(table: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``perhaps_among`` and all others; ``column`` is never null."""
    placed, found = _placed(table, column, ids, "left")
    columns = [F.col(f"`{c}`") for c in table.columns]
    return placed.where(found).select(*columns), placed.where(f"not coalesce({found}, false)").select(*columns)


def _placed(table: DataFrame, column: str, ids: DataFrame, how: str) -> tuple[DataFrame, str]:
    slot = f"pmod(xxhash64(`{column}`), {MAP_BITS}) + 1"
    maps = ids.selectExpr(f"bitmap_bucket_number({slot}) as __bucket", f"bitmap_bit_position({slot}) as __bit")
    maps = maps.groupBy("__bucket").agg(F.expr("bitmap_construct_agg(__bit)").alias("__map"))
    placed = table.withColumn("__slot", F.expr(slot)).join(F.broadcast(maps), F.expr("bitmap_bucket_number(__slot) = __bucket"), how)
    byte = "cast(conv(hex(substring(__map, bitmap_bit_position(__slot) div 8 + 1, 1)), 16, 10) as int)"
    return placed, f"shiftright({byte}, cast(bitmap_bit_position(__slot) % 8 as int)) % 2 = 1"


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def random_words(count: int, seed: int) -> np.ndarray:
    """``count`` unsigned 64-bit numbers that depend on ``seed`` alone."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def held_out_sql(column: str, modulus: int, remainder: int) -> str:
    """SQL text: does this document belong to the held-out part? A null id does not."""
    return f"coalesce(crc32(cast(cast({column} as string) as binary)) % {modulus} = {remainder}, false)"
