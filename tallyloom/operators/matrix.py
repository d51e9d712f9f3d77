"""Pairwise-complete correlations of many columns in one scan.

Every task adds up the moments of all pairs of its rows as matrix products, cut into blocks of columns; blocks are dealt
among tasks, where their sums meet and become correlations. Values are taken less a pivot near them, so that sums of
products keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import name

#: Columns of a block, and rows that give the pivots.
BLOCK, PIVOT_ROWS = 64, 1_000
_MOMENTS = ("n", "x", "y", "xx", "yy", "xy")


def _moment_batches(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each pair of blocks: of both columns present, the count, sums, squares and products."""
    width = len(pivots)
    sums = np.zeros((6, width, width))
    for batch in batches:
        values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - pivots
        here = np.isfinite(values)
        x, m = np.where(here, values, 0.0), here.astype(float)
        square = x * x
        for k, (left, right) in enumerate(((m, m), (x, m), (m, x), (square, m), (m, square), (x, x))):
            sums[k] += left.T @ right
    rows = []
    for a in range(0, width, BLOCK):
        for b in range(a, width, BLOCK):
            rows.append((a // BLOCK, b // BLOCK, np.ascontiguousarray(sums[:, a : a + BLOCK, b : b + BLOCK]).astype("<f8").tobytes()))
    kinds = (pa.int32(), pa.int32(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["a", "b", "sums"])


def correlations(sums: np.ndarray) -> np.ndarray:
    """Pearson's r from the six moments; not a number for fewer than two pairs or a constant column."""
    n, x, y, xx, yy, xy = sums
    with np.errstate(invalid="ignore", divide="ignore"):
        spread_x, spread_y = n * xx - x * x, n * yy - y * y
        # what rounding alone can leave of a constant column
        flat = (spread_x <= 1e-12 * n * xx) | (spread_y <= 1e-12 * n * yy) | (n < 2)
        return np.where(flat, np.nan, (n * xy - x * y) / np.sqrt(spread_x * spread_y))


def _correlation_batches(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            a, b, raw = (c[i].as_py() for c in batch.columns)
            part = np.frombuffer(raw, "<f8")
            held[a, b] = held[a, b] + part if (a, b) in held else part
    for (a, b), flat in sorted(held.items()):
        names_a, names_b = columns[a * BLOCK : (a + 1) * BLOCK], columns[b * BLOCK : (b + 1) * BLOCK]
        sums = flat.reshape(6, len(names_a), len(names_b))
        r = correlations(sums)
        pairs = [(i, j) for i in range(len(names_a)) for j in range(len(names_b)) if a < b or i < j]
        if pairs:
            i, j = (np.array(p) for p in zip(*pairs, strict=True))
            arrays = [pa.array([names_a[k] for k in i]), pa.array([names_b[k] for k in j]), pa.array(sums[0][i, j].astype(np.int64)), pa.array(r[i, j], from_pandas=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["left", "right", "pairs", "corr"])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """left, right, pairs, corr for every two of ``columns``, each pair once in their order.

    A pair uses the rows in which both are present and finite; ``corr`` is NULL for fewer than two such rows or a constant column.
    A table without partitions gives no rows.
    """
    columns = list(columns)
    numbers = df.selectExpr(*[f"double({name(c)}) AS c{i}" for i, c in enumerate(columns)])
    finite = [F.avg(F.expr(f"IF(isnan(c{i}) OR abs(c{i}) = double('infinity'), NULL, c{i})")) for i in range(len(columns))]
    first = numbers.limit(PIVOT_ROWS).agg(*finite).first()
    moments = numbers.mapInArrow(partial(_moment_batches, pivots=np.array([v or 0.0 for v in first])), "a int, b int, sums binary")
    met = moments.repartition("a", "b")
    return met.mapInArrow(partial(_correlation_batches, columns=columns), "left string, right string, pairs long, corr double")
