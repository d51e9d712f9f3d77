"""Correlation matrices, wide vocabularies, large density grids and bucketed families."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import matrix, profile
from tallyloom.operators.encode import sparse_indicators, value_index
from tallyloom.operators.joins import left_assemble
from tallyloom.sources import tables

RANDOM = random.Random(4)


def test_matrix_equals_pandas(spark, monkeypatch):
    rows = []
    for _ in range(300):
        x = RANDOM.gauss(1e9, 2)
        rows.append((x, None if RANDOM.random() < 0.3 else x * 2 + RANDOM.gauss(0, 1), RANDOM.choice([None, 1.0, 2.0, 3.0]), 7.5, None, math.nan if RANDOM.random() < 0.2 else RANDOM.random()))
    names = ["a", "b b", "c", "constant", "empty", "f"]
    schema = ", ".join(f"`{n}` double" for n in names)
    df = spark.createDataFrame(rows, schema).repartition(5)
    want = pd.DataFrame(rows, columns=names).astype(float)
    monkeypatch.setattr(matrix, "BLOCK", 2)  # seen by the driver only; the tasks use whole blocks
    got = {(r.left, r.right): r for r in matrix.correlation_matrix(df, names).collect()}
    assert len(got) == 15
    for (a, b), r in got.items():
        both = want[[a, b]].dropna()
        assert r.pairs == len(both)
        expected = both[a].corr(both[b]) if len(both) > 1 and both[a].nunique() > 1 and both[b].nunique() > 1 else None
        assert r.corr == (None if expected is None else pytest.approx(expected, abs=1e-6)), (a, b)
    assert {r.corr for r in matrix.correlation_matrix(df.limit(0), names).collect()} <= {None}


@pytest.mark.parametrize("block", [1, 2, 4, 64])
def test_blocks_of_columns_give_the_same_matrix(monkeypatch, block):
    import pyarrow as pa

    monkeypatch.setattr(matrix, "BLOCK", block)
    values = np.random.default_rng(1).normal(size=(50, 5))
    names = list("abcde")
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in part.T], names=names) for part in (values[:20], values[20:])]
    moments = [b for part in batches for b in matrix._moment_batches(iter([part]), np.zeros(5))]
    rows = [r for b in matrix._correlation_batches(iter(moments), names) for r in b.to_pylist()]
    want = np.corrcoef(values.T)
    assert len(rows) == 10
    for r in rows:
        assert r["corr"] == pytest.approx(want[names.index(r["left"]), names.index(r["right"])])


def test_matrix_is_one_scan(spark, tmp_path):
    spark.range(2000).selectExpr("double(id) as a", "double(id * id) as b").write.parquet(str(tmp_path / "t"))
    plan = matrix.correlation_matrix(spark.read.parquet(str(tmp_path / "t")), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_any_number_of_values_is_indexed(spark):
    rows = [(i, RANDOM.choice([None, f"v{RANDOM.randrange(3000)}", "hot", ""]), f"u{i % 3}") for i in range(9000)]
    df = spark.createDataFrame(rows, "id long, v string, u string").repartition(6)
    order = sorted({v for _, v, _ in rows if v is not None})
    got = {r.value: r.position for r in value_index(df, "v").collect()}
    assert got == {v: i for i, v in enumerate(order)}
    placed, width = sparse_indicators(df, ["v", "u"])
    assert width == len(order) + 1 + 3 + 1
    for r in placed.collect():
        assert r.indicators == [len(order) if r.v is None else got[r.v], len(order) + 1 + int(r.u[1])]
    bare, width = sparse_indicators(df, ["v"], nan_as_category=False)
    assert width == len(order) and bare.where("v is null and size(indicators) = 0").count() == df.where("v is null").count()
    none, width = sparse_indicators(df.limit(0), ["v"])
    assert none.count() == 0 and width == 1


def test_large_grid_is_near_the_exact_density(spark):
    rows = [(RANDOM.randrange(2), RANDOM.gauss(50, 20)) for _ in range(400)] + [(1, None), (None, 3.0), (0, -1e6), (1, 1e6)]
    df = spark.createDataFrame(rows, "y int, x double")
    points = [100.0 * i / 999 for i in range(1000)]
    got = {(r.y, round(r.point, 6)): r.density for r in profile.class_density_grid(df, "x", "y", 0.0, 100.0, 1000, 4.0).collect()}
    assert len(got) == 2000
    for y in (0, 1):
        values = np.array([x for k, x in rows if k == y and x is not None])
        for point in points[::37]:
            exact = np.exp(-(((point - values) / 4.0) ** 2) / 2).mean() / (4.0 * math.sqrt(2 * math.pi))
            bound = (100 / 999 / 8 / 4.0) ** 2 / 8 / (4.0 * math.sqrt(2 * math.pi))
            assert abs(got[y, round(point, 6)] - exact) <= bound + 1e-12
    plan = profile.class_density_grid(df, "x", "y", 0.0, 100.0, 1000, 4.0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("exp(") <= 4  # the kernel is one expression, not one for each point


def test_bucketed_families_are_joined_without_an_exchange(spark):
    made = []
    try:
        for i in range(3):
            table = spark.range(500).selectExpr("id * 2 as SK_ID_CURR", f"id + {i} as f{i}")
            made.append(tables.write_bucketed(table, f"bucketed_{i}", buckets=4))
        base = tables.write_bucketed(spark.range(1000).withColumnRenamed("id", "SK_ID_CURR"), "bucketed_base", buckets=4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = left_assemble(base, "SK_ID_CURR", made)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 1000 and joined.agg(F.sum("f2")).first()[0] == sum(range(2, 502))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.drop_bucketed(spark, "bucketed_base", *[f"bucketed_{i}" for i in range(3)])
    assert not spark.catalog.tableExists("bucketed_base")
