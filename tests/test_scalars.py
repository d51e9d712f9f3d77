"""Null, NaN, infinity and zero-divisor rules of the expressions."""

import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import scalars as X
from tallyloom.functions.aggregates import latest_present, pearson, total
from tallyloom.operators.aggregate import agg_exprs, category_exprs, group_by_present, size_expr

INF = float("inf")


def values(spark, rows, columns, expression):
    df = spark.createDataFrame(rows, columns)
    return [r[0] for r in df.select(F.expr(expression)).collect()]


def test_ratio(spark):
    rows = [(1.0, 2.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None), (INF, INF), (5.0, INF)]
    got = values(spark, rows, "a double, b double", X.ratio("a", "b"))
    assert got == [0.5, INF, -INF, None, None, None, None, 0.0]


def test_ratio_of_integers_and_shift(spark):
    assert values(spark, [(1, 0)], "a int, b int", X.shifted_ratio("a", "b", 1.0)) == [1.0]
    assert values(spark, [(3, -1)], "a int, b int", X.shifted_ratio("a", "b", 1.0)) == [INF]


def test_differs_keeps_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert df.filter(X.differs("x", "a")).count() == 2
    assert df.filter(X.differs("x", "a", "b")).count() == 1


def test_cleaning(spark):
    one = "x double"
    assert values(spark, [(-1.0,), (None,), (2.0,)], one, X.zero_when_negative("x")) == [0.0, None, 2.0]
    assert values(spark, [(365243.0,), (1.0,), (None,)], one, X.sentinel_to_null("x", 365243)) == [None, 1.0, None]
    assert values(spark, [(9.0,), (1.0,), (None,)], one, X.null_when("x", "x > 5")) == [None, 1.0, None]
    assert values(spark, [(0.5,), (3.0,), (None,)], one, X.capped_at_one("x")) == [0.5, 1.0, 1.0]
    assert values(spark, [(0.5,), (-3.0,), (None,)], one, X.positive_part("x")) == [0.5, 0.0, 0.0]
    assert values(spark, [("a",), ("z",), (None,)], "x string", X.collapse("x", ["a"], "others")) == [
        "a", "others", "others",
    ]
    labels = X.count_labels("x", {0: "zero", 1: "one"}, "over")
    assert values(spark, [(0,), (1,), (7,), (None,)], "x int", labels) == ["zero", "one", "over", None]
    assert values(spark, [("Closed",), ("Active",), (None,)], "x string", X.one_unless("x = 'Closed'")) == [0, 1, 1]


def test_quotes_in_names_and_literals(spark):
    df = spark.createDataFrame([("it's \\ a",)], "`odd: name / x` string")
    hit = df.filter(f"{X.name('odd: name / x')} = {X.literal(chr(39).join(['it', 's ' + chr(92) + ' a']))}")
    assert hit.count() == 1


def test_row_statistics(spark):
    rows = [(1.0, 2.0, 4.0), (1.0, None, 3.0), (None, None, 3.0), (None, None, None)]
    schema = "a double, b double, c double"
    assert values(spark, rows, schema, X.row_mean(["a", "b", "c"])) == [pytest.approx(7 / 3), 2.0, 3.0, None]
    got = values(spark, rows, schema, X.row_std(["a", "b", "c"]))
    assert got[0] == pytest.approx(math.sqrt(7 / 3)) and got[1] == pytest.approx(math.sqrt(2))
    assert got[2:] == [None, None]
    assert values(spark, rows, schema, X.null_strict_sum(["a", "b", "c"])) == [7.0, None, None, None]


def test_row_max_follows_the_first(spark):
    rows = [(1.0, 2.0), (3.0, 2.0), (None, 2.0), (1.0, None)]
    assert values(spark, rows, "a double, b double", X.row_max("a", "b")) == [2.0, 3.0, None, 1.0]


def test_empty_sum_is_zero_but_absent_subset_is_missing(spark):
    rows = [(1, "A", 2.0), (1, "C", None), (2, "C", None), (2, "C", None), (3, None, 5.0), (None, "A", 9.0)]
    df = spark.createDataFrame(rows, "k int, s string, x double")
    out = {
        r.k: r
        for r in group_by_present(df, "k")
        .agg(
            *agg_exprs({"x": ["sum", "mean", "max", "nunique"]}, "ALL_"),
            *agg_exprs({"x": ["sum", "mean", "nunique"]}, "C_", "s = 'C'"),
            size_expr("n"),
            size_expr("n_c", "s = 'C'"),
        )
        .collect()
    }
    assert set(out) == {1, 2, 3}
    assert (out[2].ALL_x_SUM, out[2].ALL_x_MEAN, out[2].ALL_x_NUNIQUE) == (0.0, None, 0)
    assert (out[1].C_x_SUM, out[1].C_x_MEAN, out[1].n_c) == (0.0, None, 1)
    assert (out[3].C_x_SUM, out[3].C_x_NUNIQUE, out[3].n_c) == (None, None, None)


def test_shares_count_missing_as_no(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "b"), (1, "a")], "k int, c string")
    row = df.groupBy("k").agg(*category_exprs("c", ["a", "b"], "P_", ("mean", "sum"), True)).first()
    assert (row["P_c_a_MEAN"], row["P_c_a_SUM"], row["P_c_nan_MEAN"]) == (0.5, 2, 0.25)


def test_variance_needs_two(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (2, 3.0)], "k int, x double")
    got = dict(df.groupBy("k").agg(*agg_exprs({"x": ["var"]})).collect())
    assert got == {1: None, 2: 2.0}


def test_infinity_is_a_value(spark):
    df = spark.createDataFrame([(1, 1.0), (1, INF)], "k int, x double")
    row = df.groupBy("k").agg(*agg_exprs({"x": ["max", "mean"]})).first()
    assert row.x_MAX == INF and row.x_MEAN == INF


def test_latest_present_is_per_column(spark):
    rows = [(1, -1, None, 5.0), (1, -2, "old", 4.0), (1, -3, "older", 3.0), (1, None, "undated", 1.0)]
    df = spark.createDataFrame(rows, "k int, m int, s string, x double")
    row = df.groupBy("k").agg(
        F.expr(latest_present("s", "m")).alias("s"), F.expr(latest_present("x", "m")).alias("x")
    ).first()
    assert (row.s, row.x) == ("old", 5.0)


def test_pearson(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, 5.0, 1.0), (4.0, None, 1.0), (None, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double, c double")
    row = df.agg(F.expr(pearson("x", "y")).alias("r"), F.expr(pearson("x", "c")).alias("flat")).first()
    assert row.r == pytest.approx(0.9819805060619657) and row.flat is None
    assert df.agg(F.expr(total("x"))).first()[0] == 10.0
