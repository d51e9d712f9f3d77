"""Joins under skew, order, encodings, scores, profile and evaluation operators."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import evaluate as E
from tallyloom.operators import joins, ordered, profile, schema
from tallyloom.operators.aggregate import agg_exprs, size_expr
from tallyloom.operators.encode import discover_vocabulary, factorize, label_encode_binary, one_hot
from tallyloom.operators.score import ScoreTerm, with_scores

INF = float("inf")


def skewed_rows(n=600, seed=3):
    """A third of the rows share key 0; some keys are missing."""
    rng = random.Random(seed)
    return [
        (i, 0 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(1, 40), float(rng.randrange(100)))
        for i in range(n)
    ]


# forced: keys above a tenth of the rows are hot
FORCED = {"hot_parts": 10}


@pytest.mark.parametrize("options", [{}, FORCED])
def test_merge_back(spark, options):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id int, k int, x double")
    out = joins.merge_back(df, ["k"], [size_expr("n"), F.sum("x").alias("s")], **options)
    want = {}
    for _, k, x in rows:
        if k is not None:
            n, s = want.get(k, (0, 0.0))
            want[k] = (n + 1, s + x)
    got = {r.id: (r.k, r.n, r.s) for r in out.collect()}
    assert len(got) == len(rows) and out.count() == len(rows)
    for i, k, _ in rows:
        assert got[i] == ((k, *want[k]) if k is not None else (None, None, None))


@pytest.mark.parametrize("options", [{}, FORCED])
@pytest.mark.parametrize("limit", [5, 100])
def test_keep_groups(spark, options, limit):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id int, k int, x double")
    kept = joins.keep_groups(df, ["k"], F.count("x") > limit, **options)
    sizes = {}
    for _, k, _ in rows:
        sizes[k] = sizes.get(k, 0) + 1
    want = {i for i, k, _ in rows if k is not None and sizes[k] > limit}
    assert {r.id for r in kept.collect()} == want and kept.count() == len(want)


@pytest.mark.parametrize("hot_parts", [20_000, 10])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup(spark, hot_parts, how):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id int, k int, x double")
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 60, 2)], "k int, v string")
    got = sorted(tuple(r) for r in joins.lookup(df, table, "k", how, hot_parts).select("id", "v").collect())
    found = {i: f"v{k}" if k is not None and k % 2 == 0 else None for i, k, _ in rows}
    want = [(i, v) for i, v in found.items() if v is not None or how == "left"]
    assert [g[0] for g in got] == [w[0] for w in sorted(want)] and dict(got) == dict(want)


def test_hot_and_missing_keys_are_dealt(spark):
    rows = [(i, 0 if i % 3 == 0 else None if i % 3 == 1 else i) for i in range(3000)]
    detail = spark.createDataFrame(rows, "id int, k int")
    table = joins.per_key(detail, ["k"], [F.max("id").alias("last")])
    hot = joins._hot(table, ["k"], 30)
    assert [tuple(r) for r in hot.collect()] == [(0, 15)]
    joined = joins.attach(detail, table, ["k"], hot_parts=30)
    assert joined.count() == 3000 and joined.where("k = 0 and last = 2997").count() == 1000
    assert joined.where("k is null and last is null").count() == 1000
    assert joins.attach(detail.limit(0), table.limit(0), ["k"]).collect() == []


def test_outer_assembly_and_flag(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    b = spark.createDataFrame([(2, 5), (3, 6)], "k int, y int")
    got = {tuple(r) for r in joins.outer_assemble("k", [a, b]).collect()}
    assert got == {(1, "a", None), (2, "b", 5), (3, None, 6)}
    flagged = joins.exists_flag(a, "k", spark.createDataFrame([(2,), (2,)], "k int"), "f")
    assert {(r.k, r.f) for r in flagged.collect()} == {(1, 0), (2, 1)}


@pytest.mark.parametrize("ranges", [None, 7])
def test_quantiles_match_sorting(spark, ranges):
    rng = random.Random(5)
    rows = [(k, float(rng.randrange(30))) for k in range(6) for _ in range(k * 17 + 1)]
    rows += [(0, None), (9, None)]
    df = spark.createDataFrame(rows, "k int, x double")
    out = ordered.quantiles(df, "x", {"m": 0.5, "q": 0.25, "top": 1.0}, ["k"], ranges=ranges)
    got = {r.k: r for r in out.collect()}
    assert set(got) == set(range(6))
    for k in range(6):
        xs = sorted(x for kk, x in rows if kk == k and x is not None)
        place = 0.25 * (len(xs) - 1)
        low = int(place)
        high = min(low + 1, len(xs) - 1)
        assert got[k].m == statistics.median(xs)
        assert got[k].q == pytest.approx(xs[low] + (xs[high] - xs[low]) * (place - low))
        assert got[k].top == xs[-1]


def test_gaps_with_ties_and_missing(spark):
    rows = [
        (1, 7, -5), (2, 7, -5), (3, 7, -20), (4, 7, None), (5, 8, -1), (6, None, -3), (7, 7, -5), (8, 7, -50),
    ]
    df = spark.createDataFrame(rows, "id int, k int, d int")
    down = {r.id: r.g for r in ordered.gap_from_later(df, "k", "d", "id", "g").collect()}
    assert down == {1: 0, 2: 0, 7: 0, 3: 15, 8: 30, 4: 0, 5: 0, 6: None}
    up = ordered.gap_from_earlier(df, "k", "d", "id", "g", F.col("d") < -4)
    assert {r.id: r.g for r in up.collect()} == {
        8: 0, 3: 30, 1: 15, 2: 0, 7: 0, 4: None, 5: None, 6: None,
    }


@pytest.mark.parametrize("ranges", [None, 5])
def test_prefix_sum(spark, ranges):
    rows = [(g, i, i % 4) for g in (1, 2) for i in range(50)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v int, n int")
    out = ordered.with_prefix_sum(df, "v", "n", "below", ["g"], ranges)
    for r in out.collect():
        assert r.below == sum(i % 4 for i in range(r.v))


def test_factorize(spark):
    rows = [(3, "b"), (1, None), (2, "b"), (5, "a"), (4, "c"), (6, "a"), (7, None)]
    df = spark.createDataFrame(rows, "o int, c string")
    want = {1: -1, 2: 0, 3: 0, 4: 1, 5: 2, 6: 2, 7: -1}
    df = df.withColumn("d", F.upper("c"))
    coded = factorize(df, ["c", "d"], "o").collect()
    assert {r.o: r.c for r in coded} == want and {r.o: r.d for r in coded} == want


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y z")], "i int, c string")
    out, new = one_hot(df)
    assert new == ["c_x", "c_y z", "c_nan"]
    assert [tuple(r) for r in out.orderBy("i").collect()] == [(1, 1, 0, 0), (2, 0, 0, 1), (3, 0, 1, 0)]
    out, new = one_hot(df, False, {"c": ["y z", "w"]})
    assert new == ["c_y z", "c_w"] and out.agg(F.sum("c_w")).first()[0] == 0
    _, new = one_hot(df.filter("c IS NOT NULL"))
    assert "c_nan" in new


def test_vocabulary_is_refused_not_cut(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "c string, d string")
    with pytest.raises(ValueError, match="categories in \\['c'\\]"):
        discover_vocabulary(df, ["c", "d"], limit=2)
    assert discover_vocabulary(df, ["c", "d"], limit=3) == {"c": ["a", "b", "c"], "d": ["x"]}


def test_infinite_ratios_leave_no_nan(spark):
    df = spark.createDataFrame([(1, float("inf")), (1, 2.0), (2, float("inf")), (2, float("-inf")), (3, 1.0), (3, 3.0)], "k int, x double")
    out = df.groupBy("k").agg(*agg_exprs({"x": ["mean", "var"]})).orderBy("k")
    assert [tuple(r) for r in out.collect()] == [(1, float("inf"), None), (2, None, None), (3, 2.0, 2.0)]


def test_label_encoding(spark):
    train = spark.createDataFrame(
        [("Y", "a", "p", None), ("N", "b", None, None), ("Y", "c", "p", None)],
        "two string, three string, one_missing string, none string",
    )
    test = spark.createDataFrame([("N", "a", "p", None)], train.schema)
    coded, (other,), columns = label_encode_binary(train, [test])
    assert columns == ["two", "one_missing", "none"]
    assert [r.two for r in coded.collect()] == [1, 0, 1]
    assert [r.one_missing for r in coded.collect()] == [0, 1, 0]
    assert other.first().two == 0
    odd = spark.createDataFrame([("maybe", "a", "p", None)], train.schema)
    with pytest.raises(Exception, match="unseen label"):
        label_encode_binary(train, [odd])[1][0].collect()


def score_of(spark, xs, term, **options):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    out = with_scores(df, {"s": [term]}, **options)
    return [r.s for r in out.orderBy("i").collect()]


def test_score_bounds(spark):
    # range is 10, so v = x / 10; bounds themselves count as between
    term = ScoreTerm("x", 0.2, 0.5, 0.7, -1.0, 0.1)
    assert score_of(spark, [0.0, 10.0, 2.0, 7.0, 5.0, None, 1.0, 8.0], term) == pytest.approx(
        [0.0, -1.0, 0.1, 0.1, 0.1, 0.0, 0.05, -0.8]
    )


def test_score_does_not_subtract_the_minimum(spark):
    # min 20, max 30: v runs from 2 to 3 and is always above the bound
    assert score_of(spark, [20.0, 30.0], ScoreTerm("x", high=1.0, high_weight=1.0)) == [2.0, 3.0]


def test_score_of_negative_constant_missing_and_infinite_columns(spark):
    assert score_of(spark, [-5.0, 5.0], ScoreTerm("x", 0.0, 2.0)) == [-1.0, 0.0]
    flat = ScoreTerm("x", 0.2, 0.1, 0.8, -0.1)
    assert score_of(spark, [7.0, 7.0], flat) == [0.0, 0.0]
    assert score_of(spark, [7.0, 7.0], flat, keep_infinite=True) == [-INF, -INF]
    assert score_of(spark, [7.0, 7.0], ScoreTerm("x", 0.2, 0.1), keep_infinite=True) == [None, None]
    assert score_of(spark, [None, None], flat) == [0.0, 0.0]
    # an infinity makes every finite value 0 in relation to the range
    assert score_of(spark, [1.0, INF, None], ScoreTerm("x", 0.2, 0.1, 0.8, -0.1, 0.5)) == [0.0, 0.0, 0.0]
    assert score_of(spark, [1.0, INF], ScoreTerm("x", 0.0, 0.1, 0.8, -0.1, 0.5)) == [0.5, 0.0]


def test_score_needs_its_columns(spark):
    with pytest.raises(ValueError, match="do not exist"):
        with_scores(spark.range(1), {"s": [ScoreTerm("absent")]})


def test_schema_operators(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "i int, s string, x double")
    assert schema.drop_columns(df, ["s", "s"]).columns == ["i", "x"]
    with pytest.raises(ValueError, match="do not exist"):
        schema.drop_columns(df, ["nope"])
    assert schema.type_histogram(df) == {"int": 1, "string": 1, "double": 1}
    assert schema.feature_columns(df, {"i"}) == ["s", "x"]
    left, right = schema.align_columns(df, spark.createDataFrame([(3.0, 1)], "x double, i int"))
    assert left.columns == right.columns == ["i", "x"]
    stacked = schema.append_unlabelled(df, df.drop("x"))
    labelled, unlabelled = schema.split_by_label(stacked, "x")
    assert (labelled.count(), unlabelled.count()) == (1, 1)
    assert schema.random_rows(spark.range(100), 10, 1, "id").distinct().count() == 10
    assert [r.id for r in schema.first_rows(spark.range(9).orderBy(F.desc("id")), "id", 2).collect()] == [0, 1]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, None, "a", 1.0), (0, 2.0, None, 1.0), (1, None, "a", 1.0)], "t int, x double, s string, c double"
    )
    rows = [tuple(r) for r in profile.missing_profile(df).collect()]
    assert rows == [("x", 2, 66.7), ("s", 1, 33.3)]
    links = {r.column: r.corr for r in profile.label_correlations(df, "t", ["t", "c", "x"]).collect()}
    assert links["t"] == pytest.approx(1.0) and links["c"] is None and links["x"] is None
    assert {(r.column, r.distinct_values) for r in profile.distinct_counts(df).collect()} == {("s", 1)}


def test_folds_are_disjoint_complete_and_stable(spark):
    df = spark.range(-50, 5000)
    folds = E.assign_folds(df, "id", 5, 1001)
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert sum(sizes) == 5050 and len(sizes) == 5 and min(sizes) > 900
    again = E.assign_folds(df.repartition(7), "id", 5, 1001)
    assert folds.exceptAll(again).count() == 0
    assert folds.exceptAll(E.assign_folds(df, "id", 5, 50)).count() > 0


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties_and_monotone_transforms(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), float(rng.randrange(12))) for _ in range(200)]
    df = spark.createDataFrame(rows, "y int, s double")
    want = brute_auc(rows)
    assert E.auc(df, "y", "s").first().auc == pytest.approx(want)
    assert E.auc(df.withColumn("s", F.exp("s") * 3 + 1), "y", "s").first().auc == pytest.approx(want)
    assert E.auc(df.filter("y = 1"), "y", "s").first().auc is None


def test_boosting_by_folds(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        x = rng.random()
        label = None if i % 6 == 0 else int(x + rng.random() * 0.3 > 0.6)
        rows.append((i, label, x if i % 11 else None, rng.random(), INF if i % 13 == 0 else 1.0))
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, `x: 1` double, noise double, odd double")
    settings = E.BoostSettings(rounds=5, depth=3, bins=16, min_rows=5, min_weight=0.1, step=0.3)
    result = E.kfold_boosted_trees(df, folds=3, settings=settings)
    assert result.features == ["x: 1", "noise", "odd"]
    assert result.out_of_fold.count() == 500
    assert result.out_of_fold.select("SK_ID_CURR").distinct().count() == 500
    assert result.predictions("SK_ID_CURR").count() == 100
    assert result.overall_auc.first().auc > 0.85
    assert result.valid_auc.count() == 3 and result.train_auc.count() == 3
    top = E.leading_features(result.importances, 1)
    assert {r.feature for r in top.collect()} == {"x: 1"} and top.count() == 3
