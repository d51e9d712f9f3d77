"""Boosting jobs against plain loops over rows: splits, gains, margins, early stopping, shared tables."""

from __future__ import annotations

import math
import os
import random

import numpy as np
import pytest

from tallyloom.operators import boosting as B
from tallyloom.operators import evaluate as E
from tallyloom.operators import staging

RANDOM = random.Random(9)
SMALL = B.BoostSettings(rounds=5, patience=100, step=0.3, leaves=5, depth=3, bins=12, min_weight=0.5, min_rows=4, chunk=3)


def rows_of(n, seed=9):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.random(), rng.choice([None, 1.0, 2.0, 3.0])
        label = None if i % 7 == 0 else int(x + (y or 0) / 4 + rng.random() * 0.6 > 1.1)
        rows.append((i, label, x if i % 11 else None, y, rng.random(), math.inf if i % 13 == 0 else 1.0))
    return rows


SCHEMA = "SK_ID_CURR long, TARGET int, `x: 1` double, y double, noise double, odd double"


def plain_boosting(data, task, s):
    """The same algorithm row by row: lists of (feature, cut, gain) for each round, and held-out margins."""
    train = [d for d in data if d["label"] is not None and d["fold"] != task.fold]
    held = [d for d in data if d["label"] is not None and d["fold"] == task.fold]
    share = sum(d["label"] for d in train) / len(train)
    start = math.log(share / (1 - share))
    margin = {d["key"]: start for d in data}
    out = []

    def score(rows):
        g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
        return max(abs(g) - s.l1, 0) ** 2 / (h + s.l2)

    for number in range(s.rounds):
        used = B._chosen_features(task, s, number).tolist()
        drawn = B._drawn(np.array([d["draw"] for d in train]), B._salt(s.seed, number, task.fold), s.row_sample)
        rows = []
        for d, taken in zip(train, drawn, strict=True):
            p = 1 / (1 + math.exp(-margin[d["key"]]))
            if taken:
                rows.append((d["bins"], p - d["label"], p * (1 - p)))
        splits, level, leaves = [], [(rows, lambda bins: True)], 1
        paths = {0: level[0][1]}
        ends = [(level[0][1], rows)]
        for _ in range(s.depth):
            candidates = []
            for place, (inside, path) in enumerate(level):
                best = None
                for f in used:
                    for cut in range(s.bins - 1):
                        left, right = [r for r in inside if r[0][f] <= cut], [r for r in inside if r[0][f] > cut]
                        if min(len(left), len(right)) < s.min_rows or min(sum(r[2] for r in p) for p in (left, right)) < s.min_weight:
                            continue
                        gain = score(left) + score(right) - score(inside)
                        if gain > s.min_gain and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, cut, left, right, path, inside)
                if best:
                    candidates.append((-best[0], place, best))
            level = []
            for _, _, (gain, f, cut, left, right, path, inside) in sorted(candidates, key=lambda c: c[:2]):
                if leaves >= s.leaves:
                    break
                leaves += 1
                splits.append((f, cut, gain))
                sides = [
                    (left, lambda b, path=path, f=f, cut=cut: path(b) and b[f] <= cut),
                    (right, lambda b, path=path, f=f, cut=cut: path(b) and b[f] > cut),
                ]
                level += sides
                ends = [e for e in ends if e[0] is not path] + [(p, r) for r, p in sides]
            if leaves >= s.leaves:
                break
        if not splits:
            break
        for d in data:
            inside = next(r for p, r in ends if p(d["bins"]))
            margin[d["key"]] += s.step * B.leaf_value(sum(r[1] for r in inside), sum(r[2] for r in inside), s)
        out.append((splits, {d["key"]: margin[d["key"]] for d in held}))
    return out


def table_of(spark, rows, folds=3, bins=12):
    df = E.assign_folds(spark.createDataFrame(rows, SCHEMA), "SK_ID_CURR", folds)
    features = df.columns[2:6]
    return staging.stage(B.binned(df, "SK_ID_CURR", "TARGET", "fold", features, bins)), features


def test_trees_gains_and_margins_equal_plain_loops(spark):
    table, features = table_of(spark, rows_of(260))
    tasks = [B.Task("all", 0, (0, 1, 2, 3)), B.Task("all", 1, (0, 1, 2, 3)), B.Task("two", 0, (0, 2))]
    models = B.trained(table, tasks, 4, SMALL, E.auc)
    data = [{"key": r["__key"], "label": r["__label"], "fold": r.fold, "draw": r["__draw"], "bins": list(r.bins)} for r in table.collect()]
    for model in models:
        want = plain_boosting(data, model.task, SMALL)
        assert len(want) == len(model.history) == SMALL.rounds
        areas = []
        for _, margins in want:
            pairs = [(d["label"], margins[d["key"]]) for d in data if d["key"] in margins]
            ones, zeros = [m for y, m in pairs if y == 1], [m for y, m in pairs if y == 0]
            areas.append(sum((a > b + 1e-12) + 0.5 * (abs(a - b) <= 1e-12) for a in ones for b in zeros) / len(ones) / len(zeros))
        assert model.history == pytest.approx(areas, abs=1e-3)
        assert model.best == 1 + max(range(len(model.history)), key=lambda i: (model.history[i], -i))
        total = dict.fromkeys(model.task.features, 0.0)
        for tree, (splits, _) in zip(model.trees, want, strict=False):
            mine = [(f, c, g) for f, c, g in zip(tree.feature, tree.cut, tree.gain, strict=True) if f >= 0]
            assert sorted(x[:2] for x in mine) == sorted(x[:2] for x in splits)
            assert sorted(x[2] for x in mine) == pytest.approx(sorted(x[2] for x in splits))
            for f, _, g in splits:
                total[f] += g
        assert dict(B.gains(model, features)) == pytest.approx({features[f]: g for f, g in total.items()})
    held = {(r["__key"], r.model): r.prediction for r in B.predicted(table, models, 4, SMALL).where("held_out").collect()}
    for number, model in enumerate(models):
        margins = plain_boosting(data, model.task, SMALL)[model.best - 1][1]
        assert {k: held[k, number] for k in margins} == pytest.approx({k: 1 / (1 + math.exp(-m)) for k, m in margins.items()})


def test_patience_keeps_the_best_round_of_a_full_run(spark):
    from dataclasses import replace

    table, _ = table_of(spark, rows_of(500, 3))
    tasks = [B.Task("all", fold, (0, 1, 2, 3)) for fold in range(3)]
    full = B.trained(table, tasks, 4, replace(SMALL, rounds=14), E.auc)
    short = B.trained(table, tasks, 4, replace(SMALL, rounds=14, patience=3, chunk=4), E.auc)
    stopped = 0
    for whole, early in zip(full, short, strict=True):
        # what a run that looks at each round one by one would keep
        best = 0
        for i, value in enumerate(whole.history):
            if value > max(whole.history[:best], default=-1.0):
                best = i + 1
            if i + 1 - best >= 3:
                stopped += 1
                break
        assert early.best == best and len(early.trees) == best
        assert early.history == pytest.approx(whole.history[: len(early.history)])
    assert stopped


def test_choices_over_one_table_equal_tables_of_their_own(spark):
    df = spark.createDataFrame(rows_of(400, 5), SCHEMA)
    choices = {"all": ["x: 1", "y", "noise", "odd"], "one": ["y"], "two": ["x: 1", "odd"]}
    together = E.evaluate_choices(df, choices, folds=3, settings=SMALL)
    report = {(r.families, r.fold): r for r in E.ablation_report(together).collect()}
    assert set(report) == {(name, fold) for name in choices for fold in (1, 2, 3)}
    for name, chosen in choices.items():
        alone = E.kfold_boosted_trees(df.select("SK_ID_CURR", "TARGET", *chosen), folds=3, settings=SMALL)
        for fold in alone.valid_auc.collect():
            assert report[name, fold.fold].valid_auc == pytest.approx(fold.auc) and report[name, fold.fold].features == len(chosen)
        for fold in alone.train_auc.collect():
            assert report[name, fold.fold].train_auc == pytest.approx(fold.auc)
        assert report[name, 1].overall_auc == pytest.approx(alone.overall_auc.first().auc)


def test_all_models_score_in_one_scan(spark):
    table, _ = table_of(spark, rows_of(100))
    models = [B.Trained(B.Task("m", fold, (0,)), [], 0, []) for fold in range(5)]
    plan = B.predicted(table, models, 4, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_odd_tables(spark):
    rows = [(i, i % 2, None, None, 1.0, -math.inf if i % 3 else math.nan) for i in range(60)]
    result = E.kfold_boosted_trees(spark.createDataFrame(rows, SCHEMA), folds=2, settings=SMALL)
    assert result.out_of_fold.count() == 60 and result.scored.count() == 0
    unlabelled = spark.createDataFrame([(i, None, 1.0, 1.0, 1.0, 1.0) for i in range(5)], SCHEMA)
    result = E.kfold_boosted_trees(unlabelled, folds=2, settings=SMALL)
    assert result.predictions("SK_ID_CURR").count() == 5 and result.valid_auc.count() == 0
    assert E.kfold_boosted_trees(unlabelled.limit(0), folds=2, settings=SMALL).scored.count() == 0
    with pytest.raises(ValueError, match="bins"):
        B.binned(unlabelled, "SK_ID_CURR", "TARGET", "SK_ID_CURR", ["y"], 300)


def test_written_tables_go(spark):
    with staging.passing(spark):
        table = staging.stage(spark.range(3))
        assert os.path.isdir(table.staged_at)
    assert not os.path.exists(table.staged_at)
    table = staging.stage(spark.range(3))
    staging.release(table)
    assert not os.path.exists(table.staged_at)
