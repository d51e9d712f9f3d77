"""Boosting over blocks of columns, and what its evaluations share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from driver_queries import families, roles
from tallyloom.operators import boosting as B
from tallyloom.operators import evaluate as E
from tallyloom.operators import staging

RNG = np.random.default_rng(4)


def row_batches(n, width, size):
    label = [None if i % 5 == 0 else float(i % 3 == 0) for i in range(n)]
    bins = RNG.integers(0, 12, (n, width)).astype(np.uint8)
    columns = [
        pa.array(range(n), pa.int64()), pa.array(label, pa.float64()), pa.array([i % 3 for i in range(n)], pa.int32()),
        pa.array(RNG.integers(-(2**62), 2**62, n), pa.int64()), pa.array([row.tobytes() for row in bins], pa.binary()),
    ]
    whole = pa.RecordBatch.from_arrays(columns, names=["__key", "__label", "fold", "__draw", "bins"])
    return label, bins, [whole.slice(i, size) for i in range(0, n, size)]


def test_blocks_hold_the_labelled_rows_column_by_column(monkeypatch):
    monkeypatch.setattr(B, "ROWS_IN_BLOCK", 64)
    label, bins, batches = row_batches(500, 6, 37)
    out = list(B._blocks(iter(batches), np.array([0.25, -1.0]), 6))
    blocks = [block for batch in out for block in B._unpacked(batch, 6, 2)]
    known = [i for i, x in enumerate(label) if x is not None]
    assert [len(b.label) for b in blocks] == [64] * (len(known) // 64) + [len(known) % 64]
    assert np.array_equal(np.concatenate([b.bins for b in blocks], axis=1), bins[known].T)
    assert np.concatenate([b.label for b in blocks]).tolist() == [label[i] for i in known]
    assert all((b.margins == [[0.25], [-1.0]]).all() for b in blocks)


def test_sums_over_blocks_equal_loops_over_rows(monkeypatch):
    monkeypatch.setattr(B, "ROWS_IN_BLOCK", 50)
    label, bins, batches = row_batches(300, 20, 300)
    blocks = list(B._blocks(iter(batches), np.array([0.5]), 20))
    tree = B.Tree()
    tree.split(0, 3, 5, 1.0)
    s = B.BoostSettings(bins=12, row_sample=1.0)
    r = B._Round(0, {0: B.Task("m", 1, tuple(range(20)))}, {0: []}, {0: tree}, {0: [1, 2]}, {0: np.arange(20)}, 1, 20, s)
    want = np.zeros((2, 20, 12, 3))
    p = 1 / (1 + np.exp(-0.5))
    for i, y in enumerate(label):
        if y is not None and i % 3 != 1:
            for feature in range(20):
                want[int(bins[i, 3] > 5), feature, bins[i, feature]] += p - y, p * (1 - p), 1
    found = {}
    for batch in B._sums(iter(blocks), r):
        for row in batch.to_pylist():
            found[row["node"], row["block"]] = np.frombuffer(row["sums"], "<f8").reshape(-1, 12, 3)
    for slot, node in enumerate((1, 2)):
        assert np.allclose(np.concatenate([found[node, 0], found[node, 1]]), want[slot])


def test_leaves_of_trees_with_many_nodes():
    tree, bins = B.Tree(), RNG.integers(0, 255, (3, 2000)).astype(np.uint8)
    places = [[0]]
    for level in range(9):
        places.append([c for k, node in enumerate(places[-1]) for c in tree.split(node, (level + k) % 3, 20 + 23 * level, 1.0)])
    assert len(tree.feature) > 512
    for row, leaf in enumerate(tree.leaf_of(bins)):
        at = 0
        while tree.feature[at] >= 0:
            at = tree.left[at] if bins[tree.feature[at], row] <= tree.cut[at] else tree.right[at]
        assert at == leaf


def test_quantiles_come_a_column_at_once(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 97) / 7, None if i % 2 else i * 1e300, None) for i in range(3000)], "a double, b double, c double")
    shares = [i / 63 for i in range(1, 63)]
    want = df.approxQuantile(["a", "b", "c"], shares, 0.001)
    monkeypatch.setattr(type(df), "approxQuantile", None)  # its numbers come one by one
    assert B._quantiles(df, ["a", "b", "c"], shares, 0.001) == want
    assert [x.tolist() for x in B.cut_points(df, ["a", "b", "c"], 64)] == [sorted(set(x)) for x in want]


def test_both_evaluations_read_one_table(spark, monkeypatch):
    seen, made = [], []
    base, family = spark.createDataFrame([(1, 0, 1.0)], "SK_ID_CURR long, TARGET int, x double"), spark.createDataFrame([(1, 2.0)], "SK_ID_CURR long, y double")
    monkeypatch.setattr(families, "_done", {})
    monkeypatch.setattr(families, "all_tables", lambda *_: made.append(1))
    monkeypatch.setattr(families.assembly, "base_table", lambda _: base)
    monkeypatch.setattr(families.assembly, "family_tables", lambda _, chosen: dict.fromkeys(chosen, family))
    monkeypatch.setattr(families.assembly, "assemble", lambda b, f: b.join(family, "SK_ID_CURR", "left") if f else b)
    monkeypatch.setattr(families, "kfold_boosted_trees", lambda table, settings: seen.append(table))
    monkeypatch.setattr(families, "evaluate_choices", lambda table, choices, settings: seen.append(table) or choices)
    families._evaluated(spark, "nowhere")
    assert families._ablated(spark, "nowhere") == {"all": ["x", "y"], "none": ["x"], **dict.fromkeys(families.assembly.FAMILIES, ["x", "y"])}
    assert len(made) == 1 and len(seen) == 2 and seen[0] is seen[1]


def test_settings_for_wide_aggregates_end_with_their_jobs(spark):
    names = "spark.sql.codegen.hugeMethodLimit", "spark.sql.files.openCostInBytes", "spark.sql.parquet.columnarReaderBatchSize"
    before = [spark.conf.get(n) for n in names]
    try:
        with staging.wide_aggregates(spark), staging.large_rows(spark):
            assert [spark.conf.get(n) for n in names] == ["8000", "262144", "8"]
            raise KeyError
    except KeyError:
        pass
    assert [spark.conf.get(n) for n in names] == before


def test_lines_are_counted_once_for_all_tables(monkeypatch):
    asked = []
    monkeypatch.setattr(roles, "ordered_lines", lambda *_: asked.append(1) or "lines")
    monkeypatch.setattr(roles, "role", lambda spark, folder, name, lines=None: lines)
    assert roles.tables(None, "nowhere", ("POS_CASH_balance", "installments_payments", "bureau"))["installments_payments"] == "lines"
    assert len(asked) == 1
    roles.tables(None, "nowhere", ("bureau",))
    assert len(asked) == 1


def test_area_of_all_folds_is_one_row_without_labels(spark):
    rows = spark.createDataFrame([(i, None, float(i)) for i in range(6)], "SK_ID_CURR long, TARGET int, x double")
    result = E.kfold_boosted_trees(rows, folds=2, settings=B.BoostSettings(rounds=1))
    assert [tuple(r) for r in result.overall_auc.collect()] == [(None, None, None)]
