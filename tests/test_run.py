"""Whole runs from CSV files to written predictions."""

import pytest

from driver_queries.roles import all_tables
from tallyloom.operators.evaluate import BoostSettings
from tallyloom.run import run_family_choices, run_first_version

SMALL = BoostSettings(rounds=2, depth=2, bins=16, min_rows=2, min_weight=0.1, step=0.3)


@pytest.fixture(scope="module")
def source(spark, folder, tmp_path_factory):
    target = tmp_path_factory.mktemp("csv")
    for name, table in all_tables(spark, folder).items():
        table.write.option("header", True).csv(str(target / f"{name}.csv"))
    return str(target)


def test_family_choices(spark, source, tmp_path):
    choices = [("none", ()), ("ins", ("ins",))]
    reports = run_family_choices(spark, source, str(tmp_path), choices, settings=SMALL, folds=2)
    assert [r["run"] for r in reports] == ["none", "ins"]
    # identifiers and label are no features
    assert [r["features"] for r in reports] == [41, 60]
    assert all(len(r["valid_auc"]) == 2 and 0 <= r["overall_auc"] <= 1 for r in reports)
    predicted = spark.read.csv(str(tmp_path / "ins" / "predictions"), header=True)
    assert predicted.columns == ["SK_ID_CURR", "TARGET"] and predicted.count() > 10
    best = spark.read.csv(str(tmp_path / "ins" / "best_features"), header=True)
    assert best.count() == 80


def test_first_version(spark, source, tmp_path):
    out = run_first_version(spark, source, str(tmp_path), settings=SMALL, folds=2)
    assert len(out["train_auc"]) == 2
    assert spark.read.csv(str(tmp_path / "first_version" / "predictions"), header=True).count() > 10
