"""Calls that are refused: labels that the first table lacks, options that would be ignored."""

from __future__ import annotations

import sys

import pytest

from tallyloom import run
from tallyloom.operators.encode import label_encode_binary


def test_missing_label_is_refused_where_train_has_none(spark):
    train = spark.createDataFrame([("Y", "a"), ("N", None)], "flag string, kind string")
    test = spark.createDataFrame([(None, "a")], "flag string, kind string")
    _, (coded,), names = label_encode_binary(train, [test])
    assert names == ["flag", "kind"]
    with pytest.raises(Exception, match="missing label in flag"):
        coded.collect()
    assert [r.kind for r in coded.select("kind").collect()] == [0]
    known = spark.createDataFrame([("Y", None)], "flag string, kind string")
    assert [tuple(r) for r in label_encode_binary(train, [known])[1][0].collect()] == [(1, 1)]


@pytest.mark.parametrize("options", [["--first-version", "--rows", "5"], ["--first-version", "--families", "ins"], ["--ablation", "--families", "ins"]])
def test_ignored_options_are_refused(monkeypatch, options):
    monkeypatch.setattr(sys, "argv", ["run", "--input", "a", "--output", "b", *options])
    with pytest.raises(SystemExit):
        run.main()
