"""Scans, cache and sinks on files."""

import pytest

from tallyloom.sources import tables
from tallyloom.sources.schemas import BUREAU_BALANCE, INSTALLMENTS_PAYMENTS, TABLES


def test_csv_scan_orders_types_by_name(spark, tmp_path):
    (tmp_path / "bureau_balance.csv").write_text("STATUS,EXTRA,SK_ID_BUREAU,MONTHS_BALANCE\n0,e,7,-1\n,f,8,\nC,,9,-2\n")
    df = tables.read_csv(spark, str(tmp_path / "bureau_balance.csv"), BUREAU_BALANCE)
    assert dict(df.dtypes) == {
        "STATUS": "string", "EXTRA": "string", "SK_ID_BUREAU": "bigint", "MONTHS_BALANCE": "int",
    }
    assert [tuple(r) for r in df.collect()] == [("0", "e", 7, -1), (None, "f", 8, None), ("C", None, 9, -2)]


def test_limited_scan_takes_first_rows_by_key(spark, tmp_path):
    rows = "\n".join(f"{i},1,1,1,-200,-200,{i}.5,1" for i in (5, 3, 9, 1))
    header = "SK_ID_PREV,SK_ID_CURR,NUM_INSTALMENT_VERSION,NUM_INSTALMENT_NUMBER,DAYS_INSTALMENT,DAYS_ENTRY_PAYMENT,AMT_INSTALMENT,AMT_PAYMENT"
    (tmp_path / "installments_payments.csv").write_text(f"{header}\n{rows}\n")
    df = tables.read_table(spark, str(tmp_path), "installments_payments", rows=2)
    assert sorted(r.SK_ID_PREV for r in df.collect()) == [1, 3]
    assert tables.read_table(spark, str(tmp_path), "installments_payments").count() == 4
    assert df.schema["AMT_INSTALMENT"].dataType == INSTALLMENTS_PAYMENTS["AMT_INSTALMENT"].dataType


def test_external_loans_are_read_whole_in_a_limited_run(spark, tmp_path):
    (tmp_path / "bureau_balance.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,0,C\n2,0,C\n3,0,C\n")
    assert tables.read_table(spark, str(tmp_path), "bureau_balance", rows=1).count() == 3


def test_parquet_scan_and_nan(spark, tmp_path):
    path = str(tmp_path / "bureau_balance.parquet")
    spark.sql("SELECT 1 AS SK_ID_BUREAU, double('NaN') AS x, 2.0D AS y").write.parquet(path)
    row = tables.read_table(spark, str(tmp_path), "bureau_balance", format="parquet").first()
    assert row.x is None and row.y == 2.0
    with pytest.raises(ValueError, match="format"):
        tables.read_table(spark, str(tmp_path), "bureau_balance", format="pickle")


def test_conform_adds_declared_columns(spark):
    out = tables.conform(spark.sql("SELECT '5' AS SK_ID_BUREAU, 'C' AS STATUS"), BUREAU_BALANCE)
    assert out.columns == ["SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"]
    assert tuple(out.first()) == (5, None, "C")


def test_cache_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5), (2, None)], "SK_ID_CURR long, `odd: name` double")
    back = tables.write_cached(df, str(tmp_path), "family")
    assert back.schema == df.schema and tables.read_cached(spark, str(tmp_path), "family").count() == 2
    scores = spark.createDataFrame([(1, 0.25, "x")], "SK_ID_CURR long, TARGET double, other string")
    tables.write_predictions(scores, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in spark.read.csv(str(tmp_path / "out"), header=True).collect()) == [("1", "0.25")]
    weights = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 1)], "feature string, importance double, fold int")
    tables.write_importances(weights, weights.filter("feature = 'b'"), str(tmp_path / "all"), str(tmp_path / "top"))
    assert spark.read.csv(str(tmp_path / "all"), header=True).count() == 2
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "top"), header=True).collect()] == [("b", "2.0", "1")]


def test_declared_tables():
    assert len(TABLES["application_train"].fields) == 122 and len(TABLES["application_test"].fields) == 121
    assert len(TABLES["bureau"].fields) == 17
    strings = [f for f in TABLES["application_train"].fields if f.dataType.simpleString() == "string"]
    assert len(strings) == 16
