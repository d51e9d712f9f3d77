"""Physical plans: what reaches the scan, how often rows are shuffled, what is sorted."""

import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.joins import left_assemble
from tallyloom.plans import balances
from tallyloom.plans.bureau import bureau_aggregates
from tallyloom.plans.bureau_history import loan_history
from tallyloom.plans.previous import clean_previous, product_aggregates
from tallyloom.sources.schemas import TABLES


@pytest.fixture(scope="module")
def scans(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(str(folder / name))
    return {name: spark.read.parquet(str(folder / name)) for name in TABLES}


@pytest.fixture(autouse=True)
def plain_plans(spark):
    """Plans as for large tables: nothing small enough to broadcast, no runtime rewriting."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxMetadataStringLength": "5000",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_installment_filters_reach_the_scan(scans):
    text = plan(balances.installment_aggregates(scans["installments_payments"]))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "LessThan(DAYS_INSTALMENT" in pushed and "GreaterThan(AMT_INSTALMENT" in pushed
    assert "SK_ID_PREV" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_pos_is_hash_aggregated_in_two_shuffles(scans):
    text = plan(balances.pos_aggregates(scans["POS_CASH_balance"]))
    assert "Sort" not in text and "Window" not in text and shuffles(text) == 2


def test_card_is_one_scan_and_one_shuffle(scans):
    text = plan(balances.card_aggregates(scans["credit_card_balance"]))
    assert text.count("FileScan") == 1 and shuffles(text) == 1 and "Join" not in text


def test_previous_needs_no_join(scans):
    text = plan(product_aggregates(clean_previous(scans["previous_application"])))
    assert text.count("FileScan") == 1 and "Join" not in text and shuffles(text) == 2
    read = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "NAME_YIELD_GROUP" not in read and "AMT_DOWN_PAYMENT" not in read


def test_loan_history_needs_no_window(scans):
    text = plan(loan_history(scans["bureau"]))
    assert "Window" not in text and text.count("FileScan") == 1


def test_bureau_scans_each_table_once(scans):
    text = plan(bureau_aggregates(scans["bureau"], scans["bureau_balance"]))
    assert text.count("FileScan") == 2
    # balance by loan, loans by loan, loans by applicant
    assert shuffles(text) == 3
    assert "In(CREDIT_TYPE, [Consumer credit,Credit card])" in text and "GreaterThan(AMT_CREDIT_SUM,1000.0)" in text


def test_assembly_shuffles_each_table_once(spark, scans):
    tables = [
        scans[t].groupBy("SK_ID_CURR").agg(F.count("*").alias(t))
        for t in ("bureau", "POS_CASH_balance", "credit_card_balance")
    ]
    base = scans["application_train"].select("SK_ID_CURR", "TARGET")
    # aggregation already places rows by the join key: no further shuffle for the families
    assert shuffles(plan(left_assemble(base, "SK_ID_CURR", tables))) == 4


def test_detail_is_read_once_when_results_are_joined_back(scans):
    from tallyloom.operators.joins import attach, lookup, per_key

    detail = scans["POS_CASH_balance"]
    text = plan(attach(detail, per_key(detail, ["SK_ID_CURR"], [F.max("SK_DPD").alias("m")]), ["SK_ID_CURR"]))
    # the other scans are of the written table of keys
    assert text.count("MONTHS_BALANCE:int") == 1
    text = plan(lookup(detail, scans["previous_application"].dropDuplicates(["SK_ID_PREV"]), "SK_ID_PREV"))
    assert text.count("CNT_INSTALMENT_FUTURE:double") == 1
