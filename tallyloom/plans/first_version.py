"""The first pipeline: cleaned applications, loan history, previous history, encoded and aligned."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyloom.functions import scalars as X
from tallyloom.operators.aggregate import with_exprs
from tallyloom.operators.encode import label_encode_binary, one_hot
from tallyloom.operators.joins import left_assemble
from tallyloom.operators.profile import extremes, label_correlations
from tallyloom.operators.schema import align_columns, drop_columns
from tallyloom.operators.staging import stage
from tallyloom.plans import names
from tallyloom.plans.bureau_history import loan_history, missed_payment_flag
from tallyloom.plans.previous_history import previous_history

_YEARS = ["DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH"]


def clean_application(df: DataFrame) -> DataFrame:
    """Same cleaning for labelled and unlabelled rows; day offsets become years."""
    cleaned = {
        "DAYS_EMPLOYED": X.sentinel_to_null("DAYS_EMPLOYED", names.MISSING_DAY),
        "CNT_CHILDREN": X.count_labels("CNT_CHILDREN", names.CHILD_COUNT_LABELS, "over_three"),
        "NAME_INCOME_TYPE": X.collapse("NAME_INCOME_TYPE", names.INCOME_TYPES_KEPT, "others"),
        "REQ_CNT": X.null_strict_sum(
            [f"AMT_REQ_CREDIT_BUREAU_{unit}" for unit in ("HOUR", "DAY", "WEEK", "MON")]
        ),
    }
    df = with_exprs(with_exprs(df, cleaned), {d: f"{d} / -365.0D" for d in _YEARS})
    return drop_columns(df, names.APPLICATION_USELESS)


def first_version_tables(
    tables: Mapping[str, DataFrame], vocabulary=None
) -> tuple[DataFrame, DataFrame]:
    """Aligned train (with TARGET) and test feature tables."""
    families = [
        loan_history(tables["bureau"]),
        missed_payment_flag(tables["bureau"], tables["bureau_balance"]),
        previous_history(tables["previous_application"], vocabulary),
    ]
    train, test = (
        left_assemble(clean_application(tables[t]), "SK_ID_CURR", families)
        for t in ("application_train", "application_test")
    )
    train, (test,), _ = label_encode_binary(train, [test])
    train, _ = one_hot(train, True, vocabulary)
    test, _ = one_hot(test, True, vocabulary)
    labelled = train
    train, test = align_columns(train, test)
    shared = set(train.columns)
    # the label exists in one table only, so alignment drops it; it is taken along again
    return labelled.selectExpr(*[X.name(c) for c in labelled.columns if c in shared or c == "TARGET"]), test


def label_links(train: DataFrame, n: int = 15) -> DataFrame:
    """The most negative and most positive correlations with the label."""
    return extremes(stage(label_correlations(stage(train), "TARGET")), n)
