"""Previous applications, first version: all, approved and refused side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tallyloom.functions import scalars as X
from tallyloom.operators.aggregate import agg_exprs, category_exprs, group_by_present, output_name, with_exprs
from tallyloom.operators.encode import discover_vocabulary
from tallyloom.operators.schema import string_columns
from tallyloom.plans import names

# Aggregates of all, approved and refused applications
_RANGE = ["min", "max", "mean"]
NUMERIC = {
    "AMT_ANNUITY": _RANGE,
    "AMT_APPLICATION": _RANGE,
    "AMT_CREDIT": _RANGE,
    "APP_CREDIT_PERC": [*_RANGE, "var"],
    "AMT_DOWN_PAYMENT": _RANGE,
    "AMT_GOODS_PRICE": _RANGE,
    "HOUR_APPR_PROCESS_START": _RANGE,
    "RATE_DOWN_PAYMENT": _RANGE,
    "DAYS_DECISION": _RANGE,
    "CNT_PAYMENT": ["mean", "sum"],
}


def previous_history(
    previous: DataFrame, vocabulary: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Numeric summaries over three row sets, category shares, and approved/refused ratios."""
    columns = string_columns(previous)
    vocabulary = dict(vocabulary or {})
    vocabulary.update(discover_vocabulary(previous, [c for c in columns if c not in vocabulary]))
    days = [
        "DAYS_FIRST_DRAWING",
        "DAYS_FIRST_DUE",
        "DAYS_LAST_DUE_1ST_VERSION",
        "DAYS_LAST_DUE",
        "DAYS_TERMINATION",
    ]
    rows = with_exprs(
        previous,
        {
            **{d: X.sentinel_to_null(d, names.MISSING_DAY) for d in days},
            "APP_CREDIT_PERC": X.ratio("AMT_APPLICATION", "AMT_CREDIT"),
        },
    )
    shares = [
        e
        for c in columns
        for e in category_exprs(c, vocabulary[c], "PREV_", nan_as_category=True)
    ]
    table = group_by_present(rows, "SK_ID_CURR").agg(
        *agg_exprs(NUMERIC, "PREV_"),
        *shares,
        *agg_exprs(NUMERIC, "APPROVED_", "NAME_CONTRACT_STATUS = 'Approved'"),
        *agg_exprs(NUMERIC, "REFUSED_", "NAME_CONTRACT_STATUS = 'Refused'"),
    )
    ratios = {
        output_name("NEW_RATIO_PREV_", c, f): X.ratio(
            output_name("APPROVED_", c, f), output_name("REFUSED_", c, f)
        )
        for c, functions in NUMERIC.items()
        for f in functions
    }
    return with_exprs(table, ratios)
