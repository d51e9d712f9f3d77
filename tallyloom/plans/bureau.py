"""External loans: cleaned, with decayed overdue history, one row per applicant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import scalars as X
from tallyloom.functions.aggregates import total
from tallyloom.operators.aggregate import agg_exprs, category_exprs, group_by_present, output_name, with_exprs
from tallyloom.operators.schema import drop_columns
from tallyloom.operators.score import with_scores
from tallyloom.plans import names
from tallyloom.plans.score_terms import BUREAU_SCORE

# Aggregates of all, active and closed loans
ALL_LOANS = {
    "ENDDATE_DIFF": ["mean"],
    "ENDDATE_FACT_DIFF": ["mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "DPD_SCORE": ["mean"],
}
ACTIVE_LOANS = {
    "ENDDATE_DIFF": ["mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
}
CLOSED_LOANS = {
    "ENDDATE_DIFF": ["mean"],
    "ENDDATE_FACT_DIFF": ["mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["max", "mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
}


def clean_bureau(bureau: DataFrame) -> DataFrame:
    """Kept loans with implausible values removed.

    The size filter looks at the amount as read; only then are huge amounts blanked.
    """
    end = X.null_when("DAYS_CREDIT_ENDDATE", "DAYS_CREDIT_ENDDATE < -200000")
    fact = X.null_when("DAYS_ENDDATE_FACT", "DAYS_ENDDATE_FACT < -4000")
    cleaned = {
        "ENDDATE_DIFF": f"({end}) - DAYS_CREDIT",
        "ENDDATE_FACT_DIFF": f"({fact}) - DAYS_CREDIT",
        "AMT_CREDIT_MAX_OVERDUE": X.null_when("AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_MAX_OVERDUE > 10000000"),
        "AMT_CREDIT_SUM": X.null_when("AMT_CREDIT_SUM", "AMT_CREDIT_SUM > 50000000"),
        "AMT_CREDIT_SUM_DEBT": X.zero_when_negative("AMT_CREDIT_SUM_DEBT"),
        "AMT_CREDIT_SUM_LIMIT": X.zero_when_negative("AMT_CREDIT_SUM_LIMIT"),
        "AMT_ANNUITY": X.null_when("AMT_ANNUITY", "AMT_ANNUITY > 10000000 OR AMT_ANNUITY < 100"),
    }
    kept = bureau.filter(X.one_of("CREDIT_TYPE", names.CREDIT_TYPES_KEPT)).filter("AMT_CREDIT_SUM > 1000")
    return kept.selectExpr(
        "SK_ID_CURR",
        "SK_ID_BUREAU",
        "CREDIT_ACTIVE",
        "CREDIT_TYPE",
        "AMT_CREDIT_SUM_OVERDUE",
        *[X.called(text, column) for column, text in cleaned.items()],
    )


def overdue_history(balance: DataFrame) -> DataFrame:
    """Per loan: months in arrears, each weighted less the longer ago it was."""
    weight = X.decay(1.2, "MONTHS_BALANCE")
    late = f"CASE WHEN {X.differs('STATUS', '0')} THEN {weight} ELSE 0.0D END"
    return group_by_present(balance.filter(X.differs("STATUS", "C", "X")), "SK_ID_BUREAU").agg(
        F.expr(X.called(total(late), "DPD_SCORE"))
    )


def bureau_aggregates(bureau: DataFrame, balance: DataFrame, shift: float = 1.0) -> DataFrame:
    loans = clean_bureau(bureau).join(overdue_history(balance), "SK_ID_BUREAU", "left")
    per_applicant = group_by_present(loans, "SK_ID_CURR").agg(
        *agg_exprs(ALL_LOANS, "BURO_"),
        *category_exprs("CREDIT_ACTIVE", names.CREDIT_ACTIVE, "BURO_", nan_as_category=True),
        *category_exprs("CREDIT_TYPE", names.CREDIT_TYPES_KEPT, "BURO_", nan_as_category=True),
        *agg_exprs(ACTIVE_LOANS, "ACTIVE_", "CREDIT_ACTIVE = 'Active'"),
        *agg_exprs(CLOSED_LOANS, "CLOSED_", "CREDIT_ACTIVE = 'Closed'"),
    )
    ratios = {
        output_name("NEW_RATIO_BURO_", column, f): X.shifted_ratio(
            output_name("ACTIVE_", column, f), output_name("CLOSED_", column, f), shift
        )
        for column, functions in ACTIVE_LOANS.items()
        for f in functions
    }
    return with_exprs(per_applicant, ratios)


def bureau_features(bureau: DataFrame, balance: DataFrame, shift: float = 1.0) -> DataFrame:
    table = drop_columns(
        bureau_aggregates(bureau, balance, shift), [*names.BUREAU_USELESS, *names.BUREAU_OPTIONAL]
    )
    scored = with_scores(table, {"BUREAU_SCORE": BUREAU_SCORE})
    return drop_columns(scored, names.BUREAU_DROPPED_AFTER_SCORE)
