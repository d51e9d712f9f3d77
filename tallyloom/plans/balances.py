"""Monthly balances and payments: POS contracts, installments, credit cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import scalars as X
from tallyloom.functions.aggregates import AGGREGATES, hits, latest_code, total
from tallyloom.operators.aggregate import (
    agg_exprs,
    group_by_present,
    keyed,
    output_name,
    size_expr,
    with_exprs,
)
from tallyloom.operators.score import with_scores
from tallyloom.plans.score_terms import CC_SCORE, INSTAL_SCORE, POS_SCORE

# --- POS ------------------------------------------------------------------


# codes of the states that matter; missing values take no part in "latest"
_STATUS_CODE = (
    "CASE WHEN NAME_CONTRACT_STATUS = 'Completed' THEN 2 WHEN NAME_CONTRACT_STATUS = 'Active' THEN 1"
    " WHEN NAME_CONTRACT_STATUS IS NOT NULL THEN 0 END"
)
_OWING_CODE = "CASE WHEN CNT_INSTALMENT_FUTURE > 0 THEN 1 WHEN CNT_INSTALMENT_FUTURE IS NOT NULL THEN 0 END"


def pos_contracts(pos: DataFrame) -> DataFrame:
    """One row per contract: latest state and worst arrears while active.

    A contract belongs to one applicant, so both contract-level summaries of the
    balance rows are one aggregation and the balance table is scanned once.
    """
    active = "NAME_CONTRACT_STATUS = 'Active'"
    summaries = {
        "months": "count(1)",
        "active_months": hits(active),
        "completed": f"{latest_code(_STATUS_CODE, 3, 'MONTHS_BALANCE')} = 2",
        "active": f"{latest_code(_STATUS_CODE, 3, 'MONTHS_BALANCE')} = 1",
        "owing": f"{latest_code(_OWING_CODE, 2, 'MONTHS_BALANCE')} = 1",
        "SK_DPD_MAX": f"max(CASE WHEN {active} THEN SK_DPD END)",
        "SK_DPD_DEF_MAX": f"max(CASE WHEN {active} THEN SK_DPD_DEF END)",
    }
    # rows without a contract still count as balance rows of the applicant
    return (
        keyed(pos, "SK_ID_CURR")
        .groupBy("SK_ID_CURR", "SK_ID_PREV")
        .agg(*[F.expr(X.called(text, column)) for column, text in summaries.items()])
    )


def pos_aggregates(pos: DataFrame) -> DataFrame:
    contract = "SK_ID_PREV IS NOT NULL"
    arrears = f"({contract} AND active_months > 0)"
    per_contract = X.ratio("SK_DPD_MAX", "SK_DPD_DEF_MAX")
    contracts = pos_contracts(pos).withColumn(
        "DPD_RATIO", F.expr(f"CASE WHEN {arrears} THEN {per_contract} END")
    )
    spec = {"SK_DPD_MAX": ["max", "mean"], "SK_DPD_DEF_MAX": ["max", "mean"], "DPD_RATIO": ["max", "mean"]}
    any_contract = hits(contract)
    completed = hits(f"{contract} AND completed")
    running = hits(f"{contract} AND active AND owing")
    counts = {
        "POS_CNT_COMPLETED": f"CASE WHEN {any_contract} > 0 THEN {completed} END",
        "POS_CNT_ACTIVED": f"CASE WHEN {any_contract} > 0 THEN {running} END",
        "POS_FLAG_UNCOMPLETED": f"int({completed} < {any_contract})",
        "POS_COUNT": "sum(months)",
    }
    return contracts.groupBy("SK_ID_CURR").agg(
        F.expr(X.called(any_contract, "POS_CNT_PREV_ID")),
        *agg_exprs(spec, "POS_", arrears),
        *[F.expr(X.called(text, column)) for column, text in counts.items()],
    )


def pos_features(pos: DataFrame) -> DataFrame:
    return with_scores(pos_aggregates(pos), {"POS_SCORE": POS_SCORE})


# --- installments ---------------------------------------------------------

# Keys of a period and aggregates of its payments
PERIOD_KEYS = [
    "SK_ID_CURR",
    "NUM_INSTALMENT_VERSION",
    "NUM_INSTALMENT_NUMBER",
    "DAYS_INSTALMENT",
    "AMT_INSTALMENT",
]
PAYMENTS = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_PERC": ["mean"],
    "AMT_INSTALMENT": ["max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
}


def payment_periods(payments: DataFrame, shift: float = 1e-3) -> DataFrame:
    """Payments of one period merged, with how far and how early they were paid.

    The filters are on grouping columns, so they reach the scan.
    """
    merged = group_by_present(payments, *PERIOD_KEYS).agg(
        F.expr(X.called(total("AMT_PAYMENT"), "AMT_PAYMENT")),
        F.min("DAYS_ENTRY_PAYMENT").alias("DAYS_ENTRY_PAYMENT"),
    )
    kept = merged.filter("NOT (AMT_INSTALMENT <=> 67.5D AND DAYS_ENTRY_PAYMENT IS NULL)").filter(
        "DAYS_INSTALMENT < -180 AND AMT_INSTALMENT > 1000"
    )
    paid = X.shifted_ratio("AMT_PAYMENT", "AMT_INSTALMENT", shift)
    return with_exprs(
        kept,
        {
            "PAYMENT_PERC": X.capped_at_one(paid),
            "DPD": X.positive_part("(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT)"),
            "DBD": X.positive_part("(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT)"),
        },
    )


def installment_aggregates(payments: DataFrame, shift: float = 1e-3) -> DataFrame:
    late, early = hits("DPD > 0"), hits("DBD > 0")
    return (
        payment_periods(payments, shift)
        .groupBy("SK_ID_CURR")
        .agg(
            *agg_exprs(PAYMENTS, "INSTAL_"),
            size_expr("INSTAL_COUNT"),
            F.expr(X.called(X.shifted_ratio(late, early, shift), "INSTAL_DPD_DBD_RATIO")),
            F.expr(X.called(f"{late} - {early}", "INSTAL_DPD_DBD_DIFF")),
        )
    )


def installment_features(payments: DataFrame) -> DataFrame:
    return with_scores(installment_aggregates(payments), {"INSTAL_SCORE": INSTAL_SCORE})


# --- credit card ----------------------------------------------------------

# Aggregates of all rows, of customers who used the card, and of rows with a balance
CARD_ALL = {
    "AMT_BALANCE": ["max", "mean"],
    "AMT_DRAWINGS_CURRENT": ["max", "mean", "sum"],
    "AMT_INST_MIN_REGULARITY": ["max"],
    "AMT_PAYMENT_CURRENT": ["mean"],
    "AMT_PAYMENT_TOTAL_CURRENT": ["max", "mean"],
    "AMT_PAYMENT_MAX": ["mean"],
    "AMT_TOTAL_RECEIVABLE": ["max", "mean"],
}
CARD_USED = {
    "AMT_BALANCE": ["mean"],
    "AMT_INST_MIN_REGULARITY": ["mean"],
    "AMT_PAYMENT_CURRENT": ["sum"],
    "AMT_TOTAL_RECEIVABLE": ["mean"],
}
CARD_OWING = {
    "AMT_BALANCE": ["mean"],
    "AMT_DRAWINGS_CURRENT": ["max"],
    "AMT_PAYMENT_CURRENT": ["sum"],
}


def card_rows(card: DataFrame) -> DataFrame:
    return with_exprs(
        card,
        {
            "FLAG_EXCEED_LIMIT": "AMT_CREDIT_LIMIT_ACTUAL < AMT_BALANCE",
            "AMT_PAYMENT_MAX": X.row_max("AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT"),
        },
    )


def card_aggregates(card: DataFrame) -> DataFrame:
    """Three row sets in one aggregation.

    Keeping only applicants who ever had a balance keeps whole groups, so the group's
    own aggregate serves, blanked where the largest balance is not positive.
    """
    used = [
        F.expr(
            X.called(
                f"CASE WHEN max(AMT_BALANCE) > 0 THEN {AGGREGATES[function](column)} END",
                output_name("CC_RM_UNUSE_", column, function),
            )
        )
        for column, functions in CARD_USED.items()
        for function in functions
    ]
    return group_by_present(card_rows(card), "SK_ID_CURR").agg(
        *agg_exprs(CARD_ALL, "CC_RAW_"),
        *used,
        *agg_exprs(CARD_OWING, "CC_EXCEED_", "AMT_BALANCE > 0"),
        size_expr("CC_COUNT"),
    )


def card_features(card: DataFrame) -> DataFrame:
    return with_scores(card_aggregates(card), {"CC_SCORE": CC_SCORE})
