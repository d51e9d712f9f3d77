"""Declared schemas of the eight input tables.

Only the columns the plans name are declared one by one; columns that are merely
dropped get their type from their name.
"""

from __future__ import annotations

from pyspark.sql import types as T

from tallyloom.plans import names

D, L, I, S = T.DoubleType(), T.LongType(), T.IntegerType(), T.StringType()

# text columns among those that are only dropped
_TEXT = {
    "NAME_TYPE_SUITE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "WEEKDAY_APPR_PROCESS_START",
    "FLAG_OWN_CAR", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE",
    "EMERGENCYSTATE_MODE", "ORGANIZATION_TYPE", "OCCUPATION_TYPE", "FLAG_LAST_APPL_PER_CONTRACT",
    "NAME_CASH_LOAN_PURPOSE", "NAME_PAYMENT_TYPE", "NAME_SELLER_INDUSTRY", "NAME_PORTFOLIO",
    "NAME_PRODUCT_TYPE", "CHANNEL_TYPE", "NAME_YIELD_GROUP", "CODE_REJECT_REASON",
    "NAME_CLIENT_TYPE", "NAME_CONTRACT_STATUS",
}
_COUNTED = ("FLAG_", "REG_", "LIVE_REGION", "LIVE_CITY", "HOUR_", "NFLAG_", "REGION_RATING", "CNT_CHILDREN")


def _by_name(column: str) -> T.DataType:
    if column in _TEXT:
        return S
    return I if column.startswith(_COUNTED) else D


def _schema(declared: dict[str, T.DataType], dropped: list[str] = ()) -> T.StructType:
    fields = dict(declared)
    for column in dropped:
        fields.setdefault(column, _by_name(column))
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


APPLICATION = _schema(
    {
        "SK_ID_CURR": L, "TARGET": I, "NAME_CONTRACT_TYPE": S, "CODE_GENDER": S,
        "FLAG_OWN_REALTY": S, "AMT_INCOME_TOTAL": D, "AMT_CREDIT": D, "AMT_ANNUITY": D,
        "AMT_GOODS_PRICE": D, "NAME_INCOME_TYPE": S, "NAME_EDUCATION_TYPE": S, "DAYS_BIRTH": I,
        "DAYS_EMPLOYED": I, "DAYS_REGISTRATION": D, "DAYS_ID_PUBLISH": I, "OWN_CAR_AGE": D,
        "EXT_SOURCE_1": D, "EXT_SOURCE_2": D, "EXT_SOURCE_3": D,
        "OBS_30_CNT_SOCIAL_CIRCLE": D, "DEF_30_CNT_SOCIAL_CIRCLE": D,
        "OBS_60_CNT_SOCIAL_CIRCLE": D, "DEF_60_CNT_SOCIAL_CIRCLE": D,
    },
    [*names.APPLICATION_USELESS, *names.APPLICATION_OPTIONAL],
)
APPLICATION_TEST = T.StructType([f for f in APPLICATION.fields if f.name != "TARGET"])

BUREAU = _schema(
    {
        "SK_ID_CURR": L, "SK_ID_BUREAU": L, "CREDIT_ACTIVE": S, "CREDIT_CURRENCY": S,
        "CREDIT_TYPE": S, "DAYS_CREDIT": I, "CREDIT_DAY_OVERDUE": I, "DAYS_CREDIT_ENDDATE": D,
        "DAYS_ENDDATE_FACT": D, "AMT_CREDIT_MAX_OVERDUE": D, "CNT_CREDIT_PROLONG": I,
        "AMT_CREDIT_SUM": D, "AMT_CREDIT_SUM_DEBT": D, "AMT_CREDIT_SUM_LIMIT": D,
        "AMT_CREDIT_SUM_OVERDUE": D, "DAYS_CREDIT_UPDATE": I, "AMT_ANNUITY": D,
    }
)

BUREAU_BALANCE = _schema({"SK_ID_BUREAU": L, "MONTHS_BALANCE": I, "STATUS": S})

PREVIOUS_APPLICATION = _schema(
    {
        "SK_ID_PREV": L, "SK_ID_CURR": L, "NAME_CONTRACT_TYPE": S, "NAME_CONTRACT_STATUS": S,
        "NAME_GOODS_CATEGORY": S, "PRODUCT_COMBINATION": S, "AMT_ANNUITY": D, "AMT_APPLICATION": D,
        "AMT_CREDIT": D, "AMT_DOWN_PAYMENT": D, "AMT_GOODS_PRICE": D, "RATE_DOWN_PAYMENT": D,
        "CNT_PAYMENT": D, "HOUR_APPR_PROCESS_START": I, "DAYS_DECISION": I,
        "DAYS_FIRST_DRAWING": D, "DAYS_FIRST_DUE": D, "DAYS_LAST_DUE_1ST_VERSION": D,
        "DAYS_LAST_DUE": D, "DAYS_TERMINATION": D, "NFLAG_INSURED_ON_APPROVAL": D,
    },
    names.PREVIOUS_UNUSED_INPUT,
)

POS_CASH_BALANCE = _schema(
    {
        "SK_ID_PREV": L, "SK_ID_CURR": L, "MONTHS_BALANCE": I, "CNT_INSTALMENT": D,
        "CNT_INSTALMENT_FUTURE": D, "NAME_CONTRACT_STATUS": S, "SK_DPD": I, "SK_DPD_DEF": I,
    }
)

INSTALLMENTS_PAYMENTS = _schema(
    {
        "SK_ID_PREV": L, "SK_ID_CURR": L, "NUM_INSTALMENT_VERSION": D, "NUM_INSTALMENT_NUMBER": I,
        "DAYS_INSTALMENT": D, "DAYS_ENTRY_PAYMENT": D, "AMT_INSTALMENT": D, "AMT_PAYMENT": D,
    }
)

CREDIT_CARD_BALANCE = _schema(
    {
        "SK_ID_PREV": L, "SK_ID_CURR": L, "MONTHS_BALANCE": I, "AMT_BALANCE": D,
        "AMT_CREDIT_LIMIT_ACTUAL": D, "AMT_DRAWINGS_CURRENT": D, "AMT_INST_MIN_REGULARITY": D,
        "AMT_PAYMENT_CURRENT": D, "AMT_PAYMENT_TOTAL_CURRENT": D, "AMT_TOTAL_RECEIVABLE": D,
    },
    names.CARD_UNUSED_INPUT,
)

# file stem -> schema
TABLES: dict[str, T.StructType] = {
    "application_train": APPLICATION,
    "application_test": APPLICATION_TEST,
    "bureau": BUREAU,
    "bureau_balance": BUREAU_BALANCE,
    "previous_application": PREVIOUS_APPLICATION,
    "POS_CASH_balance": POS_CASH_BALANCE,
    "installments_payments": INSTALLMENTS_PAYMENTS,
    "credit_card_balance": CREDIT_CARD_BALANCE,
}

# the key a row-limited scan runs along
SCAN_KEYS: dict[str, str] = {
    "application_train": "SK_ID_CURR",
    "application_test": "SK_ID_CURR",
    "bureau": "SK_ID_BUREAU",
    "bureau_balance": "SK_ID_BUREAU",
    "previous_application": "SK_ID_PREV",
    "POS_CASH_balance": "SK_ID_PREV",
    "installments_payments": "SK_ID_PREV",
    "credit_card_balance": "SK_ID_PREV",
}
