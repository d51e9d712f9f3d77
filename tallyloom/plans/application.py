"""Application features: one row per applicant, labelled and unlabelled together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import scalars as X
from tallyloom.functions.aggregates import mean
from tallyloom.operators.aggregate import with_exprs
from tallyloom.operators.encode import factorize, one_hot
from tallyloom.operators.schema import append_unlabelled, drop_columns
from tallyloom.plans import names

_EXT = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
_ORDER = "__appearance"


def appearance_order(df: DataFrame) -> DataFrame:
    """Numeric order in which rows count as seen: labelled ones first, then by applicant."""
    return df.withColumn(_ORDER, F.expr(f"bigint(TARGET IS NULL) * {1 << 40} + SK_ID_CURR"))


def derived_columns(shift: float = 1.0) -> dict[str, str]:
    birth = f"(double(DAYS_BIRTH) - {float(shift)!r}D)"
    return {
        "REQ_CNT": X.null_strict_sum(
            [f"AMT_REQ_CREDIT_BUREAU_{unit}" for unit in ("HOUR", "DAY", "WEEK", "MON")]
        ),
        "NEW_CREDIT_TO_ANNUITY_RATIO": X.ratio("AMT_CREDIT", "AMT_ANNUITY"),
        "NEW_CREDIT_TO_GOODS_RATIO": X.shifted_ratio("AMT_CREDIT", "AMT_GOODS_PRICE", shift),
        "NEW_CREDIT_TO_INCOME": X.shifted_ratio("AMT_CREDIT", "AMT_INCOME_TOTAL", shift),
        "NEW_EMPLOY_TO_BIRTH_RATIO": X.ratio("DAYS_EMPLOYED", birth),
        "NEW_SOURCES_PROD_12": "EXT_SOURCE_1 * EXT_SOURCE_2",
        "NEW_SOURCES_PROD_23": "EXT_SOURCE_2 * EXT_SOURCE_3",
        "NEW_SOURCES_PROD_13": "EXT_SOURCE_1 * EXT_SOURCE_3",
        "NEW_EXT_SOURCES_MEAN": X.row_mean(_EXT),
        "NEW_SCORES_STD": X.row_std(_EXT),
        "NEW_CAR_TO_BIRTH_RATIO": X.ratio("OWN_CAR_AGE", birth),
        "NEW_PHONE_TO_BIRTH_RATIO": X.ratio("DAYS_LAST_PHONE_CHANGE", birth),
        "DEF_TO_OBS_30_RATIO": X.ratio("DEF_30_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE"),
        "DEF_TO_OBS_60_RATIO": X.ratio("DEF_60_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE"),
    }


def filled_with_mean(df: DataFrame, column: str) -> DataFrame:
    """Missing values become the column's global mean, taken from the same table."""
    centre = df.agg(F.expr(mean(X.name(column)))).scalar()
    return df.withColumn(column, F.coalesce(F.col(X.name(column)), centre))


def application_features(
    train: DataFrame, test: DataFrame, vocabulary=names.APPLICATION_VOCABULARY, shift: float = 1.0
) -> DataFrame:
    """``train`` carries TARGET, ``test`` does not; the result has NULL there."""
    df = append_unlabelled(train, test).filter(X.differs("CODE_GENDER", "XNA"))
    df = with_exprs(
        df,
        {
            "DAYS_EMPLOYED": X.sentinel_to_null("DAYS_EMPLOYED", names.MISSING_DAY),
            "NAME_INCOME_TYPE": X.collapse("NAME_INCOME_TYPE", names.INCOME_TYPES_KEPT, "others"),
        },
    )
    df = filled_with_mean(with_exprs(df, derived_columns(shift)), "NEW_SCORES_STD")
    df = appearance_order(df)
    # FLAG_OWN_CAR would be coded as well, but is dropped below
    df = factorize(df, ["CODE_GENDER", "FLAG_OWN_REALTY"], _ORDER)
    df = drop_columns(df, [_ORDER, *names.APPLICATION_USELESS, *names.APPLICATION_OPTIONAL])
    df, _ = one_hot(df, nan_as_category=True, vocabulary=vocabulary)
    return drop_columns(df, names.APPLICATION_INDICATORS_DROPPED)
