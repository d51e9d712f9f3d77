"""The wide feature table: base plus any choice of families, plus mixed ratios."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping

from pyspark.sql import DataFrame

from tallyloom.functions.scalars import ratio
from tallyloom.operators.aggregate import with_exprs
from tallyloom.operators.joins import left_assemble
from tallyloom.plans.application import application_features
from tallyloom.plans.balances import card_features, installment_features, pos_features
from tallyloom.plans.bureau import bureau_features
from tallyloom.plans.previous import previous_features

FAMILIES = ("bureau", "prev", "pos", "ins", "cc")
_BUILD = {
    "bureau": lambda t: bureau_features(t["bureau"], t["bureau_balance"]),
    "prev": lambda t: previous_features(t["previous_application"]),
    "pos": lambda t: pos_features(t["POS_CASH_balance"]),
    "ins": lambda t: installment_features(t["installments_payments"]),
    "cc": lambda t: card_features(t["credit_card_balance"]),
}


def base_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    return application_features(tables["application_train"], tables["application_test"])


def family_tables(
    tables: Mapping[str, DataFrame], families: Collection[str] = FAMILIES
) -> dict[str, DataFrame]:
    unknown = set(families) - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown families: {sorted(unknown)}")
    return {f: _BUILD[f](tables) for f in FAMILIES if f in families}


def mixed_ratios(df: DataFrame) -> DataFrame:
    """Card figures over income; a table without the card family is returned as it is."""
    pairs = {
        "MIX_CC_BAL_MEAN_TO_INCOME": "CC_RAW_AMT_BALANCE_MEAN",
        "MIX_CC_BAL_MAX_TO_INCOME": "CC_RAW_AMT_BALANCE_MAX",
        "MIX_CC_TOTAL_RECEIVABLE_MEAN_TO_INCOME": "CC_RAW_AMT_TOTAL_RECEIVABLE_MEAN",
    }
    if not set(pairs.values()) <= set(df.columns):
        return df
    return with_exprs(df, {n: ratio(c, "AMT_INCOME_TOTAL") for n, c in pairs.items()})


def assemble(base: DataFrame, families: Mapping[str, DataFrame], key: str = "SK_ID_CURR") -> DataFrame:
    return mixed_ratios(left_assemble(base, key, [families[f] for f in FAMILIES if f in families]))


def feature_table(
    tables: Mapping[str, DataFrame], families: Collection[str] = FAMILIES
) -> DataFrame:
    return assemble(base_table(tables), family_tables(tables, families))


def ablation_choices() -> Iterator[tuple[str, tuple[str, ...]]]:
    """All families, none, and each alone."""
    yield "all", FAMILIES
    yield "none", ()
    for family in FAMILIES:
        yield family, (family,)
