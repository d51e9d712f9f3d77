"""The complete feature families, the assembled table and the evaluation, on derived roles."""

from __future__ import annotations

from functools import reduce, wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_queries import family_sql as S
from driver_queries.operators import fold_sql
from driver_queries.registry import query
from driver_queries.roles import all_tables, applications, role, with_roles
from tallyloom.operators.evaluate import (
    BoostSettings, ablation_report, choice_features, evaluate_choices, kfold_boosted_trees, leading_features,
)
from tallyloom.operators.staging import stage, wide_aggregates
from tallyloom.plans import assembly
from tallyloom.plans.application import application_features
from tallyloom.plans.balances import card_features, installment_features, pos_features
from tallyloom.plans.bureau import bureau_features
from tallyloom.plans.bureau_history import loan_history, missed_payment_flag
from tallyloom.plans.first_version import clean_application, first_version_tables, label_links
from tallyloom.plans.previous import previous_features
from tallyloom.plans.previous_history import previous_history

APPLICATION_DIGITS = {"NEW_EXT_SOURCES_MEAN": 9, "NEW_SCORES_STD": 9}
BUREAU_DIGITS = {"BURO_DPD_SCORE_MEAN": 9, "BUREAU_SCORE": 9}
PREVIOUS_DIGITS = {
    **{
        f"PREV_{g}_RATIO_ANN_TO_APP_MEAN": 12
        for g in ("APPR_CASH", "APPR_CONSUME", "REFU_CASH", "REFU_CONSUME", "REFU_REVOLVING")
    },
    "PREV_CASH_SCORE": 9,
    "PREV_CONSUME_SCORE": 9,
}
POS_DIGITS = {"POS_DPD_RATIO_MEAN": 9, "POS_SCORE": 9}
INSTALLMENT_DIGITS = {"INSTAL_PAYMENT_PERC_MEAN": 9, "INSTAL_SCORE": 9}
CARD_DIGITS = {"CC_SCORE": 9}
HISTORY_DIGITS = {
    **{f"{s}_APP_CREDIT_PERC_{f}": 9 for s in ("PREV", "APPROVED", "REFUSED") for f in ("MEAN", "VAR")},
    "NEW_RATIO_PREV_APP_CREDIT_PERC_MEAN": 9,
    "NEW_RATIO_PREV_APP_CREDIT_PERC_VAR": 3,
}

_ALL_ROLES = (
    "application", "bureau", "bureau_balance", "previous_application", "POS_CASH_balance",
    "installments_payments", "credit_card_balance",
)


@query(with_roles(("application",), S.application(), "SELECT * FROM fam_application"), APPLICATION_DIGITS)
def application_family(spark, folder):
    return application_features(*applications(spark, folder))


@query(with_roles(("bureau", "bureau_balance"), S.bureau(), "SELECT * FROM fam_bureau"), BUREAU_DIGITS)
def bureau_family(spark, folder):
    return bureau_features(role(spark, folder, "bureau"), role(spark, folder, "bureau_balance"))


@query(with_roles(("previous_application",), S.previous(), "SELECT * FROM fam_previous"), PREVIOUS_DIGITS)
def previous_family(spark, folder):
    return previous_features(role(spark, folder, "previous_application"))


@query(with_roles(("POS_CASH_balance",), S.pos(), "SELECT * FROM fam_pos"), POS_DIGITS)
def pos_family(spark, folder):
    return pos_features(role(spark, folder, "POS_CASH_balance"))


@query(
    with_roles(("installments_payments",), S.installments(), "SELECT * FROM fam_installments"),
    INSTALLMENT_DIGITS,
)
def installment_family(spark, folder):
    return installment_features(role(spark, folder, "installments_payments"))


@query(with_roles(("credit_card_balance",), S.card(), "SELECT * FROM fam_card"), CARD_DIGITS)
def card_family(spark, folder):
    return card_features(role(spark, folder, "credit_card_balance"))


@query(with_roles(("bureau",), S.loan_history(), "SELECT * FROM fam_loan_history"))
def ten_features(spark, folder):
    return loan_history(role(spark, folder, "bureau"))


@query(with_roles(("bureau", "bureau_balance"), S.missed_flag(), "SELECT * FROM fam_missed"))
def missed_payment(spark, folder):
    return missed_payment_flag(role(spark, folder, "bureau"), role(spark, folder, "bureau_balance"))


@query(
    with_roles(("previous_application",), S.previous_history(), "SELECT * FROM fam_previous_history"),
    HISTORY_DIGITS,
)
def previous_history_family(spark, folder):
    needed = [
        "SK_ID_CURR", "NAME_CONTRACT_TYPE", "NAME_CONTRACT_STATUS", "NAME_GOODS_CATEGORY",
        "PRODUCT_COMBINATION", "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT",
        "AMT_GOODS_PRICE", "HOUR_APPR_PROCESS_START", "RATE_DOWN_PAYMENT", "DAYS_DECISION", "CNT_PAYMENT",
        "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE",
        "DAYS_TERMINATION",
    ]
    return previous_history(
        role(spark, folder, "previous_application").select(*needed), S.PREV_HISTORY_VOCABULARY
    )


_YEARS = ("DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH")
_CHILDREN = """CASE WHEN CNT_CHILDREN > 3 THEN 'over_three' ELSE
  CASE CNT_CHILDREN WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 2 THEN 'two' WHEN 3 THEN 'three' END END"""
_INCOME = """CASE NAME_INCOME_TYPE WHEN 'Working' THEN 'Working' WHEN 'Commercial associate' THEN 'Commercial associate'
  WHEN 'Pensioner' THEN 'Pensioner' WHEN 'State servant' THEN 'State servant' ELSE 'others' END"""


@query(
    with_roles(
        ("application",),
        {},
        f"""SELECT SK_ID_CURR, TARGET, {_CHILDREN} AS CNT_CHILDREN, {_INCOME} AS NAME_INCOME_TYPE,
        DAYS_BIRTH / -365e0 AS DAYS_BIRTH, CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED / -365e0 END AS DAYS_EMPLOYED,
        DAYS_REGISTRATION / -365e0 AS DAYS_REGISTRATION, DAYS_ID_PUBLISH / -365e0 AS DAYS_ID_PUBLISH,
        AMT_REQ_CREDIT_BUREAU_HOUR + AMT_REQ_CREDIT_BUREAU_DAY + AMT_REQ_CREDIT_BUREAU_WEEK + AMT_REQ_CREDIT_BUREAU_MON
          AS REQ_CNT, FLAG_OWN_REALTY, AMT_CREDIT FROM application""",
    )
)
def first_version_applications(spark, folder):
    return clean_application(role(spark, folder, "application")).select(
        "SK_ID_CURR", "TARGET", "CNT_CHILDREN", "NAME_INCOME_TYPE", *_YEARS, "REQ_CNT", "FLAG_OWN_REALTY",
        "AMT_CREDIT",
    )


@query(
    with_roles(_ALL_ROLES, S.assembled(), "SELECT * FROM fam_assembled"),
    {
        **APPLICATION_DIGITS, **BUREAU_DIGITS, **PREVIOUS_DIGITS, **POS_DIGITS, **INSTALLMENT_DIGITS,
        **CARD_DIGITS,
    },
)
def assembled_features(spark, folder):
    return assembly.feature_table(all_tables(spark, folder))


# --- model evaluation: SQL states which rows, folds and features take part -----

# the published leaves, depth, sampling and penalties; three rounds without a better AUC end a model instead of 200, at a
# step of 0.3 instead of 0.02, and leaves are lighter, as these tables have far fewer rows
_SETTINGS = BoostSettings(patience=3, step=0.3, min_weight=1.0, chunk=4)


_done: dict[tuple, object] = {}


def _once(make):
    """One evaluation for each session and folder: its reports read the same written predictions."""

    @wraps(make)
    def made(spark, folder):
        key = (make.__name__, spark.sparkContext.applicationId, folder)
        if key not in _done:
            _done[key] = make(spark, folder)
        return _done[key]

    return made


@_once
def _parts(spark, folder):
    tables = all_tables(spark, folder)
    with wide_aggregates(spark):  # families are written while their scores are planned
        base, wide = assembly.base_table(tables), assembly.family_tables(tables, ("bureau", "prev"))
    return base, wide | assembly.family_tables(tables, ("pos", "ins", "cc"))


@_once
def _features(spark, folder):
    """The table of all families, written once for both evaluations."""
    parts = _parts(spark, folder)
    with wide_aggregates(spark):
        return stage(assembly.assemble(*parts))


@_once
def _evaluated(spark, folder):
    """All families and rows."""
    return kfold_boosted_trees(_features(spark, folder), settings=_SETTINGS)


@query()
def gbt_kfold(spark, folder):
    result = _evaluated(spark, folder)
    valid = result.valid_auc.select("fold", F.col("auc").alias("valid_auc"))
    train = result.train_auc.select("fold", F.col("auc").alias("train_auc"))
    return valid.join(train, "fold")


@query()
def gbt_test_predictions(spark, folder):
    return _evaluated(spark, folder).predictions("SK_ID_CURR")


@query()
def gbt_importance(spark, folder):
    return leading_features(_evaluated(spark, folder).importances, 40)


@query(
    with_roles(
        ("application",),
        S.application(),
        f"""SELECT SK_ID_CURR, CAST(TARGET AS DOUBLE) AS TARGET, CASE WHEN TARGET IS NOT NULL THEN 1 + {fold_sql('SK_ID_CURR')} END AS fold,
        CASE WHEN TARGET IS NULL THEN 5 ELSE 1 END AS models, TRUE AS probabilities FROM fam_application""",
    )
)
def gbt_rows(spark, folder):
    """Labelled rows are judged once, by the model of their fold; the others by each of five models."""
    result = _evaluated(spark, folder)
    probability = F.bool_and(F.col("prediction").between(0, 1)).alias("probabilities")
    judged = result.out_of_fold.groupBy("SK_ID_CURR", "TARGET").agg(
        F.max("fold").alias("fold"), F.count("*").alias("models"), probability
    )
    new = result.scored.groupBy("SK_ID_CURR").agg(F.count_distinct("fold").alias("models"), probability)
    return judged.unionByName(new.selectExpr("*", "double(NULL) AS TARGET", "int(NULL) AS fold"))


@query(
    with_roles(
        _ALL_ROLES,
        S.assembled(),
        """SELECT fold, features, TRUE AS no_losses, TRUE AS some_gain FROM range(1, 6) folds(fold),
        (SELECT len(list_distinct(json_keys(to_json(f)))) - 2 AS features FROM fam_assembled f LIMIT 1)""",
    )
)
def gbt_importance_sums(spark, folder):
    """Every fold weighs every feature by what its splits gained, which is never below zero."""
    return _evaluated(spark, folder).importances.groupBy("fold").agg(
        F.count_distinct("feature").alias("features"),
        (F.min("importance") >= 0).alias("no_losses"),
        (F.sum("importance") > 0).alias("some_gain"),
    )


@_once
def _ablated(spark, folder):
    choices = choice_features(*_parts(spark, folder), assembly.ablation_choices(), assembly.assemble)
    return evaluate_choices(_features(spark, folder), choices, settings=_SETTINGS)


@query()
def family_ablation(spark, folder):
    """Held-out and training AUC of each fold of the seven family choices."""
    return ablation_report(_ablated(spark, folder))


_FAMILY_TABLES = {"bureau": "fam_bureau", "prev": "fam_previous", "pos": "fam_pos", "ins": "fam_installments", "cc": "fam_card"}


def _width(table: str) -> str:
    return f"(SELECT len(list_distinct(json_keys(to_json(t)))) FROM {table} t LIMIT 1)"


@query(
    with_roles(
        _ALL_ROLES,
        S.assembled(),
        "SELECT families, fold, features::INTEGER AS features, judged, judged AS probabilities FROM (SELECT * FROM (VALUES "
        + ", ".join(
            [f"('all', {_width('fam_assembled')} - 2)", f"('none', {_width('fam_application')} - 2)"]
            # a family adds its columns but the key, the card family three ratios more
            + [f"('{f}', {_width('fam_application')} + {_width(t)} - 3 + {3 if f == 'cc' else 0})" for f, t in _FAMILY_TABLES.items()]
        )
        + f""") choices(families, features)), (SELECT 1 + {fold_sql('SK_ID_CURR')} AS fold, count(TARGET) AS judged FROM fam_application
        WHERE TARGET IS NOT NULL GROUP BY ALL)""",
    )
)
def ablation_rows(spark, folder):
    """Which features each choice has, and how many rows each of its models judges."""
    parts = []
    for name, result in _ablated(spark, folder).items():
        rows = result.out_of_fold.groupBy("fold").agg(
            F.count_distinct("SK_ID_CURR").alias("judged"), F.count_if(F.col("prediction").between(0, 1)).alias("probabilities")
        )
        parts.append(rows.select(F.lit(name).alias("families"), "fold", F.lit(len(result.features)).alias("features"), "judged", "probabilities"))
    return reduce(DataFrame.unionByName, parts)


@query()
def first_version_correlations(spark, folder):
    train, _ = first_version_tables(all_tables(spark, folder), S.PREV_HISTORY_VOCABULARY)
    return label_links(train)
