"""DuckDB counterparts of the feature families, written from the family definitions.

Each function returns named steps (common table expressions); the last one, named
like the family, holds its result. Division is DuckDB's own IEEE division. Fixed values (column
lists, category names, aggregates, score terms) are stated once, with the plans, and imported here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tallyloom.plans import names
from tallyloom.plans import score_terms as terms
from tallyloom.plans.balances import CARD_ALL, CARD_OWING, CARD_USED, PAYMENTS
from tallyloom.plans.bureau import ACTIVE_LOANS, ALL_LOANS, CLOSED_LOANS
from tallyloom.plans.previous_history import NUMERIC as PREVIOUS_HISTORY


def q(column: str) -> str:
    return '"' + column + '"'


def div(a: str, b: str) -> str:
    return f"nullif(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE), CAST('nan' AS DOUBLE))"


def score(rows, column: str) -> str:
    """Sum of the terms over the whole table, ranges by window."""
    parts = ["CAST(0 AS DOUBLE)"]
    for t in rows:
        x = f"CAST({q(t.column)} AS DOUBLE)"
        v = f"({x} / (max({x}) OVER () - min({x}) OVER ()))"
        low, lw, high, hw, other = (
            f"CAST('{float(n)!r}' AS DOUBLE)" for n in (t.low, t.low_weight, t.high, t.high_weight, t.other)
        )
        parts.append(
            f"CASE WHEN {v} IS NULL OR isnan({v}) OR isinf({v}) THEN 0e0 WHEN {v} < {low} THEN {lw} * {v}"
            f" WHEN {v} > {high} THEN {hw} * {v} ELSE {other} END"
        )
    return " + ".join(parts) + f" AS {q(column)}"


# function name -> SQL over a filtered or unfiltered column
def _agg(function: str, column: str, where: str | None) -> str:
    keep = f" FILTER (WHERE {where})" if where else ""
    if function == "mean":
        return f"nullif(avg(CAST({column} AS DOUBLE)){keep}, CAST('nan' AS DOUBLE))"
    if function == "sum":
        summed = f"coalesce(sum(CAST({column} AS DOUBLE)){keep}, 0e0)"
        return f"CASE WHEN count(*){keep} > 0 THEN {summed} END"
    if function == "var":
        return f"nullif(var_samp({column}){keep}, CAST('nan' AS DOUBLE))"
    if function == "nunique":
        return f"count(DISTINCT {column}){keep}"
    return f"{function}({column}){keep}"


def aggs(spec: Mapping[str, Sequence[str]], prefix: str, where: str | None = None) -> str:
    """Select list of each column's aggregates."""
    return ",\n  ".join(
        f"{_agg(f, column, where)} AS {q(f'{prefix}{column}_{f.upper()}')}" for column, functions in spec.items() for f in functions
    )


def shares(column: str, values, prefix: str, nan: bool, where: str | None = None) -> str:
    keep = f" FILTER (WHERE {where})" if where else ""
    out = []
    for v in values:
        hit = f"CASE WHEN {column} = '{v}' THEN 1e0 ELSE 0e0 END"
        out.append(f"avg({hit}){keep} AS {q(f'{prefix}{column}_{v}_MEAN')}")
    if nan:
        out.append(f"avg(CASE WHEN {column} IS NULL THEN 1e0 ELSE 0e0 END){keep} AS {q(f'{prefix}{column}_nan_MEAN')}")
    return ",\n  ".join(out)


def application() -> dict[str, str]:
    ext = "[EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]"
    codes = {
        f"codes_{c}": f"""SELECT {c} AS v, row_number() OVER (ORDER BY min(CASE WHEN TARGET IS NULL THEN 1 ELSE 0 END * 1099511627776 + SK_ID_CURR)) - 1 AS code
      FROM application WHERE CODE_GENDER IS DISTINCT FROM 'XNA' AND {c} IS NOT NULL GROUP BY {c}"""
        for c in ("CODE_GENDER", "FLAG_OWN_REALTY")
    }
    income = """CASE WHEN NAME_INCOME_TYPE IN ('Working', 'Commercial associate', 'Pensioner', 'State servant')
        THEN NAME_INCOME_TYPE ELSE 'others' END"""
    flags = ",\n  ".join(
        f"CASE WHEN {e} IS NOT DISTINCT FROM '{v}' THEN 1 ELSE 0 END AS {q(f'{c}_{v}')}"
        for c, e, values in (
            ("NAME_CONTRACT_TYPE", "NAME_CONTRACT_TYPE", ("Cash loans", "Revolving loans")),
            ("NAME_INCOME_TYPE", income, ("Commercial associate", "State servant", "Working")),
            (
                "NAME_EDUCATION_TYPE",
                "NAME_EDUCATION_TYPE",
                ("Higher education", "Incomplete higher", "Lower secondary", "Secondary / secondary special"),
            ),
        )
        for v in values
    )
    derived = f"""SELECT *,
      CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END AS employed,
      list_avg(list_filter({ext}, lambda e: e IS NOT NULL)) AS ext_mean,
      list_stddev_samp(list_filter({ext}, lambda e: e IS NOT NULL)) AS ext_std
      FROM application WHERE CODE_GENDER IS DISTINCT FROM 'XNA'"""
    final = f"""SELECT a.SK_ID_CURR, a.TARGET, coalesce(g.code, -1) AS CODE_GENDER, coalesce(r.code, -1) AS FLAG_OWN_REALTY,
      AMT_INCOME_TOTAL, AMT_CREDIT, AMT_ANNUITY, AMT_GOODS_PRICE, DAYS_BIRTH, employed AS DAYS_EMPLOYED,
      DAYS_REGISTRATION, DAYS_ID_PUBLISH, OWN_CAR_AGE, EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3,
      OBS_30_CNT_SOCIAL_CIRCLE, DEF_30_CNT_SOCIAL_CIRCLE, OBS_60_CNT_SOCIAL_CIRCLE, DEF_60_CNT_SOCIAL_CIRCLE,
      AMT_REQ_CREDIT_BUREAU_HOUR + AMT_REQ_CREDIT_BUREAU_DAY + AMT_REQ_CREDIT_BUREAU_WEEK + AMT_REQ_CREDIT_BUREAU_MON AS REQ_CNT,
      {div('AMT_CREDIT', 'AMT_ANNUITY')} AS NEW_CREDIT_TO_ANNUITY_RATIO,
      {div('AMT_CREDIT', 'AMT_GOODS_PRICE + 1')} AS NEW_CREDIT_TO_GOODS_RATIO,
      {div('AMT_CREDIT', 'AMT_INCOME_TOTAL + 1')} AS NEW_CREDIT_TO_INCOME,
      {div('employed', 'DAYS_BIRTH - 1')} AS NEW_EMPLOY_TO_BIRTH_RATIO,
      EXT_SOURCE_1 * EXT_SOURCE_2 AS NEW_SOURCES_PROD_12, EXT_SOURCE_2 * EXT_SOURCE_3 AS NEW_SOURCES_PROD_23,
      EXT_SOURCE_1 * EXT_SOURCE_3 AS NEW_SOURCES_PROD_13, ext_mean AS NEW_EXT_SOURCES_MEAN,
      coalesce(ext_std, (SELECT avg(ext_std) FROM app_derived)) AS NEW_SCORES_STD,
      {div('OWN_CAR_AGE', 'DAYS_BIRTH - 1')} AS NEW_CAR_TO_BIRTH_RATIO,
      {div('DAYS_LAST_PHONE_CHANGE', 'DAYS_BIRTH - 1')} AS NEW_PHONE_TO_BIRTH_RATIO,
      {div('DEF_30_CNT_SOCIAL_CIRCLE', 'OBS_30_CNT_SOCIAL_CIRCLE')} AS DEF_TO_OBS_30_RATIO,
      {div('DEF_60_CNT_SOCIAL_CIRCLE', 'OBS_60_CNT_SOCIAL_CIRCLE')} AS DEF_TO_OBS_60_RATIO,
      {flags}
      FROM app_derived a LEFT JOIN codes_CODE_GENDER g ON a.CODE_GENDER = g.v
      LEFT JOIN codes_FLAG_OWN_REALTY r ON a.FLAG_OWN_REALTY = r.v"""
    return {**codes, "app_derived": derived, "fam_application": final}


def bureau() -> dict[str, str]:
    ratios = []
    for column, functions in ACTIVE_LOANS.items():
        for f in functions:
            n = f"{column}_{f.upper()}"
            ratios.append(f"{div(f'ACTIVE_{n}', f'CLOSED_{n} + 1')} AS NEW_RATIO_BURO_{n}")
    # a name may stand twice in the lists
    dropped = ", ".join(q(c) for c in dict.fromkeys([*names.BUREAU_OPTIONAL, *names.BUREAU_DROPPED_AFTER_SCORE]))
    return {
        "bb_dpd": """SELECT SK_ID_BUREAU, coalesce(sum(CASE WHEN STATUS IS NOT DISTINCT FROM '0' THEN 0e0
          ELSE pow(CAST(1.2 AS DOUBLE), MONTHS_BALANCE) END), 0e0) AS DPD_SCORE FROM bureau_balance
          WHERE STATUS IS DISTINCT FROM 'C' AND STATUS IS DISTINCT FROM 'X' GROUP BY SK_ID_BUREAU""",
        "loans": """SELECT SK_ID_CURR, CREDIT_ACTIVE, CREDIT_TYPE, AMT_CREDIT_SUM_OVERDUE, DPD_SCORE,
          CASE WHEN DAYS_CREDIT_ENDDATE >= -200000 THEN DAYS_CREDIT_ENDDATE - DAYS_CREDIT END AS ENDDATE_DIFF,
          CASE WHEN DAYS_ENDDATE_FACT >= -4000 THEN DAYS_ENDDATE_FACT - DAYS_CREDIT END AS ENDDATE_FACT_DIFF,
          CASE WHEN AMT_CREDIT_MAX_OVERDUE <= 10000000 THEN AMT_CREDIT_MAX_OVERDUE END AS AMT_CREDIT_MAX_OVERDUE,
          CASE WHEN AMT_CREDIT_SUM <= 50000000 THEN AMT_CREDIT_SUM END AS AMT_CREDIT_SUM,
          CASE WHEN AMT_CREDIT_SUM_DEBT < 0 THEN 0e0 ELSE AMT_CREDIT_SUM_DEBT END AS AMT_CREDIT_SUM_DEBT,
          CASE WHEN AMT_CREDIT_SUM_LIMIT < 0 THEN 0e0 ELSE AMT_CREDIT_SUM_LIMIT END AS AMT_CREDIT_SUM_LIMIT,
          CASE WHEN AMT_ANNUITY BETWEEN 100 AND 10000000 THEN AMT_ANNUITY END AS AMT_ANNUITY
          FROM bureau LEFT JOIN bb_dpd USING (SK_ID_BUREAU)
          WHERE CREDIT_TYPE IN ('Consumer credit', 'Credit card') AND AMT_CREDIT_SUM > 1000""",
        "loan_aggs": f"""SELECT SK_ID_CURR, {aggs(ALL_LOANS, 'BURO_')},
          {shares('CREDIT_ACTIVE', names.CREDIT_ACTIVE, 'BURO_', False)},
          {shares('CREDIT_TYPE', names.CREDIT_TYPES_KEPT, 'BURO_', False)},
          {aggs(ACTIVE_LOANS, 'ACTIVE_', "CREDIT_ACTIVE = 'Active'")},
          {aggs(CLOSED_LOANS, 'CLOSED_', "CREDIT_ACTIVE = 'Closed'")}
          FROM loans GROUP BY SK_ID_CURR""",
        "loan_ratios": f"SELECT *, {', '.join(ratios)} FROM loan_aggs",
        "fam_bureau": f"""SELECT * EXCLUDE ({dropped}),
          {score(terms.BUREAU_SCORE, 'BUREAU_SCORE')} FROM loan_ratios""",
    }


# Aggregates of each product family; approved ones have the dates as well
PREVIOUS_CASH_APPROVED = {
    "AMT_ANNUITY": ["mean", "sum"],
    "AMT_APPLICATION": ["mean", "sum"],
    "AMT_CREDIT": ["mean", "sum"],
    "DAYS_LAST_DUE_DIFF": ["mean"],
    "DAYS_LAST_DUE_1ST_VERSION_DIFF": ["mean"],
    "DAYS_TERMINATION_DIFF": ["mean"],
    "CNT_PAYMENT": ["mean", "max"],
    "RATIO_ANN_TO_APP": ["mean"],
}
PREVIOUS_CASH_REFUSED = {
    "AMT_ANNUITY": ["mean", "sum"],
    "AMT_APPLICATION": ["mean", "sum"],
    "AMT_CREDIT": ["mean", "sum"],
    "CNT_PAYMENT": ["mean", "max"],
    "RATIO_ANN_TO_APP": ["mean"],
}
PREVIOUS_CONSUME_APPROVED = {
    "AMT_ANNUITY": ["mean", "sum"],
    "AMT_APPLICATION": ["mean", "sum"],
    "AMT_CREDIT": ["mean", "sum"],
    "RATE_DOWN_PAYMENT": ["mean", "max"],
    "DAYS_LAST_DUE_DIFF": ["mean"],
    "DAYS_LAST_DUE_1ST_VERSION_DIFF": ["mean"],
    "DAYS_TERMINATION_DIFF": ["mean"],
    "CNT_PAYMENT": ["mean", "max"],
    "RATIO_ANN_TO_APP": ["mean"],
}
PREVIOUS_CONSUME_REFUSED = {
    "AMT_ANNUITY": ["mean", "sum"],
    "AMT_APPLICATION": ["mean", "sum"],
    "AMT_CREDIT": ["mean", "sum"],
    "RATE_DOWN_PAYMENT": ["mean", "max"],
    "CNT_PAYMENT": ["mean", "max"],
    "RATIO_ANN_TO_APP": ["mean"],
}
PREVIOUS_REVOLVING_APPROVED = {
    "AMT_ANNUITY": ["mean", "sum"],
    "AMT_CREDIT": ["mean", "sum"],
    "DAYS_LAST_DUE_DIFF": ["mean"],
    "DAYS_TERMINATION_DIFF": ["mean"],
    "RATIO_ANN_TO_APP": ["mean"],
}
PREVIOUS_REVOLVING_REFUSED = {
    "AMT_ANNUITY": ["mean", "sum"],
    "AMT_CREDIT": ["mean", "sum"],
    "RATIO_ANN_TO_APP": ["mean"],
}


def _prev_family(outcome: str, family: str) -> str:
    prefix = f"PREV_{outcome}_{family}_"
    approved = outcome == "APPR"
    lists, extra = [], []
    if family == "CASH":
        spec = PREVIOUS_CASH_APPROVED if approved else PREVIOUS_CASH_REFUSED
        where = "NAME_CONTRACT_TYPE = 'Cash loans' AND PRODUCT_COMBINATION IS DISTINCT FROM 'Cash'"
        lists.append(shares("PRODUCT_COMBINATION", names.CASH_PRODUCTS, prefix, False))
        extra = [
            f"CAST(sum(CASE WHEN PRODUCT_COMBINATION = '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS {q(f'{prefix}PRODUCT_COMBINATION_{p}_SUM')}"
            for p in names.CASH_PRODUCTS
        ]
    elif family == "CONSUME":
        spec = PREVIOUS_CONSUME_APPROVED if approved else PREVIOUS_CONSUME_REFUSED
        where = "NAME_CONTRACT_TYPE = 'Consumer loans'"
        lists.append(shares("NAME_GOODS_CATEGORY", [*names.GOODS_KEPT, "Others"], prefix, False))
        lists.append(shares("PRODUCT_COMBINATION", names.CONSUMER_PRODUCTS, prefix, False))
    else:
        spec = PREVIOUS_REVOLVING_APPROVED if approved else PREVIOUS_REVOLVING_REFUSED
        where = "NAME_CONTRACT_TYPE = 'Revolving loans' AND AMT_CREDIT IS DISTINCT FROM 0"
        lists.append(shares("PRODUCT_COMBINATION", names.REVOLVING_PRODUCTS, prefix, False))
    status = {"APPR": "Approved", "REFU": "Refused"}[outcome]
    source = "prev"
    if family == "REVOLVING":
        source = f"(SELECT * REPLACE ({div('AMT_ANNUITY', 'AMT_CREDIT')} AS RATIO_ANN_TO_APP) FROM prev)"
    body = ",\n  ".join([aggs(spec, prefix), *lists, *extra])
    return f"""SELECT SK_ID_CURR, {body}, count(*) AS {prefix}COUNT FROM {source}
      WHERE NAME_CONTRACT_STATUS = '{status}' AND {where} GROUP BY SK_ID_CURR"""


def previous() -> dict[str, str]:
    day = "nullif({}, 365243)"
    first = day.format("DAYS_FIRST_DUE")
    goods = ", ".join(f"'{g}'" for g in names.GOODS_KEPT)
    steps = {
        "prev": f"""SELECT * REPLACE (CASE WHEN NAME_GOODS_CATEGORY IN ({goods}) THEN NAME_GOODS_CATEGORY
          ELSE 'Others' END AS NAME_GOODS_CATEGORY),
          {day.format('DAYS_LAST_DUE')} - {first} AS DAYS_LAST_DUE_DIFF,
          {day.format('DAYS_LAST_DUE_1ST_VERSION')} - {first} AS DAYS_LAST_DUE_1ST_VERSION_DIFF,
          {day.format('DAYS_TERMINATION')} - {first} AS DAYS_TERMINATION_DIFF,
          {div('AMT_ANNUITY', 'AMT_APPLICATION')} AS RATIO_ANN_TO_APP
          FROM previous_application WHERE NAME_CONTRACT_TYPE IS DISTINCT FROM 'XNA'"""
    }
    groups = [(o, f) for o in ("APPR", "REFU") for f in ("CASH", "CONSUME", "REVOLVING")]
    for o, f in groups:
        steps[f"prev_{o}_{f}"] = _prev_family(o, f)
    joined = f"prev_{groups[0][0]}_{groups[0][1]}" + "".join(
        f" FULL JOIN prev_{o}_{f} USING (SK_ID_CURR)" for o, f in groups[1:]
    )
    steps["prev_wide"] = f"SELECT * FROM {joined}"
    dropped = ", ".join(q(c) for c in names.PREVIOUS_DROPPED_AFTER_SCORE)
    steps["fam_previous"] = f"""SELECT * EXCLUDE ({dropped}), {score(terms.PREV_CASH_SCORE, 'PREV_CASH_SCORE')},
      {score(terms.PREV_CONSUME_SCORE, 'PREV_CONSUME_SCORE')} FROM prev_wide"""
    return steps


# Fixed values
POS_ARREARS = {
    "SK_DPD_MAX": ["max", "mean"],
    "SK_DPD_DEF_MAX": ["max", "mean"],
    "DPD_RATIO": ["max", "mean"],
}


def pos() -> dict[str, str]:
    latest = """SELECT SK_ID_CURR, SK_ID_PREV, {c} AS v FROM (SELECT *, row_number() OVER (
      PARTITION BY SK_ID_CURR, SK_ID_PREV ORDER BY MONTHS_BALANCE DESC NULLS LAST, {tie} DESC) AS rn
      FROM POS_CASH_balance WHERE {c} IS NOT NULL AND SK_ID_PREV IS NOT NULL) WHERE rn = 1"""
    # rows of one month have no order: completed before active before others
    state = "CASE NAME_CONTRACT_STATUS WHEN 'Completed' THEN 2 WHEN 'Active' THEN 1 ELSE 0 END"
    return {
        "pos_status": latest.format(c="NAME_CONTRACT_STATUS", tie=state),
        "pos_future": latest.format(c="CNT_INSTALMENT_FUTURE", tie="CNT_INSTALMENT_FUTURE"),
        "pos_contracts": """SELECT SK_ID_CURR, count(DISTINCT SK_ID_PREV) AS POS_CNT_PREV_ID, count(*) AS POS_COUNT
          FROM POS_CASH_balance GROUP BY SK_ID_CURR""",
        "pos_states": """SELECT c.SK_ID_CURR, count(*) FILTER (WHERE s.v = 'Completed') AS POS_CNT_COMPLETED,
          count(*) FILTER (WHERE s.v = 'Active' AND f.v > 0) AS POS_CNT_ACTIVED
          FROM (SELECT DISTINCT SK_ID_CURR, SK_ID_PREV FROM POS_CASH_balance WHERE SK_ID_PREV IS NOT NULL) c
          LEFT JOIN pos_status s USING (SK_ID_CURR, SK_ID_PREV)
          LEFT JOIN pos_future f USING (SK_ID_CURR, SK_ID_PREV) GROUP BY c.SK_ID_CURR""",
        "pos_arrears": f"""SELECT SK_ID_CURR, {aggs(POS_ARREARS, "POS_")}
          FROM (SELECT SK_ID_PREV, max(SK_ID_CURR) AS SK_ID_CURR, max(SK_DPD) AS SK_DPD_MAX,
            max(SK_DPD_DEF) AS SK_DPD_DEF_MAX, {div('max(SK_DPD)', 'max(SK_DPD_DEF)')} AS DPD_RATIO
            FROM POS_CASH_balance WHERE NAME_CONTRACT_STATUS = 'Active' AND SK_ID_PREV IS NOT NULL GROUP BY SK_ID_PREV)
          GROUP BY SK_ID_CURR""",
        "pos_wide": """SELECT *, CASE WHEN POS_CNT_COMPLETED < POS_CNT_PREV_ID THEN 1 ELSE 0 END AS POS_FLAG_UNCOMPLETED
          FROM pos_contracts LEFT JOIN pos_arrears USING (SK_ID_CURR) LEFT JOIN pos_states USING (SK_ID_CURR)""",
        "fam_pos": f"SELECT *, {score(terms.POS_SCORE, 'POS_SCORE')} FROM pos_wide",
    }


def installments() -> dict[str, str]:
    keys = "SK_ID_CURR, NUM_INSTALMENT_VERSION, NUM_INSTALMENT_NUMBER, DAYS_INSTALMENT, AMT_INSTALMENT"
    present = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    late, early = "count(*) FILTER (WHERE DPD > 0)", "count(*) FILTER (WHERE DBD > 0)"
    return {
        "ins_merged": f"""SELECT {keys}, coalesce(sum(AMT_PAYMENT), 0e0) AS AMT_PAYMENT,
          min(DAYS_ENTRY_PAYMENT) AS DAYS_ENTRY_PAYMENT FROM installments_payments WHERE {present} GROUP BY ALL""",
        "ins_rows": f"""SELECT *, CASE WHEN AMT_PAYMENT / (AMT_INSTALMENT + CAST('0.001' AS DOUBLE)) < 1
            THEN AMT_PAYMENT / (AMT_INSTALMENT + CAST('0.001' AS DOUBLE)) ELSE 1e0 END AS PAYMENT_PERC,
          coalesce(greatest(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0e0), 0e0) AS DPD,
          coalesce(greatest(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0e0), 0e0) AS DBD
          FROM ins_merged WHERE NOT (AMT_INSTALMENT = 67.5e0 AND DAYS_ENTRY_PAYMENT IS NULL)
          AND DAYS_INSTALMENT < -180 AND AMT_INSTALMENT > 1000""",
        "ins_aggs": f"""SELECT SK_ID_CURR, {aggs(PAYMENTS, 'INSTAL_')}, count(*) AS INSTAL_COUNT,
          CAST({late} AS DOUBLE) / ({early} + CAST('0.001' AS DOUBLE)) AS INSTAL_DPD_DBD_RATIO,
          {late} - {early} AS INSTAL_DPD_DBD_DIFF FROM ins_rows GROUP BY SK_ID_CURR""",
        "fam_installments": f"SELECT *, {score(terms.INSTAL_SCORE, 'INSTAL_SCORE')} FROM ins_aggs",
    }


def card() -> dict[str, str]:
    return {
        "cc_rows": """SELECT *, CASE WHEN AMT_PAYMENT_CURRENT IS NULL THEN NULL
          WHEN AMT_PAYMENT_TOTAL_CURRENT > AMT_PAYMENT_CURRENT THEN AMT_PAYMENT_TOTAL_CURRENT
          ELSE AMT_PAYMENT_CURRENT END AS AMT_PAYMENT_MAX FROM credit_card_balance""",
        "cc_raw": f"SELECT SK_ID_CURR, {aggs(CARD_ALL, 'CC_RAW_')}, count(*) AS CC_COUNT FROM cc_rows GROUP BY SK_ID_CURR",
        "cc_used": f"""SELECT SK_ID_CURR, {aggs(CARD_USED, 'CC_RM_UNUSE_')} FROM cc_rows
          WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM cc_rows WHERE AMT_BALANCE > 0) GROUP BY SK_ID_CURR""",
        "cc_owing": f"SELECT SK_ID_CURR, {aggs(CARD_OWING, 'CC_EXCEED_')} FROM cc_rows WHERE AMT_BALANCE > 0 GROUP BY SK_ID_CURR",
        "cc_wide": "SELECT * FROM cc_raw LEFT JOIN cc_used USING (SK_ID_CURR) LEFT JOIN cc_owing USING (SK_ID_CURR)",
        "fam_card": f"SELECT *, {score(terms.CC_SCORE, 'CC_SCORE')} FROM cc_wide",
    }


def loan_history() -> dict[str, str]:
    return {
        "ended": """SELECT *, CASE WHEN DAYS_CREDIT_ENDDATE < 0 THEN 0 ELSE 1 END AS running FROM bureau""",
        "gaps": """SELECT SK_ID_CURR, coalesce(DAYS_CREDIT_ENDDATE - lag(DAYS_CREDIT_ENDDATE) OVER (
            PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT_ENDDATE ASC NULLS LAST, SK_ID_BUREAU), 0) AS gap
          FROM ended WHERE running = 1""",
        "gap_means": "SELECT SK_ID_CURR, avg(gap) AS AVG_ENDDATE_FUTURE FROM gaps GROUP BY SK_ID_CURR",
        "loan_sums": f"""SELECT SK_ID_CURR, count(DAYS_CREDIT) AS BUREAU_LOAN_COUNT,
          count(DISTINCT CREDIT_TYPE) AS BUREAU_LOAN_TYPES,
          {div('count(DAYS_CREDIT)', 'count(DISTINCT CREDIT_TYPE)')} AS AVERAGE_LOAN_TYPE,
          avg(CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 0 ELSE 1 END) AS ACTIVE_LOANS_PERCENTAGE,
          avg(running) AS CREDIT_ENDDATE_PERCENTAGE,
          {div('coalesce(sum(AMT_CREDIT_SUM_DEBT), 0)', 'coalesce(sum(AMT_CREDIT_SUM), 0)')} AS DEBT_CREDIT_RATIO,
          {div('coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0)',
               '(coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) + coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0))')} AS OVERDUE_DEBT_RATIO,
          avg(coalesce(CNT_CREDIT_PROLONG, 0)) AS AVG_CREDITDAYS_PROLONGED
          FROM ended GROUP BY SK_ID_CURR""",
        "fam_loan_history": "SELECT * FROM loan_sums LEFT JOIN gap_means USING (SK_ID_CURR)",
    }


def missed_flag() -> dict[str, str]:
    return {
        "late": """SELECT DISTINCT SK_ID_BUREAU FROM bureau_balance
          WHERE coalesce(STATUS, 'missing') NOT IN ('X', 'C', '0')""",
        "fam_missed": """SELECT SK_ID_CURR, max(CASE WHEN SK_ID_BUREAU IN (SELECT SK_ID_BUREAU FROM late) THEN 1
          ELSE 0 END) AS FLAG_MISSED FROM bureau GROUP BY SK_ID_CURR""",
    }


PREV_HISTORY_VOCABULARY = {
    "NAME_CONTRACT_TYPE": ["Cash loans", "Consumer loans", "Revolving loans", "XNA"],
    "NAME_CONTRACT_STATUS": ["Approved", "Canceled", "Refused"],
    "NAME_GOODS_CATEGORY": [*names.GOODS_KEPT, "Weapon", "Fitness"],
    "PRODUCT_COMBINATION": ["Cash", *names.CASH_PRODUCTS, *names.CONSUMER_PRODUCTS, *names.REVOLVING_PRODUCTS],
}


def previous_history() -> dict[str, str]:
    ratios = []
    for column, functions in PREVIOUS_HISTORY.items():
        for f in functions:
            n = f"{column}_{f.upper()}"
            ratios.append(f"{div(f'APPROVED_{n}', f'REFUSED_{n}')} AS NEW_RATIO_PREV_{n}")
    cats = ",\n".join(shares(c, v, "PREV_", True) for c, v in PREV_HISTORY_VOCABULARY.items())
    return {
        "prev_rows": f"SELECT *, {div('AMT_APPLICATION', 'AMT_CREDIT')} AS APP_CREDIT_PERC FROM previous_application",
        "prev_sets": f"""SELECT SK_ID_CURR, {aggs(PREVIOUS_HISTORY, 'PREV_')}, {cats},
          {aggs(PREVIOUS_HISTORY, 'APPROVED_', "NAME_CONTRACT_STATUS = 'Approved'")},
          {aggs(PREVIOUS_HISTORY, 'REFUSED_', "NAME_CONTRACT_STATUS = 'Refused'")}
          FROM prev_rows GROUP BY SK_ID_CURR""",
        "fam_previous_history": f"SELECT *, {', '.join(ratios)} FROM prev_sets",
    }


def assembled() -> dict[str, str]:
    income = "AMT_INCOME_TOTAL"
    return {
        **application(), **bureau(), **previous(), **pos(), **installments(), **card(),
        "fam_assembled": f"""SELECT *,
          {div('CC_RAW_AMT_BALANCE_MEAN', income)} AS MIX_CC_BAL_MEAN_TO_INCOME,
          {div('CC_RAW_AMT_BALANCE_MAX', income)} AS MIX_CC_BAL_MAX_TO_INCOME,
          {div('CC_RAW_AMT_TOTAL_RECEIVABLE_MEAN', income)} AS MIX_CC_TOTAL_RECEIVABLE_MEAN_TO_INCOME
          FROM fam_application LEFT JOIN fam_bureau USING (SK_ID_CURR) LEFT JOIN fam_previous USING (SK_ID_CURR)
          LEFT JOIN fam_pos USING (SK_ID_CURR) LEFT JOIN fam_installments USING (SK_ID_CURR)
          LEFT JOIN fam_card USING (SK_ID_CURR)""",
    }
