"""Score definitions: which columns a score adds up, with which bounds and weights.

Fixed values. Columns: column, low bound, low weight, high bound, high weight, value
in between. A column may occur twice in one score; both terms count. Two terms have
a low bound without a low weight and a high weight at high bound 1; that is intended.
"""

from tallyloom.operators.score import ScoreTerm

BUREAU_SCORE = [
    ScoreTerm("ACTIVE_AMT_CREDIT_SUM_MEAN", 0.4, 0.4, 0.7, -0.2, 0),
    ScoreTerm("BURO_CREDIT_ACTIVE_Closed_MEAN", 0.3, 0.1, 0.8, -0.1, 0),
    ScoreTerm("ACTIVE_AMT_CREDIT_SUM_SUM", 0, 0, 0.7, 0.4, 0),
    ScoreTerm("BURO_AMT_CREDIT_SUM_DEBT_SUM", 0, 0, 0.7, 0.3, 0),
    ScoreTerm("ACTIVE_ENDDATE_DIFF_MEAN", 0.15, -0.1, 1, 0, 0),
    ScoreTerm("ACTIVE_AMT_CREDIT_MAX_OVERDUE_MEAN", 0, 0, 0.7, 0.5, 0),
    ScoreTerm("BURO_AMT_CREDIT_SUM_DEBT_MAX", 0.3, 0, 0.7, -0.1, 0.2),
    ScoreTerm("ACTIVE_AMT_CREDIT_SUM_MAX", 0.3, 0, 0.7, -0.2, 0.1),
    ScoreTerm("BURO_ENDDATE_FACT_DIFF_MEAN", 0, 0, 0.7, 0.25, 0),
    ScoreTerm("BURO_CREDIT_ACTIVE_Sold_MEAN", 0, 0, 0.7, 0.15, 0),
    ScoreTerm("ACTIVE_AMT_CREDIT_SUM_DEBT_MEAN", 0.1, -0.2, 0.7, 0.3, 0),
    ScoreTerm("CLOSED_AMT_CREDIT_MAX_OVERDUE_MEAN", 0.2, -0.1, 0.7, 0.1, 0),
    ScoreTerm("ACTIVE_AMT_CREDIT_SUM_LIMIT_MEAN", 0, 0, 0.8, -0.2, 0),
    ScoreTerm("CLOSED_AMT_CREDIT_SUM_MEAN", 0.3, 0.21, 1, 0, 0),
    ScoreTerm("CLOSED_AMT_CREDIT_SUM_MAX", 0, 0, 0.8, -0.1, 0),
    ScoreTerm("NEW_RATIO_BURO_ENDDATE_DIFF_MEAN", 0, 0, 0.8, -0.2, 0),
    ScoreTerm("ACTIVE_AMT_CREDIT_SUM_DEBT_SUM", 0.2, -0.2, 0.7, 0.3, 0),
    ScoreTerm("CLOSED_AMT_ANNUITY_MAX", 0.3, -0.1, 0.8, 0.1, 0),
    ScoreTerm("NEW_RATIO_BURO_AMT_CREDIT_MAX_OVERDUE_MEAN", 0, 0, 0.85, 0.6, 0),
    ScoreTerm("NEW_RATIO_BURO_AMT_CREDIT_SUM_SUM", 0.2, -0.15, 1, 0, 0),
    ScoreTerm("NEW_RATIO_BURO_AMT_CREDIT_SUM_LIMIT_MEAN", 0, 0, 0.85, -0.2, 0),
    ScoreTerm("NEW_RATIO_BURO_AMT_CREDIT_SUM_DEBT_SUM", 0, 0, 0.8, 0.35, 0),
    ScoreTerm("BURO_DPD_SCORE_MEAN", 0, 0, 0.7, 0.5, 0),
]

PREV_CASH_SCORE = [
    ScoreTerm("PREV_APPR_CASH_DAYS_LAST_DUE_1ST_VERSION_DIFF_MEAN", 0.3, -0.25, 0.6, 0.5, 0),
    ScoreTerm("PREV_APPR_CASH_PRODUCT_COMBINATION_Cash X-Sell: low_MEAN", 0, 0, 0.8, -0.2, 0),
    ScoreTerm("PREV_APPR_CASH_CNT_PAYMENT_MAX", 0, 0, 0.8, 0.2, 0),
    ScoreTerm("PREV_APPR_CASH_CNT_PAYMENT_MEAN", 0, 0, 0.9, 0.15, 0),
    ScoreTerm("PREV_REFU_CASH_PRODUCT_COMBINATION_Cash Street: high_MEAN", 0, 0, 0.7, 0.2, 0),
    ScoreTerm("PREV_APPR_CASH_DAYS_LAST_DUE_DIFF_MEAN", 0, 0, 0.7, -0.15, 0),
    ScoreTerm("PREV_APPR_CASH_AMT_CREDIT_SUM", 0, 0, 0.7, 0.3, 0),
    ScoreTerm("PREV_REFU_CASH_PRODUCT_COMBINATION_Cash X-Sell: high_MEAN", 0, 0, 0.7, 0.1, 0),
    ScoreTerm("PREV_REFU_CASH_PRODUCT_COMBINATION_Cash Street: low_MEAN", 0, 0, 0.9, -0.22, 0),
    ScoreTerm("PREV_APPR_CASH_AMT_ANNUITY_MEAN", 0.2, 0.1, 0.7, -0.1, 0),
    ScoreTerm("PREV_APPR_CASH_AMT_ANNUITY_SUM", 0.2, 0.1, 0.7, -0.1, 0),
    ScoreTerm("PREV_APPR_CASH_AMT_APPLICATION_SUM", 0, 0, 0.8, 0.15, 0),
    ScoreTerm("PREV_REFU_CASH_PRODUCT_COMBINATION_Cash X-Sell: low_MEAN", 0.2, 0, 1, 0.7, 0),
    ScoreTerm("PREV_REFU_CASH_PRODUCT_COMBINATION_Cash Street: low_MEAN", 0.2, 0.15, 0.8, -0.15, 0),
    ScoreTerm("PREV_REFU_CASH_CNT_PAYMENT_MEAN", 0, 0, 0.6, 0.16, 0),
    ScoreTerm("PREV_REFU_CONSUME_AMT_ANNUITY_MEAN", 0.2, 0.1, 1, 0, 0),
    ScoreTerm("PREV_APPR_CASH_PRODUCT_COMBINATION_Cash Street: high_MEAN", 0, 0, 0.7, 0.1, 0),
    ScoreTerm("PREV_REFU_CONSUME_AMT_CREDIT_SUM", 0.2, -0.1, 1, 0, 0),
]

PREV_CONSUME_SCORE = [
    ScoreTerm("PREV_APPR_CONSUME_CNT_PAYMENT_MAX", 0, 0, 0.7, 0.2, 0),
    ScoreTerm("PREV_APPR_CONSUME_AMT_APPLICATION_MEAN", 0.2, 0.15, 1, 0, 0),
    ScoreTerm("PREV_APPR_CONSUME_AMT_APPLICATION_SUM", 0.2, 0.1, 0.8, -0.07, 0),
    ScoreTerm("PREV_APPR_CASH_CNT_PAYMENT_MEAN", 0, 0, 0.6, 0.13, 0),
    ScoreTerm("PREV_REFU_CASH_AMT_ANNUITY_MEAN", 0.2, 0.1, 0.8, -0.1, 0),
    ScoreTerm("PREV_APPR_CONSUME_NAME_GOODS_CATEGORY_Furniture_MEAN", 0, 0, 0.8, -0.1, 0),
    ScoreTerm("PREV_APPR_CONSUME_NAME_GOODS_CATEGORY_Auto Accessories_MEAN", 0.2, -0.05, 1, 0, 0),
    ScoreTerm("PREV_REFU_CONSUME_RATE_DOWN_PAYMENT_MAX", 0, 0, 0.6, -0.1, 0),
    ScoreTerm("PREV_REFU_CONSUME_RATE_DOWN_PAYMENT_MEAN", 0, 0, 0.7, -0.05, 0),
    ScoreTerm("PREV_APPR_CONSUME_PRODUCT_COMBINATION_POS household without interest_MEAN", 0, 0, 0.7, -0.07, 0),
    ScoreTerm("PREV_APPR_CONSUME_PRODUCT_COMBINATION_POS mobile with interest_MEAN", 0, 0, 0.7, 0.05, 0),
    ScoreTerm("PREV_APPR_CONSUME_DAYS_LAST_DUE_1ST_VERSION_DIFF_MEAN", 0, 0, 0.8, 0.15, 0),
    ScoreTerm("PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Photo / Cinema Equipment_MEAN", 0, 0, 0.8, -0.1, 0),
    ScoreTerm("PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Audio/Video_MEAN", 0, 0, 0.8, 0.1, 0),
    ScoreTerm("PREV_APPR_REVOLVING_AMT_ANNUITY_SUM", 0, 0, 0.7, -0.2, 0),
    ScoreTerm("PREV_APPR_REVOLVING_AMT_ANNUITY_MEAN", 0.2, 0.1, 1, 0, 0),
    ScoreTerm("PREV_APPR_CONSUME_COUNT", 0, 0, 0.8, 0.03, 0),
    ScoreTerm("PREV_REFU_CONSUME_RATE_DOWN_PAYMENT_MAX", 0.3, 0.08, 1, 0, 0),
    ScoreTerm("PREV_REFU_CONSUME_RATE_DOWN_PAYMENT_MEAN", 0.3, 0.08, 0.8, -0.06, 0),
    ScoreTerm("PREV_REFU_CONSUME_AMT_APPLICATION_MEAN", 0.2, 0.07, 1, 0, 0),
    ScoreTerm("PREV_REFU_CONSUME_CNT_PAYMENT_MEAN", 0.2, 0, 1, -0.05, 0),
    ScoreTerm("PREV_REFU_CONSUME_CNT_PAYMENT_MAX", 0.2, -0.04, 0.8, -0.02, 0),
]

POS_SCORE = [
    ScoreTerm("POS_SK_DPD_DEF_MAX_MEAN", 0, 0, 0.8, 0.6, 0),
    ScoreTerm("POS_COUNT", 0.3, 0.2, 0.6, -0.1, 0),
    ScoreTerm("POS_SK_DPD_MAX_MEAN", 0, 0, 0.8, 0.2, 0),
]

INSTAL_SCORE = [
    ScoreTerm("INSTAL_DBD_MAX", 0.2, -0.2, 1, 0, 0),
    ScoreTerm("INSTAL_AMT_PAYMENT_SUM", 0.2, 0.2, 0.8, -0.2, 0),
    ScoreTerm("INSTAL_DPD_MEAN", 0, 0, 0.8, 0.2, 0),
    ScoreTerm("INSTAL_DPD_DBD_DIFF", 0.1, -0.1, 0.6, 0.15, 0),
    ScoreTerm("INSTAL_COUNT", 0, 0, 0.8, -0.3, 0),
    ScoreTerm("INSTAL_DBD_MEAN", 0, 0, 0.8, -0.15, 0),
    ScoreTerm("INSTAL_DBD_SUM", 0.2, 0.25, 1, 0, 0),
    ScoreTerm("INSTAL_PAYMENT_PERC_MEAN", 0.2, 0.18, 0.8, -0.1, 0),
    ScoreTerm("INSTAL_AMT_PAYMENT_MIN", 0, 0, 0.8, -0.15, 0),
    ScoreTerm("INSTAL_NUM_INSTALMENT_VERSION_NUNIQUE", 0, 0, 0.7, -0.2, 0),
    ScoreTerm("INSTAL_AMT_INSTALMENT_MEAN", 0, 0, 0.8, 0.15, 0),
    ScoreTerm("INSTAL_DPD_MAX", 0, 0, 0.8, 0.15, 0),
]

CC_SCORE = [
    ScoreTerm("CC_RAW_AMT_DRAWINGS_CURRENT_MAX", 0.2, -0.12, 1, 0, 0),
    ScoreTerm("CC_RAW_AMT_DRAWINGS_CURRENT_MEAN", 0, 0, 0.6, 0.3, 0),
    ScoreTerm("CC_RAW_AMT_BALANCE_MEAN", 0, 0, 0.8, 0.2, 0),
    ScoreTerm("CC_RM_UNUSE_AMT_PAYMENT_CURRENT_SUM", 0.4, 0.3, 1, 0, 0),
    ScoreTerm("CC_EXCEED_AMT_PAYMENT_CURRENT_SUM", 0.2, 0.15, 1, 0, 0),
    ScoreTerm("CC_EXCEED_AMT_BALANCE_MEAN", 0, 0, 0.8, 0.2, 0),
    ScoreTerm("CC_RAW_AMT_PAYMENT_TOTAL_CURRENT_MEAN", 0.2, 0.1, 1, 0, 0),
    ScoreTerm("CC_RAW_AMT_PAYMENT_TOTAL_CURRENT_MAX", 0, 0, 0.75, 0.2, 0),
    ScoreTerm("CC_COUNT", 0, 0, 0.9, 0.1, 0),
    ScoreTerm("CC_RAW_AMT_BALANCE_MAX", 0, 0, 0.85, 0.1, 0),
    ScoreTerm("CC_RM_UNUSE_AMT_TOTAL_RECEIVABLE_MEAN", 0, 0, 0.85, 0.1, 0),
    ScoreTerm("CC_RAW_AMT_DRAWINGS_CURRENT_SUM", 0, 0, 0.85, 0.1, 0),
    ScoreTerm("CC_RAW_AMT_TOTAL_RECEIVABLE_MAX", 0, 0, 0.85, 0.15, 0),
]
