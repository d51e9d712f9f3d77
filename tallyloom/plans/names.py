"""Column lists and category vocabularies.

Fixed values: every name below has to equal the name used in the data.
"""

# application columns without a visible link to the label
APPLICATION_USELESS = [
    "NAME_TYPE_SUITE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "REGION_POPULATION_RELATIVE",
    "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE",
    "FLAG_OWN_CAR", "FLAG_EMAIL", "CNT_FAM_MEMBERS", "REGION_RATING_CLIENT",
    "REGION_RATING_CLIENT_W_CITY", "WEEKDAY_APPR_PROCESS_START", "HOUR_APPR_PROCESS_START",
    "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
    "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY",
    "BASEMENTAREA_AVG", "YEARS_BEGINEXPLUATATION_AVG", "YEARS_BUILD_AVG", "COMMONAREA_AVG",
    "ELEVATORS_AVG", "ENTRANCES_AVG", "FLOORSMAX_AVG", "FLOORSMIN_AVG", "LANDAREA_AVG",
    "LIVINGAPARTMENTS_AVG", "LIVINGAREA_AVG", "NONLIVINGAPARTMENTS_AVG", "NONLIVINGAREA_AVG",
    "APARTMENTS_MODE", "APARTMENTS_AVG", "BASEMENTAREA_MODE", "YEARS_BEGINEXPLUATATION_MODE",
    "YEARS_BUILD_MODE", "COMMONAREA_MODE", "ELEVATORS_MODE", "ENTRANCES_MODE", "FLOORSMAX_MODE",
    "FLOORSMIN_MODE", "LANDAREA_MODE", "LIVINGAPARTMENTS_MODE", "LIVINGAREA_MODE",
    "NONLIVINGAPARTMENTS_MODE", "NONLIVINGAREA_MODE", "APARTMENTS_MEDI", "BASEMENTAREA_MEDI",
    "YEARS_BEGINEXPLUATATION_MEDI", "YEARS_BUILD_MEDI", "COMMONAREA_MEDI", "ELEVATORS_MEDI",
    "ENTRANCES_MEDI", "FLOORSMAX_MEDI", "FLOORSMIN_MEDI", "LANDAREA_MEDI", "LIVINGAPARTMENTS_MEDI",
    "LIVINGAREA_MEDI", "NONLIVINGAPARTMENTS_MEDI", "NONLIVINGAREA_MEDI", "FONDKAPREMONT_MODE",
    "HOUSETYPE_MODE", "TOTALAREA_MODE", "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE",
    "DAYS_LAST_PHONE_CHANGE", "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_4", "FLAG_DOCUMENT_5",
    "FLAG_DOCUMENT_7", "FLAG_DOCUMENT_8", "FLAG_DOCUMENT_9", "FLAG_DOCUMENT_10", "FLAG_DOCUMENT_11",
    "FLAG_DOCUMENT_12", "FLAG_DOCUMENT_13", "FLAG_DOCUMENT_14", "FLAG_DOCUMENT_15",
    "FLAG_DOCUMENT_16", "FLAG_DOCUMENT_17", "FLAG_DOCUMENT_18", "FLAG_DOCUMENT_19",
    "FLAG_DOCUMENT_20", "FLAG_DOCUMENT_21", "AMT_REQ_CREDIT_BUREAU_HOUR",
    "AMT_REQ_CREDIT_BUREAU_DAY", "AMT_REQ_CREDIT_BUREAU_WEEK", "AMT_REQ_CREDIT_BUREAU_MON",
    "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_YEAR",
]

APPLICATION_OPTIONAL = [
    "CNT_CHILDREN", "ORGANIZATION_TYPE", "OCCUPATION_TYPE", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_6",
]

APPLICATION_INDICATORS_DROPPED = [
    "NAME_EDUCATION_TYPE_Academic degree", "NAME_INCOME_TYPE_Pensioner", "NAME_INCOME_TYPE_others",
    "NAME_INCOME_TYPE_nan", "NAME_EDUCATION_TYPE_nan", "NAME_INCOME_TYPE_nan",
    "NAME_CONTRACT_TYPE_nan",
]

BUREAU_USELESS = ["BURO_CREDIT_TYPE_nan_MEAN", "BURO_CREDIT_ACTIVE_nan_MEAN"]

BUREAU_OPTIONAL = [
    "BURO_AMT_CREDIT_MAX_OVERDUE_MEAN", "BURO_AMT_ANNUITY_MAX", "BURO_AMT_ANNUITY_MEAN",
    "BURO_AMT_CREDIT_MAX_OVERDUE_MEAN", "BURO_AMT_CREDIT_SUM_MAX", "BURO_AMT_CREDIT_SUM_MEAN",
    "BURO_AMT_CREDIT_SUM_SUM", "BURO_AMT_CREDIT_SUM_LIMIT_MEAN", "BURO_CREDIT_ACTIVE_Bad debt_MEAN",
    "BURO_AMT_CREDIT_SUM_LIMIT_SUM", "BURO_CREDIT_ACTIVE_Bad debt_MEAN",
    "BURO_AMT_CREDIT_SUM_OVERDUE_MEAN",
]

BUREAU_DROPPED_AFTER_SCORE = [
    "CLOSED_AMT_CREDIT_SUM_OVERDUE_MEAN", "CLOSED_AMT_CREDIT_SUM_LIMIT_SUM",
    "NEW_RATIO_BURO_AMT_CREDIT_SUM_OVERDUE_MEAN",
]

# kept for completeness: no plan uses it
PREVIOUS_USELESS = [
    "PREV_NAME_CONTRACT_TYPE_nan_MEAN", "PREV_NAME_CONTRACT_STATUS_nan_MEAN",
    "PREV_NAME_CLIENT_TYPE_nan_MEAN", "PREV_NAME_GOODS_CATEGORY_nan_MEAN",
    "PREV_PRODUCT_COMBINATION_nan_MEAN",
]

PREVIOUS_UNUSED_INPUT = [
    "WEEKDAY_APPR_PROCESS_START", "HOUR_APPR_PROCESS_START", "FLAG_LAST_APPL_PER_CONTRACT",
    "NFLAG_LAST_APPL_IN_DAY", "NAME_CASH_LOAN_PURPOSE", "DAYS_DECISION", "NAME_PAYMENT_TYPE",
    "NAME_SELLER_INDUSTRY", "NAME_TYPE_SUITE", "NAME_PORTFOLIO", "NAME_PRODUCT_TYPE",
    "CHANNEL_TYPE", "NAME_YIELD_GROUP", "SELLERPLACE_AREA", "RATE_INTEREST_PRIMARY",
    "RATE_INTEREST_PRIVILEGED", "CODE_REJECT_REASON", "NAME_CLIENT_TYPE",
]

PREVIOUS_DROPPED_AFTER_SCORE = [
    "PREV_APPR_CONSUME_NAME_GOODS_CATEGORY_Homewares_MEAN",
    "PREV_APPR_CONSUME_NAME_GOODS_CATEGORY_Medical Supplies_MEAN",
    "PREV_APPR_CONSUME_NAME_GOODS_CATEGORY_XNA_MEAN",
    "PREV_APPR_REVOLVING_COUNT",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Furniture_MEAN",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Others_MEAN",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Vehicles_MEAN",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Jewelry_MEAN",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Homewares_MEAN",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Clothing and Accessories_MEAN",
    "PREV_REFU_CONSUME_PRODUCT_COMBINATION_POS other with interest_MEAN",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Auto Accessories_MEAN",
    "PREV_REFU_CONSUME_PRODUCT_COMBINATION_POS industry without interest_MEAN",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Medical Supplies_MEAN",
    "PREV_REFU_CONSUME_PRODUCT_COMBINATION_POS others without interest_MEAN",
    "PREV_REFU_CONSUME_NAME_GOODS_CATEGORY_Construction Materials_MEAN",
    "PREV_APPR_CONSUME_PRODUCT_COMBINATION_POS others without interest_MEAN",
    "PREV_REFU_CONSUME_PRODUCT_COMBINATION_POS household without interest_MEAN",
    "PREV_APPR_CASH_PRODUCT_COMBINATION_Cash Street: middle_SUM",
    "PREV_APPR_REVOLVING_RATIO_ANN_TO_APP_MEAN",
    "PREV_REFU_CASH_PRODUCT_COMBINATION_Cash Street: low_SUM",
    "PREV_REFU_CASH_PRODUCT_COMBINATION_Cash X-Sell: low_SUM",
    "PREV_REFU_CASH_PRODUCT_COMBINATION_Cash X-Sell: middle_SUM",
    "PREV_APPR_REVOLVING_DAYS_TERMINATION_DIFF_MEAN",
]

CARD_UNUSED_INPUT = [
    "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT",
    "CNT_DRAWINGS_ATM_CURRENT", "CNT_DRAWINGS_CURRENT", "CNT_DRAWINGS_OTHER_CURRENT",
    "CNT_DRAWINGS_POS_CURRENT", "CNT_INSTALMENT_MATURE_CUM", "NAME_CONTRACT_STATUS",
]

# category vocabularies
INCOME_TYPES_KEPT = ["Working", "Commercial associate", "Pensioner", "State servant"]
EDUCATION_TYPES = [
    "Academic degree", "Higher education", "Incomplete higher", "Lower secondary",
    "Secondary / secondary special",
]
CONTRACT_TYPES = ["Cash loans", "Revolving loans"]
APPLICATION_VOCABULARY = {
    "NAME_CONTRACT_TYPE": CONTRACT_TYPES,
    "NAME_INCOME_TYPE": sorted([*INCOME_TYPES_KEPT, "others"]),
    "NAME_EDUCATION_TYPE": EDUCATION_TYPES,
}
CREDIT_ACTIVE = ["Active", "Bad debt", "Closed", "Sold"]
CREDIT_TYPES_KEPT = ["Consumer credit", "Credit card"]
GOODS_KEPT = [
    "XNA", "Mobile", "Consumer Electronics", "Computers", "Audio/Video", "Furniture",
    "Photo / Cinema Equipment", "Construction Materials", "Clothing and Accessories",
    "Auto Accessories", "Jewelry", "Homewares", "Medical Supplies", "Vehicles",
]
CASH_PRODUCTS = [
    "Cash Street: high", "Cash Street: low", "Cash Street: middle",
    "Cash X-Sell: high", "Cash X-Sell: low", "Cash X-Sell: middle",
]
CONSUMER_PRODUCTS = [
    "POS household with interest", "POS household without interest", "POS industry with interest",
    "POS industry without interest", "POS mobile with interest", "POS mobile without interest",
    "POS other with interest", "POS others without interest",
]
REVOLVING_PRODUCTS = ["Card Street", "Card X-Sell"]

ID_AND_LABEL = ["TARGET", "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "index"]
MISSING_DAY = 365243
CHILD_COUNT_LABELS = {0: "zero", 1: "one", 2: "two", 3: "three"}
