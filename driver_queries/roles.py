"""The eight input tables, derived row by row from the driver's tables.

customer plays the applicants, orders the external loans and the previous
applications, lineitem the monthly balances and installments, events the card
rows. The derivation is plain SQL that both engines understand (amounts are
whole cents, so that sums are exact in any order); the feature families on top
are written separately for each engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.joins import lookup
from tallyloom.sources import schemas
from tallyloom.sources.tables import conform

# day 0 of all offsets
TODAY = "DATE '2001-08-02'"

SOURCES = {
    "application": ("customer", "nation"),
    "bureau": ("orders",),
    "bureau_balance": ("lineitem",),
    "previous_application": ("orders",),
    "POS_CASH_balance": ("lineitem", "orders"),
    "installments_payments": ("lineitem", "orders"),
    "credit_card_balance": ("events",),
}

_GOODS = """CASE day(o_orderdate)
      WHEN 1 THEN 'XNA' WHEN 2 THEN 'Mobile' WHEN 3 THEN 'Consumer Electronics' WHEN 4 THEN 'Computers'
      WHEN 5 THEN 'Audio/Video' WHEN 6 THEN 'Furniture' WHEN 7 THEN 'Photo / Cinema Equipment'
      WHEN 8 THEN 'Construction Materials' WHEN 9 THEN 'Clothing and Accessories'
      WHEN 10 THEN 'Auto Accessories' WHEN 11 THEN 'Jewelry' WHEN 12 THEN 'Homewares'
      WHEN 13 THEN 'Medical Supplies' WHEN 14 THEN 'Vehicles' WHEN 15 THEN 'Weapon'
      WHEN 16 THEN NULL WHEN 17 THEN 'Furniture' WHEN 18 THEN 'Auto Accessories' WHEN 19 THEN 'Mobile'
      WHEN 20 THEN 'Audio/Video' WHEN 21 THEN 'Photo / Cinema Equipment' WHEN 22 THEN 'Fitness'
      ELSE 'XNA' END"""

_CASH = """CASE month(o_orderdate) WHEN 1 THEN 'Cash' WHEN 2 THEN NULL
      WHEN 3 THEN 'Cash X-Sell: low' WHEN 4 THEN 'Cash X-Sell: low'
      WHEN 5 THEN 'Cash X-Sell: middle' WHEN 6 THEN 'Cash X-Sell: middle' WHEN 7 THEN 'Cash X-Sell: high'
      WHEN 8 THEN 'Cash Street: low' WHEN 9 THEN 'Cash Street: low' WHEN 10 THEN 'Cash Street: middle'
      ELSE 'Cash Street: high' END"""

_POS = """CASE month(o_orderdate)
      WHEN 1 THEN 'POS household with interest' WHEN 2 THEN 'POS household without interest'
      WHEN 3 THEN 'POS industry with interest' WHEN 4 THEN 'POS industry without interest'
      WHEN 5 THEN 'POS mobile with interest' WHEN 6 THEN 'POS mobile without interest'
      WHEN 7 THEN 'POS other with interest' WHEN 8 THEN 'POS others without interest' WHEN 9 THEN NULL
      WHEN 10 THEN 'POS mobile with interest' ELSE 'POS household without interest' END"""


def _days(engine: str, moment: str) -> str:
    if engine == "spark":
        return f"datediff({moment}, {TODAY})"
    return f"CAST(date_diff('day', {TODAY}, CAST({moment} AS DATE)) AS INTEGER)"


def role_sql(engine: str) -> dict[str, str]:
    """SELECT text per role for ``spark`` or ``duckdb``."""
    ordered, shipped = _days(engine, "o_orderdate"), _days(engine, "l_shipdate")
    contract = f"""CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash loans' WHEN '2-HIGH' THEN 'Cash loans'
      WHEN '3-MEDIUM' THEN 'Consumer loans' WHEN '5-LOW' THEN 'Revolving loans'
      ELSE CASE WHEN month(o_orderdate) < 4 THEN 'XNA' WHEN month(o_orderdate) < 6 THEN NULL
                ELSE 'Consumer loans' END END"""
    return {
        "application": """
    SELECT c_custkey AS SK_ID_CURR,
      CASE WHEN c_mktsegment <> 'MACHINERY' THEN CASE WHEN c_acctbal - 100 * c_nationkey + 6000 * sin(c_custkey) < 0 THEN 1 ELSE 0 END END AS TARGET,
      CASE WHEN c_acctbal < 5000 THEN 'Cash loans' WHEN c_acctbal < 9500 THEN 'Revolving loans' END AS NAME_CONTRACT_TYPE,
      CASE WHEN c_nationkey < 12 THEN 'F' WHEN c_nationkey < 23 THEN 'M' WHEN c_nationkey = 23 THEN 'XNA' END AS CODE_GENDER,
      CASE WHEN c_acctbal > 3000 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
      CASE WHEN c_acctbal > 7000 THEN NULL WHEN c_nationkey > 10 THEN 'Y' ELSE 'N' END AS FLAG_OWN_REALTY,
      abs(round(c_acctbal * 100)) + 100000e0 AS AMT_INCOME_TOTAL,
      round(c_acctbal * 100) + 150000e0 AS AMT_CREDIT,
      CASE WHEN c_nationkey <> 7 THEN (c_nationkey + 1) * 1000e0 END AS AMT_ANNUITY,
      CASE WHEN c_nationkey <> 9 THEN round(c_acctbal * 100) + 140000e0 END AS AMT_GOODS_PRICE,
      CASE WHEN c_nationkey = 3 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Working'
           WHEN c_mktsegment = 'BUILDING' THEN 'Commercial associate' WHEN c_mktsegment = 'FURNITURE' THEN 'Pensioner'
           WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Businessman' ELSE 'State servant' END AS NAME_INCOME_TYPE,
      CASE n_regionkey WHEN 0 THEN 'Academic degree' WHEN 1 THEN 'Higher education' WHEN 2 THEN 'Incomplete higher'
           WHEN 3 THEN 'Lower secondary' ELSE 'Secondary / secondary special' END AS NAME_EDUCATION_TYPE,
      -(7000 + c_nationkey * 600) AS DAYS_BIRTH,
      CASE WHEN c_acctbal < 0 THEN 365243 ELSE -CAST(floor(c_acctbal / 10) AS INTEGER) END AS DAYS_EMPLOYED,
      c_nationkey * -100e0 AS DAYS_REGISTRATION,
      n_regionkey * -500 AS DAYS_ID_PUBLISH,
      CASE WHEN c_acctbal > 3000 THEN c_nationkey * 1e0 END AS OWN_CAR_AGE,
      CASE WHEN c_acctbal > 2000 THEN (round(c_acctbal * 100) + 100000e0) / 1100000e0 END AS EXT_SOURCE_1,
      CASE WHEN c_nationkey > 2 THEN c_nationkey / 25e0 END AS EXT_SOURCE_2,
      CASE WHEN c_mktsegment <> 'BUILDING' THEN (c_nationkey + n_regionkey) / 30e0 END AS EXT_SOURCE_3,
      n_regionkey * 1e0 AS OBS_30_CNT_SOCIAL_CIRCLE,
      CASE WHEN n_regionkey > 1 THEN 1e0 ELSE 0e0 END AS DEF_30_CNT_SOCIAL_CIRCLE,
      c_nationkey * 1e0 AS OBS_60_CNT_SOCIAL_CIRCLE,
      CASE WHEN c_nationkey > 5 THEN 2e0 ELSE 0e0 END AS DEF_60_CNT_SOCIAL_CIRCLE,
      CASE WHEN c_nationkey <> 4 THEN 1e0 END AS AMT_REQ_CREDIT_BUREAU_HOUR,
      n_regionkey * 1e0 AS AMT_REQ_CREDIT_BUREAU_DAY,
      c_nationkey * 1e0 AS AMT_REQ_CREDIT_BUREAU_WEEK,
      2e0 AS AMT_REQ_CREDIT_BUREAU_MON,
      -floor(abs(c_acctbal) / 10) * 1e0 AS DAYS_LAST_PHONE_CHANGE,
      CASE WHEN c_nationkey = 24 THEN 5 ELSE n_regionkey END AS CNT_CHILDREN
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "bureau": f"""
    SELECT o_orderkey AS SK_ID_BUREAU, o_custkey AS SK_ID_CURR,
      CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active'
           ELSE CASE WHEN o_totalprice < 150000 THEN 'Sold' WHEN o_totalprice < 300000 THEN 'Bad debt' END END AS CREDIT_ACTIVE,
      CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'Consumer credit'
           WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN 'Credit card' ELSE 'Mortgage' END AS CREDIT_TYPE,
      {ordered} AS DAYS_CREDIT,
      CASE WHEN month(o_orderdate) = 1 THEN NULL WHEN month(o_orderdate) = 2 AND o_orderstatus = 'P' THEN -300000e0
           ELSE {ordered} + floor(o_totalprice / 200) * 1e0 END AS DAYS_CREDIT_ENDDATE,
      CASE WHEN o_orderstatus = 'F' THEN CASE WHEN month(o_orderdate) = 5 THEN -5000e0
           ELSE {ordered} + floor(o_totalprice / 400) * 1e0 END END AS DAYS_ENDDATE_FACT,
      CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_totalprice > 450000 THEN 20000000e0
           ELSE floor(o_totalprice / 7) * 1e0 END END AS AMT_CREDIT_MAX_OVERDUE,
      CASE WHEN month(o_orderdate) = 4 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 0 END AS CNT_CREDIT_PROLONG,
      CASE WHEN o_orderpriority = '5-LOW' AND month(o_orderdate) = 3 THEN NULL
           WHEN month(o_orderdate) = 7 AND o_totalprice < 50000 THEN 900e0
           ELSE round(o_totalprice * 100) + 2000000e0 END AS AMT_CREDIT_SUM,
      CASE WHEN month(o_orderdate) <> 6 THEN round(o_totalprice * 100) - 5000000e0 END AS AMT_CREDIT_SUM_DEBT,
      CASE WHEN o_orderpriority = '2-HIGH' THEN round(o_totalprice * 100) - 10000000e0 END AS AMT_CREDIT_SUM_LIMIT,
      floor(o_totalprice / 11) * 1e0 AS AMT_CREDIT_SUM_OVERDUE,
      CASE WHEN o_orderpriority = '3-MEDIUM' THEN 50e0
           WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN 20000000e0
           ELSE floor(o_totalprice / 13) * 1e0 END AS AMT_ANNUITY
    FROM orders""",
        "bureau_balance": """
    SELECT l_orderkey AS SK_ID_BUREAU, -CAST(floor(l_quantity) AS INTEGER) AS MONTHS_BALANCE,
      CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'X' ELSE 'C' END
           WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'F' THEN '0' ELSE '1' END
           ELSE CASE WHEN l_linestatus = 'O' THEN '5' END END AS STATUS
    FROM lineitem""",
        "previous_application": f"""
    SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
      {contract} AS NAME_CONTRACT_TYPE,
      CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused'
           ELSE CASE WHEN o_totalprice < 400000 THEN 'Canceled' END END AS NAME_CONTRACT_STATUS,
      CASE {contract} WHEN 'Cash loans' THEN {_CASH} WHEN 'Consumer loans' THEN {_POS}
           WHEN 'Revolving loans' THEN CASE WHEN month(o_orderdate) < 7 THEN 'Card Street' ELSE 'Card X-Sell' END END AS PRODUCT_COMBINATION,
      {_GOODS} AS NAME_GOODS_CATEGORY,
      CASE WHEN day(o_orderdate) <> 20 THEN floor(o_totalprice / 17) * 1e0 END AS AMT_ANNUITY,
      CASE WHEN day(o_orderdate) <> 27 THEN round(o_totalprice * 100) END AS AMT_APPLICATION,
      CASE WHEN o_orderpriority = '5-LOW' AND day(o_orderdate) = 25 THEN 0e0
           WHEN o_orderpriority = '5-LOW' AND day(o_orderdate) = 26 THEN NULL
           ELSE round(o_totalprice * 100) + 100000e0 * day(o_orderdate) END AS AMT_CREDIT,
      round(o_totalprice * 100) - 20000000e0 AS AMT_DOWN_PAYMENT,
      round(o_totalprice * 100) + 100000e0 AS AMT_GOODS_PRICE,
      CASE WHEN month(o_orderdate) <> 8 THEN day(o_orderdate) / 64e0 END AS RATE_DOWN_PAYMENT,
      CASE WHEN day(o_orderdate) <> 30 THEN month(o_orderdate) * 6e0 END AS CNT_PAYMENT,
      month(o_orderdate) + 5 AS HOUR_APPR_PROCESS_START,
      {ordered} AS DAYS_DECISION,
      365243e0 AS DAYS_FIRST_DRAWING,
      CASE WHEN month(o_orderdate) = 9 THEN 365243e0 ELSE {ordered} + 30e0 END AS DAYS_FIRST_DUE,
      {ordered} + 30e0 * month(o_orderdate) AS DAYS_LAST_DUE_1ST_VERSION,
      CASE WHEN month(o_orderdate) = 10 THEN 365243e0 ELSE {ordered} + 25e0 * month(o_orderdate) END AS DAYS_LAST_DUE,
      CASE WHEN month(o_orderdate) <> 11 THEN {ordered} + 26e0 * month(o_orderdate) END AS DAYS_TERMINATION
    FROM orders""",
        "POS_CASH_balance": """
    SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, -l_linenumber AS MONTHS_BALANCE,
      CASE WHEN l_discount > 0.085 THEN NULL WHEN l_linestatus = 'F' THEN 0e0 ELSE floor(l_quantity) * 1e0 END AS CNT_INSTALMENT_FUTURE,
      CASE WHEN l_tax > 0.075 THEN NULL WHEN l_returnflag = 'R' THEN 'Completed' ELSE 'Active' END AS NAME_CONTRACT_STATUS,
      CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS INTEGER) - 10 ELSE 0 END AS SK_DPD,
      CASE WHEN l_quantity > 5 THEN CAST(l_quantity AS INTEGER) - 5 ELSE 0 END AS SK_DPD_DEF
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "installments_payments": f"""
    SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
      CASE WHEN l_discount < 0.085 THEN round(l_tax * 100) END AS NUM_INSTALMENT_VERSION,
      l_linenumber AS NUM_INSTALMENT_NUMBER,
      {ordered} * 1e0 AS DAYS_INSTALMENT,
      CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE {shipped} * 1e0 END AS DAYS_ENTRY_PAYMENT,
      CASE WHEN l_quantity < 5 THEN 900e0 WHEN l_quantity < 10 THEN 67.5e0 ELSE floor(l_quantity / 10) * 1500e0 END AS AMT_INSTALMENT,
      CASE WHEN l_returnflag <> 'N' THEN floor(l_extendedprice / 10) * 1e0 END AS AMT_PAYMENT
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "credit_card_balance": """
    SELECT event_id AS SK_ID_PREV, user_id AS SK_ID_CURR, -day(ts) AS MONTHS_BALANCE,
      CASE WHEN user_id < 20 THEN CASE WHEN event_type = 'view' THEN NULL ELSE -floor(value) * 1e0 END
           WHEN event_type = 'error' THEN -round(value * 100) WHEN event_type = 'signup' THEN 0e0
           ELSE round(value * 100) END AS AMT_BALANCE,
      20000e0 AS AMT_CREDIT_LIMIT_ACTUAL,
      CASE WHEN event_type = 'purchase' THEN round(value * 100) ELSE 0e0 END AS AMT_DRAWINGS_CURRENT,
      CASE WHEN event_type <> 'click' THEN floor(value * 5) * 1e0 END AS AMT_INST_MIN_REGULARITY,
      CASE WHEN event_type <> 'click' THEN floor(value * 30) * 1e0 END AS AMT_PAYMENT_CURRENT,
      CASE WHEN event_type <> 'view' THEN floor(value * 50) * 1e0 END AS AMT_PAYMENT_TOTAL_CURRENT,
      round(value * 100) + 10e0 AS AMT_TOTAL_RECEIVABLE
    FROM events""",
    }


_SCHEMAS = {**schemas.TABLES, "application": schemas.APPLICATION}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def ordered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their order's columns; one order may own very many lines."""
    lines = read(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    joined = lookup(lines, read(spark, folder, "orders"), "o_orderkey")
    return joined.withColumn("l_orderkey", joined["o_orderkey"])


def role(spark: SparkSession, folder: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """One derived input table with its declared schema; ``lines`` are those of ``ordered_lines``, if they are there already."""
    text = role_sql("spark")[name]
    if SOURCES[name] == ("lineitem", "orders"):
        text = text.replace("lineitem JOIN orders ON l_orderkey = o_orderkey", "lines")
        sources = {"lines": ordered_lines(spark, folder) if lines is None else lines}
    else:
        sources = {t: read(spark, folder, t) for t in SOURCES[name]}
    for table in sources:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}").replace(f"JOIN {table}", f"JOIN {{{table}}}")
    return conform(spark.sql(text, **sources), _SCHEMAS[name])


def tables(spark: SparkSession, folder: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    # the lines of hot orders are counted once for all tables made of them
    lines = ordered_lines(spark, folder) if any(SOURCES[n] == ("lineitem", "orders") for n in names) else None
    return {n: role(spark, folder, n, lines) for n in names}


def applications(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Labelled rows with the label column, and unlabelled rows without it."""
    everyone = role(spark, folder, "application")
    return everyone.filter("TARGET IS NOT NULL"), everyone.filter("TARGET IS NULL").drop("TARGET")


def all_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    train, test = applications(spark, folder)
    rest = tuple(n for n in SOURCES if n != "application")
    return {"application_train": train, "application_test": test, **tables(spark, folder, rest)}


def with_roles(names: tuple[str, ...], steps: dict[str, str], final: str) -> str:
    """DuckDB query: roles, then named steps, as common table expressions before ``final``."""
    texts = role_sql("duckdb")
    ctes = {**{n: texts[n] for n in names}, **steps}
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in ctes.items()) + f"\n{final}"
