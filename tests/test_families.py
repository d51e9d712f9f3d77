"""Feature families on small literal tables that hold the awkward rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from driver_queries import family_sql as S
from tallyloom.operators.aggregate import with_exprs
from tallyloom.plans import assembly, balances, names
from tallyloom.plans.application import application_features
from tallyloom.plans.bureau import bureau_aggregates, bureau_features, clean_bureau, overdue_history
from tallyloom.plans.bureau_history import day_gaps, loan_history, missed_payment_flag
from tallyloom.plans.first_version import clean_application, first_version_tables
from tallyloom.plans.previous import clean_previous, previous_features, product_aggregates
from tallyloom.plans.previous_history import previous_history
from tallyloom.sources.schemas import TABLES
from tests.oracle import differences, duck_table, spark_table

INF = float("inf")


def table(spark, name, columns, rows):
    """Literal rows of a declared table; unnamed columns are missing."""
    schema = TABLES[name]
    known = {f.name: f.dataType for f in schema.fields}
    at = columns.split()
    assert set(at) <= set(known), set(at) - set(known)
    full = [tuple(dict(zip(at, row)).get(c) for c in known) for row in rows]
    return spark.createDataFrame(full, schema)


def same_as_sql(df, tables, steps, family):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(f"{name}_rows", frame.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
    sql = "WITH " + ", ".join(f"{n} AS ({t})" for n, t in steps.items()) + f" SELECT * FROM {family}"
    assert differences(spark_table(df), duck_table(con, sql), tolerance=1e-9) == []


BUREAU = "SK_ID_BUREAU SK_ID_CURR CREDIT_ACTIVE CREDIT_TYPE DAYS_CREDIT DAYS_CREDIT_ENDDATE DAYS_ENDDATE_FACT " \
    "AMT_CREDIT_MAX_OVERDUE CNT_CREDIT_PROLONG AMT_CREDIT_SUM AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_LIMIT " \
    "AMT_CREDIT_SUM_OVERDUE AMT_ANNUITY"
CONSUMER, CARD = "Consumer credit", "Credit card"


@pytest.fixture(scope="module")
def bureau(spark):
    return table(
        spark,
        "bureau",
        BUREAU,
        [
            # 1: active only; 2: closed only; 3: both, with a closed mean of exactly -1
            (1, 1, "Active", CONSUMER, -100, 50.0, None, None, 0, 1001.0, -5.0, -1.0, 0.0, 99.0),
            (2, 1, "Active", CARD, -100, None, None, 2e7, None, 6e7, None, None, 3.0, 2e7),
            (3, 1, "Active", CONSUMER, -40, 80.0, None, 10.0, 1, 1000.0, 9.0, 9.0, 9.0, 500.0),
            (4, 2, "Closed", CARD, -300, -100.0, -120.0, 5.0, 0, 5000.0, 0.0, None, 0.0, None),
            (5, 2, "Closed", "Mortgage", -310, -200.0, -5000.0, 5.0, 0, 9000.0, 0.0, None, 0.0, None),
            (6, 3, "Closed", CONSUMER, -10, -11.0, -4001.0, 0.0, 3, 2000.0, 7.0, 1.0, 1.0, 101.0),
            (7, 3, "Active", CONSUMER, -20, 30.0, None, 0.0, 3, 3000.0, 7.0, 1.0, 1.0, 1e7),
            (8, 3, None, CONSUMER, -30, -300000.0, None, None, None, 4000.0, None, None, None, None),
            (9, 3, "Sold", CARD, -30, 20.0, None, None, None, None, None, None, None, None),
            (10, 3, "Bad debt", CARD, -30, 20.0, None, 4.0, 0, 1e5, 1.0, 0.0, 2.0, 300.0),
            (11, 4, "Closed", None, -5, None, None, None, None, 8000.0, None, None, None, None),
            (12, None, "Active", CONSUMER, -5, 3.0, None, None, 0, 8000.0, 1.0, 1.0, 1.0, 300.0),
        ],
    )


@pytest.fixture(scope="module")
def balance(spark):
    statuses = ["X", "C", "0", "1", "5", None]
    rows = [(1, -i, s) for i, s in enumerate(statuses)]
    rows += [(4, 0, "C"), (6, -12, "1"), (7, -1, "0"), (8, 0, None), (10, None, "2"), (None, 0, "5")]
    return table(spark, "bureau_balance", "SK_ID_BUREAU MONTHS_BALANCE STATUS", rows)


def test_bureau_against_sql(spark, bureau, balance):
    same_as_sql(
        bureau_features(bureau, balance),
        {"bureau": bureau.filter("SK_ID_CURR IS NOT NULL"), "bureau_balance": balance},
        S.bureau(),
        "fam_bureau",
    )


def test_bureau_details(spark, bureau, balance):
    clean = {r.SK_ID_BUREAU: r for r in clean_bureau(bureau).collect()}
    assert set(clean) == {1, 2, 4, 6, 7, 8, 10, 12}  # 1000 is not above 1000, Mortgage and NULL type are out
    assert clean[2].AMT_CREDIT_SUM is None and clean[1].AMT_CREDIT_SUM == 1001.0
    assert clean[1].AMT_CREDIT_SUM_DEBT == 0.0 and clean[2].AMT_CREDIT_SUM_DEBT is None
    assert clean[8].ENDDATE_DIFF is None and clean[6].ENDDATE_FACT_DIFF is None
    assert (clean[1].AMT_ANNUITY, clean[2].AMT_ANNUITY, clean[7].AMT_ANNUITY) == (None, None, 1e7)
    dpd = {r.SK_ID_BUREAU: r.DPD_SCORE for r in overdue_history(balance).collect()}
    assert dpd == pytest.approx({1: 1.2**-3 + 1.2**-4 + 1.2**-5, 6: 1.2**-12, 7: 0.0, 8: 1.0, 10: 0.0})
    wide = {r.SK_ID_CURR: r for r in bureau_aggregates(bureau, balance).collect()}
    assert set(wide) == {1, 2, 3}
    assert wide[2].ACTIVE_AMT_CREDIT_SUM_SUM is None and wide[1].CLOSED_AMT_CREDIT_SUM_SUM is None
    assert wide[2].CLOSED_AMT_CREDIT_SUM_LIMIT_SUM == 0.0
    # active 50 over closed (-1 + 1) is infinite
    assert wide[3].CLOSED_ENDDATE_DIFF_MEAN == -1.0 and wide[3].NEW_RATIO_BURO_ENDDATE_DIFF_MEAN == INF


def test_loan_history_against_sql(spark, bureau, balance):
    tables = {"bureau": bureau.filter("SK_ID_CURR IS NOT NULL"), "bureau_balance": balance}
    same_as_sql(loan_history(bureau), tables, S.loan_history(), "fam_loan_history")
    same_as_sql(missed_payment_flag(bureau, balance), tables, S.missed_flag(), "fam_missed")


def test_gap_mean_equals_the_mean_of_row_gaps(spark, bureau):
    """The telescoped mean and the row-by-row gaps agree."""
    rows = day_gaps(bureau).filter("SK_ID_CURR IS NOT NULL")
    want = {r[0]: r[1] for r in rows.groupBy("SK_ID_CURR").agg(F.avg("DAYS_ENDDATE_DIFF")).collect()}
    got = {r.SK_ID_CURR: r.AVG_ENDDATE_FUTURE for r in loan_history(bureau).collect()}
    assert got == want
    assert {r.SK_ID_BUREAU: r.DAYS_DIFF for r in rows.collect() if r.SK_ID_CURR == 1} == {3: 0, 1: 60, 2: 0}


def previous_rows(spark):
    columns = "SK_ID_PREV SK_ID_CURR NAME_CONTRACT_TYPE NAME_CONTRACT_STATUS NAME_GOODS_CATEGORY " \
        "PRODUCT_COMBINATION AMT_ANNUITY AMT_APPLICATION AMT_CREDIT AMT_DOWN_PAYMENT RATE_DOWN_PAYMENT " \
        "CNT_PAYMENT DAYS_FIRST_DUE DAYS_LAST_DUE_1ST_VERSION DAYS_LAST_DUE DAYS_TERMINATION"
    rows, i = [], 0
    cases = [("Cash loans", p) for p in ["Cash", None, *names.CASH_PRODUCTS]]
    cases += [("Consumer loans", p) for p in [None, *names.CONSUMER_PRODUCTS]]
    cases += [("Revolving loans", p) for p in [None, *names.REVOLVING_PRODUCTS]]
    cases += [("XNA", "Cash"), (None, "Cash")]
    goods = [*names.GOODS_KEPT, "Weapon", None]
    for kind, product in cases:
        for status in ("Approved", "Refused", "Canceled", None):
            i += 1
            applicant = 9 if status == "Refused" and i % 5 == 0 else i % 4
            asked = 0.0 if i % 7 == 0 else None if i % 11 == 0 else 100.0 * i
            granted = 0.0 if i % 6 == 0 else None if i % 13 == 0 else 90.0 * i
            due = 365243.0 if i % 3 == 0 else -10.0 * i
            rows.append(
                (
                    i, applicant, kind, status, goods[i % len(goods)], product,
                    None if i % 9 == 0 else 5.0 * i, asked, granted, -1.0 if i % 2 else 4.0,
                    i / 64, None if i % 8 == 0 else 6.0, due, -5.0 * i,
                    365243.0 if i % 4 == 0 else -4.0 * i, -3.0 * i,
                )
            )
    return table(spark, "previous_application", columns, rows)


def test_previous_against_sql(spark):
    previous = previous_rows(spark)
    same_as_sql(
        previous_features(previous), {"previous_application": previous}, S.previous(), "fam_previous"
    )
    wide = {r.SK_ID_CURR: r for r in product_aggregates(clean_previous(previous)).collect()}
    assert wide[9].PREV_APPR_CASH_COUNT is None and wide[9].PREV_APPR_CASH_AMT_CREDIT_SUM is None


def test_previous_history_discovers_its_vocabulary(spark):
    previous = previous_rows(spark).select(
        "SK_ID_CURR", "NAME_CONTRACT_STATUS", "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT",
        "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE", "HOUR_APPR_PROCESS_START", "RATE_DOWN_PAYMENT", "DAYS_DECISION",
        "CNT_PAYMENT", "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE",
        "DAYS_TERMINATION",
    )
    out = previous_history(previous)
    shares = [c for c in out.columns if c.startswith("PREV_NAME_CONTRACT_STATUS")]
    assert shares == [
        f"PREV_NAME_CONTRACT_STATUS_{s}_MEAN" for s in ("Approved", "Canceled", "Refused", "nan")
    ]
    total = out.agg(*[F.sum(c) for c in shares]).first()
    assert sum(total) == pytest.approx(out.count())


def test_pos_against_sql(spark):
    columns = "SK_ID_PREV SK_ID_CURR MONTHS_BALANCE CNT_INSTALMENT_FUTURE NAME_CONTRACT_STATUS SK_DPD SK_DPD_DEF"
    rows = [
        (10, 1, -1, None, None, 5, 0),  # latest status missing: the older one counts
        (10, 1, -2, 3.0, "Active", 4, 0),  # arrears over 0: infinite
        (11, 1, -1, 0.0, "Active", 0, 0),  # 0 over 0: missing; nothing left to pay: not active
        (12, 2, -1, 0.0, "Completed", 0, 0),
        (13, 2, -3, 0.0, "Completed", 9, 3),
        (14, 3, -1, 2.0, "Active", 9, 3),
        (14, 3, -2, 1.0, "Signed", 90, 30),
        (15, 4, -1, 2.0, "Signed", 1, 1),
    ]
    pos = table(spark, "POS_CASH_balance", columns, rows)
    same_as_sql(balances.pos_features(pos), {"POS_CASH_balance": pos}, S.pos(), "fam_pos")
    wide = {r.SK_ID_CURR: r for r in balances.pos_aggregates(pos).collect()}
    assert wide[1].POS_DPD_RATIO_MAX == INF and wide[1].POS_CNT_ACTIVED == 1
    assert wide[2].POS_FLAG_UNCOMPLETED == 0 and wide[2].POS_DPD_RATIO_MAX is None
    assert (wide[3].POS_CNT_ACTIVED, wide[3].POS_DPD_RATIO_MEAN) == (1, 3.0)


def test_installments_against_sql(spark):
    columns = "SK_ID_CURR NUM_INSTALMENT_VERSION NUM_INSTALMENT_NUMBER DAYS_INSTALMENT DAYS_ENTRY_PAYMENT " \
        "AMT_INSTALMENT AMT_PAYMENT"
    rows = [
        (1, 1.0, 1, -300.0, -310.0, 2000.0, 500.0),  # two payments of one period
        (1, 1.0, 1, -300.0, -290.0, 2000.0, 500.0),
        (1, 2.0, 2, -181.0, -170.0, 1001.0, 5000.0),  # overpaid, late
        (1, 2.0, 3, -180.0, -170.0, 1001.0, 900.0),  # too recent
        (1, 2.0, 4, -200.0, None, 67.5, None),
        (1, 2.0, 5, -200.0, None, 1500.0, None),  # never paid
        (2, 1.0, 1, -200.0, -200.0, 1000.0, 1000.0),  # too small: applicant vanishes
        (3, None, 1, -200.0, -200.0, 9000.0, 9000.0),  # missing key part: row vanishes
        (4, 1.0, 1, -400.0, -450.0, 3000.0, 3000.0),
    ]
    payments = table(spark, "installments_payments", columns, rows)
    same_as_sql(
        balances.installment_features(payments),
        {"installments_payments": payments},
        S.installments(),
        "fam_installments",
    )
    wide = {r.SK_ID_CURR: r for r in balances.installment_aggregates(payments).collect()}
    assert set(wide) == {1, 4} and wide[1].INSTAL_COUNT == 3
    assert wide[1].INSTAL_PAYMENT_PERC_MEAN == pytest.approx((1000 / 2000.001 + 1 + 0) / 3)
    assert (wide[1].INSTAL_DPD_MAX, wide[1].INSTAL_DBD_SUM) == (11.0, 10.0)


def test_card_against_sql(spark):
    columns = "SK_ID_PREV SK_ID_CURR AMT_BALANCE AMT_CREDIT_LIMIT_ACTUAL AMT_DRAWINGS_CURRENT " \
        "AMT_INST_MIN_REGULARITY AMT_PAYMENT_CURRENT AMT_PAYMENT_TOTAL_CURRENT AMT_TOTAL_RECEIVABLE"
    rows = [
        (1, 1, 0.0, 100.0, 0.0, 1.0, 5.0, 4.0, 1.0),  # never used
        (1, 1, 0.0, 100.0, 3.0, None, None, 4.0, 2.0),
        (2, 2, -5.0, 100.0, 1.0, 1.0, 5.0, 9.0, 1.0),
        (2, 2, 50.0, 20.0, 8.0, 2.0, None, None, 3.0),
        (2, 2, 10.0, 20.0, 2.0, 2.0, 7.0, None, 3.0),
        (3, 3, None, 20.0, 2.0, 2.0, 1.0, 2.0, 3.0),
    ]
    card = table(spark, "credit_card_balance", columns, rows)
    same_as_sql(balances.card_features(card), {"credit_card_balance": card}, S.card(), "fam_card")
    wide = {r.SK_ID_CURR: r for r in balances.card_aggregates(card).collect()}
    assert wide[1].CC_RM_UNUSE_AMT_PAYMENT_CURRENT_SUM is None and wide[1].CC_EXCEED_AMT_BALANCE_MEAN is None
    assert wide[2].CC_RAW_AMT_PAYMENT_MAX_MEAN == 8.0 and wide[2].CC_EXCEED_AMT_PAYMENT_CURRENT_SUM == 7.0
    flags = balances.card_rows(card).select("FLAG_EXCEED_LIMIT")
    assert [r[0] for r in flags.collect()] == [False, False, False, True, False, None]


APPLICATION = "SK_ID_CURR TARGET CODE_GENDER FLAG_OWN_CAR FLAG_OWN_REALTY NAME_CONTRACT_TYPE NAME_INCOME_TYPE " \
    "NAME_EDUCATION_TYPE AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE DAYS_BIRTH DAYS_EMPLOYED " \
    "OWN_CAR_AGE EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3 OBS_30_CNT_SOCIAL_CIRCLE DEF_30_CNT_SOCIAL_CIRCLE " \
    "AMT_REQ_CREDIT_BUREAU_HOUR AMT_REQ_CREDIT_BUREAU_DAY AMT_REQ_CREDIT_BUREAU_WEEK AMT_REQ_CREDIT_BUREAU_MON CNT_CHILDREN"


@pytest.fixture(scope="module")
def applications(spark):
    rows = [
        (5, 0, "F", "Y", "N", "Cash loans", "Working", "Higher education", 100.0, 1000.0, 0.0, 900.0, -9000, 365243,
         2.0, 0.1, 0.5, 0.9, 0.0, 0.0, 1.0, 0.0, 0.0, 2.0, 0),
        (3, 1, "M", "N", "Y", "Revolving loans", None, "Academic degree", 200.0, 500.0, 50.0, None, -8000, -300,
         None, 0.3, None, None, 2.0, 1.0, None, 1.0, 1.0, 1.0, 3),
        (4, 0, "XNA", "N", "Y", "Cash loans", "Pensioner", None, 200.0, 500.0, 50.0, None, -8000, -300,
         None, 0.3, None, None, 2.0, 1.0, None, 1.0, 1.0, 1.0, 4),
        (1, 0, None, "N", "Y", None, "Businessman", "Lower secondary", None, None, None, None, -8000, None,
         None, None, None, None, None, None, 1.0, 1.0, 1.0, 1.0, None),
    ]
    test = [(2, None, "M", "Y", None, "Cash loans", "State servant", None, 7.0, 70.0, 7.0, 7.0, -1, -5,
             1.0, 0.2, 0.4, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 9)]
    train = table(spark, "application_train", APPLICATION, rows)
    unlabelled = table(spark, "application_train", APPLICATION, test).drop("TARGET")
    return train, unlabelled


def test_application_against_sql(spark, applications):
    train, test = applications
    everyone = train.unionByName(test, allowMissingColumns=True)
    out = application_features(train, test)
    # 43 columns: the row number column of the original is left out on purpose
    assert len(out.columns) == 43
    same_as_sql(out, {"application": everyone}, S.application(), "fam_application")
    got = {r.SK_ID_CURR: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 5} and got[2].TARGET is None
    # first seen: labelled rows by applicant, so M (3) before F (5)
    assert [got[i].CODE_GENDER for i in (1, 2, 3, 5)] == [-1, 0, 0, 1]
    assert got[5].NEW_CREDIT_TO_ANNUITY_RATIO == INF and got[5].DEF_TO_OBS_30_RATIO is None
    assert got[5].DAYS_EMPLOYED is None and got[3].REQ_CNT is None
    assert got[3].NEW_SCORES_STD == got[1].NEW_SCORES_STD is not None


def test_assembly_of_any_families(spark, applications, bureau, balance):
    train, test = applications
    tables = {
        "application_train": train, "application_test": test, "bureau": bureau, "bureau_balance": balance,
        **{t: spark.createDataFrame([], TABLES[t]) for t in (
            "previous_application", "POS_CASH_balance", "installments_payments", "credit_card_balance")},
    }
    none = assembly.feature_table(tables, ())
    assert len(none.columns) == 43
    whole = assembly.feature_table(tables)
    # 43 + 42 + 116 + 12 + 19 + 21 + 3
    assert len(whole.columns) == 256 and whole.count() == 4
    only = assembly.feature_table(tables, ("bureau",))
    assert len(only.columns) == 85
    assert {r.SK_ID_CURR: r.BUREAU_SCORE is None for r in only.collect()}[5] is True
    with pytest.raises(ValueError, match="unknown families"):
        assembly.family_tables(tables, ("houses",))
    assert [c[0] for c in assembly.ablation_choices()] == ["all", "none", "bureau", "prev", "pos", "ins", "cc"]


def test_widths(spark):
    empty = {t: spark.createDataFrame([], schema) for t, schema in TABLES.items()}
    widths = {f: len(t.columns) - 1 for f, t in assembly.family_tables(empty).items()}
    assert widths == {"bureau": 42, "prev": 116, "pos": 12, "ins": 19, "cc": 21}
    assert len(names.APPLICATION_USELESS) == 94 and len(set(names.BUREAU_OPTIONAL)) == 10


def test_first_version(spark, applications, bureau, balance):
    train, test = applications
    cleaned = {r.SK_ID_CURR: r for r in clean_application(train).collect()}
    assert [cleaned[i].CNT_CHILDREN for i in (5, 3, 4, 1)] == ["zero", "three", "over_three", None]
    assert cleaned[3].DAYS_EMPLOYED == pytest.approx(300 / 365)
    previous = previous_rows(spark).select(
        *[c for c in TABLES["previous_application"].fieldNames() if c not in names.PREVIOUS_UNUSED_INPUT
          or c in ("HOUR_APPR_PROCESS_START", "DAYS_DECISION")]
    )
    tables = {
        "application_train": train, "application_test": test, "bureau": bureau, "bureau_balance": balance,
        "previous_application": previous,
    }
    left, right = first_version_tables(tables)
    assert set(left.columns) - set(right.columns) == {"TARGET"}
    assert (left.count(), right.count()) == (4, 1)
    assert not [t for _, t in left.dtypes if t == "string"]


def test_sum_order_of_families_does_not_matter(spark, applications, bureau, balance):
    base = application_features(*applications).select("SK_ID_CURR", "TARGET")
    a = loan_history(bureau)
    b = missed_payment_flag(bureau, balance)
    one = base.join(a, "SK_ID_CURR", "left").join(b, "SK_ID_CURR", "left")
    two = base.join(b, "SK_ID_CURR", "left").join(a, "SK_ID_CURR", "left").select(*one.columns)
    assert with_exprs(one, {}).exceptAll(two).count() == 0
