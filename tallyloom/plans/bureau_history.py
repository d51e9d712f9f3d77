"""Ten loan-history features per applicant, and the missed-payment flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import scalars as X
from tallyloom.functions.aggregates import hits, mean, total
from tallyloom.operators.aggregate import group_by_present
from tallyloom.operators.joins import exists_flag
from tallyloom.operators.ordered import gap_from_earlier, gap_from_later


def day_gaps(bureau: DataFrame) -> DataFrame:
    """Per loan: days since the applicant's next later loan, and between future end dates."""
    running = F.expr(f"{X.one_unless('DAYS_CREDIT_ENDDATE < 0')} = 1")
    gaps = gap_from_later(bureau, "SK_ID_CURR", "DAYS_CREDIT", "SK_ID_BUREAU", "DAYS_DIFF")
    return gap_from_earlier(
        gaps, "SK_ID_CURR", "DAYS_CREDIT_ENDDATE", "SK_ID_BUREAU", "DAYS_ENDDATE_DIFF", running
    )


def loan_history(bureau: DataFrame) -> DataFrame:
    """The nine exported features in one aggregation, without sorting loans.

    The gaps between consecutive end dates add up to latest minus earliest, so
    their mean needs no order; and a median over rows that all repeat the
    applicant's own value is that value.
    """
    # missing end dates count as running, with a gap of 0
    is_running = X.one_unless("DAYS_CREDIT_ENDDATE < 0")
    running = f"{is_running} = 1"
    end = f"CASE WHEN {running} THEN DAYS_CREDIT_ENDDATE END"
    gap_sum = f"coalesce(double(max({end}) - min({end})), 0.0D)"
    debt, credit = total("AMT_CREDIT_SUM_DEBT"), total("AMT_CREDIT_SUM")
    overdue = total("AMT_CREDIT_SUM_OVERDUE")
    loans, kinds = "count(DAYS_CREDIT)", "count(DISTINCT CREDIT_TYPE)"
    features = {
        "BUREAU_LOAN_COUNT": loans,
        "BUREAU_LOAN_TYPES": kinds,
        "AVERAGE_LOAN_TYPE": X.ratio(loans, kinds),
        "ACTIVE_LOANS_PERCENTAGE": mean(X.one_unless("CREDIT_ACTIVE = 'Closed'")),
        "CREDIT_ENDDATE_PERCENTAGE": mean(is_running),
        "AVG_ENDDATE_FUTURE": f"try_divide({gap_sum}, double({hits(running)}))",
        "DEBT_CREDIT_RATIO": X.ratio(debt, credit),
        "OVERDUE_DEBT_RATIO": X.ratio(overdue, f"({debt} + {overdue})"),
        "AVG_CREDITDAYS_PROLONGED": mean(X.filled("CNT_CREDIT_PROLONG", 0)),
    }
    return group_by_present(bureau, "SK_ID_CURR").agg(
        *[F.expr(X.called(text, column)) for column, text in features.items()]
    )


def missed_payment_flag(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """1 for applicants with any loan that has a month in arrears, else 0."""
    late = balance.filter(X.differs("STATUS", "X", "C", "0"))
    loans = bureau.select("SK_ID_CURR", "SK_ID_BUREAU")
    flagged = exists_flag(loans, "SK_ID_BUREAU", late, "FLAG_MISSED")
    return group_by_present(flagged, "SK_ID_CURR").agg(F.max("FLAG_MISSED").alias("FLAG_MISSED"))
