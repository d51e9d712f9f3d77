"""One query per operator, each on a whole driver table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries.registry import query
from driver_queries.roles import read
from tallyloom.functions import scalars as X
from tallyloom.functions.aggregates import hits, latest_present, total
from tallyloom.operators import evaluate as E
from tallyloom.operators import joins, ordered, profile, schema
from tallyloom.operators.aggregate import (
    agg_exprs,
    category_exprs,
    group_by_present,
    output_name,
    size_expr,
    with_exprs,
)
from tallyloom.operators.encode import factorize, label_encode_binary, one_hot, sparse_indicators
from tallyloom.operators.matrix import correlation_matrix
from tallyloom.operators.score import ScoreTerm, with_scores
from tallyloom.operators.staging import shared_folder
from tallyloom.plans.application import filled_with_mean
from tallyloom.sources import tables

TODAY_ORDERS = "DATE '2001-08-02'"


def _expr(text: str, alias: str):
    return F.expr(X.called(text, alias))


# --- scans, projection, schema ------------------------------------------------


@query("SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_acctbal AS balance FROM customer")
def scan_project_drop(spark, folder):
    renamed = read(spark, folder, "customer").selectExpr(
        "c_custkey AS customer_id", "c_name", "c_nationkey", "c_mktsegment AS segment", "c_acctbal AS balance"
    )
    return schema.drop_columns(renamed, ["c_name", "c_nationkey", "c_name"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def limited_scan(spark, folder):
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return schema.first_rows(orders, "o_orderkey", 100)


_PART_SCHEMA = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)


def _fresh_path(spark, label):
    return f"{shared_folder(spark).rstrip('/')}/tallyloom/{label}-{uuid.uuid4().hex}"


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_scan(spark, folder):
    """Written with the columns in another order, read back by declared schema."""
    path = _fresh_path(spark, "csv")
    part = read(spark, folder, "part").select("p_retailprice", "p_name", "p_size", "p_partkey")
    part.write.option("header", True).csv(path)
    return tables.read_csv(spark, path, _PART_SCHEMA)


@query("SELECT s_suppkey, s_nationkey, round(s_acctbal * 100) AS cents FROM supplier")
def cached_table(spark, folder):
    suppliers = read(spark, folder, "supplier").selectExpr(
        "s_suppkey", "s_nationkey", "round(s_acctbal * 100) AS cents"
    )
    return tables.write_cached(suppliers, _fresh_path(spark, "cache"), "suppliers")


@query("SELECT o_custkey AS SK_ID_CURR, max(o_orderkey) AS TARGET FROM orders GROUP BY o_custkey")
def prediction_sink(spark, folder):
    scored = (
        read(spark, folder, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("TARGET"))
    ).withColumnRenamed("o_custkey", "SK_ID_CURR")
    path = _fresh_path(spark, "predictions")
    tables.write_predictions(scored, path)
    written = T.StructType([T.StructField(c, T.LongType()) for c in ("SK_ID_CURR", "TARGET")])
    return tables.read_csv(spark, path, written)


# --- filters, cleaning, scalars -----------------------------------------------


@query(
    """SELECT p_partkey, p_type, size FROM (SELECT *, CASE WHEN p_size = 50 THEN NULL ELSE p_size END AS size FROM part)
    WHERE (size <> 10 OR size IS NULL) AND p_type IN ('ECONOMY', 'PROMO', 'SMALL') AND p_retailprice > 905
    AND NOT (coalesce(size = 7, false) AND p_type = 'SMALL')"""
)
def filter_keep_missing(spark, folder):
    part = with_exprs(read(spark, folder, "part"), {"size": X.sentinel_to_null("p_size", 50)})
    return (
        part.filter(X.differs("size", 10))
        .filter(X.one_of("p_type", ["ECONOMY", "PROMO", "SMALL"]))
        .filter("p_retailprice > 905")
        .filter("NOT (size <=> 7 AND p_type = 'SMALL')")
        .select("p_partkey", "p_type", "size")
    )


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_acctbal < 0 THEN 0e0 ELSE c_acctbal END AS cleaned,
    CASE WHEN c_acctbal > 9000 THEN -1e0 WHEN c_acctbal < 0 THEN 0e0 ELSE c_acctbal END AS filled FROM customer"""
)
def clean_ranges(spark, folder):
    plausible = X.null_when("c_acctbal", "c_acctbal > 9000")
    rows = with_exprs(read(spark, folder, "customer"), {"plausible": plausible})
    rows = with_exprs(rows, {"cleaned": X.zero_when_negative("plausible")})
    return with_exprs(rows, {"filled": X.filled("cleaned", -1.0)}).select("c_custkey", "cleaned", "filled")


@query(
    """SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN p_type ELSE 'others' END AS kind,
    CASE WHEN p_size > 3 THEN 'over_three' WHEN p_size = 1 THEN 'one' WHEN p_size = 2 THEN 'two' ELSE 'three' END AS size_label,
    CASE WHEN p_type = 'LARGE' THEN 0 ELSE 1 END AS not_large FROM part"""
)
def collapse_map(spark, folder):
    return read(spark, folder, "part").selectExpr(
        "p_partkey",
        X.called(X.collapse("p_type", ["ECONOMY", "PROMO"], "others"), "kind"),
        X.called(
            X.count_labels("p_size", {0: "zero", 1: "one", 2: "two", 3: "three"}, "over_three"), "size_label"
        ),
        X.called(X.one_unless("p_type = 'LARGE'"), "not_large"),
    )


@query(
    """WITH p AS (SELECT p_partkey, CASE WHEN p_size <> 50 THEN CAST(p_size AS DOUBLE) END AS size FROM part)
    SELECT p_partkey, coalesce(size, (SELECT avg(size) FROM p)) AS size FROM p"""
)
def impute_mean(spark, folder):
    sizes = read(spark, folder, "part").selectExpr(
        "p_partkey", X.called(X.sentinel_to_null("double(p_size)", 50.0), "size")
    )
    return filled_with_mean(sizes, "size")


_RATIO_SQL = """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_tax = 0 THEN NULL ELSE round(l_discount * 100) / round(l_tax * 100) END AS discount_to_tax,
    round(l_extendedprice * 100) / (l_quantity + 1) AS price_per_unit,
    l_quantity - 25 AS above_25, l_quantity * round(l_tax * 100) AS product, l_quantity / -365 AS scaled
    FROM lineitem"""


@query(_RATIO_SQL)
def ratios(spark, folder):
    # a divisor of zero is made missing first: infinities are left to the unit tests
    return read(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        X.called(X.ratio("round(l_discount * 100)", "nullif(round(l_tax * 100), 0)"), "discount_to_tax"),
        X.called(X.shifted_ratio("round(l_extendedprice * 100)", "l_quantity", 1.0), "price_per_unit"),
        "l_quantity - 25 AS above_25",
        "l_quantity * round(l_tax * 100) AS product",
        "l_quantity / -365 AS scaled",
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
    round(list_avg(list_filter([q, d, t], lambda e: e IS NOT NULL)), 9) AS row_mean,
    round(list_stddev_samp(list_filter([q, d, t], lambda e: e IS NOT NULL)), 9) AS row_std,
    CASE WHEN d IS NULL THEN NULL WHEN t > d THEN t ELSE d END AS row_max, q + d + t AS row_sum
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_quantity, 50) AS q, nullif(round(l_discount * 100), 0) AS d,
      nullif(round(l_tax * 100), 0) AS t FROM lineitem)"""
)
def row_stats(spark, folder):
    rows = read(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "nullif(l_quantity, 50) AS q",
        "nullif(round(l_discount * 100), 0) AS d",
        "nullif(round(l_tax * 100), 0) AS t",
    )
    values = ["q", "d", "t"]
    return rows.selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        X.called(f"round({X.row_mean(values)}, 9)", "row_mean"),
        X.called(f"round({X.row_std(values)}, 9)", "row_std"),
        X.called(X.row_max("d", "t"), "row_max"),
        X.called(X.null_strict_sum(values), "row_sum"),
    )


# --- joins --------------------------------------------------------------------

_ORDER_SPEC = {"cents": ["sum", "max"]}


def _orders(spark, folder):
    return read(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        "round(o_totalprice * 100) AS cents",
        f"datediff(o_orderdate, {TODAY_ORDERS}) AS day",
    )


_ORDERS_SQL = f"""(SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, round(o_totalprice * 100) AS cents,
  CAST(date_diff('day', {TODAY_ORDERS}, CAST(o_orderdate AS DATE)) AS INTEGER) AS day FROM orders)"""


@query(
    f"""SELECT c_custkey, c_mktsegment, o.orders, o.ORDER_cents_SUM, o.ORDER_cents_MAX, e.events, e.last_type FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS orders, sum(cents) AS ORDER_cents_SUM, max(cents) AS ORDER_cents_MAX
      FROM {_ORDERS_SQL} GROUP BY 1) o ON c_custkey = o_custkey
    LEFT JOIN (SELECT user_id, count(*) AS events, arg_max(event_type, ts) AS last_type FROM events GROUP BY 1) e
      ON c_custkey = user_id"""
)
def left_join_families(spark, folder):
    orders = (
        _orders(spark, folder)
        .withColumnRenamed("o_custkey", "c_custkey")
        .groupBy("c_custkey")
        .agg(size_expr("orders"), *agg_exprs(_ORDER_SPEC, "ORDER_"))
    )
    events = (
        read(spark, folder, "events")
        .withColumnRenamed("user_id", "c_custkey")
        .groupBy("c_custkey")
        .agg(size_expr("events"), _expr(latest_present("event_type", "ts"), "last_type"))
    )
    base = read(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return joins.left_assemble(base, "c_custkey", [orders, events])


@query(
    f"""SELECT o_custkey, u.urgent_F, u.cents_F, p.orders_P FROM
    (SELECT o_custkey, count(*) AS urgent_F, sum(cents) AS cents_F FROM {_ORDERS_SQL}
      WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY 1) u FULL JOIN
    (SELECT o_custkey, count(*) AS orders_P FROM {_ORDERS_SQL} WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
      GROUP BY 1) p USING (o_custkey)"""
)
def outer_join_families(spark, folder):
    orders = _orders(spark, folder)
    urgent = (
        orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
        .groupBy("o_custkey")
        .agg(size_expr("urgent_F"), _expr(total("cents"), "cents_F"))
    )
    low = orders.filter("o_orderstatus = 'P' AND o_orderpriority = '5-LOW'").groupBy("o_custkey")
    return joins.outer_assemble("o_custkey", [urgent, low.agg(size_expr("orders_P"))])


@query(
    f"""SELECT o_orderkey, o_custkey, cents, count(*) OVER w AS n, sum(cents) OVER w AS cents_sum, cents / sum(cents) OVER w AS part
    FROM {_ORDERS_SQL} WINDOW w AS (PARTITION BY o_custkey)"""
)
def merge_back(spark, folder):
    orders = _orders(spark, folder).select("o_orderkey", "o_custkey", "cents")
    merged = joins.merge_back(
        orders, ["o_custkey"], [size_expr("n"), _expr(total("cents"), "cents_sum")]
    )
    return with_exprs(merged, {"part": X.ratio("cents", "cents_sum")})


@query(
    """SELECT o_custkey, max(CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 1 ELSE 0 END)
      AS any_returned, count(*) AS orders FROM orders GROUP BY o_custkey"""
)
def exists_flag(spark, folder):
    returned = read(spark, folder, "lineitem").filter("l_returnflag = 'R'").selectExpr("l_orderkey AS o_orderkey")
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    flagged = joins.exists_flag(orders, "o_orderkey", returned, "returned")
    return flagged.groupBy("o_custkey").agg(F.max("returned").alias("any_returned"), size_expr("orders"))


# --- aggregation --------------------------------------------------------------


@query(
    """SELECT l_suppkey, count(l_quantity) AS "LINE_l_quantity_COUNT", count(DISTINCT l_partkey) AS "LINE_l_partkey_NUNIQUE",
    sum(l_quantity) AS "LINE_l_quantity_SUM", avg(l_quantity) AS "LINE_l_quantity_MEAN", min(l_quantity) AS "LINE_l_quantity_MIN",
    max(l_quantity) AS "LINE_l_quantity_MAX", round(var_samp(l_quantity), 9) AS "LINE_l_quantity_VAR", count(*) AS "LINE_ROWS"
    FROM lineitem GROUP BY l_suppkey""",
    {"LINE_l_quantity_VAR": 9},
)
def agg_multi(spark, folder):
    spec = {
        "l_quantity": ["count", "sum", "mean", "min", "max", "var"],
        "l_partkey": ["nunique"],
    }
    lines = group_by_present(read(spark, folder, "lineitem"), "l_suppkey")
    return lines.agg(*agg_exprs(spec, "LINE_"), size_expr("LINE_ROWS"))


@query(f"SELECT o_custkey, median(cents) AS cents_median FROM {_ORDERS_SQL} GROUP BY o_custkey")
def agg_median(spark, folder):
    return ordered.median(_orders(spark, folder), "cents", ["o_custkey"], "cents_median")


@query(
    """SELECT user_id, event_type, arg_max(v, ts) AS v, arg_max(w, ts) AS w FROM (SELECT user_id, event_type, ts,
      CASE WHEN value > 20 THEN value END AS v, CASE WHEN value < 60 THEN value END AS w FROM events)
    GROUP BY user_id, event_type"""
)
def latest_nonnull(spark, folder):
    events = with_exprs(
        read(spark, folder, "events"),
        {"v": "CASE WHEN value > 20 THEN value END", "w": "CASE WHEN value < 60 THEN value END"},
    )
    return ordered.latest_state(events, ["user_id", "event_type"], "ts", ["v", "w"])


@query(
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks,
    count(*) FILTER (WHERE event_type = 'purchase' AND value > 100) AS big_purchases FROM events GROUP BY user_id"""
)
def cond_counts(spark, folder):
    return read(spark, folder, "events").groupBy("user_id").agg(
        _expr(hits("event_type = 'click'"), "clicks"),
        _expr(hits("event_type = 'purchase' AND value > 100"), "big_purchases"),
    )


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "SELECT user_id, count(*) AS events, "
    + ", ".join(
        f"""avg(CASE WHEN event_type = '{t}' THEN 1e0 ELSE 0e0 END) AS "event_type_{t}_MEAN",
        CAST(sum(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS "event_type_{t}_SUM" """
        for t in _EVENT_TYPES
    )
    + " FROM events GROUP BY user_id"
)
def category_share(spark, folder):
    shares = category_exprs("event_type", _EVENT_TYPES, functions=("mean", "sum"))
    return read(spark, folder, "events").groupBy("user_id").agg(size_expr("events"), *shares)


_PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_FLAG_SQL = ", ".join(
    f"""CASE WHEN t = '{v}' THEN 1 ELSE 0 END AS "p_type_{v}" """ for v in _PART_TYPES if v != "PROMO"
)


def _parts_with_gaps(spark, folder):
    return read(spark, folder, "part").selectExpr("p_partkey", "nullif(p_type, 'PROMO') AS p_type")


@query(
    f"""SELECT p_partkey, {_FLAG_SQL}, CASE WHEN t IS NULL THEN 1 ELSE 0 END AS p_type_nan
    FROM (SELECT p_partkey, nullif(p_type, 'PROMO') AS t FROM part)"""
)
def onehot_nan(spark, folder):
    return one_hot(_parts_with_gaps(spark, folder))[0]


@query(f"SELECT p_partkey, {_FLAG_SQL} FROM (SELECT p_partkey, nullif(p_type, 'PROMO') AS t FROM part)")
def onehot_plain(spark, folder):
    declared = {"p_type": [t for t in _PART_TYPES if t != "PROMO"]}
    return one_hot(_parts_with_gaps(spark, folder), nan_as_category=False, vocabulary=declared)[0]


@query(
    """SELECT o_custkey, max(q) AS "LINE_q_MAX", avg(q) AS "LINE_q_MEAN", count(*) AS groups FROM
    (SELECT o_custkey, l_orderkey, l_partkey, l_returnflag, sum(l_quantity) AS q
      FROM (SELECT *, nullif(l_linestatus, 'F') AS s FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
      WHERE s IS NOT NULL GROUP BY o_custkey, l_orderkey, l_partkey, l_returnflag, s) GROUP BY o_custkey"""
)
def two_level(spark, folder):
    lines = read(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_partkey", "l_returnflag", "nullif(l_linestatus, 'F') AS s", "l_quantity"
    )
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    keys = ["o_custkey", "o_orderkey", "l_partkey", "l_returnflag", "s"]
    inner = group_by_present(joins.lookup(lines, orders, "o_orderkey"), *keys).agg(_expr(total("l_quantity"), "q"))
    return inner.groupBy("o_custkey").agg(*agg_exprs({"q": ["max", "mean"]}, "LINE_"), size_expr("groups"))


@query(
    """SELECT user_id, round(sum(CASE WHEN event_type = 'view' THEN 0e0 ELSE pow(CAST('1.2' AS DOUBLE), -day(ts)) END), 12) AS decayed
    FROM events WHERE event_type <> 'signup' GROUP BY user_id"""
)
def decayed_sum(spark, folder):
    weight = f"CASE WHEN {X.differs('event_type', 'view')} THEN {X.decay(1.2, '-day(ts)')} ELSE 0.0D END"
    kept = read(spark, folder, "events").filter(X.differs("event_type", "signup"))
    return kept.groupBy("user_id").agg(_expr(f"round({total(weight)}, 12)", "decayed"))


_SUBSETS_SQL = ", ".join(
    f"""avg(cents) FILTER (WHERE o_orderstatus = '{s}') AS "{s}_cents_MEAN",
    sum(cents) FILTER (WHERE o_orderstatus = '{s}') AS "{s}_cents_SUM",
    max(day) FILTER (WHERE o_orderstatus = '{s}') AS "{s}_day_MAX" """
    for s in ("F", "O")
)


@query(
    f"""SELECT *, "F_cents_MEAN" / ("O_cents_MEAN" + 1) AS "RATIO_cents_MEAN", "F_cents_SUM" / ("O_cents_SUM" + 1) AS "RATIO_cents_SUM"
    FROM (SELECT o_custkey, {_SUBSETS_SQL} FROM {_ORDERS_SQL} GROUP BY o_custkey)"""
)
def subset_aggs(spark, folder):
    spec = {"cents": ["mean", "sum"], "day": ["max"]}
    table = _orders(spark, folder).groupBy("o_custkey").agg(
        *agg_exprs(spec, "F_", "o_orderstatus = 'F'"), *agg_exprs(spec, "O_", "o_orderstatus = 'O'")
    )
    return with_exprs(
        table,
        {
            output_name("RATIO_", "cents", f): X.shifted_ratio(
                output_name("F_", "cents", f), output_name("O_", "cents", f), 1.0
            )
            for f in ("mean", "sum")
        },
    )


_PAIRS = [(s, p) for s in ("F", "O") for p in ("1-URGENT", "5-LOW")]


@query(
    "SELECT * FROM "
    + " FULL JOIN ".join(
        f"""(SELECT o_custkey, avg(cents) AS "{s}_{p}_cents_MEAN", count(*) AS "{s}_{p}_COUNT" FROM {_ORDERS_SQL}
        WHERE o_orderstatus = '{s}' AND o_orderpriority = '{p}' GROUP BY o_custkey) t{i}"""
        + ("" if i == 0 else " USING (o_custkey)")
        for i, (s, p) in enumerate(_PAIRS)
    )
)
def product_families(spark, folder):
    labels = [f"{s}_{p}" for s, p in _PAIRS]
    rows = with_exprs(_orders(spark, folder), {"label": "o_orderstatus || '_' || o_orderpriority"})
    kept = rows.filter(X.one_of("label", labels))
    return (
        kept.groupBy("o_custkey").pivot("label", labels).agg(*agg_exprs({"cents": ["mean"]}), size_expr("COUNT"))
    )


@query(
    """SELECT o_custkey, max(late) AS "late_MAX", avg(late) AS "late_MEAN", sum(early) AS "early_SUM",
    round(avg(capped), 9) AS "capped_MEAN" FROM (SELECT o_custkey, greatest(d, 0e0) AS late, greatest(-d, 0e0) AS early,
      least(l_extendedprice / (l_quantity * 1000 + CAST('0.001' AS DOUBLE)), 1e0) AS capped FROM
      (SELECT *, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE) AS d
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey)) GROUP BY o_custkey""",
    {"capped_MEAN": 9},
)
def payment_behaviour(spark, folder):
    lines = read(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = joins.lookup(lines, orders, "o_orderkey").selectExpr(
        "o_custkey",
        X.called(X.positive_part("datediff(l_shipdate, o_orderdate)"), "late"),
        X.called(X.positive_part("datediff(o_orderdate, l_shipdate)"), "early"),
        X.called(X.capped_at_one(X.shifted_ratio("l_extendedprice", "l_quantity * 1000", 1e-3)), "capped"),
    )
    spec = {"late": ["max", "mean"], "early": ["sum"], "capped": ["mean"]}
    return rows.groupBy("o_custkey").agg(*agg_exprs(spec))


@query(
    """SELECT event_id, user_id, event_type FROM events WHERE user_id IN
    (SELECT user_id FROM events GROUP BY user_id HAVING max(value) > 250)"""
)
def active_only_rows(spark, folder):
    events = read(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return joins.keep_groups(events, ["user_id"], F.expr("max(value) > 250")).select(
        "event_id", "user_id", "event_type"
    )


@query(
    """SELECT user_id, avg(cents) AS cents_mean, count(*) AS n FROM (SELECT user_id, round(value * 100) AS cents FROM events
    WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING max(value) > 250)) GROUP BY user_id"""
)
def active_only_aggs(spark, folder):
    events = read(spark, folder, "events").selectExpr("user_id", "round(value * 100) AS cents")
    kept = joins.keep_groups(events, ["user_id"], F.expr("max(cents) > 25000"))
    return kept.groupBy("user_id").agg(F.avg("cents").alias("cents_mean"), size_expr("n"))


# --- order --------------------------------------------------------------------


@query(
    f"""SELECT o_orderkey, o_custkey, day, coalesce(lag(day) OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey) - day, 0)
    AS gap FROM {_ORDERS_SQL}"""
)
def gap_desc(spark, folder):
    orders = _orders(spark, folder).select("o_orderkey", "o_custkey", "day")
    return ordered.gap_from_later(orders, "o_custkey", "day", "o_orderkey", "gap")


@query(
    f"""SELECT o_orderkey, o_custkey, day, CASE WHEN o_orderstatus <> 'P' THEN coalesce(day - lag(day) OVER (
      PARTITION BY o_custkey, o_orderstatus <> 'P' ORDER BY day, o_orderkey), 0) END AS gap FROM {_ORDERS_SQL}"""
)
def gap_asc(spark, folder):
    orders = _orders(spark, folder)
    gaps = ordered.gap_from_earlier(
        orders, "o_custkey", "day", "o_orderkey", "gap", F.col("o_orderstatus") != "P"
    )
    return gaps.select("o_orderkey", "o_custkey", "day", "gap")


@query(
    """WITH m AS (SELECT p_brand, avg(round(p_retailprice * 100)) AS mean_cents FROM part GROUP BY p_brand
      ORDER BY mean_cents DESC, p_brand LIMIT 5)
    SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_brand IN (SELECT p_brand FROM m)"""
)
def topk_semi(spark, folder):
    part = read(spark, folder, "part").selectExpr(
        "p_partkey", "p_brand AS feature", "round(p_retailprice * 100) AS importance", "p_retailprice"
    )
    return E.leading_features(part, 5).selectExpr("p_partkey", "feature AS p_brand", "p_retailprice")


# --- encodings and set operators ----------------------------------------------


@query(
    """SELECT c_custkey, coalesce(code, -1) AS code FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS s FROM customer)
    LEFT JOIN (SELECT nullif(c_mktsegment, 'BUILDING') AS v, row_number() OVER (ORDER BY min(c_custkey)) - 1 AS code
      FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1) ON s = v"""
)
def factorize_codes(spark, folder):
    rows = read(spark, folder, "customer").selectExpr("c_custkey", "nullif(c_mktsegment, 'BUILDING') AS code")
    return factorize(rows, ["code"], "c_custkey")


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS l_linestatus, l_returnflag
    FROM lineitem"""
)
def label_encode(spark, folder):
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_linestatus", "l_returnflag"
    )
    return label_encode_binary(lines, [])[0]


@query(
    """SELECT d.doc_id, d.n_chars, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def align_union(spark, folder):
    documents = read(spark, folder, "documents").select("doc_id", "n_chars", "lang")
    labels = read(spark, folder, "labels").select("doc_id", "quality")
    joined = documents.join(labels, "doc_id", "left")
    labelled, unlabelled = schema.split_by_label(joined, "quality")
    unlabelled = unlabelled.drop("quality", "lang")
    left, right = schema.align_columns(labelled, unlabelled)
    with_label = left.join(labels, "doc_id")
    return schema.append_unlabelled(with_label, right)


@query(
    """SELECT o_orderkey FROM (SELECT o_orderkey, y * y % 2147483647 AS x
    FROM (SELECT o_orderkey, (x * 48271 + 14) % 2147483647 AS y
    FROM (SELECT o_orderkey, y * y % 2147483647 AS x
    FROM (SELECT o_orderkey, (o_orderkey % 2147483647 * 48271 + 7) % 2147483647 AS y FROM orders))))
    ORDER BY x, o_orderkey LIMIT 1000"""
)
def random_sample(spark, folder):
    return schema.random_rows(read(spark, folder, "orders").select("o_orderkey"), 1000, seed=7, key="o_orderkey")


# --- scores -------------------------------------------------------------------

_TERMS = [
    ScoreTerm("ORDER_cents_SUM", 0.3, 0.4, 0.7, -0.2),
    ScoreTerm("ORDER_cents_MAX", 0.6, 0, 0.9, 0.5, 0.1),
    ScoreTerm("constant", 0.2, 0.1, 0.8, -0.1),
    ScoreTerm("first_half", 0.2, 0.3, 0.5, 0.7),
]


def _scored_base(spark, folder):
    aggregates = _orders(spark, folder).groupBy("o_custkey").agg(
        *agg_exprs(_ORDER_SPEC, "ORDER_"),
        _expr("sum(CASE WHEN day < -1200 THEN cents END)", "first_half"),
    )
    return with_exprs(aggregates, {"constant": "7.0D"})


def _term_sql(column, low, lw, high, hw, other):
    v = f"({column} / (max({column}) OVER () - min({column}) OVER ()))"
    return f"""CASE WHEN {v} IS NULL OR isnan({v}) OR isinf({v}) THEN 0e0 WHEN {v} < {low} THEN CAST('{lw}' AS DOUBLE) * {v}
      WHEN {v} > {high} THEN CAST('{hw}' AS DOUBLE) * {v} ELSE CAST('{other}' AS DOUBLE) END"""


_SCORED_SQL = f"""(SELECT o_custkey, sum(cents) AS "ORDER_cents_SUM", max(cents) AS "ORDER_cents_MAX", CAST(7 AS DOUBLE) AS constant,
  sum(CASE WHEN day < -1200 THEN cents END) AS first_half FROM {_ORDERS_SQL} GROUP BY o_custkey)"""


@query(f"""SELECT *, {_term_sql('"ORDER_cents_SUM"', 0.3, 0.4, 0.7, -0.2, 0)} AS score FROM {_SCORED_SQL}""")
def score_term(spark, folder):
    return with_scores(_scored_base(spark, folder), {"score": _TERMS[:1]})


@query(
    f"""SELECT *, {_term_sql('"ORDER_cents_SUM"', 0.3, 0.4, 0.7, -0.2, 0)}
    + {_term_sql('"ORDER_cents_MAX"', 0.6, 0, 0.9, 0.5, 0.1)} + {_term_sql('constant', 0.2, 0.1, 0.8, -0.1, 0)}
    + {_term_sql('first_half', 0.2, 0.3, 0.5, 0.7, 0)} AS score FROM {_SCORED_SQL}""",
    {"score": 9},
)
def score_sum(spark, folder):
    return with_scores(_scored_base(spark, folder), {"score": _TERMS})


@query(
    f"""SELECT c_custkey, round(c_acctbal * 100) / s AS balance_to_orders FROM customer LEFT JOIN
    (SELECT o_custkey, sum(cents) AS s FROM {_ORDERS_SQL} GROUP BY 1) ON c_custkey = o_custkey"""
)
def mix_ratio(spark, folder):
    sums = _orders(spark, folder).groupBy("o_custkey").agg(_expr(total("cents"), "s"))
    base = read(spark, folder, "customer").selectExpr("c_custkey AS o_custkey", "round(c_acctbal * 100) AS b")
    joined = joins.left_assemble(base, "o_custkey", [sums])
    return joined.selectExpr("o_custkey AS c_custkey", X.called(X.ratio("b", "s"), "balance_to_orders"))


# --- profiling ----------------------------------------------------------------


@query(
    """SELECT * FROM (
      SELECT 'p_size' AS "column", count(*) FILTER (WHERE p_size > 40) AS missing_values,
        round(100e0 * count(*) FILTER (WHERE p_size > 40) / count(*), 1) AS percent_missing FROM part
      UNION ALL SELECT 'p_type', count(*) FILTER (WHERE p_type = 'PROMO'),
        round(100e0 * count(*) FILTER (WHERE p_type = 'PROMO') / count(*), 1) FROM part)"""
)
def missing_profile(spark, folder):
    part = read(spark, folder, "part").selectExpr(
        "p_partkey",
        "p_name",
        X.called(X.null_when("p_size", "p_size > 40"), "p_size"),
        "nullif(p_type, 'PROMO') AS p_type",
    )
    return profile.missing_profile(part)


def _labelled_documents(spark, folder):
    documents = read(spark, folder, "documents").selectExpr(
        "doc_id",
        "double(n_chars) AS n_chars",
        "double(length(text) - length(replace(text, ' ', ''))) AS spaces",
        r"double(length(text) - length(replace(text, '\n', ''))) AS line_breaks",
        "int(lang = 'en') AS english",
        "CASE WHEN n_chars > 300 THEN double(n_chars) END AS long_chars",
        "1.0D AS constant",
    )
    return documents.join(read(spark, folder, "labels"), "doc_id")


_DOCS_SQL = """(SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, length(text) - length(replace(text, ' ', '')) AS spaces,
  length(text) - length(replace(text, chr(10), '')) AS line_breaks, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS english,
  CASE WHEN n_chars > 300 THEN n_chars END AS long_chars, quality, toxic FROM documents JOIN labels USING (doc_id))"""
_LINKED = ["n_chars", "spaces", "line_breaks", "english", "long_chars", "toxic", "quality"]
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", corr({c}, quality) AS corr FROM {_DOCS_SQL}" for c in _LINKED
)


@query(
    f"SELECT * FROM ({_CORR_SQL} UNION ALL SELECT 'constant', CAST(NULL AS DOUBLE))", {"corr": 9}
)
def corr_target(spark, folder):
    return profile.label_correlations(_labelled_documents(spark, folder), "quality", [*_LINKED, "constant"])


@query(f"""SELECT * FROM ({_CORR_SQL}) ORDER BY abs(corr) DESC, "column" LIMIT 3""", {"corr": 9})
def corr_top(spark, folder):
    links = profile.label_correlations(_labelled_documents(spark, folder), "quality", [*_LINKED, "constant"])
    return profile.strongest(links, 3)


@query(
    f"""SELECT * FROM (SELECT *, 'negative' AS side FROM ({_CORR_SQL}) ORDER BY corr, "column" LIMIT 2)
    UNION ALL SELECT * FROM (SELECT *, 'positive' AS side FROM ({_CORR_SQL}) ORDER BY corr DESC, "column" LIMIT 2)""",
    {"corr": 9},
)
def corr_extremes(spark, folder):
    links = profile.label_correlations(_labelled_documents(spark, folder), "quality", [*_LINKED, "constant"])
    return profile.extremes(links, 2)


@query(
    f"""SELECT quality, median(n_chars) AS median, (SELECT corr(n_chars, quality) FROM {_DOCS_SQL}) AS corr
    FROM {_DOCS_SQL} GROUP BY quality""",
    {"corr": 9},
)
def class_median(spark, folder):
    return profile.class_summary(_labelled_documents(spark, folder), "n_chars", "quality")


_POINTS = [100.0 * i for i in range(1, 21)]


@query(
    f"""SELECT quality, point, avg(exp(-0.5e0 * ((point - n_chars) / 150e0) * ((point - n_chars) / 150e0)) / (150e0 * sqrt(2 * pi())))
    AS density FROM {_DOCS_SQL}, (SELECT CAST(unnest({_POINTS}) AS DOUBLE) AS point) GROUP BY quality, point""",
    {"density": 12},
)
def kde_grid(spark, folder):
    return profile.class_density(_labelled_documents(spark, folder), "n_chars", "quality", _POINTS, 150.0)


@query(
    f"""SELECT d.quality, point, avg(exp(-0.5e0 * ((point - n_chars) / h) * ((point - n_chars) / h)) / (h * sqrt(2 * pi()))) AS density
    FROM {_DOCS_SQL} d JOIN (SELECT quality, stddev_samp(n_chars) * pow(count(*), CAST('-0.2' AS DOUBLE)) AS h FROM {_DOCS_SQL}
      GROUP BY quality) b ON d.quality = b.quality, (SELECT CAST(unnest({_POINTS}) AS DOUBLE) AS point) GROUP BY d.quality, point""",
    {"density": 12},
)
def kde_scott(spark, folder):
    return profile.class_density(_labelled_documents(spark, folder), "n_chars", "quality", _POINTS)


_CELLS = [(100.0 + 5.0 * i) for i in range(601)]


@query(
    f"""WITH placed AS (SELECT quality, (n_chars - 100e0) / 0.625e0 AS a FROM {_DOCS_SQL}),
    cells AS (SELECT quality, floor(a) AS b, 1 - (a - floor(a)) AS w FROM placed UNION ALL SELECT quality, floor(a) + 1, a - floor(a) FROM placed),
    bins AS (SELECT quality, b, sum(w) AS w FROM cells GROUP BY ALL),
    totals AS (SELECT quality, count(*) AS n FROM placed GROUP BY ALL)
    SELECT bins.quality, point, sum(w * exp(-0.5e0 * pow((point - 100e0 - b * 0.625e0) / 150e0, 2))) / (any_value(n) * 150e0 * sqrt(2 * pi())) AS density
    FROM bins JOIN totals USING (quality), (SELECT CAST(unnest({_CELLS}) AS DOUBLE) AS point) GROUP BY ALL""",
    {"density": 12},
)
def kde_large_grid(spark, folder):
    return profile.class_density_grid(_labelled_documents(spark, folder), "n_chars", "quality", 100.0, 3100.0, 601, 150.0)


_MEASURES = {
    "orderkey": "l_orderkey", "partkey": "l_partkey", "suppkey": "l_suppkey", "line": "l_linenumber", "quantity": "l_quantity",
    "price": "l_extendedprice", "discount": "nullif(l_discount, 0)", "tax": "nullif(l_tax, 0.08)",
    "unit": "CASE WHEN l_linenumber < 5 THEN l_extendedprice / l_quantity END", "part_line": "CASE WHEN l_quantity > 10 THEN l_partkey * l_linenumber END",
}
_MEASURED = [f"CAST({text} AS DOUBLE) AS {name}" for name, text in _MEASURES.items()]


@query(
    f"WITH m AS (SELECT {', '.join(_MEASURED)} FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS pairs, corr({a}, {b}) AS corr FROM m"
        for i, a in enumerate(_MEASURES)
        for b in list(_MEASURES)[i + 1 :]
    ),
    {"corr": 9},
)
def corr_matrix(spark, folder):
    return correlation_matrix(read(spark, folder, "lineitem").selectExpr(*_MEASURED), list(_MEASURES))


@query(
    """WITH p AS (SELECT p_partkey, p_name, CASE WHEN p_size % 7 > 0 THEN p_type END AS kind FROM part),
    sizes AS (SELECT count(DISTINCT p_name) AS names, count(DISTINCT kind) AS kinds FROM p)
    SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS name_place,
      names + 1 + CASE WHEN kind IS NULL THEN kinds ELSE dense_rank() OVER (ORDER BY kind NULLS LAST) - 1 END AS kind_place, names + kinds + 2 AS width
    FROM p, sizes"""
)
def wide_indicators(spark, folder):
    """Names of parts, one indicator each, however many there are."""
    part = read(spark, folder, "part").selectExpr("p_partkey", "p_name", "CASE WHEN p_size % 7 > 0 THEN p_type END AS kind")
    placed, width = sparse_indicators(part, ["p_name", "kind"])
    return placed.selectExpr("p_partkey", "indicators[0] AS name_place", "indicators[1] AS kind_place", f"{width}L AS width")


@query(
    """SELECT l_returnflag AS feature, CAST(sum(l_linenumber) AS DOUBLE) AS importance, l_linenumber AS fold FROM lineitem
    GROUP BY l_returnflag, l_linenumber HAVING l_returnflag IN (SELECT f FROM (SELECT l_returnflag AS f, sum(l_linenumber) AS s, l_linenumber FROM lineitem
      GROUP BY ALL) GROUP BY f ORDER BY avg(s) DESC, f LIMIT 2)"""
)
def importance_sink(spark, folder):
    """Rows by feature and fold are kept under a name, read back, and those of the two leading features written as a file."""
    rows = read(spark, folder, "lineitem").groupBy("l_returnflag", "l_linenumber").agg(F.sum("l_linenumber").cast("double").alias("importance"))
    path = _fresh_path(spark, "importance")
    tables.write_cached(rows.selectExpr("l_returnflag AS feature", "importance", "int(l_linenumber) AS fold"), path, "all")
    kept = tables.read_cached(spark, path, "all")
    tables.write_importances(kept, E.leading_features(kept, 2), f"{path}/csv", f"{path}/best")
    return tables.read_csv(spark, f"{path}/best", T.StructType([kept.schema["feature"], kept.schema["importance"], kept.schema["fold"]]))


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def value_counts(spark, folder):
    return profile.value_counts(read(spark, folder, "orders"), "o_orderpriority")


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
        max({c}) AS max, quantile_cont({c}, CAST('0.25' AS DOUBLE)) AS q25, quantile_cont({c}, CAST('0.5' AS DOUBLE)) AS q50,
        quantile_cont({c}, CAST('0.75' AS DOUBLE)) AS q75 FROM (SELECT CAST(cents AS DOUBLE) AS cents, CAST(day AS DOUBLE) AS day
        FROM {_ORDERS_SQL})"""
        for c in ("cents", "day")
    ),
    {"std": 6},
)
def describe(spark, folder):
    return profile.describe(_orders(spark, folder), ["cents", "day"])


@query(
    """SELECT o_orderstatus, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent_n,
    avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1e0 ELSE 0e0 END) AS urgent_share,
    count(*) FILTER (WHERE o_totalprice > 250000) AS big_n, avg(CASE WHEN o_totalprice > 250000 THEN 1e0 ELSE 0e0 END) AS big_share
    FROM orders GROUP BY o_orderstatus"""
)
def class_share(spark, folder):
    tests = {"urgent": "o_orderpriority = '1-URGENT'", "big": "o_totalprice > 250000"}
    return profile.class_shares(read(spark, folder, "orders"), "o_orderstatus", tests)


@query(
    """SELECT * FROM (SELECT 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) AS distinct_values FROM orders
    UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders)"""
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(read(spark, folder, "orders"))


# --- evaluation ---------------------------------------------------------------

_M, _A, _SEED = 2147483647, 48271, 1001


def fold_sql(key: str) -> str:
    x = f"({key} % {_M})"
    for step in (1, 2):
        x = f"(({x} * {_A} + {_SEED * step}) % {_M})"
        x = f"(({x} * {x}) % {_M})"
    return f"{x} % 5"


@query(f"SELECT doc_id, {fold_sql('doc_id')} AS fold FROM documents")
def fold_assign(spark, folder):
    return E.assign_folds(read(spark, folder, "documents").select("doc_id"), "doc_id")


_AUC_SQL = """sum(CASE WHEN quality = 1 THEN r END) - CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE)
  * (count(*) FILTER (WHERE quality = 1) + 1) / 2"""


@query(
    f"""SELECT ({_AUC_SQL}) / (CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) * count(*) FILTER (WHERE quality = 0)) AS auc,
    count(*) FILTER (WHERE quality = 1) AS positives, count(*) FILTER (WHERE quality = 0) AS negatives
    FROM (SELECT quality, (rank() OVER (ORDER BY n_chars) + rank() OVER (ORDER BY n_chars)
      + count(*) OVER (PARTITION BY n_chars) - 1) / 2e0 AS r FROM {_DOCS_SQL})""",
    {"auc": 12},
)
def auc_rank(spark, folder):
    return E.auc(_labelled_documents(spark, folder), "quality", "n_chars")


@query(
    f"""SELECT fold, ({_AUC_SQL}) / (CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) * count(*) FILTER (WHERE quality = 0)) AS auc,
    count(*) FILTER (WHERE quality = 1) AS positives, count(*) FILTER (WHERE quality = 0) AS negatives
    FROM (SELECT quality, fold, (2 * rank() OVER (PARTITION BY fold ORDER BY n_chars)
      + count(*) OVER (PARTITION BY fold, n_chars) - 1) / 2e0 AS r FROM (SELECT *, {fold_sql('doc_id')} AS fold FROM {_DOCS_SQL}))
    GROUP BY fold""",
    {"auc": 12},
)
def auc_by_fold(spark, folder):
    return E.auc(
        E.assign_folds(_labelled_documents(spark, folder), "doc_id"), "quality", "n_chars", ["fold"]
    )


@query(
    f"""SELECT o_custkey, avg(cents) AS prediction FROM (SELECT o_custkey, fold, max(cents) AS cents FROM
    (SELECT *, {fold_sql('o_orderkey')} AS fold FROM {_ORDERS_SQL}) GROUP BY o_custkey, fold) GROUP BY o_custkey"""
)
def fold_mean(spark, folder):
    folded = E.assign_folds(_orders(spark, folder), "o_orderkey")
    per_fold = folded.groupBy("o_custkey", "fold").agg(F.max("cents").alias("cents"))
    return E.mean_by_key(per_fold, "o_custkey", "cents", "prediction")
