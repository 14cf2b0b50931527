"""Window functions, sorting and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import dates, numbers
from tallyloom.operators import groups, longwindows, windows


def site_months(spark, d):
    return fx.counts(spark, d).select("site", "month", "n", "n_f")


SM = fx.counts_sql() + ", sm AS (SELECT site, month, n, n_f FROM counts)"


@query("win_row_number", f"""
WITH {SM} SELECT site, month, n, CAST(row_number() OVER (PARTITION BY site ORDER BY month) AS INTEGER) AS rn FROM sm""")
def win_row_number(spark, d):
    rn = F.row_number().over(windows.series(["site"], "month"))
    return site_months(spark, d).select("site", "month", "n", rn.alias("rn"))


@query("win_lag", f"""
WITH {SM} SELECT site, month, n, CAST(lag(n) OVER (PARTITION BY site ORDER BY month) AS DOUBLE) AS previous FROM sm""")
def win_lag(spark, d):
    lag = F.lag("n").over(windows.series(["site"], "month"))
    return site_months(spark, d).select("site", "month", "n", lag.cast("double").alias("previous"))


@query("win_lead", f"""
WITH {SM} SELECT site, month, n, lead(month) OVER (PARTITION BY site ORDER BY month) AS next_month FROM sm""")
def win_lead(spark, d):
    lead = F.lead("month").over(windows.series(["site"], "month"))
    return site_months(spark, d).select("site", "month", "n", lead.alias("next_month"))


@query("win_group_value", """
SELECT l_orderkey, l_linenumber, l_quantity, max(l_quantity) OVER (PARTITION BY l_orderkey) AS top,
       count(*) OVER (PARTITION BY l_orderkey) AS n_lines FROM lineitem""")
def win_group_value(spark, d):
    lines = fx.t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return groups.attach_group(lines, ["l_orderkey"], top=F.max("l_quantity"), n_lines=F.count("*"))


@query("keep_latest_ties", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day FROM lineitem
QUALIFY l_shipdate = max(l_shipdate) OVER (PARTITION BY l_orderkey)""")
def keep_latest_ties(spark, d):
    lines = fx.t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("day")
    )
    return groups.keep_extreme(lines, ["l_orderkey"], "day")


@query("keep_earliest_ties", """
SELECT l_suppkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem
QUALIFY l_shipdate = min(l_shipdate) OVER (PARTITION BY l_suppkey)""")
def keep_earliest_ties(spark, d):
    lines = fx.t(spark, d, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day")
    )
    return groups.keep_extreme(lines, ["l_suppkey"], "day", largest=False)


@query("keep_tiebreak_chain", """
WITH a AS (SELECT * FROM lineitem QUALIFY l_shipdate = max(l_shipdate) OVER (PARTITION BY l_orderkey))
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM a
QUALIFY l_quantity = max(l_quantity) OVER (PARTITION BY l_orderkey)""")
def keep_tiebreak_chain(spark, d):
    lines = fx.t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    return groups.keep_chain(lines, ["l_orderkey"], [("l_shipdate", True), ("l_quantity", True)]).drop("l_shipdate")


@query("keep_first_ordered", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_quantity DESC, l_orderkey DESC, l_linenumber,
  l_partkey, l_extendedprice, l_discount, l_tax) = 1""")
def keep_first_ordered(spark, d):
    order = [
        F.asc_nulls_last("l_shipdate"), F.desc_nulls_last("l_quantity"), F.desc_nulls_last("l_orderkey"),
        F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_extendedprice"), F.asc("l_discount"), F.asc("l_tax"),
    ]
    first = groups.head_per(fx.t(spark, d, "lineitem"), ["l_suppkey"], order)
    return first.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("keep_last_in_filtered", f"""
WITH {SM}, r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY month) AS srn FROM sm)
SELECT site, month, n, CAST(srn AS INTEGER) AS srn FROM r WHERE n_f >= 2 QUALIFY r.srn = max(r.srn) OVER (PARTITION BY site)""")
def keep_last_in_filtered(spark, d):
    srn = F.row_number().over(windows.series(["site"], "month"))
    kept = site_months(spark, d).withColumn("srn", srn).filter("n_f >= 2")
    # one row per month and site, so the sequence numbers are unique
    return groups.head_per(kept, ["site"], [F.desc("srn")]).select("site", "month", "n", "srn")


@query("win_baseline_n", f"""
WITH {SM}, s AS (SELECT *, CASE WHEN month(month) IN (2, 3, 4, 5, 9, 10, 11) THEN 'School' ELSE 'Break' END AS season,
    row_number() OVER (PARTITION BY site ORDER BY month) AS rn FROM sm)
SELECT site, month, season, CAST(rn AS INTEGER) AS rn,
  CAST(sum(CASE WHEN s.rn <= 24 THEN n_f END) OVER (PARTITION BY site, season) AS BIGINT) AS base_num,
  CAST(sum(CASE WHEN s.rn <= 24 THEN n END) OVER (PARTITION BY site, season) AS BIGINT) AS base_den FROM s""")
def win_baseline_n(spark, d):
    season = F.when(F.month("month").isin(2, 3, 4, 5, 9, 10, 11), "School").otherwise("Break")
    rows = site_months(spark, d).withColumn("season", season)
    return windows.baseline_sums(
        rows, ["site"], ["season"], ["month"], 24, base_num="n_f", base_den="n"
    ).drop("n", "n_f")


@query("run_length", f"""
WITH {SM}, v AS (SELECT site, month, CASE WHEN n_f * 2 > n THEN 'Y' ELSE 'N' END AS side FROM sm),
g AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY month)
             - row_number() OVER (PARTITION BY site, side ORDER BY month) AS grp FROM v),
f AS (SELECT *, min(month) OVER (PARTITION BY site, side, grp) AS run_start FROM g)
SELECT site, month, side, CAST(dense_rank() OVER (PARTITION BY site ORDER BY run_start) AS BIGINT) AS run_no,
  CAST(row_number() OVER (PARTITION BY site, run_start ORDER BY month) AS INTEGER) AS run_pos,
  count(*) OVER (PARTITION BY site, run_start) AS run_len FROM f""")
def run_length(spark, d):
    rows = site_months(spark, d).select(
        "site", "month", F.when(F.col("n_f") * 2 > F.col("n"), "Y").otherwise("N").alias("side")
    )
    return windows.runs(rows, ["site"], ["month"], "side")


@query("fill_previous_once", f"""
WITH {SM}, v AS (SELECT site, month, CAST(nullif(n_f, 2) AS DOUBLE) AS value FROM sm)
SELECT site, month, coalesce(value, lag(value) OVER (PARTITION BY site ORDER BY month)) AS value FROM v""")
def fill_previous_once(spark, d):
    rows = site_months(spark, d).select("site", "month", F.nullif(F.col("n_f"), F.lit(2)).cast("double").alias("value"))
    return windows.fill1(rows, ["site"], ["month"], "value")


@query("win_count_filter", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey) = 1""")
def win_count_filter(spark, d):
    lines = fx.t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return groups.keep_singletons(lines, ["l_orderkey"])


@query("win_restart_flag", f"""
WITH {fx.EVENTS}, dd AS (SELECT user_id, day, CAST(max(CAST(event_type = 'signup' AS INTEGER)) AS DOUBLE) AS s,
  max(CAST(event_type = 'error' AS INTEGER)) AS e FROM ev GROUP BY 1, 2)
SELECT user_id, day, e AS "end", CASE WHEN s = 0 AND e = 0
  AND lag(e) OVER (PARTITION BY user_id ORDER BY day) = 1 THEN 1.1 ELSE s END AS start FROM dd""")
def win_restart_flag(spark, d):
    days = fx.events(spark, d).groupBy("user_id", "day").agg(
        F.max((F.col("event_type") == "signup").cast("double")).alias("start"),
        F.max((F.col("event_type") == "error").cast("int")).alias("end"),
    )
    return windows.restart_flag(days, ["user_id"], "day", "start", "end")


@query("sort_multi", f"""
WITH {fx.ORDERS} SELECT o_orderpriority, o_date, o_orderkey, o_totalprice FROM orders_d ORDER BY 1, 2, 3""")
def sort_multi(spark, d):
    order = [F.asc_nulls_last(c) for c in ("o_orderpriority", "o_date", "o_orderkey")]
    return fx.orders(spark, d).select("o_orderpriority", "o_date", "o_orderkey", "o_totalprice").orderBy(*order)


@query("sort_desc_nulls_last", f"""
WITH {fx.ORDERS} SELECT o_orderkey, TRY_CAST(nullif(left(o_orderpriority, 1), '5') AS DOUBLE) AS code, o_totalprice
FROM orders_d ORDER BY code DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey""")
def sort_desc_nulls_last(spark, d):
    code = numbers.to_num(F.nullif(F.left("o_orderpriority", F.lit(1)), F.lit("5")))
    return fx.t(spark, d, "orders").select("o_orderkey", code.alias("code"), "o_totalprice").orderBy(
        F.desc_nulls_last("code"), F.desc_nulls_last("o_totalprice"), F.asc("o_orderkey")
    )


@query("topk_per_group", f"""
WITH {SM} SELECT site, month, n FROM sm WHERE month >= DATE '1997-01-01'
QUALIFY row_number() OVER (PARTITION BY site ORDER BY month) <= 24""")
def topk_per_group(spark, d):
    rows = site_months(spark, d).filter(F.col("month") >= dates.day("1997-01-01"))
    return groups.head_per(rows, ["site"], [F.col("month")], 24).select("site", "month", "n")


# A third of all lines is under one key here.
HOT = """hot AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k, CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, l_partkey,
    CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice, CASE WHEN l_quantity < 10 THEN NULL ELSE l_returnflag END AS flag FROM lineitem)"""
HOT_ORDER = ("day", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def hot_lines(spark, d):
    return fx.t(spark, d, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey")).alias("k"), F.to_date("l_shipdate").alias("day"),
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("quantity"), "l_extendedprice",
        F.when(F.col("l_quantity") >= 10, F.col("l_returnflag")).alias("flag"),
    )


@query("win_long_sequence", f"""
WITH {HOT} SELECT k, l_orderkey, l_linenumber, quantity, row_number() OVER w AS row_no, lag(quantity) OVER w AS before,
  lead(quantity) OVER w AS after, CAST(sum(quantity) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far
FROM hot WINDOW w AS (PARTITION BY k ORDER BY day, l_orderkey, l_linenumber, l_partkey, l_extendedprice)""")
def win_long_sequence(spark, d):
    """Numbers, neighbours and running sums over raw rows of which one key has a third."""
    made = longwindows.over(hot_lines(spark, d), ["k"], HOT_ORDER).add(
        number="row_no", lag={"before": "quantity"}, lead={"after": "quantity"}, total={"so_far": "quantity"}
    )
    return made.result().select("k", "l_orderkey", "l_linenumber", "quantity", "row_no", "before", "after", "so_far")


@query("win_long_runs", f"""
WITH {HOT}, m AS (SELECT *, lag(flag) OVER w AS was, row_number() OVER w AS rn
  FROM hot WINDOW w AS (PARTITION BY k ORDER BY day, l_orderkey, l_linenumber, l_partkey, l_extendedprice)),
r AS (SELECT k, flag, sum(CASE WHEN rn = 1 OR flag IS DISTINCT FROM was THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY rn) AS run_no FROM m),
l AS (SELECT k, run_no, flag, count(*) AS len FROM r GROUP BY 1, 2, 3)
SELECT k, flag, count(*) AS runs, max(len) AS longest FROM l GROUP BY 1, 2""")
def win_long_runs(spark, d):
    """Runs of equal flags over the same rows."""
    rows = longwindows.runs(hot_lines(spark, d), ["k"], HOT_ORDER, "flag")
    each = rows.groupBy("k", "run_no", "flag").agg(F.count("*").alias("len"))
    return each.groupBy("k", "flag").agg(F.count("*").alias("runs"), F.max("len").alias("longest"))
