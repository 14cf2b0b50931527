"""Grouped aggregates, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import dates
from tallyloom.operators import groups, project, rules, setops
from tallyloom.session import scratch_path
from tallyloom.sources import publish, tables


@query("agg_count", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def agg_count(spark, d):
    return fx.t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("agg_count_distinct", """
SELECT o_orderstatus, count(DISTINCT k) + max(CAST(k IS NULL AS INTEGER)) AS n
FROM (SELECT o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS k FROM orders)
GROUP BY 1""")
def agg_count_distinct(spark, d):
    k = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    rows = fx.t(spark, d, "orders").select("o_orderstatus", k.alias("k"))
    return rows.groupBy("o_orderstatus").agg(groups.count_distinct_with_null("k").alias("n"))


@query("agg_count_distinct_nonnull", """
SELECT c_nationkey, count(DISTINCT o_orderpriority) AS n
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' AND o_totalprice > 495000 GROUP BY 1""")
def agg_count_distinct_nonnull(spark, d):
    o = fx.t(spark, d, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 495000")
    held = o.select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority").distinct()
    return (
        fx.t(spark, d, "customer").join(held, "c_custkey", "left")
        .groupBy("c_nationkey").agg(F.countDistinct("o_orderpriority").alias("n"))
    )


@query("agg_sum", """
SELECT l_suppkey, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS price
FROM lineitem GROUP BY 1""")
def agg_sum(spark, d):
    return fx.t(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


@query("agg_minmax", f"""
WITH {fx.ORDERS} SELECT o_custkey, min(o_date) AS first_day, max(o_date) AS last_day, max(o_orderpriority) AS code,
  min(o_totalprice) AS low, CASE WHEN count(*) = count(p) THEN max(p) END AS strict_max
FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS p FROM orders_d) GROUP BY 1""")
def agg_minmax(spark, d):
    rows = fx.orders(spark, d).withColumn("p", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return rows.groupBy("o_custkey").agg(
        F.min("o_date").alias("first_day"), F.max("o_date").alias("last_day"),
        F.max("o_orderpriority").alias("code"), F.min("o_totalprice").alias("low"),
        groups.strict(F.max("p"), "p").alias("strict_max"),
    )


@query("agg_flag_rollup", """
SELECT l_orderkey, max(CAST(l_returnflag = 'R' AS INTEGER)) AS returned,
       max(CAST(l_linestatus = 'O' AS INTEGER)) AS open, max(CAST(l_quantity > 40 AS INTEGER)) AS big
FROM lineitem GROUP BY 1""")
def agg_flag_rollup(spark, d):
    lines = fx.t(spark, d, "lineitem").withColumns(
        {
            "returned": (F.col("l_returnflag") == "R").cast("int"),
            "open": (F.col("l_linestatus") == "O").cast("int"),
            "big": (F.col("l_quantity") > 40).cast("int"),
        }
    )
    return lines.groupBy("l_orderkey").agg(*[F.max(c).alias(c) for c in ("returned", "open", "big")])


@query("agg_conditional", """
SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 2) AS returned,
       max(CASE WHEN l_discount > 0.05 THEN l_extendedprice END) AS top_discounted,
       min(CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS DATE) END) AS first_open FROM lineitem GROUP BY 1""")
def agg_conditional(spark, d):
    where = groups.agg_where
    return fx.t(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.round(where(F.sum, F.col("l_quantity"), F.col("l_returnflag") == "R"), 2).alias("returned"),
        where(F.max, F.col("l_extendedprice"), F.col("l_discount") > 0.05).alias("top_discounted"),
        where(F.min, F.to_date("l_shipdate"), F.col("l_linestatus") == "O").alias("first_open"),
    )


@query("agg_max_sentinel", f"""
WITH {fx.EVENTS} SELECT user_id, day, max(coalesce(CASE WHEN event_type = 'click' THEN value END, -1)) AS score
FROM ev GROUP BY 1, 2""")
def agg_max_sentinel(spark, d):
    score = F.when(F.col("event_type") == "click", F.col("value"))
    return fx.events(spark, d).groupBy("user_id", "day").agg(
        F.max(F.coalesce(score, F.lit(-1.0))).alias("score")
    )


@query("agg_global", """
SELECT count(*) AS n, round(sum(l_quantity), 2) AS quantity, max(l_discount) AS top_discount FROM lineitem""")
def agg_global(spark, d):
    return fx.t(spark, d, "lineitem").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.max("l_discount").alias("top_discount")
    )


@query("agg_having", """
SELECT l_orderkey, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 150""")
def agg_having(spark, d):
    sums = fx.t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    return sums.filter("quantity > 150").withColumn("quantity", F.round("quantity", 2))


@query("distinct_rows", f"WITH {fx.ORDERS} SELECT DISTINCT o_custkey, month FROM orders_d")
def distinct_rows(spark, d):
    return fx.orders(spark, d).select("o_custkey", "month").distinct()


@query("agg_rollup_level", f"""
WITH {fx.SERIES} SELECT site, month, numerator, denominator, network, aggregation FROM series UNION ALL
SELECT network || ' Network', month, sum(numerator), sum(denominator), network, 'Network' FROM series GROUP BY network, month""")
def agg_rollup_level(spark, d):
    detail = fx.stored_series(spark, d).drop("measure")
    both = groups.append_level(
        detail, ["network", "month"], ["numerator", "denominator"], {"site": "", "aggregation": "Network"}
    )
    name = F.when(F.col("aggregation") == "Network", F.concat("network", F.lit(" Network"))).otherwise(F.col("site"))
    return both.withColumn("site", name)


@query("agg_list3", """
WITH c AS (SELECT DISTINCT o_custkey, o_orderpriority AS code FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY code) AS rn FROM c)
SELECT o_custkey, string_agg(code, '; ' ORDER BY code) AS code_list FROM r WHERE rn <= 3 GROUP BY 1""")
def agg_list3(spark, d):
    return groups.code_list(fx.t(spark, d, "orders"), ["o_custkey"], "o_orderpriority", 3)


@query("agg_ratio", f"""
WITH {fx.counts_sql()}, num AS (
  SELECT site, month, count(*) AS k FROM orders_d JOIN sites ON o_custkey = c_custkey
  WHERE o_orderstatus = 'P' AND o_totalprice > 400000 GROUP BY 1, 2)
SELECT c.site, c.month, CAST(coalesce(k, 0) AS DOUBLE) AS numerator, n AS denominator
FROM counts c LEFT JOIN num ON c.site = num.site AND c.month = num.month""")
def agg_ratio(spark, d):
    # numerator and denominator are two conditions on the same rows: one pass
    large = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)
    per_customer = fx.orders(spark, d).groupBy("o_custkey", "month").agg(
        F.count("*").alias("n"), groups.agg_where(F.count, F.lit(1), large).alias("k")
    )
    held = per_customer.join(fx.sites(spark, d), F.col("o_custkey") == F.col("c_custkey"))
    return held.groupBy("site", "month").agg(F.sum("k").cast("double").alias("numerator"), F.sum("n").alias("denominator"))


@query("agg_ratio_join", f"""
WITH {fx.counts_sql()}, num AS (
  SELECT n_name AS site, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS k
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity > 49 GROUP BY 1, 2)
SELECT c.site, c.month, CAST(coalesce(k, 0) AS DOUBLE) AS numerator, n AS denominator
FROM counts c LEFT JOIN num ON c.site = num.site AND c.month = num.month""")
def agg_ratio_join(spark, d):
    """Numerators and denominators from different facts."""
    nation = fx.t(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("site"))
    lines = fx.t(spark, d, "lineitem").filter("l_quantity > 49").groupBy(
        F.col("l_suppkey").alias("s_suppkey"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")
    ).agg(F.count("*").alias("k"))
    num = lines.join(fx.t(spark, d, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey").join(nation, "s_nationkey")
    num = num.groupBy("site", "month").agg(F.sum("k").alias("numerator"))
    den = fx.counts(spark, d).select("site", "month", F.col("n").alias("denominator"))
    return groups.ratio(num, den, ["site", "month"])


# ---------------------------------------------------------------- set operations, reshape


@query("union_align", """
SELECT o_custkey AS subject, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_custkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) FROM orders WHERE o_orderstatus <> 'F'""")
def union_align(spark, d):
    o = fx.orders(spark, d).withColumnRenamed("o_custkey", "subject")
    a = o.filter("o_orderstatus = 'F'").select("subject", "month")
    b = o.filter("o_orderstatus <> 'F'").select(dates.ceil_month(F.col("o_date")).alias("report_month"), "subject")
    return setops.append_aligned(a, b, {"report_month": "month"})


@query("upsert_by_key", f"""
WITH {fx.SERIES}, new AS (SELECT site, month, numerator + 1000 AS numerator, denominator FROM series
                          WHERE month >= DATE '2000-06-01')
SELECT site, month, numerator, denominator FROM series s
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.site = s.site AND n.month = s.month)
UNION ALL SELECT * FROM new""")
def upsert_by_key(spark, d):
    old = fx.stored_series(spark, d).select("site", "month", "numerator", "denominator")
    new = old.filter(F.col("month") >= dates.day("2000-06-01")).withColumn("numerator", F.col("numerator") + 1000)
    return setops.upsert(old, new, ["site", "month"])


@query("upsert_chain", f"""
WITH {fx.SERIES}, s0 AS (SELECT site, month, numerator FROM series),
a AS (SELECT site, month, numerator + 1000 AS numerator FROM s0 WHERE month >= DATE '1998-01-01'),
b AS (SELECT site, month, numerator + 2000 AS numerator FROM s0 WHERE month >= DATE '2001-01-01' OR month < DATE '1995-06-01'),
c AS (SELECT site, month, numerator + 3000 AS numerator FROM s0 WHERE month >= DATE '2001-06-01' OR month = DATE '1999-01-01'),
s1 AS (SELECT * FROM s0 ANTI JOIN a USING (site, month) UNION ALL SELECT * FROM a),
s2 AS (SELECT * FROM s1 UNION ALL SELECT * FROM b)
SELECT * FROM s2 ANTI JOIN c USING (site, month) UNION ALL SELECT * FROM c""")
def upsert_chain(spark, d):
    s0 = fx.stored_series(spark, d).select("site", "month", "numerator")
    m = F.col("month")

    def delivery(add, where):
        return s0.filter(where).withColumn("numerator", F.col("numerator") + add)

    a = delivery(1000, m >= dates.day("1998-01-01"))
    b = delivery(2000, (m >= dates.day("2001-01-01")) | (m < dates.day("1995-06-01")))
    c = delivery(3000, (m >= dates.day("2001-06-01")) | (m == dates.day("1999-01-01")))
    return setops.upsert_all(s0, [(a, True), (b, False), (c, True)], ["site", "month"])


@query("union_distinct", """
SELECT c_nationkey AS site, 'x' AS kind FROM customer WHERE c_acctbal > 9000
UNION SELECT s_nationkey, 'x' FROM supplier""")
def union_distinct(spark, d):
    a = fx.t(spark, d, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("site"), F.lit("x").alias("kind"))
    b = fx.t(spark, d, "supplier").select(F.col("s_nationkey").alias("site"), F.lit("x").alias("kind"))
    return a.union(b).distinct()


@query("unpivot", f"""
WITH {fx.counts_sql()} SELECT site, month, 'Initial Intake' AS measure, n_f AS numerator FROM counts
UNION ALL SELECT site, month, 'Crisis Stabilization', n_o FROM counts""")
def unpivot(spark, d):
    return project.unpivot(
        fx.counts(spark, d), ["site", "month"], {"n_f": "Initial Intake", "n_o": "Crisis Stabilization"},
        "measure", "numerator",
    )


@query("pivot_rownum", """
WITH c AS (SELECT DISTINCT o_custkey, o_orderpriority AS code FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY code) AS rn FROM c)
SELECT o_custkey, max(CASE WHEN rn = 1 THEN code END) AS row1, max(CASE WHEN rn = 2 THEN code END) AS row2,
       max(CASE WHEN rn = 3 THEN code END) AS row3 FROM r GROUP BY 1""")
def pivot_rownum(spark, d):
    return groups.pivot_rownum(fx.t(spark, d, "orders"), ["o_custkey"], "o_orderpriority", 3)


@query("fn_recode_map", f"""
WITH {fx.counts_sql()} SELECT CASE site WHEN 'NATION_0' THEN 'Hilltop' WHEN 'NATION_3' THEN 'Hilltop'
    WHEN 'NATION_7' THEN 'Seven' WHEN 'NATION_11' THEN 'Eleven'
    ELSE CASE WHEN site LIKE 'NATION_1%' THEN 'Group ' || site ELSE site END END AS site,
  CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY 1""")
def fn_recode_map(spark, d):
    """Names by a table of rules: whole names, and a prefix that keeps the name; the longest counts."""
    table = tables.params(
        spark,
        [(1, "NATION_0", True, "Hilltop", False), (2, "NATION_3", True, "Hilltop", False), (3, "NATION_7", True, "Seven", False),
         (4, "NATION_1", False, "Group ", True), (5, "NATION_11", True, "Eleven", False), (6, "NATION_11", False, "no", False)],
        f"{rules.RULE}, name string, keeps boolean",
    )
    named = rules.by_prefix(fx.counts(spark, d), "site", table, ["name", "keeps"])
    name = F.when(F.col("keeps"), F.concat("name", "site")).otherwise(F.coalesce("name", "site"))
    return named.groupBy(name.alias("site")).agg(F.sum("n").alias("n"))


# Part types are codes of one to three characters here; later rules repeat and narrow earlier ones.
CLASS_RULES = [(1, "12", True, "a"), (2, "1", False, "b"), (3, "2", False, "c"), (4, "23", False, "d"), (5, "23", True, "e"), (6, "4", True, "f"), (7, "", False, "rest")]


@query("classify_by_rules", """
WITH c AS (SELECT CASE WHEN p_size % 10 = 9 THEN NULL ELSE CAST(p_partkey % 260 AS VARCHAR) END AS code FROM part)
SELECT code, count(*) AS n,
  CASE WHEN code IS NULL THEN NULL WHEN code = '23' THEN 'e' WHEN code LIKE '23%' THEN 'd' WHEN code = '12' THEN 'a' WHEN code = '4' THEN 'f'
       WHEN code LIKE '1%' THEN 'b' WHEN code LIKE '2%' THEN 'c' ELSE 'rest' END AS longest,
  CASE WHEN code IS NULL THEN NULL WHEN code = '12' THEN 'a' WHEN code LIKE '1%' THEN 'b' WHEN code LIKE '2%' THEN 'c' WHEN code LIKE '23%' THEN 'd'
       WHEN code = '4' THEN 'f' ELSE 'rest' END AS first
FROM c GROUP BY 1""")
def classify_by_rules(spark, d):
    """Codes by longest prefix and by first rule of the same table."""
    part = fx.t(spark, d, "part").select(F.when(F.col("p_size") % 10 != 9, (F.col("p_partkey") % 260).cast("string")).alias("code"))
    table = tables.params(spark, CLASS_RULES, f"{rules.RULE}, class string")
    counted = part.groupBy("code").agg(F.count("*").alias("n"))
    both = rules.by_prefix(counted, "code", table.withColumnRenamed("class", "longest"), ["longest"])
    return rules.by_prefix(both, "code", table.withColumnRenamed("class", "first"), ["first"], longest=False)


@query("redelivered_months", f"""
WITH {fx.SERIES}, s AS (SELECT site, month, numerator, denominator FROM series),
new AS (SELECT site, month, numerator + 1000 AS numerator, denominator FROM s
        WHERE month IN (DATE '1997-03-01', DATE '1998-05-01') AND site <> 'NATION_4')
SELECT * FROM s ANTI JOIN new USING (site, month) UNION ALL SELECT * FROM new""")
def redelivered_months(spark, d):
    """A table kept by month into which two months are delivered again."""
    rows = fx.stored_series(spark, d).select("site", "month", "numerator", "denominator")
    path = scratch_path(spark, "months")
    publish.write_months(rows, path)
    again = F.col("month").isin([dates.day("1997-03-01"), dates.day("1998-05-01")])
    new = rows.filter(again & (F.col("site") != "NATION_4")).withColumn("numerator", F.col("numerator") + 1000)
    publish.redeliver(path, new, ["site", "month"])
    return publish.read_months(spark, path, rows)
