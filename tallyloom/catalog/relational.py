"""Projection, predicates and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import dates, logic
from tallyloom.operators import calendar, intervals, joins, project, rules
from tallyloom.plans import facts, population
from tallyloom.sources import tables

# ---------------------------------------------------------------- projection, predicates


@query("project_rename", "SELECT o_orderkey AS encounter, o_custkey AS subject, o_orderstatus AS status FROM orders")
def project_rename(spark, d):
    df = project.select_as(fx.t(spark, d, "orders"), encounter="o_orderkey", subject="o_custkey", state="o_orderstatus")
    return project.rename(df, status="state")


@query("project_range", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def project_range(spark, d):
    return project.cols_between(fx.t(spark, d, "lineitem"), "l_quantity", "l_tax")


@query("project_drop", "SELECT * EXCLUDE (p_name, p_retailprice) FROM part")
def project_drop(spark, d):
    return fx.t(spark, d, "part").drop("p_name", "p_retailprice")


@query("derive", """
SELECT l_orderkey, l_linenumber, round(net, 6) AS net, round(net * (1 + l_tax), 6) AS gross,
       CASE WHEN net * (1 + l_tax) > 50000 THEN 'large' ELSE 'small' END AS size_class, 'Practice' AS aggregation
FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem)""")
def derive(spark, d):
    return (
        fx.t(spark, d, "lineitem")
        .withColumn("net0", F.col("l_extendedprice") * (1 - F.col("l_discount")))
        .withColumn("gross0", F.col("net0") * (1 + F.col("l_tax")))
        .select(
            "l_orderkey", "l_linenumber", F.round("net0", 6).alias("net"), F.round("gross0", 6).alias("gross"),
            F.when(F.col("gross0") > 50000, "large").otherwise("small").alias("size_class"),
            F.lit("Practice").alias("aggregation"),
        )
    )


@query("filter_and", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE nullif(l_quantity, 7) > 5 AND l_discount < 0.05 AND l_shipdate >= TIMESTAMP '1997-01-01'""")
def filter_and(spark, d):
    return (
        fx.t(spark, d, "lineitem")
        .filter(
            (F.nullif(F.col("l_quantity"), F.lit(7.0)) > 5)
            & (F.col("l_discount") < 0.05)
            & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        )
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


OPEN_SPANS = fx.SPANS + """, sp AS (
  SELECT o_custkey, start_date, CASE WHEN end_date >= DATE '2001-06-01' THEN NULL ELSE end_date END AS end_date
  FROM spans)"""


def open_spans(spark, d):
    end = F.when(F.col("end_date") < dates.day("2001-06-01"), F.col("end_date"))
    return fx.spans(spark, d).withColumn("end_date", end)


@query("filter_or_null", f"""
WITH {OPEN_SPANS} SELECT o_custkey, start_date, end_date FROM sp
WHERE DATE '2001-03-15' <= end_date OR end_date IS NULL""")
def filter_or_null(spark, d):
    on = dates.day("2001-03-15")
    return open_spans(spark, d).filter(logic.open_or(F.col("end_date"), on <= F.col("end_date")))


@query("in_list", """
SELECT o_orderpriority, count(*) AS n FROM orders
WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND o_orderstatus IN ('F', 'O') GROUP BY 1""")
def in_list(spark, d):
    return (
        fx.t(spark, d, "orders")
        .filter(logic.in_list(F.col("o_orderpriority"), ["1-URGENT", "3-MEDIUM"]))
        .filter(logic.in_list(F.col("o_orderstatus"), ["F", "O"]))
        .groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    )


@query("not_in_null_true", """
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
WHERE NOT coalesce(nullif(c_mktsegment, 'BUILDING') IN ('FURNITURE', 'MACHINERY'), FALSE)""")
def not_in_null_true(spark, d):
    c = fx.t(spark, d, "customer").select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return c.filter(logic.not_in(F.col("segment"), ["FURNITURE", "MACHINERY"]))


@query("not_in_sql", """
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
WHERE nullif(c_mktsegment, 'BUILDING') NOT IN ('FURNITURE', 'MACHINERY')""")
def not_in_sql(spark, d):
    c = fx.t(spark, d, "customer").select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return c.filter(logic.not_in_sql(F.col("segment"), ["FURNITURE", "MACHINERY"]))


@query("like_class", """
SELECT p_brand, count(*) AS n FROM part
WHERE (p_brand LIKE 'Brand#1%' AND p_brand NOT LIKE 'Brand#18%') OR p_brand LIKE 'Brand#2%' OR p_name LIKE 'red%' GROUP BY 1""")
def like_class(spark, d):
    """The classes are rows: a longer prefix takes out what a shorter one takes in, and of equal ones the first counts."""
    table = tables.params(
        spark,
        [(1, "Brand#1", False, True), (2, "Brand#18", False, False), (3, "Brand#2", False, True), (4, "red", False, True), (5, "red", False, False)],
        f"{rules.RULE}, taken boolean",
    )
    part = fx.t(spark, d, "part").select("p_brand", "p_name")
    brands = rules.by_prefix(part, "p_brand", table.withColumnRenamed("taken", "by_brand"), ["by_brand"])
    both = rules.by_prefix(brands, "p_name", table.withColumnRenamed("taken", "by_name"), ["by_name"])
    return both.filter("by_brand OR by_name").groupBy("p_brand").agg(F.count("*").alias("n"))


@query("like_pattern", """
SELECT p_brand, count(*) AS n FROM part
WHERE regexp_matches(p_brand, '^Brand#1[^8]$') OR p_brand LIKE '%#2_' OR p_name LIKE 'red%' GROUP BY 1""")
def like_pattern(spark, d):
    brand = F.col("p_brand")
    return (
        fx.t(spark, d, "part")
        .filter(brand.rlike("^Brand#1[^8]$") | brand.like("%#2_") | F.col("p_name").startswith("red"))
        .groupBy("p_brand").agg(F.count("*").alias("n"))
    )


@query("null_predicates", """
SELECT CAST(seg IS NULL AS INTEGER) AS missing, CAST(pri IS NOT NULL AS INTEGER) AS present,
       CAST(seg IS NULL OR trim(seg) = '' AS INTEGER) AS blank, count(*) AS n
FROM (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'FURNITURE' THEN ' ' ELSE c_mktsegment END AS seg,
             nullif(o_orderpriority, '5-LOW') AS pri
      FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY 1, 2, 3""")
def null_predicates(spark, d):
    seg = F.col("seg")
    per = fx.t(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("c"))
    df = per.join(fx.t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(F.col("c_mktsegment") == "FURNITURE", " ").otherwise(
            F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
        ).alias("seg"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("pri"), "c",
    )
    return df.groupBy(
        seg.isNull().cast("int").alias("missing"), F.col("pri").isNotNull().cast("int").alias("present"),
        logic.is_blank(seg).cast("int").alias("blank"),
    ).agg(F.sum("c").alias("n"))


@query("closed_month_filter", f"""
WITH {fx.ORDERS} SELECT month, count(*) AS n FROM orders_d WHERE month < DATE '2001-08-01' GROUP BY 1""")
def closed_month_filter(spark, d):
    months = fx.orders(spark, d).groupBy("month").agg(F.count("*").alias("n"))
    return calendar.closed_months(months, dates.day(fx.ORDERS_AS_OF), 15)


@query("effective_on", f"""
WITH {OPEN_SPANS} SELECT o_custkey, start_date, end_date FROM sp
WHERE start_date <= DATE '1998-06-30' AND (end_date IS NULL OR end_date >= DATE '1998-06-30')""")
def effective_on(spark, d):
    on = dates.day("1998-06-30")
    return open_spans(spark, d).filter(logic.valid_on(on, F.col("start_date"), F.col("end_date")))


@query("sentinel_null", f"""
WITH {OPEN_SPANS} SELECT o_custkey, coalesce(end_date, DATE '2099-01-01') AS end_or_far,
  nullif(coalesce(end_date, DATE '2099-01-01'), DATE '2099-01-01') AS end_back FROM sp""")
def sentinel_null(spark, d):
    far = dates.day("2099-01-01")
    df = open_spans(spark, d).select("o_custkey", F.coalesce("end_date", far).alias("end_or_far"))
    return df.withColumn("end_back", F.nullif(F.col("end_or_far"), far))


@query("date_guarded_attribution", """
SELECT l_suppkey, site, count(*) AS n FROM (
  SELECT l_suppkey, CASE
      WHEN l_returnflag = 'A' AND l_shipdate < TIMESTAMP '1998-03-09' THEN 'guarded'
      WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'by flag'
      WHEN l_returnflag = 'R' THEN 'always' END AS site
  FROM lineitem) WHERE site IS NOT NULL GROUP BY 1, 2""")
def date_guarded_attribution(spark, d):
    rules = tables.params(
        spark,
        [("A", "guarded", "1998-03-09", None), ("N", "by flag", None, "O"), ("R", "always", None, None)],
        "member string, site string, valid_to string, flag string",
    )
    lines = fx.t(spark, d, "lineitem").select(
        "l_suppkey", "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("day")
    )
    mine = facts.attributed(lines, rules, "l_returnflag", "day", "l_linestatus")
    return mine.groupBy("l_suppkey", "site").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- joins


@query("join_inner", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(spark, d):
    o = fx.t(spark, d, "orders").withColumnRenamed("o_custkey", "subject")
    c = fx.t(spark, d, "customer").withColumnRenamed("c_custkey", "subject")
    return o.join(c, "subject").select("o_orderkey", "c_name", "o_totalprice")


@query("join_left", """
SELECT d.doc_id, d.lang, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def join_left(spark, d):
    docs = fx.t(spark, d, "documents").select("doc_id", "lang")
    labels = fx.t(spark, d, "labels").withColumns({c: F.col(c).cast("double") for c in ("quality", "toxic")})
    return docs.join(joins.assert_unique(labels, ["doc_id"]), "doc_id", "left")


@query("join_right", """
SELECT o.o_orderkey, o.o_custkey, l.l_quantity
FROM lineitem l RIGHT JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag <> 'R'""")
def join_right(spark, d):
    lines = fx.t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_returnflag")
    o = fx.t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return lines.join(o, "o_orderkey", "right").filter("l_returnflag <> 'R'").drop("l_returnflag")


@query("join_anti", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def join_anti(spark, d):
    o = fx.t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return joins.anti(o, fx.t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("join_semi_distinct", """
SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def join_semi_distinct(spark, d):
    docs = fx.t(spark, d, "documents").select("doc_id", "source", "n_chars")
    return joins.semi(docs, fx.t(spark, d, "labels").filter("quality = 1"), ["doc_id"])


@query("join_null_safe", """
WITH c AS (SELECT nullif(c_mktsegment, 'BUILDING') AS segment, c_nationkey AS nation, count(*) AS customers,
                  round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1, 2),
o AS (SELECT nullif(c_mktsegment, 'BUILDING') AS segment, c_nationkey AS nation, count(*) AS n_orders
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' AND o_totalprice > 200000 GROUP BY 1, 2)
SELECT c.segment, c.nation, customers, balance, n_orders
FROM c JOIN o ON c.segment IS NOT DISTINCT FROM o.segment AND c.nation IS NOT DISTINCT FROM o.nation""")
def join_null_safe(spark, d):
    c = fx.t(spark, d, "customer").select(
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"), F.col("c_nationkey").alias("nation"),
        "c_custkey", "c_acctbal",
    )
    customers = c.groupBy("segment", "nation").agg(
        F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )
    per_customer = (
        fx.t(spark, d, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 200000")
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"))
    )
    held = per_customer.join(c, "c_custkey").groupBy("segment", "nation").agg(F.sum("k").alias("n_orders"))
    return joins.natural_join(customers, held)


# Three of ten orders don't know their customer; the unknown one is a row of the dimension.
@query("join_null_keys", """
WITH o AS (SELECT CASE WHEN o_orderkey % 10 >= 3 THEN o_custkey END AS k, o_orderstatus, o_totalprice FROM orders),
c AS (SELECT c_custkey AS k, c_mktsegment AS segment FROM customer UNION ALL SELECT NULL, 'unknown')
SELECT segment, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS price
FROM o JOIN c ON o.k IS NOT DISTINCT FROM c.k GROUP BY 1, 2""")
def join_null_keys(spark, d):
    o, c = orders_of_some(spark, d), fx.t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    c = c.union(spark.createDataFrame([(None, "unknown")], c.schema))
    found = joins.null_split_join(o, c, ["k"])
    return found.groupBy("segment", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("price"))


def orders_of_some(spark, d):
    key = F.when(F.col("o_orderkey") % 10 >= 3, F.col("o_custkey")).alias("k")
    return fx.t(spark, d, "orders").select(key, "o_orderkey", "o_orderstatus", "o_totalprice")


@query("join_null_anti", """
WITH o AS (SELECT CASE WHEN o_orderkey % 10 >= 3 THEN o_custkey END AS k, o_orderkey, o_orderstatus FROM orders),
gone AS (SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING'), gone2 AS (SELECT k FROM gone UNION ALL SELECT NULL)
SELECT 'without' AS list, o_orderstatus, count(*) AS n FROM o WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.k IS NOT DISTINCT FROM o.k) GROUP BY 1, 2
UNION ALL SELECT 'known', o_orderstatus, count(*) FROM o WHERE NOT EXISTS (SELECT 1 FROM gone2 g WHERE g.k IS NOT DISTINCT FROM o.k) GROUP BY 1, 2""")
def join_null_anti(spark, d):
    """Orders without the customers of a list, which holds the unknown one or doesn't."""
    gone = fx.t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"))
    lists = {"without": gone, "known": gone.union(spark.createDataFrame([(None,)], gone.schema))}
    parts = [
        joins.anti(orders_of_some(spark, d), keys, ["k"]).groupBy(F.lit(name).alias("list"), "o_orderstatus").agg(F.count("*").alias("n"))
        for name, keys in lists.items()
    ]
    return parts[0].union(parts[1])


@query("join_renamed_keys", """
SELECT l_orderkey, l_linenumber, l_suppkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def join_renamed_keys(spark, d):
    lines = fx.t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.join_renamed(lines, fx.t(spark, d, "supplier").select("s_suppkey", "s_name"), {"l_suppkey": "s_suppkey"})


@query("join_theta_left", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) AS end_date, l_quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND o_orderdate < l_shipdate""")
def join_theta_left(spark, d):
    starts = fx.orders(spark, d).select("o_orderkey", F.col("o_date").alias("start_date"))
    ends = fx.t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("end_date"), "l_quantity"
    )
    # a start without a later end is one that no last end lies after
    last = ends.groupBy("o_orderkey").agg(F.max("end_date").alias("end_date"))
    return joins.left_join_where(starts, ends, ["o_orderkey"], F.col("start_date") < F.col("end_date"), probes=last)


@query("join_point_in_interval", f"""
WITH {fx.FREE_SPANS} SELECT o.o_orderkey, o.o_date, span, lo, hi FROM orders_d o
JOIN free ON o.o_custkey = free.o_custkey AND o.o_date >= lo AND (o.o_date <= hi OR hi IS NULL)""")
def join_point_in_interval(spark, d):
    o = fx.orders(spark, d).select("o_orderkey", "o_custkey", "o_date")
    found = intervals.join_in_interval(o, fx.free_spans(spark, d).drop("priority"), ["o_custkey"], "o_date", "lo", "hi")
    return found.select("o_orderkey", "o_date", "span", "lo", "hi")


@query("join_overlapping", f"""
WITH {fx.FREE_SPANS} SELECT a.span AS span, b.span AS other FROM free a JOIN free b ON a.o_custkey = b.o_custkey
  AND a.priority <> b.priority AND a.lo <= coalesce(b.hi, DATE '9999-12-31') AND b.lo <= coalesce(a.hi, DATE '9999-12-31')
WHERE a.lo <= coalesce(a.hi, DATE '9999-12-31') AND b.lo <= coalesce(b.hi, DATE '9999-12-31')""")
def join_overlapping(spark, d):
    a = fx.free_spans(spark, d)
    b = a.withColumnsRenamed({"span": "other", "lo": "lo2", "hi": "hi2", "priority": "priority2"})
    pairs = intervals.join_overlapping(a, b, ["o_custkey"], ("lo", "hi"), ("lo2", "hi2"))
    return pairs.filter("priority <> priority2").select("span", "other")


@query("join_point_in_month", f"""
WITH {fx.ORDERS}, s AS (SELECT o_custkey, month, CAST(last_day(month) AS DATE) AS month_end, count(*) AS n_month
                        FROM orders_d GROUP BY 1, 2)
SELECT o.o_orderkey, o.o_date, s.month, s.n_month FROM orders_d o
JOIN s ON o.o_custkey = s.o_custkey AND o.o_date >= s.month AND o.o_date <= s.month_end""")
def join_point_in_month(spark, d):
    o = fx.orders(spark, d)
    s = o.groupBy("o_custkey", "month").agg(F.count("*").alias("n_month"))
    return joins.join_in_month(
        o.select("o_orderkey", "o_custkey", "o_date"), s, ["o_custkey"], "o_date"
    ).select("o_orderkey", "o_date", "month", "n_month")


@query("join_range_calendar", f"""
WITH {fx.SPANS}, {fx.MONTHS} SELECT month, count(*) AS members, CAST(sum(o_custkey) AS BIGINT) AS key_sum
FROM spans JOIN months ON start_date <= month_end GROUP BY month""")
def join_range_calendar(spark, d):
    lo, hi = dates.day(fx.FIRST_MONTH), dates.day(fx.LAST_MONTH)
    expanded = joins.expand_months(fx.spans(spark, d), F.col("start_date"), hi, lo, hi)
    return expanded.groupBy("month").agg(F.count("*").alias("members"), F.sum("o_custkey").alias("key_sum"))


@query("join_cross_filter", f"""
WITH {OPEN_SPANS}, {fx.MONTHS} SELECT month, count(*) AS members, CAST(sum(o_custkey) AS BIGINT) AS key_sum
FROM sp CROSS JOIN months WHERE month >= start_date AND (month <= end_date OR end_date IS NULL) GROUP BY month""")
def join_cross_filter(spark, d):
    lo, hi = dates.day(fx.FIRST_MONTH), dates.day(fx.LAST_MONTH)
    valid = population.valid_members(open_spans(spark, d), ["start_date"], ["end_date"], lo, hi)
    return valid.groupBy("month").agg(F.count("*").alias("members"), F.sum("o_custkey").alias("key_sum"))


@query("join_then_range", f"""
WITH {fx.FREE_SPANS} SELECT priority, count(*) AS n_lines, CAST(count(DISTINCT span) AS BIGINT) AS n_spans
FROM orders_d o JOIN lineitem ON o_orderkey = l_orderkey JOIN free ON o.o_custkey = free.o_custkey
WHERE CAST(l_shipdate AS DATE) >= lo AND (CAST(l_shipdate AS DATE) <= hi OR hi IS NULL) GROUP BY 1""")
def join_then_range(spark, d):
    lines = fx.t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("day"))
    owned = lines.join(fx.t(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    found = intervals.join_in_interval(owned, fx.free_spans(spark, d), ["o_custkey"], "day", "lo", "hi")
    per_span = found.groupBy("priority", "span").agg(F.count("*").alias("n"))
    return per_span.groupBy("priority").agg(F.sum("n").alias("n_lines"), F.count("*").alias("n_spans"))


@query("join_then_range_days", """
SELECT o_orderpriority, count(*) AS n_lines, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_orders
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 90 DAY GROUP BY 1""")
def join_then_range_days(spark, d):
    o = fx.orders(spark, d).select("o_orderkey", "o_orderpriority", "o_date")
    lines = fx.t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("day"))
    inside = F.col("day").between(F.col("o_date"), F.date_add("o_date", 90))
    # the join is on the order, so counting per order needs no exchange of its own
    per_order = joins.join_where(o, lines, ["o_orderkey"], inside).groupBy("o_orderkey", "o_orderpriority").agg(F.count("*").alias("n"))
    return per_order.groupBy("o_orderpriority").agg(F.sum("n").alias("n_lines"), F.count("*").alias("n_orders"))


@query("join_or", """
SELECT s_suppkey, s_name, count(*) AS n, round(sum(l_quantity), 2) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey OR l_partkey = s_suppkey GROUP BY 1, 2""")
def join_or(spark, d):
    lines = fx.t(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    per_pair = lines.groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("k"), F.sum("l_quantity").alias("q"))
    either = joins.join_either(per_pair, fx.t(spark, d, "supplier"), ["l_suppkey", "l_partkey"], "s_suppkey")
    return either.groupBy("s_suppkey", "s_name").agg(F.sum("k").alias("n"), F.round(F.sum("q"), 2).alias("quantity"))


VERSIONS = """versions AS (
  SELECT p_partkey, 1 AS version, DATE '1900-01-01' AS v_start, DATE '1997-12-31' + p_size AS v_end, p_brand FROM part
  UNION ALL SELECT p_partkey, 2, DATE '1998-01-01' + p_size, NULL, p_brand FROM part)"""


def part_versions(spark, d):
    cut = F.date_add(dates.day("1998-01-01"), F.col("p_size"))
    return fx.t(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand",
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("version"), dates.day("1900-01-01").alias("v_start"), F.date_sub(cut, 1).alias("v_end")),
                F.struct(F.lit(2).alias("version"), cut.alias("v_start"), F.lit(None).cast("date").alias("v_end")),
            )
        ),
    )


@query("join_effective_dim", f"""
WITH {VERSIONS} SELECT p_brand, version, count(*) AS n, round(sum(l_quantity), 2) AS quantity
FROM lineitem JOIN versions ON l_partkey = p_partkey AND CAST(l_shipdate AS DATE) >= v_start
  AND (v_end IS NULL OR CAST(l_shipdate AS DATE) <= v_end) GROUP BY 1, 2""")
def join_effective_dim(spark, d):
    lines = fx.t(spark, d, "lineitem").select("l_partkey", "l_quantity", F.to_date("l_shipdate").alias("day"))
    return (
        joins.scd2_join(lines, part_versions(spark, d), ["l_partkey"], "day", "v_start", "v_end")
        .groupBy("p_brand", "version").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


@query("join_star", f"""
WITH {fx.SITES} SELECT site, network, p_type, count(*) AS n, round(sum(l_extendedprice), 2) AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN sites ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE o_orderstatus <> 'P' GROUP BY 1, 2, 3""")
def join_star(spark, d):
    c = F.col
    return (
        fx.t(spark, d, "lineitem")
        .join(fx.t(spark, d, "supplier").select("s_suppkey"), c("l_suppkey") == c("s_suppkey"))
        .join(fx.t(spark, d, "part").select("p_partkey", "p_type"), c("l_partkey") == c("p_partkey"))
        .join(fx.t(spark, d, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey"))
        .join(fx.sites(spark, d), c("o_custkey") == c("c_custkey"))
        .groupBy("site", "network", "p_type").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    )


@query("join_left_residual", """
SELECT o_orderkey, l_extendedprice, l_quantity FROM orders
LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity > 30""")
def join_left_residual(spark, d):
    lines = fx.t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice", "l_quantity", "l_returnflag")
    on = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30)
    o = fx.t(spark, d, "orders").select("o_orderkey")
    # a condition on the right side alone filters it before the join
    return joins.left_join_where(o, lines.filter(on).drop("l_returnflag"), ["o_orderkey"])


@query("join_left_is_null", """
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL""")
def join_left_is_null(spark, d):
    return joins.anti(fx.t(spark, d, "documents").select("doc_id", "lang"), fx.t(spark, d, "labels"), ["doc_id"])


@query("join_coalesce_pair", f"""
WITH {fx.SERIES} SELECT b.site, b.month, coalesce(o.numerator, b.numerator) AS numerator,
  coalesce(o.denominator, b.denominator) AS denominator
FROM series b LEFT JOIN (SELECT site, month, nullif(numerator, 3) + 100 AS numerator, denominator FROM series
                         WHERE month >= DATE '1999-01-01') o ON b.site = o.site AND b.month = o.month""")
def join_coalesce_pair(spark, d):
    base = fx.stored_series(spark, d).select("site", "month", "numerator", "denominator")
    over = base.filter(F.col("month") >= dates.day("1999-01-01")).withColumn(
        "numerator", F.nullif(F.col("numerator"), F.lit(3.0)) + 100
    )
    return joins.overlay(base, over, ["site", "month"], ["numerator", "denominator"])


@query("join_neighbours", f"""
WITH {fx.SERIES} SELECT s.site, s.month, p.denominator AS before, n.denominator AS after FROM series s
JOIN series p ON p.site = s.site AND p.month = s.month - INTERVAL 1 MONTH
JOIN series n ON n.site = s.site AND n.month = s.month + INTERVAL 1 MONTH""")
def join_neighbours(spark, d):
    rows = fx.stored_series(spark, d).select("site", "month", "denominator")
    at = rows.withColumns({"prev": F.add_months("month", -1), "next": F.add_months("month", 1)})
    found = joins.neighbour_values(
        at.drop("denominator"), ["site"], {"before": "prev", "after": "next"}, "month", rows, "denominator"
    )
    return found.select("site", "month", "before", "after")


@query("join_cardinality", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def join_cardinality(spark, d):
    return joins.duplicate_keys(fx.t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
