"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import dates, logic, numbers, text


@query("fn_case", """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'high' WHEN o_orderstatus = 'P' THEN 'pending'
  WHEN o_orderpriority LIKE '1-%' THEN 'urgent' END AS class FROM orders""")
def fn_case(spark, d):
    rules = [
        (F.col("o_totalprice") > 400000, "high"),
        (F.col("o_orderstatus") == "P", "pending"),
        (F.col("o_orderpriority").startswith("1-"), "urgent"),
    ]
    return fx.t(spark, d, "orders").select("o_orderkey", logic.case(rules).alias("class"))


@query("fn_if", """
SELECT o_orderkey, CASE WHEN p > 300000 THEN 'over' WHEN NOT p > 300000 THEN 'under' END AS side
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS p FROM orders)""")
def fn_if(spark, d):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return fx.t(spark, d, "orders").select("o_orderkey", logic.if_else(price > 300000, "over", "under").alias("side"))


@query("fn_coalesce", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'), 'none') AS code FROM orders""")
def fn_coalesce(spark, d):
    code = F.coalesce(
        F.nullif(F.col("o_orderstatus"), F.lit("P")), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("none")
    )
    return fx.t(spark, d, "orders").select("o_orderkey", code.alias("code"))


def _per_day(spark, d):
    """Distinct order days: what date functions are computed on."""
    return fx.orders(spark, d).groupBy("o_date").agg(F.count("*").alias("n"))


DAYS = fx.ORDERS + ", od AS (SELECT o_date, count(*) AS n FROM orders_d GROUP BY 1)"


@query("fn_floor_month", f"WITH {DAYS} SELECT o_date, n, CAST(date_trunc('month', o_date) AS DATE) AS m FROM od")
def fn_floor_month(spark, d):
    return _per_day(spark, d).withColumn("m", dates.floor_month(F.col("o_date")))


@query("fn_ceil_month", f"""
WITH {DAYS} SELECT o_date, n, CAST(date_trunc('month', o_date) + INTERVAL 1 MONTH AS DATE) AS m FROM od""")
def fn_ceil_month(spark, d):
    return _per_day(spark, d).withColumn("m", dates.ceil_month(F.col("o_date")))


@query("fn_month_end", f"WITH {DAYS} SELECT o_date, n, CAST(last_day(o_date) AS DATE) AS m FROM od")
def fn_month_end(spark, d):
    return _per_day(spark, d).withColumn("m", dates.month_end(F.col("o_date")))


@query("fn_date_shift", f"WITH {DAYS} SELECT o_date, n, o_date + 90 AS later, o_date - 1 AS earlier FROM od")
def fn_date_shift(spark, d):
    day = F.col("o_date")
    return _per_day(spark, d).withColumns({"later": dates.shift_days(day, 90), "earlier": dates.shift_days(day, -1)})


@query("fn_date_diff", """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def fn_date_diff(spark, d):
    lines = fx.t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship"))
    o = fx.orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), "o_date")
    return lines.join(o, "l_orderkey").select(
        "l_orderkey", "l_linenumber", dates.days_between(F.col("ship"), F.col("o_date")).alias("days")
    )


@query("fn_date_parts", f"""
WITH {DAYS} SELECT o_date, CAST(year(o_date) AS INTEGER) AS y, CAST(month(o_date) AS INTEGER) AS m,
  CAST(day(o_date) AS INTEGER) AS d, n FROM od""")
def fn_date_parts(spark, d):
    return _per_day(spark, d).withColumns(
        {"y": F.year("o_date"), "m": F.month("o_date"), "d": F.dayofmonth("o_date")}
    )


@query("fn_date_build", f"""
WITH {DAYS} SELECT o_date, n, CAST(strftime(o_date, '%Y%m%d') AS INTEGER) AS key, o_date AS from_key,
  make_date(year(o_date), month(o_date), 1) AS from_parts FROM od""")
def fn_date_build(spark, d):
    day = F.col("o_date")
    return _per_day(spark, d).withColumn("key", dates.key_of_date(day)).withColumns(
        {
            "from_key": dates.date_of_key(F.col("key")),
            "from_parts": dates.date_of(F.year(day).cast("string"), F.date_format(day, "MM")),
        }
    )


@query("fn_date_parse", f"""
WITH {DAYS} SELECT month(o_date) || '/' || day(o_date) || '/' || year(o_date) || ' 12:00' AS txt, o_date AS parsed, n FROM od""")
def fn_date_parse(spark, d):
    txt = F.concat(F.date_format("o_date", "M/d/yyyy"), F.lit(" 12:00"))
    days = _per_day(spark, d).withColumn("txt", txt)
    return days.select("txt", dates.parse_date(F.col("txt")).alias("parsed"), "n")


@query("fn_age_at", f"""
WITH {fx.SPANS} SELECT o_custkey, CAST(year(end_date) - year(start_date)
  - CASE WHEN strftime(end_date, '%m%d') < strftime(start_date, '%m%d') THEN 1 ELSE 0 END AS INTEGER) AS age FROM spans""")
def fn_age_at(spark, d):
    age = dates.age_at(F.col("start_date"), F.col("end_date"))
    return fx.spans(spark, d).select("o_custkey", age.alias("age"))


@query("fn_month_name_num", f"""
WITH {DAYS} SELECT strftime(o_date, '%B') AS name, strftime(o_date, '%m') AS no, CAST(sum(n) AS BIGINT) AS n
FROM od GROUP BY 1, 2""")
def fn_month_name_num(spark, d):
    named = _per_day(spark, d).withColumn("name", dates.month_name(F.col("o_date")))
    return named.groupBy("name", dates.month_no(F.col("name")).alias("no")).agg(F.sum("n").alias("n"))


@query("fn_left_right", """
SELECT c_custkey, left(c_name, 4) AS head, right(c_name, 3) AS tail FROM customer""")
def fn_left_right(spark, d):
    name = F.col("c_name")
    return fx.t(spark, d, "customer").select("c_custkey", text.left(name, 4).alias("head"), text.right(name, 3).alias("tail"))


@query("fn_str_clean", """
SELECT p_partkey, regexp_replace(p_brand, 'Brand#', '') AS code,
  'X.' || CAST(p_partkey AS VARCHAR) AS skey,
  'PART ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
  concat_ws('; ', nullif(p_type, 'LARGE'), p_brand) AS codes FROM part""")
def fn_str_clean(spark, d):
    return fx.t(spark, d, "part").select(
        "p_partkey", text.remove_first(F.col("p_brand"), "Brand#").alias("code"),
        F.concat(F.lit("X."), F.col("p_partkey").cast("string")).alias("skey"),
        text.prefixed_title(F.concat(F.lit("PART "), F.upper("p_name")), "PART ").alias("title"),
        text.join_present("; ", F.nullif(F.col("p_type"), F.lit("LARGE")), F.col("p_brand")).alias("codes"),
    )


@query("fn_first_number", """
SELECT page_id, nullif(regexp_extract(url, '(\\d+)', 1), '') AS first_no FROM pages""")
def fn_first_number(spark, d):
    return fx.t(spark, d, "pages").select("page_id", text.first_number(F.col("url")).alias("first_no"))


@query("fn_split_keep_first", """
SELECT doc_id, split_part(text, ' ', 1) AS first_word FROM documents""")
def fn_split_keep_first(spark, d):
    return fx.t(spark, d, "documents").select("doc_id", text.split_first(F.col("text"), " ").alias("first_word"))


@query("fn_cast", """
SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'S9485' ELSE left(o_orderpriority, 1) END AS DOUBLE) AS num,
  CAST(o_custkey AS VARCHAR) AS txt, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day_txt FROM orders""")
def fn_cast(spark, d):
    code = F.when(F.col("o_orderstatus") == "P", "S9485").otherwise(F.left("o_orderpriority", F.lit(1)))
    return fx.orders(spark, d).select(
        "o_orderkey", numbers.to_num(code).alias("num"), numbers.to_text(F.col("o_custkey")).alias("txt"),
        numbers.to_text(F.col("o_date")).alias("day_txt"),
    )


@query("fn_math", f"""
WITH {fx.counts_sql()} SELECT site, month, (n_f + n_o) / 2 AS mean, round(sqrt(n), 6) AS root,
  round(n_f * 10000.0 / n, 6) AS rate, round(CAST(n AS DOUBLE) / nullif(n_p, 0), 6) AS per_p FROM counts""")
def fn_math(spark, d):
    n, n_f, n_o, n_p = (F.col(c).cast("double") for c in ("n", "n_f", "n_o", "n_p"))
    return fx.counts(spark, d).select(
        "site", "month", numbers.mean2(n_f, n_o).alias("mean"), F.round(F.sqrt(n), 6).alias("root"),
        F.round(numbers.rate(n_f, n, 10000), 6).alias("rate"), F.round(numbers.rate(n, n_p), 6).alias("per_p"),
    )


@query("fn_format_number", """
SELECT o_orderkey, format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)) AS txt,
  CAST(round_even(o_orderkey / 2, 0) AS BIGINT) AS half FROM orders""")
def fn_format_number(spark, d):
    return fx.t(spark, d, "orders").select(
        "o_orderkey", text.thousands(F.col("o_totalprice")).alias("txt"),
        F.bround(F.col("o_orderkey") / 2, 0).cast("bigint").alias("half"),
    )


@query("fn_case_insensitive", """
SELECT CASE WHEN turn % 2 = 0 THEN upper(role) ELSE role END AS role, count(*) AS n
FROM conversations WHERE lower(CASE WHEN turn % 2 = 0 THEN upper(role) ELSE role END) = 'user' GROUP BY 1""")
def fn_case_insensitive(spark, d):
    role = F.when(F.col("turn") % 2 == 0, F.upper("role")).otherwise(F.col("role"))
    turns = fx.t(spark, d, "conversations").select(role.alias("role"))
    return turns.filter(logic.eq_ci(F.col("role"), "User")).groupBy("role").agg(F.count("*").alias("n"))
