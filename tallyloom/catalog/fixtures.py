"""Frames the queries share, each with the SQL that gives the same rows.

Orders stand in for encounters, customers for subjects, nations for sites and regions
for networks; ``events`` is a subject timeline. The tables hold no NULLs, so missing
values are made with ``nullif`` where a rule about them is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import materialise
from tallyloom.sources.tables import read_table

ORDERS_AS_OF = "2001-08-16"
EVENTS_AS_OF = "2024-01-31"
FIRST_MONTH = "1995-01-01"
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


# Schemas of the driver tables read here.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name, SCHEMAS.get(name))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a date and month."""
    return t(spark, folder, "orders").withColumns(
        {"o_date": F.to_date("o_orderdate"), "month": F.trunc("o_orderdate", "MM")}
    )


ORDERS = """orders_d AS (
  SELECT *, CAST(o_orderdate AS DATE) AS o_date,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month
  FROM orders)"""


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """Customer to site (nation) and network (region)."""
    nation = t(spark, folder, "nation").join(
        t(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        t(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", F.col("n_name").alias("site"), F.col("r_name").alias("network"))
    )


SITES = """sites AS (
  SELECT c_custkey, c_mktsegment, n_name AS site, r_name AS network
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def counts(spark: SparkSession, folder: str, *by: str) -> DataFrame:
    """Orders per site, month and further order or customer columns.

    Orders are counted per customer and month before they meet the customer table, so a
    customer with a large share of the rows is combined before the shuffle.
    """
    o_by = [c for c in by if c.startswith("o_")]
    s_by = [c for c in by if not c.startswith("o_")]
    per_customer = orders(spark, folder).groupBy("o_custkey", "month", *o_by).agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("n_f"),
        F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("n_o"),
        F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("n_p"),
    )
    return (
        per_customer.join(sites(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("site", "network", "month", *o_by, *s_by)
        .agg(*[F.sum(c).alias(c) for c in ("n", "n_f", "n_o", "n_p")])
    )


def counts_sql(*by: str) -> str:
    cols = ", ".join(["site", "network", "month", *by])
    return f"""{ORDERS}, {SITES}, counts AS (
  SELECT {cols}, CAST(count(*) AS BIGINT) AS n,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS n_f,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS n_o,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS n_p
  FROM orders_d JOIN sites ON o_custkey = c_custkey GROUP BY {cols})"""


def nation_series(spark: SparkSession, folder: str) -> DataFrame:
    """Measure rows: filled orders over orders, per site and month."""
    return counts(spark, folder).select(
        "site", F.lit("Initial Intake").alias("measure"), "month",
        F.col("n_f").cast("double").alias("numerator"), F.col("n").cast("double").alias("denominator"),
        "network", F.lit("Practice").alias("aggregation"),
    )


def stored_series(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows stored once, for queries that read them several times."""
    return materialise(nation_series(spark, folder))


SERIES = counts_sql() + """, series AS (
  SELECT site, 'Initial Intake' AS measure, month, CAST(n_f AS DOUBLE) AS numerator,
         CAST(n AS DOUBLE) AS denominator, network, 'Practice' AS aggregation FROM counts)"""


def segment_series(spark: SparkSession, folder: str) -> DataFrame:
    """Measure rows per nation and segment: short series with missing months."""
    return counts(spark, folder, "c_mktsegment").select(
        F.concat_ws("/", "site", "c_mktsegment").alias("site"),
        F.when(F.col("c_mktsegment") == "BUILDING", "ED Visits (Discharged)")
        .when(F.col("c_mktsegment") == "MACHINERY", "Crisis Stabilization")
        .otherwise("Initial Intake").alias("measure"),
        "month", F.col("n_f").cast("double").alias("numerator"), F.col("n").cast("double").alias("denominator"),
        "network", F.lit("Practice").alias("aggregation"),
    )


SEGMENTS = counts_sql("c_mktsegment") + """, seg AS (
  SELECT site || '/' || c_mktsegment AS site,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'ED Visits (Discharged)'
              WHEN 'MACHINERY' THEN 'Crisis Stabilization' ELSE 'Initial Intake' END AS measure,
         month, CAST(n_f AS DOUBLE) AS numerator, CAST(n AS DOUBLE) AS denominator,
         network, 'Practice' AS aggregation FROM counts)"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    return t(spark, folder, "events").withColumn("day", F.to_date("ts"))


EVENTS = "ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events)"


def spans(spark: SparkSession, folder: str) -> DataFrame:
    """First and last order date of each customer."""
    return orders(spark, folder).groupBy("o_custkey").agg(
        F.min("o_date").alias("start_date"), F.max("o_date").alias("end_date")
    )


SPANS = ORDERS + """, spans AS (
  SELECT o_custkey, min(o_date) AS start_date, max(o_date) AS end_date FROM orders_d GROUP BY 1)"""

MONTHS = """months AS (
  SELECT CAST(m AS DATE) AS month, CAST(last_day(m) AS DATE) AS month_end
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-01', INTERVAL 1 MONTH) g(m))"""
LAST_MONTH = "2001-07-01"


def free_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Intervals of customers that begin and end anywhere: days, years, open, and some empty ones."""
    key, day = F.col("o_orderkey"), F.col("o_date")
    hi = (
        F.when(key % 11 == 0, F.lit(None).cast("date"))
        .when(key % 13 == 0, F.date_add(day, 1500))
        .when(key % 17 == 0, F.date_sub(day, 60))
        .otherwise(F.date_add(day, (key % 60).cast("int")))
    )
    return orders(spark, folder).filter(key % 4 == 1).select(
        key.alias("span"), "o_custkey", F.date_sub(day, (key % 50).cast("int")).alias("lo"), hi.alias("hi"),
        F.col("o_orderpriority").alias("priority"),
    )


FREE_SPANS = ORDERS + """, free AS (
  SELECT o_orderkey AS span, o_custkey, o_date - CAST(o_orderkey % 50 AS INTEGER) AS lo, o_orderpriority AS priority,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN o_date + 1500
         WHEN o_orderkey % 17 = 0 THEN o_date - 60 ELSE o_date + CAST(o_orderkey % 60 AS INTEGER) END AS hi
  FROM orders_d WHERE o_orderkey % 4 = 1)"""


def two_sites(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their site; every fourth is in the next nation as well."""
    nation = t(spark, folder, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("site"))
    own, second = F.col("c_nationkey"), F.when(F.col("c_custkey") % 4 == 0, (F.col("c_nationkey") + 1) % 25)
    held = t(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.explode(F.array_compact(F.array(own, second))).alias("key")
    )
    return held.join(nation, "key").select("o_custkey", "site")


TWO_SITES = """two AS (
  SELECT c_custkey, n_name AS site FROM customer JOIN nation ON n_nationkey = c_nationkey
  UNION ALL SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = (c_nationkey + 1) % 25 WHERE c_custkey % 4 = 0)"""
