"""Reading, form cells, parameters, calendars, sink."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.catalog import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import dates
from tallyloom.operators import calendar, setops
from tallyloom.schema import MEASURE_ROW, measure_rows
from tallyloom.session import materialise, scratch_path
from tallyloom.sources import folders, forms, publish, tables


@query("scan_table", """
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_date
FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1996-01-01'""")
def scan_table(spark, d):
    return (
        tables.read_table(spark, d, "orders")
        .filter((F.col("o_orderstatus") != "P") & (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")))
        .select("o_orderkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_date"))
    )


# Sheets of three sites and two months, landed as CSV under names that tell both. Their columns differ in
# number and order, and some amounts are no numbers.
LANDED = {
    "1-URGENT": ("Hill Top", ["subject", "amount", "day"]),
    "2-HIGH": ("Hill Side", ["day", "note", "subject", "amount"]),
    "3-MEDIUM": ("Mill", ["subject", "day"]),
}
LANDED_MONTHS = ("1997-01-01", "1997-02-01")
SHEET = "subject BIGINT, amount DOUBLE, day DATE"
LANDED_SQL = f"""{fx.ORDERS}, landed AS (
  SELECT site || ' ' || strftime(month, '%Y%m') || '.csv' AS file, site, month, o_orderkey AS subject, o_date AS day,
    CASE WHEN site <> 'Mill' AND o_orderkey % 5 > 0 THEN o_totalprice END AS amount,
    CASE WHEN site <> 'Mill' AND o_orderkey % 5 = 0 THEN 'amount' END AS bad
  FROM orders_d JOIN (VALUES ('1-URGENT', 'Hill Top'), ('2-HIGH', 'Hill Side'), ('3-MEDIUM', 'Mill')) v(p, site) ON p = o_orderpriority
  WHERE month IN (DATE '{LANDED_MONTHS[0]}', DATE '{LANDED_MONTHS[1]}'))"""


def landed(spark, d):
    """A new folder with one file per site and month, each published under its name."""
    folder = scratch_path(spark, "landed")
    month = F.col("month").isin([dates.day(m) for m in LANDED_MONTHS])
    rows = materialise(
        fx.orders(spark, d).filter(month & F.col("o_orderpriority").isin(list(LANDED))).select(
            "o_orderpriority", "month", F.col("o_orderkey").alias("subject"), F.col("o_date").alias("day"), F.lit("seen").alias("note"),
            F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        )
    )
    for priority, (site, columns) in LANDED.items():
        for m in LANDED_MONTHS:
            sheet = rows.filter((F.col("o_orderpriority") == priority) & (F.col("month") == dates.day(m)))
            publish.publish_csv(sheet.select(columns), f"{folder}/{site} {m[:4]}{m[5:7]}.csv", ["subject"])
    return folder


@query("scan_typed", f"""
WITH {LANDED_SQL} SELECT subject, amount, day FROM landed WHERE site = 'Hill Side'""")
def scan_typed(spark, d):
    """Sheets of one layout by its declared columns and types."""
    layout = T.StructType.fromDDL("day DATE, note STRING, subject BIGINT, amount DOUBLE")
    return tables.read_sheet(spark, f"{landed(spark, d)}/Hill Side*.csv", layout, ["subject", "amount", "day"])


@query("scan_typed_lines", """
SELECT o_orderkey AS subject, CASE WHEN o_orderpriority LIKE '1-%' THEN NULL ELSE o_totalprice END AS amount,
       CAST(o_orderdate AS DATE) AS day FROM orders""")
def scan_typed_lines(spark, d):
    amount = F.when(F.col("o_orderpriority").startswith("1-"), "n/a").otherwise(F.col("o_totalprice").cast("string"))
    lines = fx.orders(spark, d).select(
        F.concat_ws(",", "o_orderkey", "o_orderpriority", amount, F.col("o_date").cast("string")).alias("line")
    )
    ddl = "subject BIGINT, note STRING, amount DOUBLE, day DATE"
    return tables.parse_lines(lines, "line", ddl, ["subject", "amount", "day"])


@query("scan_folder", f"""
WITH {LANDED_SQL} SELECT file, site, month, subject, amount, day, bad FROM landed""")
def scan_folder(spark, d):
    """All files of a folder whose columns differ, bad values named."""
    files = folders.list_files(spark, landed(spark, d))
    return folders.read_files(spark, files, T.StructType.fromDDL(SHEET)).drop("line")


@query("scan_folder_tables", """
SELECT 'orders.parquet' AS file, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority""")
def scan_folder_tables(spark, d):
    return tables.read_folder(spark, f"{d}/o*.parquet").groupBy("file", "o_orderpriority").agg(F.count("*").alias("n"))


@query("file_meta", f"""
WITH {LANDED_SQL} SELECT file, site, month, count(*) AS n, CAST(count(bad) AS BIGINT) AS n_bad,
  CAST(month >= DATE '{LANDED_MONTHS[1]}' AS INTEGER) AS recent
FROM landed WHERE site LIKE 'Hill%' GROUP BY 1, 2, 3""")
def file_meta(spark, d):
    """Files chosen by their names before any is opened, and again by the months of their rows."""
    files = folders.choose(folders.list_files(spark, landed(spark, d)), prefixes=["Hill"])
    rows = folders.read_files(spark, files, T.StructType.fromDDL(SHEET))
    counted = rows.groupBy("file", "site", "month").agg(F.count("*").alias("n"), F.count("bad").alias("n_bad"))
    recent = tables.files_from(counted, ["Hill"], LANDED_MONTHS[1]).withColumn("recent", F.lit(1))
    return counted.join(recent.select("file", "recent"), "file", "left").withColumn("recent", F.coalesce("recent", F.lit(0)))


@query("file_meta_names", f"""
WITH {fx.ORDERS} SELECT o_orderpriority AS site, month, count(*) AS n,
  CAST(o_orderpriority LIKE '1-%' OR month >= DATE '2000-01-01' AS INTEGER) AS chosen
FROM orders_d GROUP BY 1, 2""")
def file_meta_names(spark, d):
    files = fx.orders(spark, d).select(
        F.concat("o_orderpriority", F.lit(" "), F.date_format("o_date", "yyyyMM"), F.lit(".xlsx")).alias("file")
    )
    chosen = F.col("site").startswith("1-") | (F.col("month") >= dates.day("2000-01-01"))
    counted = files.groupBy("file").agg(F.count("*").alias("n"))
    return tables.with_file_meta(counted).select("site", "month", "n", chosen.cast("int").alias("chosen"))


# Cell positions by form kind: (kind, sheet, row, col, name).
LAYOUT = [
    ("wide", "Initial Intake Template", 3, 3, "intake_num"),
    ("wide", "Initial Intake Template", 4, 3, "intake_den"),
    ("wide", "Provider Turnover Template", 8, 2, "leavers"),
    ("wide", "Provider Turnover Template", 8, 3, "opening"),
    ("wide", "Provider Turnover Template", 8, 4, "closing"),
    ("tall", "Initial Intake Template", 3, 3, "intake_num"),
    ("tall", "Initial Intake Template", 4, 3, "intake_den"),
    ("tall", "Provider Turnover Template", 3, 3, "leavers"),
    ("tall", "Provider Turnover Template", 4, 3, "opening"),
    ("tall", "Provider Turnover Template", 5, 3, "closing"),
]
LAYOUT_DDL = "kind string, sheet string, row int, col int, name string"


def form_cells(spark, d):
    """Site-month counts written out as form cells, one file per site and month."""
    c = fx.counts(spark, d).withColumn(
        "kind", F.when(F.col("network").isin("AFRICA", "ASIA"), "wide").otherwise("tall")
    )
    at = {(k, n): (s, r, col) for k, s, r, col, n in LAYOUT}
    source = {"intake_num": "n_f", "intake_den": "n", "leavers": "n_o", "opening": "n_p", "closing": "n"}

    def cells(kind):
        return F.array(
            *[
                F.struct(
                    F.lit(at[kind, n][0]).alias("sheet"), F.lit(at[kind, n][1]).alias("row"),
                    F.lit(at[kind, n][2]).alias("col"),
                    F.when((F.col(v) == 0) & F.lit(n == "leavers"), "none").otherwise(F.col(v).cast("string")).alias("value"),
                )
                for n, v in source.items()
            ]
        )

    all_cells = F.when(F.col("kind") == "wide", cells("wide")).otherwise(cells("tall"))
    file = F.concat("site", F.lit(" "), F.date_format("month", "yyyyMM"), F.lit(".xlsx"))
    return c.select(file.alias("file"), "kind", F.inline(all_cells))


NAMES = ["intake_num", "intake_den", "leavers", "opening", "closing"]
FORMS_SQL = fx.counts_sql() + """, forms AS (
  SELECT site || ' ' || strftime(month, '%Y%m') || '.xlsx' AS file, site, month, CAST(n_f AS DOUBLE) AS intake_num,
         CAST(n AS DOUBLE) AS intake_den, CAST(nullif(n_o, 0) AS DOUBLE) AS leavers,
         CAST(n_p AS DOUBLE) AS opening, CAST(n AS DOUBLE) AS closing FROM counts)"""


def extracted_forms(spark, d):
    layout = tables.params(spark, LAYOUT, LAYOUT_DDL)
    return forms.extract_cells(form_cells(spark, d), layout, names=NAMES)


@query("cell_extract", f"WITH {FORMS_SQL} SELECT file, {', '.join(NAMES)} FROM forms")
def cell_extract(spark, d):
    return extracted_forms(spark, d)


@query("measure_turnover", f"""
WITH {FORMS_SQL} SELECT site, month, leavers AS numerator, (opening + closing) / 2 AS denominator,
  round(leavers / ((opening + closing) / 2), 6) AS rate FROM forms""")
def measure_turnover(spark, d):
    form = tables.with_file_meta(extracted_forms(spark, d))
    return form.select(
        "site", "month", F.col("leavers").alias("numerator"),
        ((F.col("opening") + F.col("closing")) / 2).alias("denominator"),
        F.round(forms.turnover(F.col("leavers"), F.col("opening"), F.col("closing")), 6).alias("rate"),
    )


@query("cell_block", """
SELECT n_name AS file, CAST(c_custkey + 5 AS INTEGER) AS "row", CAST(c_custkey AS VARCHAR) AS pat_id,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal END AS score
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING'""")
def cell_block(spark, d):
    customer = fx.t(spark, d, "customer").join(fx.t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    filled = F.col("c_mktsegment") != "BUILDING"
    score = F.when(F.col("c_mktsegment") == "FURNITURE", "n/a").otherwise(F.col("c_acctbal").cast("string"))

    def cell(col, value):
        return F.struct(F.lit(col).alias("col"), F.when(filled, value).alias("value"))

    body = customer.select(
        F.col("n_name").alias("file"), (F.col("c_custkey") + 5).cast("int").alias("row"),
        F.inline(F.array(cell(1, F.col("c_custkey").cast("string")), cell(2, score), cell(3, F.lit("note")))),
    )
    header = fx.t(spark, d, "nation").select(
        F.col("n_name").alias("file"), F.lit(4).alias("row"), F.lit(1).alias("col"), F.lit("pat_id").alias("value")
    )
    return forms.extract_block(body.unionByName(header), 5, None, {1: ("pat_id", "string"), 2: ("score", "double")})


@query("param_table", """
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' ELSE 'slow' END AS lane, count(*) AS n
FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1""")
def param_table(spark, d):
    rows = [("1-URGENT", "fast"), ("2-HIGH", "fast"), ("3-MEDIUM", "slow"), ("4-NOT SPECIFIED", "slow")]
    lanes = tables.params(spark, rows, "o_orderpriority string, lane string")
    return fx.t(spark, d, "orders").join(lanes, "o_orderpriority").groupBy("lane").agg(F.count("*").alias("n"))


@query("empty_like", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def empty_like(spark, d):
    table = fx.t(spark, d, "orders")
    return tables.empty_like(table).unionByName(table).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("month_list", f"""
WITH {fx.MONTHS}, {fx.ORDERS} SELECT m.month, count(o.o_orderkey) AS n
FROM months m LEFT JOIN orders_d o ON m.month = o.month AND o.o_orderstatus = 'P' GROUP BY m.month""")
def month_list(spark, d):
    months = spark.range(1).select(
        F.explode(calendar.month_array(dates.day(fx.FIRST_MONTH), dates.day(fx.ORDERS_AS_OF), 30)).alias("month")
    )
    held = fx.orders(spark, d).filter("o_orderstatus = 'P'").groupBy("month").agg(F.count("*").alias("n"))
    return months.join(held, "month", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("month_grid", f"""
WITH {fx.MONTHS}, {fx.counts_sql("o_orderpriority")}, pri AS (SELECT DISTINCT o_orderpriority AS measure FROM orders)
SELECT n_name AS site, pri.measure, months.month, coalesce(c.n, 0) AS n
FROM nation CROSS JOIN pri CROSS JOIN months
LEFT JOIN counts c ON c.site = n_name AND c.o_orderpriority = pri.measure AND c.month = months.month""")
def month_grid(spark, d):
    site = fx.t(spark, d, "nation").select(F.col("n_name").alias("site"))
    grid = calendar.month_grid(site, fx.PRIORITIES, dates.day(fx.FIRST_MONTH), dates.day(fx.LAST_MONTH))
    held = fx.counts(spark, d, "o_orderpriority").select("site", F.col("o_orderpriority").alias("measure"), "month", "n")
    return grid.join(held, ["site", "measure", "month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("index_months", f"""
WITH {fx.ORDERS} SELECT month, CAST(last_day(month) AS DATE) AS month_end, count(*) AS n FROM orders_d
WHERE month > DATE '1999-12-31' AND month < DATE '2001-08-01' GROUP BY 1""")
def index_months(spark, d):
    months = fx.orders(spark, d).groupBy("month").agg(F.count("*").alias("n"))
    return calendar.index_months(months, dates.day("1999-12-31"), dates.day(fx.ORDERS_AS_OF))


@query("placeholder_row", f"""
WITH {fx.ORDERS}, {fx.SITES}, f AS (
  SELECT DISTINCT site, month FROM orders_d JOIN sites ON o_custkey = c_custkey),
r AS (SELECT site, month, CAST(count(*) FILTER (WHERE o_totalprice > 450000) AS DOUBLE) AS numerator,
             CAST(count(*) AS DOUBLE) AS denominator
      FROM orders_d JOIN sites ON o_custkey = c_custkey
      WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 250000 GROUP BY 1, 2)
SELECT f.site, f.month, numerator, denominator FROM f LEFT JOIN r ON f.site = r.site AND f.month = r.month""")
def placeholder_row(spark, d):
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 250000)
    per_customer = fx.orders(spark, d).groupBy("o_custkey", "month").agg(
        F.sum(F.when(urgent, F.when(F.col("o_totalprice") > 450000, 1.0).otherwise(0.0))).alias("numerator"),
        F.sum(F.when(urgent, 1.0)).alias("denominator"),
    )
    # files and the rows of them come from one pass; the placeholder is the missing sum
    return (
        per_customer.join(fx.sites(spark, d), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("site", "month")
        .agg(F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"))
    )


@query("placeholder_files", f"""
WITH {fx.ORDERS}, {fx.SITES}, f AS (SELECT DISTINCT site, month FROM orders_d JOIN sites ON o_custkey = c_custkey),
r AS (SELECT site, month, CAST(count(*) AS DOUBLE) AS numerator FROM orders_d JOIN sites ON o_custkey = c_custkey
      WHERE o_orderstatus = 'P' AND o_totalprice > 350000 GROUP BY 1, 2)
SELECT f.site, f.month, numerator FROM f LEFT JOIN r ON f.site = r.site AND f.month = r.month""")
def placeholder_files(spark, d):
    """Files without a row get one of missing values, where files and rows come from two places."""
    large = fx.orders(spark, d).filter("o_orderstatus = 'P' AND o_totalprice > 350000")
    rows = (
        large.groupBy("o_custkey", "month").agg(F.count("*").cast("double").alias("numerator"))
        .join(fx.sites(spark, d), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("site", "month").agg(F.sum("numerator").alias("numerator"))
    )
    return forms.or_placeholder(fx.counts(spark, d), rows, ["site", "month"])


@query("sink_csv", f"""
WITH {fx.SERIES} SELECT site, measure, month, nullif(numerator, 0) AS numerator, denominator, network, aggregation
FROM series""")
def sink_csv(spark, d):
    rows = measure_rows(
        fx.nation_series(spark, d).withColumn("numerator", F.nullif(F.col("numerator"), F.lit(0.0)))
    )
    path = scratch_path(spark, "report-csv")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, MEASURE_ROW)


@query("union_by_name", """
SELECT site, count(*) AS n FROM (
  SELECT c_nationkey AS site FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY site""")
def union_by_name(spark, d):
    a = fx.t(spark, d, "customer").select(F.col("c_nationkey").alias("site"), F.col("c_custkey").alias("id"))
    b = fx.t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("site"))
    return setops.append(a, b).groupBy("site").agg(F.count("*").alias("n"))
