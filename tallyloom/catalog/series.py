"""Gap filling, control charts and the published report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog import fixtures as fx
from tallyloom.catalog import aggregates, composite, sources  # noqa: F401  their queries are the report's inputs
from tallyloom.catalog.registry import ORACLE, QUERIES, query
from tallyloom.functions import dates
from tallyloom.operators import setops
from tallyloom.plans import report, series
from tallyloom.session import materialise, scratch_path
from tallyloom.sources import publish, tables

RULES = series.ChartRules()
UTILISATION = ("ED Visits (Discharged)", "Inpatient Admissions")


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def gap_fill_sql(rows: str, measures: str, first: str, last: str) -> str:
    """Missing months of a series by a month grid and two neighbour look-ups."""
    return f"""gf_span AS (SELECT site, measure, min(month) AS f, max(month) AS l FROM {rows} WHERE measure IN ({measures}) GROUP BY 1, 2),
gf_grid AS (SELECT CAST(m AS DATE) AS month FROM generate_series(TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL 1 MONTH) g(m)),
gf_miss AS (SELECT s.site, s.measure, g.month FROM gf_span s JOIN gf_grid g ON g.month BETWEEN s.f AND s.l
            ANTI JOIN {rows} r ON r.site = s.site AND r.measure = s.measure AND r.month = g.month),
gf_edge AS (SELECT *, CAST(min(month) OVER (PARTITION BY site, measure) - INTERVAL 1 MONTH AS DATE) AS before,
                   CAST(max(month) OVER (PARTITION BY site, measure) + INTERVAL 1 MONTH AS DATE) AS behind FROM gf_miss),
gf AS (SELECT e.site, e.measure, e.month, CAST(0 AS DOUBLE) AS numerator, (a.denominator + b.denominator) / 2 AS denominator, a.network, a.aggregation
       FROM gf_edge e JOIN {rows} a ON a.site = e.site AND a.measure = e.measure AND a.month = e.before
       JOIN {rows} b ON b.site = e.site AND b.measure = e.measure AND b.month = e.behind)"""


def chart_sql(rows: str) -> str:
    """Season, sequence, limits, shifts and new limits, step by step as self joins."""
    return f"""ch0 AS (SELECT *, CASE WHEN measure NOT IN ('ED Visits (Discharged)', 'Inpatient Admissions') THEN 'None'
    WHEN month(month) IN (2, 3, 4, 5, 9, 10, 11) THEN 'School' ELSE 'Break' END AS season,
    CASE WHEN measure IN ('ED Visits (Discharged)', 'Inpatient Admissions') THEN 10000.0 ELSE 1.0 END AS k,
    row_number() OVER (PARTITION BY site, measure ORDER BY month) AS rn FROM {rows}),
chb AS (SELECT site, measure, season, sum(numerator) AS bn, sum(denominator) AS bd FROM ch0 WHERE rn <= 24 GROUP BY 1, 2, 3),
ch1 AS (SELECT ch0.*, bn * k / bd AS c, numerator * k / denominator AS rate FROM ch0 LEFT JOIN chb USING (site, measure, season)),
ch2 AS (SELECT *, CASE WHEN c + 3 * sqrt(k * c / denominator) > 1 AND measure = 'PRO BOS' THEN 1 ELSE c + 3 * sqrt(k * c / denominator) END AS u,
    greatest(c - 3 * sqrt(k * c / denominator), 0) AS l FROM ch1),
sh0 AS (SELECT *, CASE WHEN rate > c THEN 'Y' WHEN rate <= c THEN 'N' ELSE 'NA' END AS side,
    max(rn) OVER (PARTITION BY site, measure) AS points FROM ch2),
sh1 AS (SELECT *, rn - row_number() OVER (PARTITION BY site, measure, side ORDER BY month) AS grp FROM sh0 WHERE rn > 24 AND points >= 32),
sh2 AS (SELECT site, measure, side, grp, count(*) AS len, min(month) AS first_month FROM sh1 GROUP BY 1, 2, 3, 4 HAVING count(*) >= 8),
sh3 AS (SELECT site, measure, min(first_month) AS shift_start FROM sh2 GROUP BY 1, 2),
rb0 AS (SELECT ch2.*, row_number() OVER (PARTITION BY site, measure ORDER BY month) AS rn2 FROM ch2 JOIN sh3 USING (site, measure) WHERE month >= shift_start),
rb1 AS (SELECT site, measure, season, sum(numerator) AS bn2, sum(denominator) AS bd2 FROM rb0 WHERE rn2 <= 24 GROUP BY 1, 2, 3),
rb2 AS (SELECT rb0.site, rb0.measure, rb0.month, rb0.denominator, rb0.k, bn2 * rb0.k / bd2 AS c2, CASE WHEN rn2 <= 8 THEN rate END AS shift_period
        FROM rb0 JOIN rb1 ON rb1.site = rb0.site AND rb1.measure = rb0.measure AND rb1.season = rb0.season WHERE rn2 <= 24),
rb3 AS (SELECT *, CASE WHEN c2 + 3 * sqrt(k * c2 / denominator) > 1 AND measure = 'PRO BOS' THEN 1 ELSE c2 + 3 * sqrt(k * c2 / denominator) END AS u2,
    greatest(c2 - 3 * sqrt(k * c2 / denominator), 0) AS l2 FROM rb2),
fin AS (SELECT ch2.site, ch2.measure, ch2.month, ch2.numerator, ch2.denominator, ch2.network, ch2.aggregation, ch2.season, CAST(ch2.rn AS INTEGER) AS rn,
  round(ch2.rate, 6) AS rate, round(c, 6) AS base_c, round(u, 6) AS base_u, round(l, 6) AS base_l, shift_start,
  round(shift_period, 6) AS shift_period, round(coalesce(c2, c), 6) AS centerline, round(coalesce(u2, u), 6) AS ucl, round(coalesce(l2, l), 6) AS lcl,
  right(CAST(year(ch2.month) AS VARCHAR), 2) || '-' || strftime(ch2.month, '%B') || ' (n = ' || format('{{:,}}', CAST(round_even(ch2.denominator, 0) AS BIGINT)) || ')' AS label
  FROM ch2 LEFT JOIN sh3 USING (site, measure) LEFT JOIN rb3 ON rb3.site = ch2.site AND rb3.measure = ch2.measure AND rb3.month = ch2.month)"""


NATION = fx.SERIES + ", " + chart_sql("series")
SEGMENT = fx.SEGMENTS + ", " + chart_sql("seg")
ID = "site, measure, month"


@query("series_gap_fill", f"""
WITH {fx.SEGMENTS}, {gap_fill_sql("seg", "'Crisis Stabilization', 'Initial Intake'", "1995-01-01", "2001-08-01")}
SELECT site, measure, month, numerator, denominator, network, aggregation FROM gf""")
def series_gap_fill(spark, d):
    return series.gap_fill(fx.segment_series(spark, d), ("Crisis Stabilization", "Initial Intake"))


def limited(rows):
    return series.control_limits(series.with_season(rows, UTILISATION, RULES), RULES)


@query("control_limits", f"""
WITH {SEGMENT} SELECT {ID}, season, rn, rate, base_c AS centerline, base_u AS ucl, base_l AS lcl FROM fin""")
def control_limits(spark, d):
    df = rounded(limited(fx.segment_series(spark, d)), "rate", "centerline", "ucl", "lcl")
    return df.select("site", "measure", "month", "season", "rn", "rate", "centerline", "ucl", "lcl")


@query("shift_detect", f"""
WITH {NATION} SELECT site, measure, shift_start, count(*) AS points FROM fin GROUP BY 1, 2, 3""")
def shift_detect(spark, d):
    shifted = series.detect_shifts(limited(fx.nation_series(spark, d)), RULES)
    return shifted.groupBy("site", "measure", "shift_start").agg(F.count("*").alias("points"))


@query("shift_rebaseline", f"""
WITH {NATION} SELECT {ID}, rate, shift_period, centerline, ucl, lcl FROM fin""")
def shift_rebaseline(spark, d):
    full = series.chart(fx.nation_series(spark, d), UTILISATION, RULES)
    return rounded(full, "rate", "shift_period", "centerline", "ucl", "lcl").select(
        "site", "measure", "month", "rate", "shift_period", "centerline", "ucl", "lcl"
    )


@query("season_class", f"WITH {SEGMENT} SELECT season, measure, CAST(month(month) AS INTEGER) AS m, count(*) AS n FROM fin GROUP BY 1, 2, 3")
def season_class(spark, d):
    seasoned = series.with_season(fx.segment_series(spark, d), UTILISATION, RULES)
    return seasoned.groupBy("season", "measure", F.month("month").alias("m")).agg(F.count("*").alias("n"))


@query("series_label", f"""
WITH {NATION} SELECT site, month, right(CAST(year(month) AS VARCHAR), 2) || '-' || strftime(month, '%B') || ' (n = ' ||
  format('{{:,}}', CAST(round_even(denominator * 77.5, 0) AS BIGINT)) || ')' AS label FROM fin""")
def series_label(spark, d):
    text = series.label(F.col("month"), F.col("denominator") * 77.5)
    return fx.nation_series(spark, d).select("site", "month", text.alias("label"))


REPORT_RULES = report.ReportRules(
    as_of=fx.ORDERS_AS_OF, network="ASIA", network_site="ASIA Network", first_month="1996-01-01"
)
EVENT_SHIFT = 288  # months from the orders' years to those of the events

# The inputs of the report in the order of delivery: key, whether its rows replace earlier ones of their key, the
# query they come from, and the measure rows made of them. m0 is a month of the events moved to the orders' years.
_M0 = f"CAST(month - INTERVAL {EVENT_SHIFT} MONTH AS DATE)"
REPORT_INPUTS = [
    ("forms", True, "measure_improved_forms", "site || ' Forms'", "'PRO BOS'", "month", "'EUROPE'", "'Practice'"),
    ("intake", True, "measure_event_count", "site", "'Initial Intake'", "month", "'ASIA'", "'Practice'"),
    ("episodes", True, "measure_improved", "site", "'PRO BOS'", _M0, "'ASIA'", "'Practice'"),
    ("log", True, "measure_improved_log", "'Session Log'", "'Session Score'", _M0, "'ASIA'", "'Practice'"),
    ("first", True, "measure_after_first", "'Clinic ' || site", "'Crisis Stabilization'", _M0, "'ASIA'", "'Practice'"),
    ("old_sites", False, "agg_ratio", "'Old ' || site", "'Crisis Stabilization'", "month", "'AFRICA'", "'Practice'"),
    ("old_partners", False, "agg_ratio_join", "'Old Partner ' || site", "'Initial Intake'", "month", "'AMERICA'", "'Practice'"),
    ("old_intake", False, "placeholder_row", "'Old ' || site", "'Initial Intake'", "month", "'ASIA'", "'Practice'"),
    ("use", True, "measure_utilisation WHERE aggregation = 'Practice'", "site", "measure", "month", "'ASIA'", "aggregation"),
    ("use_net", True, "measure_utilisation WHERE aggregation = 'Network'", "site", "measure", "month", "'ASIA'", "aggregation"),
    ("partners", True, "rate_site_network WHERE aggregation = 'Practice'", "site || ' Partner'", "'ED Visits (Discharged)'", "month", "'PARTNERS'", "aggregation"),
    ("partner_net", True, "rate_site_network WHERE aggregation = 'Network'", "'Partner Network'", "'ED Visits (Discharged)'", "month", "'PARTNERS'", "aggregation"),
]
# Deliveries that arrive together and don't replace each other.
TOGETHER = {"intake", "episodes", "log", "first"}


def _report_sql() -> str:
    """The chain of the inputs, one anti join and union after the other."""
    parts = [fx.SEGMENTS]
    for key, _, source, *made in REPORT_INPUTS:
        name, _, where = source.partition(" WHERE ")
        site, measure, month, network, aggregation = made
        rows = f"(SELECT * FROM ({ORACLE[name]}) q{' WHERE ' + where if where else ''})"
        parts.append(f"""in_{key} AS (SELECT {site} AS site, {measure} AS measure, {month} AS month, CAST(numerator AS DOUBLE) AS numerator,
  CAST(denominator AS DOUBLE) AS denominator, {network} AS network, {aggregation} AS aggregation FROM {rows})""")
    step = "seg"
    for key, replaces, *_ in REPORT_INPUTS:
        if key == "intake":  # four deliveries at once
            keys = " UNION ALL ".join(f"SELECT * FROM in_{k}" for k, *_ in REPORT_INPUTS if k in TOGETHER)
            parts.append(f"in_four AS ({keys})")
            key = "four"
        elif key in TOGETHER:
            continue
        old = f"SELECT * FROM {step}" + (f" ANTI JOIN in_{key} USING (site, measure, month)" if replaces else "")
        step = f"after_{key}"
        parts.append(f"{step} AS ({old} UNION ALL SELECT * FROM in_{key})")
    return ", ".join(parts) + f""",
re_rows AS (SELECT site, measure, month, coalesce(numerator, 0) AS numerator, denominator, network, aggregation FROM {step}
  WHERE month >= DATE '1996-01-01' AND denominator > 0.00001 AND month < DATE '2001-08-01'),
re_net AS (SELECT 'ASIA Network' AS site, measure, month, sum(numerator) AS numerator, sum(denominator) AS denominator, network, 'Network' AS aggregation
  FROM re_rows WHERE network = 'ASIA' AND aggregation = 'Practice' AND site <> 'ASIA Network'
    AND measure NOT IN ('ED Visits (Discharged)', 'Inpatient Admissions') GROUP BY measure, month, network),
{gap_fill_sql("re_rows", "'Crisis Stabilization', 'Initial Intake'", "1996-01-01", "2001-07-01")},
re_all AS (SELECT * FROM re_rows UNION ALL SELECT site, measure, month, numerator, denominator, network, 'Practice' FROM gf
           UNION ALL SELECT * FROM re_net), {chart_sql("re_all")}"""


REPORT = _report_sql()


def report_inputs(spark, d):
    """The history and the deliveries (rows, whether they replace earlier ones) from the measures of this catalog."""
    done, made = {}, {}
    for key, _, source, site, measure, month, network, aggregation in REPORT_INPUTS:
        name, _, where = source.partition(" WHERE ")
        if name not in done:
            reads = sum(s.partition(" WHERE ")[0] == name for _, _, s, *_ in REPORT_INPUTS)
            done[name] = materialise(QUERIES[name](spark, d), name) if reads > 1 else QUERIES[name](spark, d)
        rows = done[name].filter(where) if where else done[name]
        made[key] = rows.selectExpr(
            f"{site} AS site", f"{measure} AS measure", f"{month} AS month", "CAST(numerator AS DOUBLE) AS numerator",
            "CAST(denominator AS DOUBLE) AS denominator", f"{network} AS network", f"{aggregation} AS aggregation",
        )
    four = setops.append(*[made[k] for k, *_ in REPORT_INPUTS if k in TOGETHER])
    deliveries = []
    for key, replaces, *_ in REPORT_INPUTS:
        if key not in TOGETHER:
            deliveries.append((made[key], replaces))
        elif key == "intake":
            deliveries.append((four, True))
    return fx.segment_series(spark, d), deliveries


@query("report_pipeline", f"""
WITH {REPORT} SELECT {ID}, numerator, denominator, network, aggregation, season, rate, label, shift_period, centerline, ucl, lcl FROM fin""")
def report_pipeline(spark, d):
    """The whole report as its one published CSV file holds it, read back."""
    history, deliveries = report_inputs(spark, d)
    built = report.build_report(history, deliveries, REPORT_RULES, cut=materialise)
    built = rounded(built, "rate", "shift_period", "centerline", "ucl", "lcl")
    path = scratch_path(spark, "report") + "/report.csv"
    publish.publish_csv(built, path, ["measure", "site", "month"])
    return tables.read_csv(spark, path, built.schema)


@query("flagship_chart", f"""
WITH {NATION} SELECT {ID}, numerator, denominator, season, rn, rate, shift_period, centerline, ucl, lcl FROM fin""")
def flagship_chart(spark, d):
    full = series.chart(fx.nation_series(spark, d), UTILISATION, RULES)
    return rounded(full, "rate", "shift_period", "centerline", "ucl", "lcl").select(
        "site", "measure", "month", "numerator", "denominator", "season", "rn", "rate",
        "shift_period", "centerline", "ucl", "lcl",
    )
