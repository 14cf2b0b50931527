"""Measure series: gap filling, control limits, shift detection, re-baselining.

A series is ``(site, measure)`` with one row per month. Every window below partitions by
that key, or by it and something finer, so the whole chart takes one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates, numbers, text
from tallyloom.operators import windows
from tallyloom.schema import SERIES_KEY

SERIES = list(SERIES_KEY)
# Months of one series are unique as a rule; the rest makes the order total if not.
ORDER = ["month", "network", "aggregation", "numerator", "denominator"]


@dataclass(frozen=True)
class ChartRules:
    """Domain constants of the control chart."""

    baseline: int = 24
    run: int = 8
    min_points: int = 32
    scaled: Sequence[str] = ("ED Visits (Discharged)", "Inpatient Admissions")
    scale: float = 10_000.0
    capped: Sequence[str] = ("PRO BOS",)
    school_months: Sequence[int] = (2, 3, 4, 5, 9, 10, 11)

    def factor(self) -> Column:
        return F.when(F.col("measure").isin(list(self.scaled)), F.lit(self.scale)).otherwise(F.lit(1.0))


def gap_fill(
    rows: DataFrame, measures: Sequence[str], first: Column | None = None, last: Column | None = None
) -> DataFrame:
    """Rows for the months a series lacks between its first and last month.

    Numerator 0; the denominator of every missing month is the mean of the values just
    before the first and just after the last missing month of the series. ``first`` and
    ``last`` bound the months looked at; a series whose neighbour month is itself absent
    gives no rows.
    """
    w, all_months = windows.series(SERIES, *ORDER), windows.whole(SERIES)
    gaps = (
        rows.filter(F.col("measure").isin(list(measures)))
        .withColumns(
            {
                "__next": F.lead("month").over(w),
                "__d_before": F.col("denominator"),
                "__d_after": F.lead("denominator").over(w),
            }
        )
        .filter(F.col("__next") > F.add_months("month", 1))
    )
    lo, hi = F.add_months("month", 1), F.add_months("__next", -1)
    if first is not None:
        lo = F.greatest(lo, first)
    if last is not None:
        hi = F.least(hi, last)
    span = dates.months_spanned(lo, hi)
    missing = (
        gaps.withColumns({"__before": F.col("month"), "__months": span})
        .withColumn("month", F.explode("__months"))
        .drop("__months")
    )
    edge = missing.withColumns(
        {"__first": F.min("month").over(all_months), "__last": F.max("month").over(all_months)}
    )
    before = F.when(
        (F.col("month") == F.col("__first")) & (F.add_months("month", -1) == F.col("__before")),
        F.col("__d_before"),
    )
    behind = F.when(
        (F.col("month") == F.col("__last")) & (F.add_months("month", 1) == F.col("__next")),
        F.col("__d_after"),
    )
    both = edge.withColumns(
        {"__d1": F.max(before).over(all_months), "__d2": F.max(behind).over(all_months)}
    )
    mean = numbers.mean2(F.col("__d1"), F.col("__d2"))
    return (
        both.withColumns({"numerator": F.lit(0.0), "denominator": mean})
        .filter(F.col("denominator").isNotNull())
        .select(rows.columns)
    )


def with_season(rows: DataFrame, seasonal: Sequence[str], rules: ChartRules = ChartRules()) -> DataFrame:
    """``School`` or ``Break`` for seasonal measures, ``None`` for the others."""
    month = F.month("month")
    season = (
        F.when(~F.coalesce(F.col("measure").isin(list(seasonal)), F.lit(False)), "None")
        .when(month.isin(list(rules.school_months)), "School")
        .otherwise("Break")
    )
    return rows.withColumn("season", season)


def label(month: Column, denominator: Column) -> Column:
    """``24-March (n = 1,234)``."""
    return F.concat(
        text.right(F.year(month).cast("string"), 2), F.lit("-"), dates.month_name(month),
        F.lit(" (n = "), text.thousands(denominator), F.lit(")"),
    )


def _limits(df: DataFrame, centre: str, rules: ChartRules, prefix: str = "") -> DataFrame:
    c = F.col(centre)
    width = numbers.limit_width(c, F.col("denominator"), rules.factor())
    upper = c + width
    capped = F.col("measure").isin(list(rules.capped)) & (upper > 1)
    return df.withColumns(
        {
            prefix + "ucl": F.when(capped, F.lit(1.0)).otherwise(upper),
            prefix + "lcl": F.when(c - width < 0, F.lit(0.0)).otherwise(c - width),
        }
    )


def control_limits(rows: DataFrame, rules: ChartRules = ChartRules()) -> DataFrame:
    """Sequence number, rate, centre line and three-sigma limits.

    The centre is the ratio of sums over the first ``baseline`` points of the series,
    taken per season.
    """
    based = windows.baseline_sums(
        rows, SERIES, ["season"], ORDER, rules.baseline, __bn="numerator", __bd="denominator"
    )
    rated = based.withColumns(
        {
            "rate": numbers.rate(F.col("numerator"), F.col("denominator"), rules.factor()),
            "centerline": numbers.rate(F.col("__bn"), F.col("__bd"), rules.factor()),
            "label": label(F.col("month"), F.col("denominator")),
        }
    ).drop("__bn", "__bd")
    return _limits(rated, "centerline", rules)


def detect_shifts(chart: DataFrame, rules: ChartRules = ChartRules()) -> DataFrame:
    """``shift_start``: first month of the first long run on one side of the centre.

    Only points after the baseline of series with ``min_points`` or more count. A rate
    equal to the centre is not above it.
    """
    counted = chart.withColumn("__points", F.max("rn").over(windows.whole(SERIES)))
    eligible = (F.col("rn") > rules.baseline) & (F.col("__points") >= rules.min_points)
    above = F.col("rate") > F.col("centerline")
    side = F.when(above, "Y").when(~above, "N").otherwise("NA")
    tested = counted.withColumns({"__eligible": eligible, "__side": side})
    ran = windows.runs(tested, [*SERIES, "__eligible"], ["rn"], "__side")
    long_run = F.col("__eligible") & (F.col("run_len") >= rules.run)
    start = F.min(F.when(long_run, F.col("month"))).over(windows.whole(SERIES))
    return ran.withColumn("shift_start", start).drop(
        "__points", "__eligible", "__side", "run_no", "run_pos", "run_len"
    )


def rebaseline(shifted: DataFrame, rules: ChartRules = ChartRules()) -> DataFrame:
    """Limits from the shift on, over its first ``baseline`` points, laid on the series.

    ``shift_period`` carries the rate of the first ``run`` points.
    """
    after = shifted.withColumn(
        "__after", F.coalesce(F.col("month") >= F.col("shift_start"), F.lit(False))
    )
    based = windows.baseline_sums(
        after.withColumnRenamed("rn", "__rn"), [*SERIES, "__after"], ["season"], ["__rn"], rules.baseline,
        __bn="numerator", __bd="denominator",
    )
    inside = F.col("__after") & (F.col("rn") <= rules.baseline)
    centred = based.withColumns(
        {
            "shift_period": F.when(F.col("__after") & (F.col("rn") <= rules.run), F.col("rate")),
            "__new": F.when(inside, numbers.rate(F.col("__bn"), F.col("__bd"), rules.factor())),
        }
    )
    limits = _limits(centred, "__new", rules, "__new_")
    return limits.withColumns(
        {
            "centerline": F.coalesce("__new", "centerline"),
            "ucl": F.coalesce("__new_ucl", "ucl"),
            "lcl": F.coalesce("__new_lcl", "lcl"),
        }
    ).drop("rn", "__after", "__bn", "__bd", "__new", "__new_ucl", "__new_lcl").withColumnRenamed("__rn", "rn")


def chart(rows: DataFrame, seasonal: Sequence[str], rules: ChartRules = ChartRules()) -> DataFrame:
    """Measure rows to the full control chart."""
    limited = control_limits(with_season(rows, seasonal, rules), rules)
    return rebaseline(detect_shifts(limited, rules), rules)
