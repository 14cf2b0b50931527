"""All sources to the published series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates
from tallyloom.operators import calendar, setops
from tallyloom.plans import series
from tallyloom.schema import ROW_KEY, measure_rows

OUTPUT = (
    "site", "measure", "month", "numerator", "denominator", "network", "aggregation", "season",
    "rate", "label", "shift_period", "centerline", "ucl", "lcl",
)


@dataclass(frozen=True)
class ReportRules:
    """What is published, rolled up and gap-filled."""

    as_of: str
    network: str
    network_site: str
    first_month: str = "2022-01-01"
    open_days: int = 15
    grid_days: int = 30
    min_denominator: float = 0.00001
    utilisation: Sequence[str] = ("ED Visits (Discharged)", "Inpatient Admissions")
    gap_filled: Sequence[str] = ("Crisis Stabilization", "Initial Intake")
    chart: series.ChartRules = field(default_factory=series.ChartRules)


def publishable(rows: DataFrame, rules: ReportRules) -> DataFrame:
    """Closed months with a denominator; a missing numerator is 0."""
    kept = rows.withColumn("numerator", F.coalesce("numerator", F.lit(0.0))).filter(
        (F.col("month") >= dates.day(rules.first_month))
        & (F.col("denominator") > rules.min_denominator)
    )
    return calendar.closed_months(kept, dates.day(rules.as_of), rules.open_days)


def network_rows(rows: DataFrame, rules: ReportRules) -> DataFrame:
    """Practice rows of one network summed per month, without utilisation measures."""
    return (
        rows.filter(
            (F.col("network") == rules.network)
            & (F.col("aggregation") == "Practice")
            & (F.col("site") != rules.network_site)
            & ~F.col("measure").isin(list(rules.utilisation))
        )
        .groupBy("measure", "month", "network")
        .agg(F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"))
        .withColumns({"site": F.lit(rules.network_site), "aggregation": F.lit("Network")})
    )


def build_report(
    history: DataFrame, sources: Sequence[tuple[DataFrame, bool]], rules: ReportRules, cut=lambda df: df
) -> DataFrame:
    """Upserts, publish filter, network roll-up, gap fill, limits and shifts.

    ``cut`` stores the merged rows, which three branches read; pass
    ``session.materialise`` when the sources scan large facts.
    """
    merged = setops.upsert_all(
        measure_rows(history), [(measure_rows(s), replaces) for s, replaces in sources], ROW_KEY
    )
    rows = cut(publishable(merged, rules))
    grid_last = F.date_sub(dates.day(rules.as_of), rules.grid_days)
    filled = series.gap_fill(
        rows, rules.gap_filled, dates.day(rules.first_month), grid_last
    ).withColumn("aggregation", F.lit("Practice"))
    everything = setops.append(rows, filled, network_rows(rows, rules).select(rows.columns))
    return series.chart(everything, rules.utilisation, rules.chart).select(*OUTPUT)
