"""Month lists, grids and closed-month filters against an explicit as-of date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates


def month_array(first: Column, as_of: Column, lag_days: int = 30) -> Column:
    """Months from a fixed start to the as-of date less some days."""
    return dates.months_spanned(first, F.date_sub(as_of, lag_days))


def month_grid(sites: DataFrame, measures: Sequence[str], first: Column, last: Column) -> DataFrame:
    """Every site x measure x month: two literal arrays exploded per site row."""
    return sites.withColumn("measure", F.explode(F.array(*[F.lit(m) for m in measures]))).withColumn(
        "month", F.explode(dates.months_spanned(first, last))
    )


def closed_month(as_of: Column, lag_days: int = 0) -> Column:
    """First month that is still open; closed months lie before it."""
    return F.trunc(F.date_sub(as_of, lag_days), "MM")


def closed_months(df: DataFrame, as_of: Column, lag_days: int = 0, month: str = "month") -> DataFrame:
    return df.filter(F.col(month) < closed_month(as_of, lag_days))


def index_months(months: DataFrame, after: Column, as_of: Column, month: str = "month") -> DataFrame:
    """Closed months after a cut-off, with their last day."""
    return (
        months.filter((F.col(month) > after) & (F.col(month) < closed_month(as_of)))
        .withColumn("month_end", F.last_day(month))
    )
