"""Window helpers for series.

Their partitions are series that were aggregated to one row per day or month first, so
a partition is bounded by the calendar whatever the size of the facts behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series(keys: Sequence[str], *order: str | Column):
    return Window.partitionBy(*keys).orderBy(*order)


def whole(keys: Sequence[str]):
    return Window.partitionBy(*keys)


def fill1(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str) -> DataFrame:
    """A missing value takes that of the row before it, one step only."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lag(col).over(series(keys, *order))))


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Runs of equal neighbouring values: ``run_no``, ``run_pos`` and ``run_len``."""
    w = series(keys, *order)
    changed = ~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)
    by_run = [*keys, "run_no"]
    return (
        df.withColumn("__changed", changed.cast("int"))
        .withColumn("run_no", F.sum("__changed").over(w))
        .withColumn("run_pos", F.row_number().over(series(by_run, *order)))
        .withColumn("run_len", F.count("*").over(whole(by_run)))
        .drop("__changed")
    )


def baseline_sums(
    df: DataFrame, keys: Sequence[str], season: Sequence[str], order: Sequence[str], n: int, **sums: str
) -> DataFrame:
    """Sequence number in the series, and sums over its first ``n`` rows per season."""
    out = df.withColumn("rn", F.row_number().over(series(keys, *order)))
    w = whole([*keys, *season])
    return out.withColumns(
        {name: F.sum(F.when(F.col("rn") <= n, F.col(c))).over(w) for name, c in sums.items()}
    )


def restart_flag(df: DataFrame, keys: Sequence[str], day: str, start: str, end: str) -> DataFrame:
    """Mark 1.1 where the day before was an end and this one is neither start nor end."""
    previous_end = F.lag(end).over(series(keys, day))
    restarted = (F.col(start) == 0) & (F.col(end) == 0) & (previous_end == 1)
    return df.withColumn(start, F.when(restarted, F.lit(1.1)).otherwise(F.col(start)))
