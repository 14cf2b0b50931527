"""One score per subject and day, and first/last summaries per subject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates
from tallyloom.operators import groups


def preferred(
    visits: DataFrame, self_scores: DataFrame, staff_scores: DataFrame, keys: Sequence[str], order: Sequence[Column],
    per: Sequence[str] | None = None,
) -> DataFrame:
    """One visit row per key with the staff score, else the self-reported one.

    Scores are joined before a row is picked, so ``order`` may name them. ``per`` says for what
    one row stays, where that is less than the keys of the join.

    Score frames are ``keys + (self_score, self_owner)`` and
    ``keys + (staff_score, staff_owner)``; ``order`` picks the visit row.
    """
    joined = visits.join(self_scores, list(keys), "left").join(staff_scores, list(keys), "left")
    first = groups.head_per(joined, per or keys, order)
    return first.withColumns(
        {
            "score": F.coalesce("staff_score", "self_score"),
            "entered_by": F.when(F.col("staff_score").isNotNull(), F.col("staff_owner")).when(
                F.col("self_score").isNotNull(), F.col("self_owner")
            ),
        }
    )


def first_last(df: DataFrame, keys: Sequence[str], day: str, score: str) -> DataFrame:
    """First and last day with the best score on each; ties by maximum, one aggregation."""
    inf = float("inf")
    first = F.min(F.struct(F.col(day), F.coalesce(-F.col(score), F.lit(inf)).alias("neg")))
    last = F.max(F.struct(F.col(day), F.col(score)))
    return df.groupBy(*keys).agg(
        first[day].alias("first_day"),
        last[day].alias("last_day"),
        (-F.nullif(first["neg"], F.lit(inf))).alias("first_score"),
        last[score].alias("last_score"),
    )


def discharge_split(
    df: DataFrame, key: str, day: str, is_discharge: Column, items: Sequence[str], as_of: Column,
    quiet: int = 90, min_days: int = 6,
) -> DataFrame:
    """Subjects whose last discharge has nothing after it, and subjects never discharged.

    Rows are collapsed to subject-days, then to one row per subject, so both lists come
    out of one pass. Subjects with all item maxima 0, and subjects that would be in both
    lists, are left out. ``df`` has one column per score item. A row whose ``is_discharge`` is
    missing is neither a discharge nor another session; its scores and day count all the same.
    """
    total = sum((F.col(i) for i in items[1:]), F.col(items[0]))
    by_day = df.groupBy(key, F.col(day).alias("day")).agg(
        F.max(total).alias("score"),
        F.max(F.when(is_discharge, 1).otherwise(0)).alias("dis"),
        F.max(F.when(~is_discharge, 1).otherwise(0)).alias("oth"),
        *[F.max(i).alias(i) for i in items],
    )
    any_item = F.lit(False)
    for i in items:
        any_item = any_item | (F.max(i) != 0)
    first = F.min(F.struct("day", (-F.col("score")).alias("neg")))
    last = F.max(F.struct("day", "score"))
    subject = by_day.groupBy(key).agg(
        first["day"].alias("first_day"),
        last["day"].alias("last_day"),
        (-first["neg"]).alias("first_score"),
        last["score"].alias("last_score"),
        F.max(F.when(F.col("dis") == 1, F.col("day"))).alias("dis_day"),
        F.sum("dis").alias("dis_days"),
        F.sum("oth").alias("oth_days"),
        any_item.alias("any_item"),
    )
    discharged = F.col("dis_day").isNotNull() & (F.col("last_day") <= F.col("dis_day"))
    other = F.col("oth_days") > 0
    closed_end = F.date_sub(F.trunc(as_of, "MM"), 1)
    follow_up = F.date_add("last_day", quiet)
    overdue = (F.col("oth_days") >= min_days) & (follow_up <= closed_end)
    return subject.filter(F.col("any_item") & (discharged != other)).select(
        key, "first_day", "last_day", "first_score", "last_score",
        F.when(discharged, F.col("dis_days")).otherwise(F.col("oth_days")).alias("session_days"),
        F.when(~discharged, follow_up).alias("follow_up"),
        F.when(discharged, F.lit("No")).when(overdue, F.lit("Yes")).otherwise(F.lit("Not Yet")).alias("lost"),
        F.when(discharged, F.trunc("last_day", "MM"))
        .otherwise(dates.ceil_month(follow_up)).alias("month"),
    )
