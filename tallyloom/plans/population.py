"""Month-by-month population snapshots.

A member is collapsed to at most one row per calendar month before the months are
fanned out, so the fan-out is no larger than the snapshot itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import groups, intervals, joins, setops, windows


def latest_member(
    assignments: DataFrame, member: str, start: str, order: Sequence[Column], first: Column, last: Column
) -> DataFrame:
    """Per index month, the latest assignment of a member that started by its end.

    The latest assignment of each start month holds until the next start month, so the
    member's months are a chain of ranges and no month is compared with every assignment.
    """
    clipped = assignments.withColumn(
        "from_month", F.greatest(F.trunc(start, "MM"), F.trunc(first, "MM"))
    )
    one = groups.head_per(clipped, [member, "from_month"], [F.desc(start), *order])
    next_from = F.lead("from_month").over(windows.series([member], "from_month"))
    one = one.withColumn("__until", F.add_months(next_from, -1))
    return joins.expand_months(one, F.col("from_month"), F.col("__until"), first, last).drop(
        "from_month", "__until"
    )


def active_members(
    events: DataFrame, member: Sequence[str], date: str, first: Column, last: Column, days: int = 30,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per index month, members with an event in the trailing days, and its latest date.

    ``carry`` names attributes of the latest event; events of the same day that differ in them
    are rows of their own.
    """
    by_month = events.select(*member, date, *carry, F.trunc(date, "MM").alias("__m"))
    if carry:
        by_month = groups.keep_extreme(by_month, [*member, "__m"], date).distinct()
    else:
        by_month = by_month.groupBy(*member, "__m").agg(F.max(date).alias(date))
    reach = F.date_add(date, days - 1)
    expanded = joins.expand_months(by_month, F.col(date), reach, first, last).filter(F.last_day("month") <= reach)
    if carry:
        return groups.keep_extreme(expanded.drop("__m"), ["month", *member], date)
    return expanded.groupBy("month", *member).agg(F.max(date).alias(date))


def valid_members(
    df: DataFrame, starts: Sequence[str], ends: Sequence[str], first: Column, last: Column,
    some_length: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Per index month, rows whose spans all cover the month start; a NULL end is open.

    A row with a missing start is never valid. The spans (start, end) of ``some_length`` must
    end after they start.
    """
    usable = df.dropna(subset=list(starts))
    for start, end in some_length:
        usable = usable.filter(F.col(end).isNull() | (F.col(end) > F.col(start)))
    latest_start = F.greatest(*starts) if len(starts) > 1 else F.col(starts[0])
    earliest_end = F.least(*ends) if len(ends) > 1 else F.col(ends[0])
    whole_from = F.add_months(F.trunc(F.date_sub(latest_start, 1), "MM"), 1)
    return joins.expand_months(usable, whole_from, earliest_end, first, last)


def valid_spans(
    df: DataFrame, member: Sequence[str], starts: Sequence[str], ends: Sequence[str],
    some_length: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """The same rule as a span of months per row: member, from_month, until_month (NULL is open).

    The row is valid in the months whose first day all its spans cover.
    """
    usable = df.dropna(subset=list(starts))
    for start, end in some_length:
        usable = usable.filter(F.col(end).isNull() | (F.col(end) > F.col(start)))
    latest_start = F.greatest(*starts) if len(starts) > 1 else F.col(starts[0])
    earliest_end = F.least(*ends) if len(ends) > 1 else F.col(ends[0])
    out = usable.select(
        *member, F.add_months(F.trunc(F.date_sub(latest_start, 1), "MM"), 1).alias("from_month"),
        F.trunc(earliest_end, "MM").alias("until_month"),
    )
    return out.filter(F.col("until_month").isNull() | (F.col("from_month") <= F.col("until_month")))


def any_population_spans(frames: Sequence[DataFrame], member: Sequence[str]) -> DataFrame:
    """Months in which a member is in at least one of several populations, as disjoint spans.

    ``frames``: member, from_month, until_month.
    """
    columns = [*member, "from_month", "until_month"]
    return intervals.merge_spans(setops.append(*[f.select(*columns) for f in frames]), member, "from_month", "until_month")


def any_population(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Members of at least one of several populations, each key once."""
    return setops.append(*[f.select(*keys) for f in frames]).distinct()


def eligibility_flag(
    population: DataFrame, spans: DataFrame, member: str, start: str, end: str, death: str,
    first: Column, last: Column,
) -> DataFrame:
    """0/1 per population row (a ``month`` between the index months): covered past the month start and alive then.

    Spans turn into months on which cover begins and ends, sorted among the population's rows of
    the member; no row is fanned out over the calendar.
    """
    usable = spans.filter(F.col(end).isNull() | (F.col(end) > F.col(start)))
    until = F.least(F.date_sub(end, 1), F.date_sub(death, 1))
    months = usable.select(
        member, F.trunc(start, "MM").alias("from_month"), F.last_day(until).alias("until_day")
    )
    found = intervals.covered(population, months, [member], "month", "from_month", "until_day")
    inside = (F.col("month") >= F.trunc(first, "MM")) & (F.col("month") <= F.trunc(last, "MM"))
    return found.withColumn("eligible", F.coalesce((F.col("covered") & inside).cast("int"), F.lit(0))).drop("covered")
