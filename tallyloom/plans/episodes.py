"""Treatment episodes from visit days and end markers.

Facts are first collapsed to one row per subject and day, so that every window below
runs over at most one row per calendar day of a subject.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions import dates, logic
from tallyloom.operators import windows


@dataclass(frozen=True)
class EpisodeRules:
    """Domain constants of the episode measures."""

    gap: int = 90
    quiet: int = 90
    min_visits: int = 6
    report_from: str = "2022-10-01"
    seen_from: str = "2021-10-01"
    target_score: float = 9.0
    improved_share: float = 0.4


EPISODE = ("start_date", "end_date", "start_owner", "end_owner", "start_flag", "end_flag")


def collapse_days(visits: DataFrame, ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per subject-day from visits and end markers.

    ``visits``: keys, day, owner, score, code, start (1 for an intake visit);
    ``ends``: keys, day, owner, score, value. The owner is the visit's where there is one.
    """
    v = visits.select(
        *keys, "day", "owner", "score", "code", F.lit("").alias("value"),
        F.col("start").cast("double").alias("start"), F.lit(0.0).alias("end"), F.lit(1).alias("source"),
    )
    e = ends.select(
        *keys, "day", "owner", "score", F.lit("").alias("code"), "value",
        F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), F.lit(2).alias("source"),
    )
    days = (
        v.unionByName(e)
        .groupBy(*keys, "day")
        .agg(
            F.max(F.coalesce("score", F.lit(-1.0))).alias("score"),
            F.max("value").alias("value"),
            F.max("code").alias("code"),
            F.max("start").alias("start"),
            F.max("end").alias("end"),
            F.min(F.struct("source", "owner"))["owner"].alias("owner"),
        )
    )
    days = windows.restart_flag(days, keys, "day", "start", "end")
    return days.withColumn("score", logic.from_sentinel(F.col("score"), -1.0))


def pair(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each end with the latest earlier start; starts without a later end stay open.

    Day rows are unique per subject, so "latest start before" is a running last value and
    no start x end join is needed. A day that is an end and a start can give both rows.
    """
    before = windows.series(keys, "day").rowsBetween(Window.unboundedPreceding, -1)
    is_start, is_end = F.col("start") > 0, F.col("end") == 1
    start_here = F.struct(
        F.col("day").alias("start_date"), F.col("owner").alias("start_owner"), F.col("start").alias("start_flag")
    )
    marked = days.withColumns(
        {
            "__open": F.last(F.when(is_start, start_here), ignorenulls=True).over(before),
            "__last_end": F.max(F.when(is_end, F.col("day"))).over(windows.whole(keys)),
            "__here": F.when(is_start, start_here),
        }
    )

    def row(start: str, end_date: Column, end_owner: Column, end_flag: Column, when: Column) -> Column:
        s = F.col(start)
        return F.when(
            when,
            F.struct(
                s["start_date"].alias("start_date"), s["start_owner"].alias("start_owner"),
                s["start_flag"].alias("start_flag"), end_date.alias("end_date"),
                end_owner.alias("end_owner"), end_flag.alias("end_flag"),
            ),
        )

    closed = row("__open", F.col("day"), F.col("owner"), F.col("end"), is_end & F.col("__open").isNotNull())
    never_closed = F.col("__last_end").isNull() | (F.col("__last_end") <= F.col("day"))
    open_ = row(
        "__here", F.lit(None).cast("date"), F.lit(None).cast(days.schema["owner"].dataType),
        F.lit(None).cast("double"), is_start & never_closed,
    )
    return marked.select(*keys, F.inline(F.array_compact(F.array(closed, open_)))).select(*keys, *EPISODE)


def build(pairs: DataFrame, keys: Sequence[str], rules: EpisodeRules = EpisodeRules()) -> DataFrame:
    """Merge ends near the first one, split later ends off, close superseded open starts.

    Ends less than ``gap`` days after the first end extend the episode; each later end
    opens one of its own. An open start ends the day before the next open start. Owners
    of start and end must agree.
    """
    of_start = [*keys, "start_date"]
    by_end = windows.series(of_start, F.asc_nulls_last("end_date"))
    by_start = windows.series(keys, "start_date", F.asc_nulls_last("end_date"))
    r = pairs.withColumns(
        {
            "first_end": F.min("end_date").over(windows.whole(of_start)),
            "next_end": F.lead("end_date").over(by_end),
            "last_end": F.lag("end_date").over(by_end),
            "srn": F.row_number().over(by_end),
            # open starts come after every closed one, so the next row is the next open start
            "next_start": F.lead("start_date").over(by_start),
        }
    )
    is_open = F.col("end_date").isNull()
    since_first = F.datediff("end_date", "first_end")
    to_next = F.datediff("next_end", "end_date")
    since_last = F.datediff("end_date", "last_end")
    split = since_first >= rules.gap
    last_merged = (since_first < rules.gap) & (
        F.col("next_end").isNull() | (F.datediff("next_end", "first_end") >= rules.gap)
    )
    split_start = F.when(
        (F.col("srn") > 2) & (since_last >= rules.gap), F.date_add("last_end", 1)
    ).otherwise(F.date_add("first_end", rules.gap))
    split_end = F.when(to_next < rules.gap, F.col("next_end")).otherwise(F.col("end_date"))
    kept = r.filter(is_open | split | last_merged).select(
        *keys,
        F.when(split, split_start).otherwise(F.col("start_date")).alias("start_date"),
        F.when(is_open, F.date_sub("next_start", 1)).when(split, split_end)
        .otherwise(F.col("end_date")).alias("end_date"),
        "start_owner",
        "end_owner",
        F.when(split, F.lit(1.2)).otherwise(F.col("start_flag")).alias("start_flag"),
        F.when(is_open, F.lit(1.1)).otherwise(F.col("end_flag")).alias("end_flag"),
    )
    return kept.filter((F.col("start_owner") == F.col("end_owner")) | F.col("end_owner").isNull())


def episode_stats(episodes: DataFrame, days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Visits, last seen, and the scores an episode needs, without a join of days and episodes.

    Gives ``visits``, ``last_seen``, ``seen_score`` (on the last visit day), ``end_score``
    (on the end day), ``first_score_day`` and ``first_score``. Episodes without a visit
    are dropped.

    Day rows and the two boundaries of every episode are sorted together per subject. Running
    values (visits so far, last visit, last day, next scored day) are read off at the boundaries:
    what happened inside is the end's value less the start's. A subject has at most one row per
    calendar day and two per episode, and every row is handled once, however many
    episodes overlap.
    """
    visit = F.col("code").isNotNull() & (F.col("code") != "")
    day_score = F.struct(F.col("day"), F.col("score"))
    at_days = days.select(
        *keys, "day", F.lit(1).alias("__at"), visit.cast("int").alias("__visit"), day_score.alias("__day"),
        F.when(visit, day_score).alias("__seen"), F.when(F.col("score").isNotNull(), day_score).alias("__scored"),
    )
    # a start comes before the row of its day and an end after it; an open episode ends after all days
    whole = F.struct(*EPISODE)
    last = F.coalesce(F.col("end_date"), F.lit("9999-12-31").cast("date"))
    bounds = episodes.filter(F.col("start_date").isNotNull()).select(
        *keys, whole.alias("__episode"),
        F.inline(
            F.array(
                F.struct(F.col("start_date").alias("day"), F.lit(0).alias("__at")),
                F.struct(last.alias("day"), F.lit(2).alias("__at")),
            )
        ),
    )
    rows = at_days.unionByName(bounds, allowMissingColumns=True)
    so_far = windows.series(keys, "day", "__at").rowsBetween(Window.unboundedPreceding, 0)
    # running backwards, the last scored day is the next one
    from_here = windows.series(keys, F.desc("day"), F.desc("__at")).rowsBetween(Window.unboundedPreceding, 0)
    read = rows.withColumns(
        {
            "__visits": F.sum("__visit").over(so_far),
            "__last": F.last("__seen", ignorenulls=True).over(so_far),
            "__here": F.last("__day", ignorenulls=True).over(so_far),
        }
    ).withColumn("__next", F.last("__scored", ignorenulls=True).over(from_here))
    at_start, at_end = F.col("__at") == 0, F.col("__at") == 2
    stats = read.filter("__episode IS NOT NULL").groupBy(*keys, "__episode").agg(
        F.max(F.when(at_start, F.coalesce("__visits", F.lit(0)))).alias("__before"),
        F.max(F.when(at_end, F.col("__visits"))).alias("__until"),
        F.max(F.when(at_end, F.col("__last"))).alias("__last"),
        F.max(F.when(at_end, F.col("__here"))).alias("__here"),
        F.max(F.when(at_start, F.col("__next"))).alias("__next"),
    )
    in_time = logic.open_or(F.col("end_date"), F.col("__next.day") <= F.col("end_date"))
    return (
        stats.select(*keys, "__episode.*", *[c for c in stats.columns if c.startswith("__") and c != "__episode"])
        .withColumn("visits", F.col("__until") - F.col("__before"))
        .filter("visits > 0")
        .select(
            *keys, *EPISODE, F.col("visits").cast("long").alias("visits"),
            F.col("__last.day").alias("last_seen"), F.col("__last.score").alias("seen_score"),
            F.when(F.col("__here.day") == F.col("end_date"), F.col("__here.score")).alias("end_score"),
            F.when(in_time, F.col("__next.day")).alias("first_score_day"),
            F.when(in_time, F.col("__next.score")).alias("first_score"),
        )
    )


def lost_to_follow_up(stats: DataFrame, as_of: Column, rules: EpisodeRules = EpisodeRules()) -> DataFrame:
    """Keep reportable episodes; open ones end ``quiet`` days after the last visit.

    Adds ``ltfu_date``, ``report_month`` and ``lost``.
    """
    is_open = F.col("end_date").isNull()
    report_from = dates.day(rules.report_from)
    reportable = (F.col("end_date") >= report_from) | (
        is_open & (F.col("visits") >= rules.min_visits) & (F.col("last_seen") >= dates.day(rules.seen_from))
    )
    quiet_until = F.date_add("last_seen", rules.quiet)
    kept = stats.filter(reportable & ~(is_open & (quiet_until >= as_of)))
    ltfu = F.when(is_open, quiet_until)
    return kept.withColumn("ltfu_date", ltfu).select(
        *[c for c in stats.columns if c != "end_date"],
        F.coalesce("end_date", "ltfu_date").alias("end_date"),
        "ltfu_date",
        F.when(~is_open, F.trunc("end_date", "MM"))
        .when(F.col("ltfu_date") < report_from, report_from)
        .otherwise(dates.ceil_month(F.col("ltfu_date"))).alias("report_month"),
        F.when(is_open, F.lit("Y")).otherwise(F.lit("N")).alias("lost"),
    )


def attach_scores(reported: DataFrame) -> DataFrame:
    """Final and first score; an episode without a final score is dropped."""
    final = F.when(F.col("lost") == "N", F.col("end_score")).otherwise(F.col("seen_score"))
    in_time = F.col("first_score_day") <= F.col("end_date")
    return (
        reported.withColumns(
            {
                "final_score": final,
                "first_score": F.when(in_time, F.col("first_score")),
                "first_score_day": F.when(in_time, F.col("first_score_day")),
            }
        )
        .drop("end_score", "seen_score")
        .filter(F.col("final_score").isNotNull())
    )


def improved(first: Column, final: Column, rules: EpisodeRules = EpisodeRules()) -> Column:
    """1 when the final score meets the target or fell by the wanted share."""
    share = F.try_divide(first - final, first)
    return F.coalesce(
        ((final <= rules.target_score) | ((first != 0) & (share >= rules.improved_share))).cast("int"),
        F.lit(0),
    )


def improved_measure(
    scored: DataFrame, as_of: Column, by: Sequence[str], rules: EpisodeRules = EpisodeRules()
) -> DataFrame:
    """Improved and all reported episodes per closed month."""
    return (
        scored.filter(F.col("report_month") < F.trunc(as_of, "MM"))
        .groupBy(F.col("report_month").alias("month"), *by)
        .agg(
            F.sum(improved(F.col("first_score"), F.col("final_score"), rules)).cast("double").alias("numerator"),
            F.count("*").cast("double").alias("denominator"),
        )
    )
