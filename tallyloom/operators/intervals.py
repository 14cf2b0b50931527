"""Joins and lookups on intervals, without a nested loop and without a fan-out over the calendar.

An interval is [start, end], both days included; a missing end is open, a missing start and
an end before the start hold nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EPOCH = "1970-01-01"
_LAST_DAY = "9999-12-31"
_PREFIX = "__iv_"


def bin_widths(spans: DataFrame, start: str, end: str, shares: Sequence[float] = (0.5, 0.95, 1.0)) -> list[int]:
    """Bin widths in days: the lengths below which the given shares of the intervals stay.

    One row of figures comes to the driver. They steer the plan only: an interval longer than the
    last width takes as many bins as it needs, so rounding costs no match.
    """
    days = F.datediff(F.col(end), F.col(start)) + 1
    found = spans.filter(F.col(end) >= F.col(start)).agg(F.percentile_approx(days, list(shares)).alias("w")).collect()[0]["w"]
    return sorted({max(1, w) for w in found or [1]})


def _binned(spans: DataFrame, start: str, end: str, widths: Sequence[int]) -> DataFrame:
    """Each interval once per bin of the smallest width that is no shorter than it: two bins at most,
    but for those longer than all widths."""
    length = F.datediff(F.col(end), F.col(start)) + 1
    width = F.lit(widths[-1])
    for w in reversed(widths[:-1]):
        width = F.when(length <= w, F.lit(w)).otherwise(width)
    first, last = (F.floor(F.datediff(F.col(c), F.lit(_EPOCH).cast("date")) / F.col(_PREFIX + "width")) for c in (start, end))
    return spans.withColumn(_PREFIX + "width", width).withColumn(_PREFIX + "bin", F.explode(F.sequence(first, last)))


def _closed(spans: DataFrame, start: str, end: str, last: Column) -> DataFrame:
    """The intervals that hold a day, with the end that the bins are cut from."""
    until = F.least(F.coalesce(F.col(end), last), last)
    return spans.withColumn(_PREFIX + "until", until).filter(F.col(start) <= F.col(_PREFIX + "until"))


def join_in_interval(
    events: DataFrame, spans: DataFrame, keys: Sequence[str], date: str, start: str, end: str,
    widths: Sequence[int] | None = None,
) -> DataFrame:
    """Every event with every interval of its keys that holds its day, each pair once.

    Intervals are cut into bins, an event falls into one bin of each width, and the join is on
    keys, width and bin; the exact days are a residual condition. A key with many rows is spread over
    its bins, and a large bin can be split as in any inner equi join. ``widths`` (days) are
    taken from the intervals' lengths if not given; an open interval counts up to the last event. Events
    without a key or day match nothing. Other columns keep their names, which must differ.
    """
    last = events.agg(F.max(date)).collect()[0][0]
    if last is None:
        last = _EPOCH  # no event, no pair
    usable = _closed(spans, start, end, F.lit(last).cast("date"))
    widths = list(widths) if widths else bin_widths(usable, start, _PREFIX + "until")
    cut = _binned(usable, start, _PREFIX + "until", widths).withColumnsRenamed({k: _PREFIX + k for k in keys})
    day = F.datediff(F.col(date), F.lit(_EPOCH).cast("date"))
    probe = events.withColumn(_PREFIX + "w", F.explode(F.array(*[F.lit(w) for w in widths]))).withColumn(
        _PREFIX + "b", F.floor(day / F.col(_PREFIX + "w"))
    )
    on = [F.col(k) == F.col(_PREFIX + k) for k in keys]
    on += [F.col(_PREFIX + "w") == F.col(_PREFIX + "width"), F.col(_PREFIX + "b") == F.col(_PREFIX + "bin")]
    on += [F.col(date) >= F.col(start), F.col(date) <= F.col(_PREFIX + "until")]
    joined = probe.join(cut, on)
    return joined.drop(*[c for c in joined.columns if c.startswith(_PREFIX)])


def join_overlapping(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str],
    width: int | None = None,
) -> DataFrame:
    """Every pair of intervals of equal keys that share a day, each pair once.

    Both sides are cut into bins of one width; a pair meets in every bin both have and counts in
    the first, where the later of the two starts. The default width is the mean length, so neither
    side grows beyond about twice its closed intervals. An open end counts up to the
    latest start or end of either side, after which nothing new can meet.
    """
    ends = [F.max(F.greatest(F.col(s), F.coalesce(F.col(e), F.col(s)))) for s, e in (left_span, right_span)]
    tops = [df.agg(e).collect()[0][0] for df, e in zip((left, right), ends)]
    last = F.lit(max((t for t in tops if t is not None), default=None)).cast("date")
    sides = [_closed(df, *span, last) for df, span in ((left, left_span), (right, right_span))]
    if width is None:
        sums = [
            df.agg(F.sum(F.datediff(_PREFIX + "until", s) + 1).alias("d"), F.count("*").alias("n")).collect()[0]
            for df, (s, _) in zip(sides, (left_span, right_span))
        ]
        width = max(1, -(-sum(x["d"] or 0 for x in sums) // max(1, sum(x["n"] for x in sums))))

    def cut(df: DataFrame, start: str, tag: str) -> DataFrame:
        bins = [F.floor(F.datediff(F.col(c), F.lit(_EPOCH).cast("date")) / width) for c in (start, _PREFIX + "until")]
        out = df.withColumn(_PREFIX + "first", bins[0]).withColumn(_PREFIX + "bin", F.explode(F.sequence(*bins)))
        marks = [_PREFIX + c for c in ("until", "first", "bin")]
        return out.withColumnsRenamed({c: c + tag for c in marks} | {k: _PREFIX + k + tag for k in keys if tag == "_r"})

    a, b = cut(sides[0], left_span[0], "_l"), cut(sides[1], right_span[0], "_r")
    p = lambda c: F.col(_PREFIX + c)
    on = [F.col(k) == p(k + "_r") for k in keys] + [p("bin_l") == p("bin_r")]
    on += [p("bin_l") == F.greatest(p("first_l"), p("first_r"))]
    on += [F.col(left_span[0]) <= p("until_r"), F.col(right_span[0]) <= p("until_l")]
    joined = a.join(b, on)
    return joined.drop(*[c for c in joined.columns if c.startswith(_PREFIX)])


def merge_spans(spans: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Union of the intervals of each key as disjoint intervals that don't touch: keys, start, end.

    One window over the intervals of a key; its running last end tells where a new stretch begins.
    """
    until = F.coalesce(F.col(end), F.lit(_LAST_DAY).cast("date"))
    rows = spans.select(*keys, F.col(start).alias("__s"), until.alias("__e")).filter(F.col("__s") <= F.col("__e"))
    by = Window.partitionBy(*keys).orderBy("__s", "__e")
    reached = F.max("__e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    # date_add beyond the last day would leave the calendar, and nothing starts after it
    new = reached.isNull() | ((reached < F.lit(_LAST_DAY).cast("date")) & (F.col("__s") > F.date_add(reached, 1)))
    stretch = F.sum(new.cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    merged = rows.withColumn("__n", stretch).groupBy(*keys, "__n").agg(F.min("__s").alias(start), F.max("__e").alias(end))
    return merged.withColumn(end, F.nullif(F.col(end), F.lit(_LAST_DAY).cast("date"))).drop("__n")


def count_by_month(spans: DataFrame, keys: Sequence[str], start: str, end: str, first: Column, last: Column) -> DataFrame:
    """keys, month, n: how many intervals hold each month between the index months, where any does.

    ``start`` and ``end`` are months. +1 where an interval begins and -1 after it ends are added
    up per key and month, and a running sum over the calendar follows: rows shuffled go with the
    intervals, not with their months.
    """
    lo, hi = F.trunc(first, "MM"), F.trunc(last, "MM")
    begin, stop = F.greatest(F.col(start), lo), F.least(F.coalesce(F.col(end), hi), hi)
    turns = spans.withColumns({"__b": begin, "__e": stop}).filter(F.col("__b") <= F.col("__e")).select(
        *keys,
        F.inline(F.array(F.struct(F.col("__b").alias("month"), F.lit(1).alias("d")), F.struct(F.add_months("__e", 1).alias("month"), F.lit(-1).alias("d")))),
    )
    deltas = turns.groupBy(*keys, "month").agg(F.sum("d").alias("d"))
    by = Window.partitionBy(*keys).orderBy("month")
    # the count holds until the next turn; only turns are windowed, months in between are filled in after
    level = deltas.withColumns({"n": F.sum("d").over(by), "__next": F.lead("month").over(by)}).filter("n > 0")
    months = F.sequence(F.col("month"), F.add_months("__next", -1), F.expr("interval 1 month"))
    return level.select(*keys, F.explode(months).alias("month"), F.col("n").cast("long").alias("n"))


def covered(points: DataFrame, spans: DataFrame, keys: Sequence[str], date: str, start: str, end: str) -> DataFrame:
    """Every point with ``covered``, whether an interval of its keys holds its day.

    One sorted pass over points and turns (+1 at a start, -1 after an end) of a key, so no point
    meets an interval. Points without a day aren't covered.
    """
    real = spans.filter(F.col(end).isNull() | (F.col(start) <= F.col(end))).filter(F.col(start).isNotNull())
    turns = real.select(
        *keys,
        F.inline(F.array(F.struct(F.col(start).alias(date), F.lit(1).alias("__d")), F.struct(F.date_add(end, 1).alias(date), F.lit(-1).alias("__d")))),
    ).filter(F.col(date).isNotNull())
    both = turns.unionByName(points.withColumn("__d", F.lit(0)).withColumn("__point", F.lit(True)), allowMissingColumns=True)
    # turns of a day count for the points of that day
    by = Window.partitionBy(*keys).orderBy(F.col(date), F.col("__point").asc_nulls_first())
    level = F.sum("__d").over(by.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("covered", F.col(date).isNotNull() & (level > 0))
    return found.filter("__point").select(*points.columns, "covered")
