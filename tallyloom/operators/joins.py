"""Join shapes beyond a plain equi join.

None of these ends as a cross product: every helper leaves at least one hash key, or
fans a row out over the calendar with ``explode``. Skewed keys are split by adaptive
skew-join handling, which ``session.tune`` turns on, and joins are shaped so that it can
act; sides are broadcast by Spark's own size check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_R = "__right_"


def _tagged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: _R + k for k in keys})


def _null_safe(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(_R + k)) for k in keys])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which a missing key matches a missing key."""
    joined = left.join(_tagged(right, keys), _null_safe(keys), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("right", "full", "outer", "full_outer", "right_outer"):
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(_R + k)) for k in keys})
    return joined.drop(*[_R + k for k in keys])


def null_split_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = 32
) -> DataFrame:
    """The same join where many left rows miss all keys and would meet in one task.

    Those rows are dealt over ``salts`` places by a hash of their other columns, and the right rows that miss
    all keys are there in each of them; all other rows join as they are. So it takes a right side
    with few such rows, like distinct keys or a dimension with one row for the unknown.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"the right side of a {how} join can't be repeated")
    none = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    # a place that follows from the row lets filters pass through to the scan; maps have no hash
    known = [f.name for f in left.schema if f.name not in keys and "map<" not in f.dataType.simpleString()]
    place = F.pmod(F.xxhash64(*known), F.lit(salts)).cast("int") if known else F.lit(0)
    dealt = left.withColumn("__salt", F.when(none, place).otherwise(F.lit(0)))
    every = F.when(none, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = right.withColumn("__salt", F.explode(every))
    return null_safe_join(dealt, spread, [*keys, "__salt"], how).drop("__salt")


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Null-safe join on all common columns."""
    return null_safe_join(left, right, [c for c in left.columns if c in right.columns], how)


def join_renamed(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Equi join whose key names differ; the left names survive."""
    back = {r: l for l, r in keys.items()}
    return left.join(right.withColumnsRenamed(back), list(keys), how)


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key exists on the right, each once."""
    return null_split_join(left, right.select(*keys).distinct(), keys, "left_semi")


def anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is absent on the right."""
    return null_split_join(left, right.select(*keys).distinct(), keys, "left_anti")


def join_where(
    left: DataFrame, right: DataFrame, keys: Sequence[str], where: Column, how: str = "inner"
) -> DataFrame:
    """Equi keys plus a residual condition that is part of the join, not a later filter."""
    on = [F.col(k) == F.col(_R + k) for k in keys]
    joined = left.join(_tagged(right, keys), reduce(lambda a, b: a & b, on) & where, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[_R + k for k in keys])


def left_join_where(
    left: DataFrame, right: DataFrame, keys: Sequence[str], where: Column | None = None, tested: Sequence[str] = (),
    probes: DataFrame | None = None,
) -> DataFrame:
    """Left outer join whose right side may hold most of its rows under one key.

    A skewed partition can be split on either side of an inner join, but not on the right
    of an outer one. So the matches come from an inner join, and the rows without a match
    from an anti join against ``probes``: rows of the keys and ``tested`` columns (the right columns
    ``where`` looks at) that hold if and only if any right row does. Without them the distinct ones are
    taken; an aggregate, such as the last day of a key for ``start < day``, is smaller. Where
    the right side is unique (``assert_unique``) a plain left join is enough.
    """
    where = F.lit(True) if where is None else where
    matched = join_where(left, right, keys, where)
    if probes is None:
        probes = right.select(*keys, *tested).distinct()
    lone = join_where(left, probes, keys, where, "left_anti")
    return matched.unionByName(lone, allowMissingColumns=True)


def join_in_month(
    events: DataFrame, spans: DataFrame, keys: Sequence[str], date: str, month: str = "month"
) -> DataFrame:
    """Event inside a calendar-month span: the interval turns into one more equi key."""
    return events.withColumn(month, F.trunc(date, "MM")).join(spans, [*keys, month])


def expand_months(
    df: DataFrame, start: Column, end: Column, first: Column, last: Column, month: str = "month"
) -> DataFrame:
    """One row per calendar month from start to end, clipped to the index months."""
    lo = F.greatest(F.trunc(start, "MM"), F.trunc(first, "MM"))
    hi = F.least(F.coalesce(F.trunc(end, "MM"), F.trunc(last, "MM")), F.trunc(last, "MM"))
    return df.filter(lo <= hi).withColumn(
        month, F.explode(F.sequence(lo, hi, F.expr("interval 1 month")))
    )


def join_either(
    fact: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_key: str, how: str = "inner"
) -> DataFrame:
    """Match a fact on any of several keys: one equi join over the distinct keys of a row."""
    probe = fact.withColumn(dim_key, F.explode(F.array_distinct(F.array(*fact_keys))))
    return probe.join(dim, dim_key, how)


def scd2_join(
    fact: DataFrame, dim: DataFrame, key: Sequence[str], date: str, start: str, end: str, how: str = "inner"
) -> DataFrame:
    """Fact to the dimension version valid on its date; a NULL end is open."""
    valid = (F.col(date) >= F.col(start)) & (F.col(end).isNull() | (F.col(date) <= F.col(end)))
    return join_where(fact, dim, key, valid, how)


def overlay(base: DataFrame, over: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Values of ``over`` win where it has the key and a value, else those of ``base``."""
    right = over.select(*keys, *[F.col(c).alias(_R + c) for c in cols])
    joined = null_safe_join(base, right, keys, "left")
    return joined.withColumns({c: F.coalesce(F.col(_R + c), F.col(c)) for c in cols}).drop(
        *[_R + c for c in cols]
    )


def neighbour_values(
    df: DataFrame, keys: Sequence[str], at: Mapping[str, str], date: str, source: DataFrame, value: str
) -> DataFrame:
    """Look up a series value at other dates: ``at`` maps output name to date column."""
    out = df
    for name, column in at.items():
        side = source.select(*keys, F.col(date).alias(column), F.col(value).alias(name))
        out = out.join(side, [*keys, column])
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, for checking a declared relationship."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail on a key held twice; one aggregation, no rows returned to the driver."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"keys {list(keys)} are not unique")
    return df
