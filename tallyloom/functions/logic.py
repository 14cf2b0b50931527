"""Predicates and conditionals with explicit missing-value rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def case(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First rule that holds wins; without a match the default, NULL unless given."""
    out = None
    for predicate, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(predicate, value) if out is None else out.when(predicate, value)
    return out if default is None else out.otherwise(default)


def if_else(predicate: Column, yes: object, no: object) -> Column:
    """Two-way choice where an unknown predicate gives NULL."""
    return F.when(predicate, yes).when(~predicate, no)


def in_list(c: Column, values: Iterable[object]) -> Column:
    return c.isin(list(values))


def not_in(c: Column, values: Iterable[object]) -> Column:
    """Not a member; a missing value counts as not a member."""
    return ~F.coalesce(c.isin(list(values)), F.lit(False))


def not_in_sql(c: Column, values: Iterable[object]) -> Column:
    """Not a member under SQL rules; a missing value is unknown and filtered out."""
    return ~c.isin(list(values))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def open_or(end: Column, predicate: Column) -> Column:
    """A bound that holds when it is open (NULL) or when the predicate holds."""
    return end.isNull() | predicate


def valid_on(d: Column, start: Column, end: Column) -> Column:
    """Row valid on a date; a NULL end is open."""
    return (start <= d) & open_or(end, end >= d)


def from_sentinel(c: Column, sentinel: object) -> Column:
    return F.nullif(c, F.lit(sentinel))


def to_sentinel(c: Column, sentinel: object) -> Column:
    return F.coalesce(c, F.lit(sentinel))


def eq_ci(a: Column, b: Column | str) -> Column:
    b = b if isinstance(b, Column) else F.lit(b)
    return F.lower(a) == F.lower(b)
