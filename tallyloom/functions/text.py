"""Text clean-up and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def left(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))


def right(c: Column, n: int) -> Column:
    return F.right(c, F.lit(n))


def remove_first(c: Column, pattern: str) -> Column:
    """Drop the first match of a pattern."""
    return F.regexp_replace(c, f"^(.*?){pattern}", "$1")


def prefixed_title(c: Column, prefix: str) -> Column:
    """Keep a network prefix as written and put the rest in title case."""
    rest = F.initcap(F.substr(c, F.lit(len(prefix) + 1)))
    return F.when(c.startswith(prefix), F.concat(F.lit(prefix), rest)).otherwise(c)


def first_number(c: Column) -> Column:
    """First run of digits, NULL when there is none."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit(""))


def split_first(c: Column, delimiter: str = " ") -> Column:
    """Piece before the first delimiter; further pieces are dropped."""
    return F.substring_index(c, delimiter, 1)


def thousands(c: Column) -> Column:
    """Rounded half to even, with comma groups."""
    return F.format_number(F.bround(c, 0), 0)


def join_present(sep: str, *cols: Column) -> Column:
    """Concatenate, skipping missing pieces."""
    return F.concat_ws(sep, *cols)
