"""Month and day arithmetic on date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names in calendar order.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def day(value: str) -> Column:
    """A literal date, ``yyyy-MM-dd``."""
    return F.lit(value).cast("date")


def floor_month(d: Column) -> Column:
    return F.trunc(d, "MM")


def ceil_month(d: Column) -> Column:
    """First day of the next month, also when ``d`` is already a first day."""
    return F.add_months(F.trunc(d, "MM"), 1)


def month_end(d: Column) -> Column:
    return F.last_day(d)


def shift_days(d: Column, n: int | Column) -> Column:
    return F.date_add(d, n)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def date_of(year: Column, month: Column) -> Column:
    """First day of a month given as numbers or digits."""
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def date_of_key(key: Column) -> Column:
    """Date of an integer ``YYYYMMDD`` key; sentinel keys give NULL."""
    return F.when(key > 0, F.to_date(key.cast("string"), "yyyyMMdd"))


def key_of_date(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def parse_date(text: Column, fmt: str = "M/d/yyyy") -> Column:
    """Date from text whose time part, after the first blank, is ignored."""
    return F.to_date(F.split(text, " ")[0], fmt)


def age_at(birth: Column, on: Column) -> Column:
    """Completed years on a date."""
    before_birthday = (F.month(on) < F.month(birth)) | (
        (F.month(on) == F.month(birth)) & (F.dayofmonth(on) < F.dayofmonth(birth))
    )
    return F.year(on) - F.year(birth) - before_birthday.cast("int")


def month_no(name: Column) -> Column:
    """Two-digit number of an English month name, NULL for other text."""
    numbers = [F.lit(x) for n, m in enumerate(MONTH_NAMES, 1) for x in (m, f"{n:02d}")]
    return F.try_element_at(F.create_map(*numbers), name)


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def months_spanned(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last``, empty when reversed."""
    lo, hi = floor_month(first), floor_month(last)
    return F.when(
        lo <= hi, F.sequence(lo, hi, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))
