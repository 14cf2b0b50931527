"""Arithmetic that tolerates bad or missing input only where asked to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_num(c: Column) -> Column:
    """Number in a text; other text gives NULL."""
    return c.try_cast("double")


def to_text(c: Column) -> Column:
    return c.cast("string")


def mean2(a: Column, b: Column) -> Column:
    return (a + b) / F.lit(2.0)


def rate(numerator: Column, denominator: Column, scale: float | Column = 1.0) -> Column:
    """Ratio times a scale; an empty denominator gives NULL."""
    scale = scale if isinstance(scale, Column) else F.lit(float(scale))
    return F.try_divide(numerator * scale, denominator)


def limit_width(centre: Column, denominator: Column, scale: float | Column) -> Column:
    """Three standard errors of a count ratio (Poisson form)."""
    scale = scale if isinstance(scale, Column) else F.lit(float(scale))
    return F.lit(3.0) * F.sqrt(F.try_divide(scale * centre, denominator))
