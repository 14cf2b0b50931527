"""Column choice by name, position and rename."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_as(df: DataFrame, **new_from_old: str) -> DataFrame:
    """Keep the named columns under new names."""
    return df.select([F.col(old).alias(new) for new, old in new_from_old.items()])


def rename(df: DataFrame, **new_from_old: str) -> DataFrame:
    """Rename columns, keep the rest."""
    return df.withColumnsRenamed({old: new for new, old in new_from_old.items()})


def cols_between(df: DataFrame, first: str, last: str) -> DataFrame:
    """A run of neighbouring columns."""
    a, b = df.columns.index(first), df.columns.index(last)
    return df.select(df.columns[a : b + 1])


def unpivot(df: DataFrame, ids: list[str], values: Mapping[str, str], name: str, value: str) -> DataFrame:
    """Wide columns to ``(name, value)`` rows; ``values`` maps column to the name written."""
    long = df.select(*ids, *[F.col(c).alias(label) for c, label in values.items()])
    return long.unpivot(list(ids), list(values.values()), name, value)
