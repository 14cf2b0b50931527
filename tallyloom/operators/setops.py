"""Appending and keyed replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.joins import anti


def append(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; column names must be the same."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def append_aligned(a: DataFrame, b: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Append ``b`` after renaming its columns, ``{theirs: ours}``."""
    return a.unionByName(b.withColumnsRenamed(dict(mapping)))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows replace all old rows that share their key."""
    return anti(old, new, keys).unionByName(new)


def upsert_all(
    base: DataFrame, sources: Sequence[tuple[DataFrame, bool]], keys: Sequence[str]
) -> DataFrame:
    """Ordered upserts in one pass: ``(frame, replaces)``; a later source wins.

    A key keeps the rows of the last replacing source that has it, and of every
    appended source after that. Same rows as a chain of upserts, with one shuffle.
    Inputs are measure rows, so a key holds a row or two per source.
    """
    tagged = [base.withColumns({"__src": F.lit(0), "__from": F.lit(0)})]
    for i, (frame, replaces) in enumerate(sources, 1):
        tagged.append(frame.withColumns({"__src": F.lit(i), "__from": F.lit(i if replaces else 0)}))
    newest = F.max("__from").over(Window.partitionBy(*keys))
    return (
        append(*tagged)
        .withColumn("__newest", newest)
        .filter("__src >= __newest")
        .drop("__src", "__from", "__newest")
    )
