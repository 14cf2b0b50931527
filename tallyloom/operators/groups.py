"""Grouped results built so that one huge group is combined before it is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.joins import null_safe_join


def count_distinct_with_null(c: str) -> Column:
    """Distinct values, a missing value counting as one."""
    return F.countDistinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))


def strict(agg: Column, over: str) -> Column:
    """An aggregate that is missing as soon as one value of the group is."""
    return F.when(F.count("*") == F.count(over), agg)


def distinct_sets(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact sets of whole numbers from 0 per key, as bitmaps of 32,768 numbers: keys, bucket, bits.

    Bitmaps merge, so a coarser level is made of the finer one without its rows. They pay
    where numbers lie densely, like surrogate keys; missing and negative numbers are left out.
    """
    number = F.col(value).cast("long") + 1  # bit 0 of bucket 1 belongs to number 1
    return (
        df.filter(F.col(value) >= 0)
        .groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def merged_count(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct numbers per key over all sets of it: keys, n."""
    merged = sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def agg_where(agg, value: Column, where: Column) -> Column:
    """An aggregate over the rows of a group that meet a condition."""
    return agg(F.when(where, value))


def attach_group(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Group aggregates on each row.

    An aggregate and a join instead of a window: the aggregate combines map-side and the
    join may split a hot key over tasks, where a window would hold it in one.
    """
    side = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return null_safe_join(df, side, keys)


def keep_extreme(
    df: DataFrame, keys: Sequence[str], col: str, largest: bool = True, strict_nulls: bool = False
) -> DataFrame:
    """All rows equal to the group maximum (or minimum), ties kept.

    The semi join hashes on the key *and* the extreme value, so the rows of one hot key
    spread out. ``strict_nulls`` drops a group that holds a missing value.
    """
    best = (F.max if largest else F.min)(col)
    side = df.groupBy(*keys).agg((strict(best, col) if strict_nulls else best).alias(col))
    side = side.filter(F.col(col).isNotNull())
    return null_safe_join(df, side, [*keys, col], "left_semi")


def keep_chain(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Successive extremes: ``order`` lists ``(column, largest)``; ties of all kept.

    Neighbouring columns of one direction are compared as one struct, so "latest, then
    latest documented" is one aggregation and one semi join.
    """
    out = df
    for largest, block in groupby(order, key=lambda o: o[1]):
        cols = [c for c, _ in block]
        # a missing value ranks behind every present one in either direction
        ranked = F.struct(
            *[e for c in cols for e in ((F.col(c).isNotNull() == F.lit(largest)).alias("p_" + c), F.col(c))]
        )
        best = out.groupBy(*keys).agg((F.max if largest else F.min)(ranked).alias("__best"))
        side = best.select(*keys, *[F.col("__best")[c].alias(c) for c in cols]).dropna(subset=cols)
        out = null_safe_join(out, side, [*keys, *cols], "left_semi")
    return out


def head_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each group in a total order, pruned before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).filter(F.col("__rn") <= n).drop("__rn")


def keep_singletons(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once; a group of one is its own aggregate."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in rest])
        .filter("__n = 1")
        .select(df.columns)
    )


def code_list(df: DataFrame, keys: Sequence[str], code: str, n: int = 3, sep: str = "; ") -> DataFrame:
    """The first ``n`` codes of each key as one text; only those rows are ever grouped."""
    codes = head_per(df.select(*keys, code).distinct(), keys, [F.col(code)], n)
    text = F.array_join(F.array_sort(F.collect_list(code)), sep)
    return codes.groupBy(*keys).agg(text.alias("code_list"))


def pivot_rownum(df: DataFrame, keys: Sequence[str], code: str, n: int = 3) -> DataFrame:
    """Codes in order as columns ``row1 .. rowN``."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(code))
    rows = df.select(*keys, code).distinct().withColumn("__rn", rn).filter(F.col("__rn") <= n)
    return rows.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__rn") == i, F.col(code))).alias(f"row{i}") for i in range(1, n + 1)]
    )


def ratio(
    numerator: DataFrame, denominator: DataFrame, keys: Sequence[str], zero_fill: bool = True
) -> DataFrame:
    """Numerators on denominators; with ``zero_fill`` an absent numerator is 0."""
    joined = null_safe_join(denominator, numerator, keys, "left" if zero_fill else "inner")
    return joined.withColumn("numerator", F.coalesce(F.col("numerator").cast("double"), F.lit(0.0)))


def append_level(
    detail: DataFrame, keys: Sequence[str], sums: Sequence[str], constants: Mapping[str, str]
) -> DataFrame:
    """Detail rows plus their totals on a coarser key, named by constants."""
    total = (
        detail.groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in sums])
        .withColumns({k: F.lit(v) for k, v in constants.items()})
    )
    return detail.unionByName(total.select(detail.columns))
