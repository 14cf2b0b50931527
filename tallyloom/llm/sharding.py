"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows are numbered within blocks of at most 2 ** BLOCK_BITS. How many rows of each block go to
each shard is drawn first: the matrix of a uniform shuffle, whose columns add up to the
shards' exact sizes. It is drawn in two levels, for groups of blocks on the driver and
for the blocks of a group in the group's task, since a multivariate hypergeometric draw for
a sum of blocks splits into one for each block. Then every block is permuted locally and
cut at its counts, rows are exchanged, and each shard is permuted again: rows fall into random
buckets, buckets are permuted one by one and set end to end. No task holds more than a block, a
bucket or the counts of one group, whatever the size of a shard.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.registry import fresh, query, table
from tallyloom.session import materialise

SHARDS = 16
BLOCK_BITS = 16
# Rows of a bucket on average; buckets are random, so sizes vary by a few standard deviations only.
BUCKET_ROWS = 1024
# A group has the blocks of 2 ** 8 partitions, 2 ** 2 blocks of each: 1,024 counts.
GROUP_PARTITION_BITS, GROUP_BLOCK_BITS = 8, 2
# monotonically_increasing_id keeps the row's number within its partition in so many bits.
_ROW_BITS = 33


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of `n` rows drawn from good + bad are good; any size, by inversion around the mode.

    Beyond 12 standard deviations lies less than the rounding of a double.
    """
    lo, hi = max(0, n - bad), min(good, n)
    if lo == hi:
        return lo
    total = good + bad
    mode = min(max((n + 1) * (good + 1) // (total + 2), lo), hi)
    width = 40 + int(12 * sqrt(n / total * good / total * bad * (total - n) / (total - 1)))
    first, last = max(lo, mode - width), min(hi, mode + width)
    x = np.arange(first, last, dtype=np.float64)
    step = np.log(good - x) + np.log(n - x) - np.log(x + 1) - np.log(bad - n + x + 1)
    log_p = np.concatenate([[0.0], np.cumsum(step)])
    below = np.cumsum(np.exp(log_p - log_p.max()))
    return first + min(int(np.searchsorted(below, rng.random() * below[-1], "right")), last - first)


def deal_counts(rng: np.random.Generator, sizes: list[int], room: list[int]) -> list[list[int]]:
    """A matrix of uniform deals: row i adds up to sizes[i]; what is left of `room` stays open."""
    room, out = list(room), []
    for size in sizes:
        row, left, rest = [], size, sum(room)
        for r in room:
            rest -= r
            row.append(hypergeometric(rng, r, rest, left))
            left -= row[-1]
        room = [r - x for r, x in zip(room, row)]
        out.append(row)
    return out


def deal(
    rows: DataFrame, shards: int = SHARDS, seed: int = 0, block_bits: int = BLOCK_BITS, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add `shard` (int, from 0) and `slot` (long, gapless from 0 in its shard) to every row.

    Shards differ by one row at most; the first ones take the odd rows. Values play no part, so
    null ids or texts, repeated rows and long rows are dealt like all others. All columns stay,
    earlier columns of the two names are replaced; an empty table gives an empty table. Rows are
    stored first, so a task that runs again deals the same rows to the same places.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = rows.sparkSession
    keep = [c for c in rows.columns if c not in ("shard", "slot")]
    at, block, group, upto, nth, bucket, offset = fresh(keep, "at", "block", "group", "upto", "nth", "bucket", "offset")
    stored = materialise(rows.select(*keep, F.monotonically_increasing_id().alias(at)), "rows")
    stored = stored.withColumn(block, F.shiftright(at, block_bits))

    per_part = _ROW_BITS - block_bits  # bits of a block's number within its partition
    in_part = F.col(block).bitwiseAND(F.lit((1 << per_part) - 1))
    of_group = F.shiftleft(F.shiftright(block, per_part + GROUP_PARTITION_BITS), per_part) + F.shiftright(in_part, GROUP_BLOCK_BITS)
    counts = materialise(stored.groupBy(block).agg(F.count("*").alias("n")).withColumn(group, of_group), "blocks")
    groups = sorted(counts.groupBy(group).agg(F.sum("n")).collect())  # one row per 1,024 blocks
    total = sum(n for _, n in groups)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = dict(zip((g for g, _ in groups), deal_counts(np.random.default_rng([seed, 0]), [n for _, n in groups], room)))

    def blocks_of_group(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        part = part.sort_by(block)
        g = key[0].as_py()
        drawn = deal_counts(np.random.default_rng([seed, 1, g]), part["n"].to_pylist(), matrix[g])
        return pa.table({block: part[block], upto: pa.array([np.cumsum(x) for x in drawn], pa.list_(pa.int64()))})

    cuts = materialise(counts.groupBy(group).applyInArrow(blocks_of_group, f"`{block}` long, `{upto}` array<long>"), "cuts")

    buckets = -(-(total // shards + 1) // bucket_rows)
    locally = Window.partitionBy(block).orderBy(F.xxhash64(at, F.lit(seed)), at)

    def sent(some: DataFrame) -> DataFrame:
        """Each block permuted and cut, with the shard and a random bucket of it."""
        cut = some.join(cuts, block).withColumn(nth, F.row_number().over(locally) - 1)
        here = F.size(F.filter(upto, lambda end: end <= F.col(nth)))
        there = F.pmod(F.xxhash64(at, F.lit(seed), F.lit(1)), F.lit(buckets))
        return cut.withColumn("shard", here).withColumn(bucket, there).drop(block, upto, nth)

    before = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sent(stored.select(at, block)).groupBy("shard", bucket).agg(F.count("*").alias("n"))
    starts = sizes.select("shard", bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(offset))
    again = Window.partitionBy("shard", bucket).orderBy(F.xxhash64(at, F.lit(seed), F.lit(2)), at)
    ranked = sent(stored).withColumn(nth, F.row_number().over(again) - 1)
    return ranked.join(starts, ["shard", bucket]).select(*keep, "shard", (F.col(offset) + F.col(nth)).cast("long").alias("slot"))


def write_shards(dealt: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Parquet files in folders shard=0, shard=1, ..., each a run of slots in order."""
    chunk = fresh(dealt.columns, "chunk")[0]
    (
        dealt.withColumn(chunk, F.floor(F.col("slot") / rows_per_file))
        .repartition("shard", chunk)
        .sortWithinPartitions("shard", "slot")
        .drop(chunk)
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard")
        .parquet(path)
    )


@query("op11_sharding")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards, counts at most one apart."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return deal(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
