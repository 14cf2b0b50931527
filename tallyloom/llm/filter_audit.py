"""What each filter of a chain removes, in every order of the chain.

Rows are reduced to cells first: how many rows of a part fail exactly which set of filters
(a bit mask). A recursive query then walks the orders: every level extends each prefix by a
filter it hasn't used, joins the cells of the part and emits what this step keeps and
removes, carrying the bits applied so far. A prefix is computed once, whatever number of
orders begin with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.wordcache import text_groups
from tallyloom.session import materialise

MAX_FILTERS = 8  # an audit has factorial(filters) orders


@dataclass(frozen=True)
class Limits:
    """Thresholds of the text filters."""

    min_words: int = 200
    distinct_percent: int = 50
    capitals_percent: int = 3
    signs: bytes = b"#$%&*|"


_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def text_mask(text: bytes, limits: Limits = Limits()) -> int:
    """Bits 1, 2, 4, 8: too short, too repetitive, too many capitals, holds a sign."""
    words = text.split()
    points = len(text) - len(text.translate(None, _LEADS))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < limits.min_words)
        | (100 * len(set(words)) < limits.distinct_percent * len(words)) << 1
        | (100 * capitals > limits.capitals_percent * points) << 2
        | (len(text.translate(None, limits.signs)) < len(text)) << 3
    )


_LEADS = bytes(b for b in range(256) if b & 0xC0 != 0x80)


def text_masks(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """id, part, mask of the four text filters, and a 256-bit digest of each whole text.

    Null text is empty, null part is the empty string. One narrow row per row of `docs`;
    repeated ids stay, other columns are left out, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches, "text"):
            masks = np.fromiter((text_mask(t, limits) for t in texts), np.int32, len(texts))
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), pa.array(masks), digests], names)

    names = ["id", "part", "mask", "digest"]
    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "part", "text").mapInArrow(run, f"id {kind}, part string, mask int, digest binary")


def mask_cells(masked: DataFrame, weights: DataFrame, repeat_bit: int, names: Sequence[str]) -> DataFrame:
    """part, mask, n and a count per weight, once the bit of repeated texts is set.

    A row fails as a repeat if a row of a smaller id has the same digest, in whatever part.
    Rows without an id come after all others and are never repeats; rows that share the
    smallest id are none either. No text group is gathered: rows are counted per (digest,
    cell, id) and per (digest, cell) before the first of a digest is looked up.
    """
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in names]
    counted = masked.groupBy("digest", "part", "mask", "id").agg(F.count("*").alias("n"))
    labelled = counted.join(weights, "id", "left").select("digest", "part", "mask", "id", "n", *flags)
    known = F.col("id").isNotNull()
    cells = labelled.groupBy("digest", "part", "mask", *names).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("without"),
        F.min(F.when(known, F.struct("id", "n"))).alias("first"),
    )
    first = cells.groupBy("digest").agg(F.min("first.id").alias("first_id"))
    # Cells of one digest differ in part and labels only, so a digest has few rows here.
    alone = F.col("without") + F.when(F.col("first.id") == F.col("first_id"), F.col("first.n")).otherwise(0)
    split = cells.join(first, "digest").select(
        "part", *names,
        F.inline(
            F.array(
                F.struct(F.col("mask"), alone.alias("n")),
                F.struct(F.col("mask").bitwiseOR(F.lit(repeat_bit)).alias("mask"), (F.col("n") - alone).alias("n")),
            )
        ),
    )
    return split.filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in names]
    )


def audit(cells: DataFrame, letters: str, lost: Mapping[str, str]) -> DataFrame:
    """One row per part, order of the filters and step.

    `cells`: part, mask, n and the counts that `lost` names (column -> name in the result);
    at most 2 ** filters rows a part. Bit i of a mask stands for letter i. Columns: part,
    filter_order, step (from 1; its filter is that letter), kept, removed, redundant,
    unique_fails, those of `lost`, shapley (removed by this filter, summed over all orders).
    Parts without rows don't occur; without cells the result is empty.
    """
    if not 0 < len(letters) <= MAX_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"between 1 and {MAX_FILTERS} different letters are needed, not {letters!r}")
    spark = cells.sparkSession
    columns = ["mask", "n", *lost]
    packed = materialise(
        cells.groupBy("part").agg(F.collect_list(F.struct(*columns)).alias("cells")), "cells"  # 2 ** filters at most
    )
    unused = ", ".join(f"struct('{c}' AS letter, {1 << i} AS bit)" for i, c in enumerate(letters))

    def total(count: str, where: str) -> str:
        return f"aggregate(c.cells, 0L, (a, x) -> a + if({where}, x.{count}, 0L))"

    fails, earlier = "x.mask & f.bit != 0", "x.mask & w.applied != 0"
    steps = {
        "kept": total("n", f"NOT ({fails}) AND NOT ({earlier})"),
        "removed": total("n", f"{fails} AND NOT ({earlier})"),
        "redundant": total("n", f"{fails} AND {earlier}"),
        "unique_fails": total("n", "x.mask = f.bit"),
        **{name: total(f"`{c}`", f"{fails} AND NOT ({earlier})") for c, name in lost.items()},
    }
    walk = spark.sql(
        f"""
        WITH RECURSIVE walk (part, prefix, letter, step, applied, {", ".join(steps)}) AS (
            SELECT part, '', '', 0, 0, {", ".join("0L" for _ in steps)} FROM {{cells}}
            UNION ALL
            SELECT w.part, concat(w.prefix, f.letter), f.letter, w.step + 1, w.applied | f.bit, {", ".join(steps.values())}
            FROM walk w JOIN {{cells}} c ON c.part = w.part
            LATERAL VIEW explode(filter(array({unused}), u -> w.applied & u.bit = 0)) unused AS f
        )
        SELECT * FROM walk WHERE step > 0 LIMIT ALL
        """,
        cells=packed,
    )
    walk = materialise(walk.drop("applied"), "orders")
    whole = walk.filter(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    orders = whole.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    rows = orders.withColumn("prefix", F.expr("substring(filter_order, 1, step)")).join(walk, ["part", "step", "prefix"])
    # A prefix begins factorial(letters left) orders.
    times = F.factorial(F.lit(len(letters)) - F.col("step"))
    shapley = walk.groupBy("part", "letter").agg(F.sum(F.col("removed") * times).alias("shapley"))
    return rows.join(shapley, ["part", "letter"]).select("part", "filter_order", "step", *steps, "shapley")


def filter_audit(
    docs: DataFrame, labels: DataFrame, weights: Mapping[str, tuple[str, Column]], limits: Limits = Limits(),
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """Audit of the four text filters (A-D) and of repeated texts (E).

    `weights`: name -> (result column, condition on `labels`); a row counts if any of its
    id's label rows meets the condition, and none do without an id. Null text is empty, a
    null part the empty string. Other columns of either table play no role.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(part_col), F.lit("")).alias("part")
    )
    names = [f"w{i}" for i in range(len(weights))]
    marks = labels.select(F.col(id_col).alias("id"), *[c.alias(n) for n, (_, c) in zip(names, weights.values())])
    marks = marks.filter("id IS NOT NULL").groupBy("id").agg(*[F.max(n).alias(n) for n in names])
    cells = mask_cells(text_masks(rows, limits), marks, 16, names)
    return audit(cells, "ABCDE", dict(zip(names, (c for c, _ in weights.values()))))


ORACLE = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
cells AS (
    SELECT part,
           CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(x.t, '[^A-Z]', '', 'g')) > 3 * length(x.t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(x.t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN x.doc_id > f.first_id THEN 16 ELSE 0 END AS mask,
           count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM texts x JOIN firsts f ON f.t = x.t LEFT JOIN marks m ON m.doc_id = x.doc_id
    GROUP BY 1, 2
),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders(filter_order, step, before, bit) AS (
    SELECT '', 0, 0, 0
    UNION ALL
    SELECT filter_order || l.letter, step + 1, before | o.bit, l.bit
    FROM orders o JOIN letters l ON (before | o.bit) & l.bit = 0
),
steps AS (
    SELECT part, filter_order AS prefix, step, o.bit,
           sum(CASE WHEN mask & (before | o.bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & o.bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & o.bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = o.bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & o.bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & o.bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM orders o, cells WHERE step > 0 GROUP BY part, filter_order, step, o.bit
),
result AS (
    SELECT s.part, o.filter_order, s.step, bit, kept, removed, redundant, unique_fails, good_lost, toxic_lost
    FROM steps s JOIN (SELECT filter_order FROM orders WHERE step = 5) o ON o.filter_order[1:s.step] = s.prefix
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM result
"""


@query("op13_filter_audit", ORACLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """All 120 orders of the five filters, per language."""
    return filter_audit(
        table(spark, folder, "documents", "doc_id", "text", "lang"),
        table(spark, folder, "labels", "doc_id", "quality", "toxic"),
        {"good": ("good_lost", F.col("quality") == 1), "toxic": ("toxic_lost", F.col("toxic") == 1)},
    )
