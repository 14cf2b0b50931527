"""Near-duplicate vectors by cosine, with randomly rotated one-bit codes.

Slices of the code's sign bits are bucket keys; pairs are looked at inside buckets only. There
the codes and correction factors give an unbiased estimate of the cosine with a confidence
bound, and pairs that may reach the threshold are recomputed exactly on the original vectors.
The slice length follows the number of vectors so that buckets stay small, and the number of
tables follows the slice length so that a pair at the threshold is missed with `miss` at most.
Buckets larger than a block are compared block by block in tasks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.ann import coded, dimension, unpack
from tallyloom.llm.components import components
from tallyloom.llm.registry import query, table
from tallyloom.llm.rotcodes import RotatedCodes, unit
from tallyloom.session import materialise

BUCKET = 256  # aimed-at vectors per bucket
BLOCK = 1024
SIGMAS = 5.0
PAIRS_AT_ONCE = 65_536


def table_shape(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """Bits per key and number of tables for n vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = max(4, math.ceil(math.log2(max(2, n) / BUCKET)))
    return bits, math.ceil(math.log(miss) / math.log(1 - agree**bits))


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, miss: float = 1e-5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Linked: cosine of the original vectors in double precision at least `threshold`. Vectors
    that are null, zero, of another length than most, or hold a null or non-finite component
    link with nothing, as do rows with a null id. Rows with equal vectors are one class that
    counts its members, so they need no pairs; rows that repeat id and vector link with each
    other. Only the id and the vector column are read.
    """
    dim, n = dimension(vectors, vector_col)
    bits, tables = table_shape(n, threshold, miss)
    codes = RotatedCodes(dim, max(1, -(-bits * tables // dim)))
    powers = (1 << np.arange(bits)).astype(np.int64)

    def keys_of(code: np.ndarray) -> np.ndarray:
        signs = codes.signs(code)[:, : bits * tables]
        return signs.reshape(len(code), tables, bits).astype(np.int64) @ powers

    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    rows = materialise(coded(ids, codes, "vec_id", "embedding").withColumn("same", F.md5("vector")), "codes")
    classes = (
        rows.groupBy("same")
        .agg(F.min(F.struct("vec_id", "vector", "code", "factor")).alias("v"), F.count("*").alias("members"))
        .select("same", "members", "v.*")
    )
    classes = materialise(classes, "classes")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), "<u8").reshape(batch.num_rows, codes.rotations, codes.words)
            keys = keys_of(code)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), t, np.int32)), pa.array(keys[:, t]), *batch.columns],
                    ["tab", "bucket", *batch.schema.names],
                )

    kinds = "vec_id long, members long, vector binary, code binary, factor binary"
    dealt = classes.select("vec_id", "members", "vector", "code", "factor").mapInArrow(deal, f"tab int, bucket long, {kinds}")
    sizes = dealt.groupBy("tab", "bucket").agg(F.count("*").alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    met = (
        dealt.join(sizes, ["tab", "bucket"])
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("own", "other"))
        .withColumn("hi", F.greatest("own", "other"))
        .drop("blocks", "other", "size")
    )

    def compare(t: pa.Table) -> pa.Table:
        vec_ids, x, code, factor = unpack(t, codes)
        keys, members = keys_of(code), np.asarray(t.column("members"))
        own, lo, hi = (np.asarray(t.column(c)) for c in ("own", "lo", "hi"))
        tab = t.column("tab")[0].as_py()
        u = unit(x)
        first, second = np.flatnonzero(own == lo[0]), np.flatnonzero(own == hi[0])
        pairs = []
        for at in range(0, len(second), 128):
            part = second[at : at + 128]
            guess, half = codes.bounds(code[first], factor[first], codes.queries(u[part]), SIGMAS)
            i, j = np.nonzero(guess + half >= threshold)
            i, j = first[i], part[j]
            apart = i < j if lo[0] == hi[0] else np.ones(len(i), bool)
            i, j = i[apart], j[apart]
            for s in range(0, len(i), PAIRS_AT_ONCE):
                a, b = i[s : s + PAIRS_AT_ONCE], j[s : s + PAIRS_AT_ONCE]
                new = ~(keys[a, :tab] == keys[b, :tab]).any(1)  # a pair counts in the first table where it meets
                a, b = a[new], b[new]
                cosine = np.einsum("ij,ij->i", x[a], x[b]) / np.sqrt((x[a] ** 2).sum(1) * (x[b] ** 2).sum(1))
                linked = cosine >= threshold
                pairs.append((a[linked], b[linked]))
        a, b = (np.concatenate(p) for p in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        links = np.bincount(a, members[b], len(x)) + np.bincount(b, members[a], len(x))
        label = vec_ids.copy()
        while True:
            before = label.copy()
            np.minimum.at(label, a, before[b])
            np.minimum.at(label, b, before[a])
            if (label == before).all():
                break
        some = links > 0
        return pa.table([vec_ids[some], links[some].astype(np.int64), label[some]], ["vec_id", "links", "label"])

    found = materialise(
        met.groupBy("tab", "bucket", "lo", "hi").applyInArrow(compare, "vec_id long, links long, label long"), "links"
    )
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(found, "vec_id", "label").withColumnRenamed("node", "vec_id")
    of_class = classes.select("same", "members", "vec_id").join(links, "vec_id", "left").join(groups, "vec_id", "left")
    of_class = of_class.select(
        "same", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    linked = rows.select("vec_id", "same").join(of_class, "same").drop("same")
    usable = rows.select("vec_id").distinct()
    alone = ids.join(usable, "vec_id", "left_anti").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a, v AS b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(least(vec_id, least.b), vec_id) AS component_id,
  coalesce(least(vec_id, least.b), vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


@query("op2_embedding_dedup", SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return near_duplicates(table(spark, folder, "embeddings", "vec_id", "embedding"))
