"""Nearest neighbours by one-bit codes: estimates with error bounds choose what is reranked.

Every row's code and correction factors are compared with the queries; a row is reranked on its
original vector unless its smallest possible distance is beyond the k-th smallest of the
largest possible ones. Rows and queries meet block by block, so no task holds more than a
block of either, and each block passes on its k best per query only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.rotcodes import RotatedCodes, unit, vectors_of

ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 2048
# Width of the confidence interval in standard deviations of the estimate.
SIGMAS = 4.0
CODED = "vec_id long, vector binary, code binary, factor binary"


def dimension(vectors: DataFrame, column: str) -> tuple[int, int]:
    """The most frequent vector length (the smaller one on ties) and its number of rows."""
    sizes = vectors.filter(F.size(column) > 0).groupBy(F.size(column).alias("dim")).count()
    top = sizes.orderBy(F.desc("count"), "dim").limit(1).collect()
    return (top[0]["dim"], top[0]["count"]) if top else (1, 0)


def coded(vectors: DataFrame, codes: RotatedCodes, id_col: str, column: str) -> DataFrame:
    """Usable vectors with their codes; all others are left out (see rotcodes.vectors_of)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, good = vectors_of(batch.column("vector"), codes.dim)
            good &= np.asarray(batch.column("vec_id").is_valid())
            ids, x = batch.column("vec_id").filter(pa.array(good)), x[good]
            if len(x):
                code, factor = codes.encode(unit(x))
                blobs = [pa.array(list(map(bytes, a)), pa.binary()) for a in (x, code, factor)]
                yield pa.RecordBatch.from_arrays([ids, *blobs], ["vec_id", "vector", "code", "factor"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(column).alias("vector"))
    return rows.mapInArrow(run, CODED)


def unpack(t: pa.Table, codes: RotatedCodes) -> tuple[np.ndarray, ...]:
    blob = lambda c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(t.num_rows, -1)
    code = blob("code", "<u8").reshape(-1, codes.rotations, codes.words)
    return np.asarray(t.column("vec_id")), blob("vector", np.float64), code, blob("factor", np.float32)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to one vector, summed coordinate by coordinate."""
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total += (x[:, i] - q[i]) ** 2
    return np.sqrt(total)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    rotations: int = 4, sigmas: float = SIGMAS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query by Euclidean distance.

    Queries are the rows where `is_query` (on the id, named vec_id) holds; rows with a query's
    id aren't its candidates. Ties go to the smaller id. Unusable vectors take no part; a
    query id that is repeated is searched once, with its smallest vector in byte order.
    Repeated candidates count each. Fewer candidates than k: all. Only the id and the vector
    column are read.
    """
    dim, n = dimension(vectors, vector_col)
    codes = RotatedCodes(dim, rotations)
    rows = coded(vectors, codes, id_col, vector_col)
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("vector", "code", "factor")).alias("q")).select("vec_id", "q.*")
    m = vectors.select(F.col(id_col).alias("vec_id")).filter(is_query).count()
    row_blocks, query_blocks = -(-n // ROWS_PER_BLOCK) or 1, -(-m // QUERIES_PER_BLOCK) or 1
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.withColumn("rb", F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)).cast("int")).withColumn("qb", every(query_blocks))
    right = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).withColumn("rb", every(row_blocks))

    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if data.num_rows and queries.num_rows:
            ids, x, code, factor = unpack(data, codes)
            qids, q, _, _ = unpack(queries, codes)
            norm, qnorm = np.sqrt((x**2).sum(1)), np.sqrt((q**2).sum(1))
            for at in range(0, len(q), 32):
                part = slice(at, at + 32)
                guess, half = codes.bounds(code, factor, codes.queries(unit(q[part])), sigmas)
                base, scale = norm[:, None] ** 2 + qnorm[None, part] ** 2, 2 * norm[:, None] * qnorm[None, part]
                own = ids[:, None] == qids[None, part]
                most = np.where(own, np.inf, base - scale * np.maximum(guess - half, -1))
                least = base - scale * np.minimum(guess + half, 1)
                limit = np.partition(most, k - 1, 0)[k - 1] if len(x) > k else np.full(most.shape[1], np.inf)
                for j in range(most.shape[1]):
                    near = np.flatnonzero((least[:, j] <= limit[j] + 1e-9 * base[:, j]) & ~own[:, j])
                    d = distances(x[near], q[at + j])
                    best = np.lexsort((ids[near], d))[:k]
                    found.append((np.full(len(best), qids[at + j]), ids[near][best], d[best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table(columns, ["query_id", "vec_id", "score"])

    best = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(
    list_transform(range(1, 65), lambda i: (q.e[i] - v.e[i]) * (q.e[i] - v.e[i])), lambda s, x: s + x)) AS score
  FROM v AS q, v WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op9_ann", SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Ten nearest rows of every hundredth vector among all rows."""
    return nearest(table(spark, folder, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)
