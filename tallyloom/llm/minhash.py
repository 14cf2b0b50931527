"""Near-duplicate documents by MinHash with one permutation.

One hash function deals a document's shingles to bins and each bin keeps its smallest. An
empty bin takes the value of a random other bin, by a fixed random order per bin that all
documents share (optimal densification). Bands of bins are bucket keys.

A bucket gives edges from its smallest document to the others only, a star, so the number of
edges is bounded by documents x bands. Edges whose sketches may reach the threshold are
confirmed on full shingle sets. A star alone could lose a link between two of its leaves, so
leaves that it leaves unconnected meet the star's other leaves too, block by block inside
tasks: sketches first, and full sets where those may reach the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.registry import query, table
from tallyloom.llm.shingles import common, mix, shingle_set
from tallyloom.llm.wordcache import text_groups
from tallyloom.session import materialise

ROWS_PER_BAND = 6
BANDS = 56
# A sketch of this many bins is off by more than this much once in several 100,000 pairs.
SLACK = 0.16
BLOCK = 512
_U = np.uint64


class Signer:
    """Signatures of shingle sets: a band key per band and a byte per bin."""

    def __init__(self, rows: int = ROWS_PER_BAND, bands: int = BANDS, seed: int = 11):
        self.rows, self.bands, self.bins = rows, bands, rows * bands
        rng = np.random.default_rng(seed)
        others = [rng.permutation(self.bins) for _ in range(self.bins)]
        self.probes = np.array([[i, *o[o != i]] for i, o in enumerate(others)])
        self.starts = np.array([(i << 64) // self.bins for i in range(self.bins)], object).astype(_U)
        self.every = np.arange(self.bins)

    def values(self, shingles: np.ndarray) -> np.ndarray:
        """The bins' smallest shingles; the set must not be empty and be sorted."""
        first = np.searchsorted(shingles, self.starts)
        filled = first < np.append(first[1:], len(shingles))
        source = self.probes[self.every, np.argmax(filled[self.probes], 1)]
        return shingles[first[source]]

    def sign(self, shingles: np.ndarray) -> tuple[bytes, bytes]:
        values = self.values(shingles)
        keys = np.arange(self.bands, dtype=_U)
        for column in values.reshape(self.bands, self.rows).T:
            keys = mix(keys * _U(0x9E3779B97F4A7C15) + column)
        return keys.tobytes(), mix(values).astype(np.uint8).tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from sketches (bytes along the last axis), corrected for chance agreement."""
    same = (a == b).mean(-1)
    return (same - 1 / 256) / (1 - 1 / 256)


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, n_shingles, component_id, kept for every row.

    Words are lower-cased (A-Z) and cut at ASCII white space. Linked: 100 x intersection of the
    shingle sets at least `percent` x their union. Null or empty texts, and rows with a null id,
    link with nothing. Documents with equal sets are one class with its smallest id; rows that
    share an id but not the text are taken by their text. Only the id and the text column are read. A pair
    exactly at 80 % is missed with a probability of about 1e-5, a closer one with less.
    """
    signer = Signer()
    least = percent / 100 - SLACK

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch, texts in text_groups(batches, "text"):
            sizes, keys, bands = [], [], []
            for text in texts:
                s = shingle_set(text, shingle)
                sizes.append(len(s))
                keys.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                bands.append(signer.sign(s)[0] if len(s) else None)
            blobs = [pa.array(x, pa.binary()) for x in (keys, bands)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), *blobs], ["id", "n", "same", "bands"])

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = materialise(read.mapInArrow(sign, "id long, n long, same binary, bands binary"), "signed")
    full = rows.filter(F.col("id").isNotNull() & F.col("same").isNotNull())
    classes = full.groupBy("same").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    classes = materialise(classes, "classes")
    several = classes.filter("copies > 1").select("same", "node")
    copies = full.select("id", "same").join(several, "same").filter("id > node").select("id").distinct()
    copies = copies.join(classes.select(F.col("node").alias("id")), "id", "left_anti")
    stars = materialise(_stars(full, signer).join(copies, "id", "left_anti"), "stars")
    ids = stars.select("id").union(stars.select("center")).distinct()
    members = read.mapInArrow(_squeeze, "id long, packed binary").join(ids, "id", "left_semi").dropDuplicates()
    members = materialise(members.mapInArrow(_sketch(signer, shingle), "id long, n long, sketch binary, packed binary"), "members")

    sketch = members.select("id", "n", "sketch")
    center = sketch.select(F.col("id").alias("center"), F.col("n").alias("cn"), F.col("sketch").alias("csketch"))
    near = (
        stars.join(sketch, "id").join(center, "center")
        .filter(100 * F.least("n", "cn") >= percent * F.greatest("n", "cn"))
        .mapInArrow(_close(least), "a long, b long").distinct()
    )
    links = materialise(_confirm(near, members, shingle, percent), "links")
    labels = components(links)

    new = materialise(_leaf_links(stars, members, labels, shingle, percent), "links")
    labels = components(links.union(new))

    found = classes.join(labels, "node", "left").select("same", F.coalesce("component", "node").alias("component_id"))
    found = materialise(found, "found")
    out = full.select("id", "n", "same").join(found, "same").drop("same")
    rest = rows.filter(F.col("id").isNull() | F.col("same").isNull()).select("id", "n", F.col("id").alias("component_id"))
    return out.union(rest).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the way, with their size in front; null and empty ones go."""
    codec = pa.Codec("zstd", 1)
    for batch, texts in text_groups(batches, "text"):
        some = [i for i, t in enumerate(texts) if t]
        packed = [len(texts[i]).to_bytes(8, "little") + codec.compress(texts[i], asbytes=True) for i in some]
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(some, pa.int64())), pa.array(packed, pa.binary())], ["id", "packed"])


def _loose(packed: bytes) -> bytes:
    return pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)


def _sketch(signer: Signer, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(_loose(x), shingle) for x in batch.column("packed").to_pylist()]
            some = [i for i, s in enumerate(sets) if len(s)]
            kept = batch.take(pa.array(some, pa.int64()))
            n, sketch = pa.array([len(sets[i]) for i in some], pa.int64()), pa.array([signer.sign(sets[i])[1] for i in some], pa.binary())
            yield pa.RecordBatch.from_arrays([kept.column("id"), n, sketch, kept.column("packed")], ["id", "n", "sketch", "packed"])

    return run


def _stars(nodes: DataFrame, signer: Signer) -> DataFrame:
    """center, id: each bucket's smallest document with every other one, each pair once."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            ids = np.repeat(np.asarray(batch.column("id")), signer.bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], ["bucket", "id"])

    dealt = nodes.select("id", "bands").mapInArrow(deal, "bucket long, id long")
    centers = dealt.groupBy("bucket").agg(F.min("id").alias("center"), F.max("id").alias("last")).filter("center < last")
    centers = materialise(centers.select("bucket", "center"), "buckets")
    return dealt.join(centers, "bucket").filter("id > center").select("center", "id").distinct()


def _close(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sketch", "csketch"))
            ok = pa.array(estimate(a, b) >= least) if batch.num_rows else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("center").filter(ok), batch.column("id").filter(ok)], ["a", "b"])

    return run


def _leaf_links(stars: DataFrame, members: DataFrame, labels: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between leaves of one star that the labels don't connect yet.

    Leaves that are connected with the center need no comparison among themselves. All others
    meet every leaf of the star, block by block; a task ends a comparison as soon as its own
    links connect the two, so it passes on fewer links than it has leaves.
    """
    of = labels.withColumnRenamed("node", "id").withColumnRenamed("component", "label")
    leaf = stars.join(of, "id", "left").withColumn("label", F.coalesce("label", "id"))
    hub = of.select(F.col("id").alias("center"), F.col("label").alias("hub"))
    leaf = leaf.join(hub, "center", "left").withColumn("apart", F.col("label") != F.coalesce("hub", "center")).drop("hub")
    leaf = materialise(leaf, "leaves")
    size = leaf.groupBy("center").agg(F.sum(F.col("apart").cast("long")).alias("u"), F.count("*").alias("m")).filter("u > 0 AND m > 1")
    size = materialise(size.select("center", *(F.ceil(F.col(c) / BLOCK).cast("int").alias(c) for c in ("u", "m"))), "stars")
    block = lambda c: F.pmod(F.xxhash64("id"), c).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    sized = leaf.join(size, "center")
    left = sized.filter("apart").withColumn("lb", block("u")).withColumn("rb", every("m")).withColumn("left", F.lit(True))
    right = sized.withColumn("rb", block("m")).withColumn("lb", every("u")).withColumn("left", F.lit(False))
    met = left.unionByName(right).join(members, "id")
    least = percent / 100 - SLACK

    def run(t: pa.Table) -> pa.Table:
        ids, n, label, apart, left = (np.asarray(t.column(c)) for c in ("id", "n", "label", "apart", "left"))
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
        packed = t.column("packed")
        sets: dict[int, np.ndarray] = {}
        root = {int(x): int(x) for x in label}

        def find(x: int) -> int:
            while root[x] != x:
                x = root[x]
            return x

        def shingles(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_set(_loose(packed[i].as_py()), shingle)
            return sets[i]

        found = []
        rows = np.flatnonzero(~left)
        for j in np.flatnonzero(left):
            i = rows[(label[rows] != label[j]) & (~apart[rows] | (ids[rows] > ids[j]))]
            i = i[100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])]
            close = estimate(sketch[i], sketch[j]) if len(i) else np.zeros(0)
            for k in i[np.argsort(-close, kind="stable")][: int((close >= least).sum())]:
                a, b = find(int(label[j])), find(int(label[k]))
                if a == b:
                    continue
                both = common(shingles(j), shingles(k))
                if 100 * both >= percent * (n[j] + n[k] - both):
                    root[max(a, b)] = min(a, b)
                    found.append((int(ids[j]), int(ids[k])))
        return pa.table([[x for x, _ in found], [x for _, x in found]], schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    columns = met.select("center", "lb", "rb", "id", "n", "label", "apart", "left", "sketch", "packed")
    return columns.groupBy("center", "lb", "rb").applyInArrow(run, "a long, b long").distinct()


def _confirm(pairs: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs a, b whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, have = None, None
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                if x != last:
                    last, have = x, shingle_set(_loose(x), shingle)
                other = shingle_set(_loose(y), shingle)
                both = common(have, other)
                ok.append(100 * both >= percent * (len(have) + len(other) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(ok) for c in ("a", "b")], ["a", "b"])

    right = pairs.join(members.select(F.col("id").alias("b"), F.col("packed").alias("right")), "b")
    both = right.join(members.select(F.col("id").alias("a"), F.col("packed").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+', ' ', 'g'), '[^ ]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS hit
  FROM items AS a JOIN items AS b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared WHERE 100 * hit >= 80 * (an + bn - hit)
  UNION ALL SELECT b, a FROM shared WHERE 100 * hit >= 80 * (an + bn - hit)
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, coalesce(least(doc_id, least.b), doc_id) AS component_id,
  coalesce(least(doc_id, least.b), doc_id) = doc_id AS kept
FROM sets LEFT JOIN least ON least.a = doc_id
"""


@query("op1_minhash_dedup", SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all documents on two-word shingles at 80 %."""
    return near_duplicates(table(spark, folder, "documents", "doc_id", "text"), shingle=2)
