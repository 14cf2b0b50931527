import zlib
from collections import Counter
from math import comb

import numpy as np
import pytest

from tallyloom.llm import sharding

FOLDER = "/root/testdata/sf0.001"


def check(rows, shards):
    """Exact sizes and gapless slots."""
    sizes = Counter(r.shard for r in rows)
    assert all(sizes[s] in (len(rows) // shards, -(-len(rows) // shards)) for s in range(shards))
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_draws_follow_the_law():
    rng = np.random.default_rng(1)
    for good, bad, n in ((5, 7, 4), (3, 20, 10), (9, 2, 6)):
        got = Counter(sharding.hypergeometric(rng, good, bad, n) for _ in range(6000))
        want = [comb(good, x) * comb(bad, n - x) / comb(good + bad, n) if n >= x else 0 for x in range(good + 1)]
        assert all(abs(got[x] / 6000 - p) < 5 * (p * (1 - p) / 6000) ** 0.5 + 1e-9 for x, p in enumerate(want))
    big = [sharding.hypergeometric(rng, 3 * 10**9, 45 * 10**9, 60_000_000) for _ in range(200)]
    sd = (60e6 / 16 * 15 / 16) ** 0.5
    assert abs(np.mean(big) - 60e6 / 16) < 5 * sd / 200**0.5 and 0.8 < np.std(big) / sd < 1.2
    assert sharding.hypergeometric(rng, 0, 9, 4) == 0 and sharding.hypergeometric(rng, 9, 0, 4) == 4


def test_matrix_adds_up():
    rng = np.random.default_rng(2)
    sizes, room = [7, 0, 12, 1, 20], [10, 10, 10, 10]
    m = np.array(sharding.deal_counts(rng, sizes, room))
    assert m.sum(1).tolist() == sizes and m.sum(0).tolist() == room and (m >= 0).all()


def test_many_blocks_and_buckets(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("id", "'x' AS shard", "id AS slot", "id AS AT", "null AS block")
    out = sharding.deal(df, 6, seed=3, block_bits=6, bucket_rows=50)
    rows = out.collect()
    assert out.columns == ["id", "AT", "block", "shard", "slot"] and sorted(r.id for r in rows) == list(range(5000))
    check(rows, 6)
    assert sorted(rows) == sorted(sharding.deal(df, 6, seed=3, block_bits=6, bucket_rows=50).collect())
    assert sorted(rows) != sorted(sharding.deal(df, 6, seed=4, block_bits=6, bucket_rows=50).collect())
    # neighbours are spread: the places of consecutive rows hardly correlate
    place = np.array([r.shard * 10_000 + r.slot for r in sorted(rows)], float)
    assert abs(np.corrcoef(place[:-1], place[1:])[0, 1]) < 0.07 and abs(np.corrcoef(place, np.arange(5000))[0, 1]) < 0.07


def test_every_place_is_as_likely(spark):
    df = spark.range(0, 12, 1, 3)
    seen = np.zeros((12, 12))
    for seed in range(36):
        for r in sharding.deal(df, 2, seed=seed, block_bits=1, bucket_rows=2).collect():
            seen[r.id, r.shard * 6 + r.slot] += 1
    assert ((seen - 3) ** 2 / 3).sum() < 121 + 5 * (2 * 121) ** 0.5


def test_odd_tables(spark):
    assert sharding.deal(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, None), (1, ""), (1, ""), (None, "x" * 100_000), (2, "b")]
    out = sharding.deal(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    check(out, 3)
    assert Counter((r.doc_id, r.text) for r in out) == Counter(rows)
    with pytest.raises(ValueError):
        sharding.deal(spark.range(1), 0)


def test_written_shards_keep_the_order(spark, tmp_path):
    dealt = sharding.deal(spark.range(100), 4)
    sharding.write_shards(dealt, str(tmp_path / "out"), rows_per_file=10)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.id, r.shard, r.slot) for r in back.collect()) == sorted((r.id, r.shard, r.slot) for r in dealt.collect())
    one = spark.read.parquet(str(tmp_path / "out" / "shard=2")).collect()
    runs = [r.slot for r in one]
    assert sorted(runs) == list(range(25)) and sum(b != a + 1 for a, b in zip(runs, runs[1:])) <= 2


def test_query(spark):
    rows = sharding.op11(spark, FOLDER).collect()
    check(rows, 16)
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(docs[r.doc_id]) + 1, zlib.crc32(docs[r.doc_id]))
        assert r.law == "rows" and r.grown_shard is None
