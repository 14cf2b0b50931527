import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from tallyloom.llm import ann, embed_dedup
from tallyloom.llm.components import components
from tallyloom.llm.rotcodes import RotatedCodes, unit

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, vector string, label string"


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    x, q = unit(rng.normal(size=(400, 64))), unit(rng.normal(size=(50, 64)))
    codes = RotatedCodes(64, 4)
    guess, half = codes.bounds(*codes.encode(x), codes.queries(q), 4.0)
    error = guess - x @ q.T
    assert (np.abs(error) <= half).mean() > 0.999 and abs(error.mean()) < 0.005


@pytest.mark.parametrize("edges, want", [
    ([(1, 2), (2, 3), (5, 4), (3, 3), (2, 1)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(99, i) for i in range(60)], {i: 0 for i in [*range(60), 99]}),
    ([(None, 1)], {}),
])
def test_components(spark, edges, want):
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want


def odd_rows():
    rng = np.random.default_rng(8)
    base = rng.normal(size=8)
    rows = [(i, list(map(float, rng.normal(size=8))), "x", "x") for i in range(10, 200)]
    rows += [(200 + i, list(map(float, base + rng.normal(size=8) * 0.02)), "x", "x") for i in range(12)]
    rows += [(300, [0.0] * 8, "x", "x"), (301, None, None, None), (302, [1.0], "x", "x"), (303, [float("nan")] * 8, "x", "x")]
    rows += [(304, [None] * 8, "x", "x"), (305, [float("inf")] + [1.0] * 7, "x", "x"), (306, rows[0][1], "x", "x"), (307, rows[0][1], "x", "x")]
    return rows


def usable(rows):
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if v is not None and len(v) == 8 and None not in v]
    return [(i, v) for i, v in kept if np.isfinite(v).all() and v.any()]


def test_near_duplicates(spark):
    rows = odd_rows()
    good = usable(rows)
    cos = {(a, b): v @ w / np.sqrt((v @ v) * (w @ w)) for a, v in good for b, w in good if a != b}
    out = {r.vec_id: r for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(out) == {r[0] for r in rows}
    for r in rows:
        assert out[r[0]].n_links == sum(cos.get((r[0], b), 0) >= 0.95 for b, _ in good)
    assert out[306].component_id == 10 and not out[306].kept and out[307].n_links == 2
    assert all(out[i].kept and out[i].n_links == 0 for i in (300, 301, 302, 303, 304, 305))
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    rows = [(i, list(map(float, base + rng.normal(size=8) * 0.01)), "x", "x") for i in range(150)]
    out = embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in out} == {(149, 0)}


def test_nearest(spark):
    rows = odd_rows()
    good = usable(rows)
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for i, v in good:
        if i % 20 == 0:
            want = sorted((float(np.sqrt(((v - w) ** 2).sum())), b) for b, w in good if b != i)[:5]
            assert [b for _, b, _ in sorted(got.pop(i))] == [b for _, b in want]
    assert not got
    few = spark.createDataFrame(rows[:2], SCHEMA)
    assert ann.nearest(few, F.col("vec_id") == 10).collect()[0].vec_id == 11
    assert ann.nearest(few.limit(0), F.col("vec_id") == 10).count() == 0


@pytest.mark.parametrize("name", ["op2_embedding_dedup", "op9_ann"])
def test_sql(spark, name):
    import compare
    from tallyloom.llm.registry import ORACLE, QUERIES

    df = QUERIES[name](spark, FOLDER)
    res = compare.connect(FOLDER).execute(ORACLE[name])
    columns = [c[0] for c in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert compare.as_rows(df.columns, [tuple(r) for r in df.collect()]) == compare.as_rows(columns, res.fetchall())
