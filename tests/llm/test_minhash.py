import random

import numpy as np
import pytest

from tallyloom.llm import minhash
from tallyloom.llm.shingles import common, shingle_set

SCHEMA = "doc_id long, text string, n string, id string"


def brute(rows, k, percent):
    """Component and kept of each distinct id, by all pairs."""
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    links = {i: {i} for i in sets}
    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a != b and x and y and 100 * len(x & y) >= percent * len(x | y):
                links[a].add(b)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(sets[i]), min(seen))
    return out


def family(rng, n, words, change):
    base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, change)):
            copy[rng.randrange(words)] = f"v{rng.randint(0, 9999)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_components(spark, k):
    rng = random.Random(k)
    texts = [t for words, change in ((60, 6), (200, 24), (30, 3), (400, 30)) for t in family(rng, 40, words, change)]
    texts += ["", None, "one", "One", "one two", "a b c d e f g", "a b c d e f g", "x " * 60_000, "ONE\x0btwo"]
    rows = [(i, t, "x", "x") for i, t in enumerate(texts)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=k).collect()
    want = brute(rows, k, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_edges(spark):
    rows = [(1, "a b c", "x", "x"), (1, "a b c", "x", "x"), (2, "a b c", "x", "x"), (None, "a b c", "x", "x"), (3, None, None, None)]
    out = sorted((str(r.doc_id), r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), 2).collect())
    assert out == [("1", 1, True), ("1", 1, True), ("2", 1, False), ("3", 3, True), ("None", None, True)]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_leaves_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(9)
    rows = [(i, t, "x", "x") for i, t in enumerate(family(rng, 150, 60, 9))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2, 80)


def test_signature_estimates_similarity():
    rng, signer = np.random.default_rng(1), minhash.Signer()
    for n in (5, 40, 300, 3000):
        errors = []
        for _ in range(40):
            pool = np.unique(rng.integers(0, 2**63, 2 * n, dtype=np.uint64) * np.uint64(2))
            a, b = np.sort(pool[: int(1.5 * n)]), np.sort(pool[n // 4 : int(1.75 * n)])
            j = common(a, b) / (len(a) + len(b) - common(a, b))
            s = [np.frombuffer(signer.sign(x)[1], np.uint8) for x in (a, b)]
            errors.append(minhash.estimate(*s) - j)
        assert np.abs(errors).max() < minhash.SLACK * (3 if n < 20 else 1.2) and abs(np.mean(errors)) < 0.05
    assert len(shingle_set(b"a b a b a", 2)) == 2


def test_sql(spark):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    import compare
    from tallyloom.llm.registry import ORACLE

    folder = "/root/testdata/sf0.001"
    df = minhash.op1(spark, folder)
    res = compare.connect(folder).execute(ORACLE["op1_minhash_dedup"])
    columns = [c[0] for c in res.description]
    assert compare.as_rows(df.columns, [tuple(r) for r in df.collect()]) == compare.as_rows(columns, res.fetchall())
