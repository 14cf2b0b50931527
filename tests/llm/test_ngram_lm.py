import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import elias_fano as ef
from tallyloom.llm import ngram_lm as lm

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n, universe", [(1, 1), (1, 10**12), (5, 7), (1000, 1000), (1000, 10**6), (3000, 2**60), (70_000, 10**9)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe, n, dtype=np.uint64)) if n < universe else np.arange(universe, dtype=np.uint64)
    arrays, head = ef.open_arrays(np.frombuffer(ef.file_bytes(ef.named("x", ef.encode(values, universe)), {"a": 1}), np.uint8))
    s = ef.sequence(arrays, "x")
    assert head["a"] == 1 and (s.access(np.arange(len(values))) == values.astype(np.int64)).all()
    assert (s.find(values) == np.arange(len(values))).all()
    first, second = s.access_two(np.arange(len(values) - 1))
    assert (first == values[:-1].astype(np.int64)).all() and (second == values[1:].astype(np.int64)).all()
    other = rng.integers(0, universe, 500, dtype=np.uint64)
    where = {int(v): i for i, v in enumerate(values)}
    assert list(s.find(other)) == [where.get(int(x), -1) for x in other]


def test_elias_fano_with_repeats():
    values = np.array([0, 0, 0, 3, 3, 9, 9, 9, 200], np.uint64)
    s = ef.EliasFano(ef.encode(values, 201))
    assert list(s.access(np.arange(9))) == list(values)


def test_elias_fano_is_compact():
    values = np.sort(np.random.default_rng(2).integers(0, 10**9, 100_000, dtype=np.uint64))
    size = sum(a.nbytes for a in ef.encode(np.unique(values), 10**9).values())
    assert size * 8 / 100_000 < 2 + math.log2(10**4) + 2


def brute(train, order, discount=lm.DISCOUNT):
    """Probability of each token of a list of words, by dictionaries."""
    counts = [Counter() for _ in range(order)]
    for w in train:
        for k in range(order):
            counts[k].update(tuple(w[i : i + k + 1]) for i in range(len(w) - k))
    kinds = Counter(g[:-1] for k in range(1, order) for g in counts[k])
    tokens, words = sum(counts[0].values()), len(counts[0])

    def p(w, i):
        out = (counts[0][(w[i],)] + 1) / (tokens + words + 1)
        for k in range(1, order):
            h = tuple(w[max(0, i - k) : i])
            if len(h) < k or not kinds[h]:
                break
            c = counts[k - 1][h]
            out = max(counts[k][(*h, w[i])] - discount, 0) / c + discount * kinds[h] / c * out
        return out

    return p, counts[0], tokens, words


def words_of(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def test_codes():
    p = np.array([1.0, 0.5, 1e-3, 1e-12, 0.0])
    codes, lowest = lm.to_code(p)
    back = lm.of_code(lowest)[codes]
    assert lowest == -12 and back[4] == 0 and np.abs(np.log10(back[:4] / p[:4])).max() <= 6 / 254 + 1e-9
    for odd in (np.zeros(3), np.ones(2), np.zeros(0)):
        codes, lowest = lm.to_code(odd)
        assert np.allclose(lm.of_code(lowest)[codes], odd)


@pytest.mark.parametrize("block", [16, 64, 1 << 18])
def test_tokens(monkeypatch, block):
    """Equal words have equal keys wherever they stand, different ones different keys."""
    monkeypatch.setattr(lm, "HASHED_AT_ONCE", block)
    lm.forget()
    rng = np.random.default_rng(block)
    letters = [b"a", b"b", b"\x00", "é".encode(), b"Z", b"\x1c"]
    words = [b"".join(rng.choice(letters, int(n))) for n in rng.integers(1, 12, 400)] + [b"x" * 63, b"x" * 64, b"x" * 65, b"y" * 300]
    gaps = [b" ", b"\t", b"\n ", b"\r\n", b"  "]
    texts = [b"".join(rng.choice(words) + rng.choice(gaps) for _ in range(int(n))) for n in rng.integers(0, 40, 60)] + [b"", b" a  B\tc", b"a", b"  "]
    hashes, starts = lm.tokens_of(texts)
    want = [w for t in texts for w in [*t.lower().split(), None]]
    key = dict(zip(want, hashes.tolist()))
    assert [key[w] for w in want] == hashes.tolist() and len(set(key.values())) == len(key) and key[None] == int(lm.END)
    first = np.cumsum([0] + [len(t.split()) + 1 for t in texts])[:-1]
    assert np.flatnonzero(starts).tolist() == first.tolist()
    assert all(len(x) == 0 for x in lm.tokens_of([]))
    lm.forget()


def test_limits(spark):
    lm._fits(2**31, 2**31)
    with pytest.raises(OverflowError):
        lm._fits(10**10, 10**9)
    assert lm.qualified(spark, "/x/y") == "file:/x/y" and lm.qualified(spark, "file:///x") == "file:/x"
    with pytest.raises(ValueError):
        lm._filesystem("/x/y")


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_model(spark, order, monkeypatch):
    monkeypatch.setattr(lm, "KEYS_AT_ONCE", 500)
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(list("aabbbcdefgh"), rng.integers(0, 30))) for _ in range(120)] + [None, "", "A b\x0bC", "a " * 5000]
    train = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    asked = [*texts[::7], "zz unknown a b", "a zz b c d", None, "b a b a b a"]
    trie = lm.build(train, order)
    p, c, tokens, words = brute([words_of(t) for t in texts], order)
    assert (trie.tokens, trie.words) == (tokens, words)
    out = lm.score(spark.createDataFrame([(i, t, "x") for i, t in enumerate(asked)], train.schema), trie)
    for r in out.collect():
        w = words_of(asked[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(w), sum(c[(x,)] > 0 for x in w))
        assert math.isclose(r.base_score, sum(math.log10((c[(x,)] + 1) / (tokens + words + 1)) for x in w), abs_tol=1e-6)
        assert abs(r.score - sum(math.log10(p(w, i)) for i in range(len(w)))) <= 0.04 * len(w)


def test_probabilities_add_up(spark):
    texts = ["a b c a b", "b c a", "c c b a b c"]
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    trie = lm.build(frame(texts), 3)
    score = {r.doc_id: r.score for r in lm.score(frame(["a", "a a", "a b", "a c", "a zz", ""]), trie).collect()}
    p, *_ = brute([words_of(t) for t in texts], 3)
    total = sum(p([b"a", x], 1) for x in (b"a", b"b", b"c", b"\n", b"zz"))
    assert math.isclose(total, 1, abs_tol=1e-9) and score[2] < 0


def test_no_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    trie = lm.build(empty)
    assert lm.score(empty, trie).count() == 0
    one = lm.score(spark.createDataFrame([(1, "a")], empty.schema), trie).first()
    assert (one.n_tokens, one.n_known, one.score) == (2, 0, 0.0)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    out_of = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    _, c, tokens, words = brute([words_of(t) for i, t in docs.items() if not out_of[i]], 1)
    rows = lm.op6(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = words_of(docs[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out_of[r.doc_id], len(w), sum(c[(x,)] > 0 for x in w), tokens)
        assert math.isclose(r.base_score, sum(math.log10((c[(x,)] + 1) / (tokens + words + 1)) for x in w), rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
