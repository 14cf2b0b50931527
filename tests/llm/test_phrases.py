import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import double_array, phrases


def brute(docs, least, longest, top, percent=100):
    """Counts of all phrases, cut and compared one by one."""
    f, n = {}, Counter()
    for text, lang in docs:
        lang = lang or "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in good.items():
            inside = (q for q in good if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * good[q] >= percent * a for q in inside):
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, rows):
    rng = random.Random(seed)
    words = ["a", "A", "bé", "c", "d\x00", "E1", "\x1cf", "　", "g-h", "ÀB"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", " ; "]
    out = []
    for _ in range(rows):
        t = "".join(w + rng.choice(gaps) for w in rng.choices(words, range(10, 0, -1), k=rng.randint(0, 40)))
        out.append((rng.choice([t, t, t, None, ""]), rng.choice(["en", "en", "de", None, "und", ""])))
    return out


@pytest.mark.parametrize("least, longest, top, each", [(3, 5, 2000, 1000), (8, 3, 7, 5), (2, 2, 50, 40)])
def test_against_counting(spark, least, longest, top, each):
    docs = texts(least, 120)
    docs += docs[:10]
    df = spark.createDataFrame([(*d, 5, "x") for d in docs], "text string, lang string, n int, word string").repartition(3)
    out = phrases.collocations(df, least, longest, top, phrases_each=each)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == brute(docs, least, longest, top)


class Task:
    """Takes the function of a pass, to run it here over batches."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def dropDuplicates(self, keys):
        return self

    def rows(self, texts):
        batches = [pa.RecordBatch.from_arrays([pa.array([t.tobytes()], pa.binary())], ["symbols"]) for t in texts]
        return [tuple(r.values()) for b in self.run(iter(batches)) for r in b.to_pylist()]


class Value:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("kept", [5, 10**6])
def test_passes_with_little_memory(monkeypatch, kept):
    """What a task gathers is passed on in parts when it gets too much."""
    for name in ("KEPT_KEYS", "KEPT_PHRASES"):
        monkeypatch.setattr(phrases, name, kept)
    monkeypatch.setattr(phrases, "STEP_SYMBOLS", 50)
    rng = np.random.default_rng(4)
    words = phrases.symbols_of([b"a", b"b", b"c", b"d", b"e", b"f"], "en")
    texts = [words[rng.integers(0, 6, 70)] for _ in range(12)]
    for t in texts:
        t[rng.random(70) < 0.1] = 0
        t[-1] = 0
    every = Value(np.full((1 << phrases.FILTER_BITS) // 8, 255, np.uint8))
    whole = np.concatenate(texts)
    *_, (_, _, keys) = phrases.grams(whole, [every.value] * 2)
    got = Counter()
    for half, n in phrases.half_key_counts(Task(), [every] * 2).rows(texts):
        got[half % 2**32] += n
    assert got == Counter((keys >> np.uint64(32)).tolist())
    times = Counter(tuple(whole[i : i + k].tolist()) for k in (2, 3) for i in range(len(whole) - k + 1) if whole[i : i + k].all())
    rows = phrases.paths(Task(), [every] * 3, 4).rows(texts)
    found = [tuple(x % 2**64 for x in path) for _, path in rows]
    frequent = {p for p, n in times.items() if n >= 4}
    assert set(found) <= set(times) and frequent <= set(found) and frequent
    if kept > 5:
        assert len(found) == len(frequent)


def test_covered_by_share(spark):
    docs = [("x y z", "en")] * 8 + [("x y", "en")] * 2
    df = spark.createDataFrame(docs, "text string, lang string")
    for percent in (100, 80, 81):
        got = sorted(map(tuple, phrases.collocations(df, 2, covered_percent=percent).collect()))
        assert got == brute(docs, 2, 5, 2000, percent)


def test_long_text_and_no_text(spark):
    docs = [("to be or " * 70_000, "en"), (None, "en"), ("", None)]
    out = phrases.collocations(spark.createDataFrame(docs, "text string, lang string")).collect()
    assert sorted(map(tuple, out)) == brute(docs, 100, 5, 2000)
    assert {r.phrase: r.a for r in out}["to be or"] == 70_000 and {r.n for r in out} == {210_000}
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    for wrong in ({"max_words": 1}, {"min_count": 0}):
        with pytest.raises(ValueError):
            phrases.collocations(spark.createDataFrame([], "text string, lang string"), **wrong)


def test_score_beyond_64_bits(spark):
    a, n, left, right = 10**13, 9 * 10**15, 3 * 10**13, 7 * 10**14
    big = "decimal(17, 0)"
    q = f"SELECT (1000BD * cast({a}L AS {big}) * cast({n}L AS {big})) div (cast({left}L AS {big}) * cast({right}L AS {big}))"
    assert spark.sql(q).collect()[0][0] == 1000 * a * n // (left * right)


def test_trie_against_lookups():
    rng = np.random.default_rng(0)
    for words, n in ((5, 30), (50, 500), (1000, 4000)):
        paths = [np.unique(rng.zipf(1.3, (n, k)) % words + 7, axis=0).astype(np.uint64) for k in (2, 3, 5)]
        keys = [np.arange(1, len(p) + 1) + 10**6 * k for k, p in enumerate(paths, 1)]
        trie = double_array.build(paths, keys)
        text = (rng.zipf(1.3, 5000) % words + 7).astype(np.uint64)
        text[rng.random(5000) < 0.05] = 0
        counts = np.zeros(len(trie.check), np.int64)
        trie.add_counts(text, counts)
        plain = text.tolist()
        want = Counter(x for x in plain if x in set(trie.symbols.tolist()))
        for p, k in zip(paths, keys):
            look = {tuple(row): key for row, key in zip(p.tolist(), k.tolist())}
            m = p.shape[1]
            want.update(look[g] for i in range(len(plain) - m + 1) if (g := tuple(plain[i : i + m])) in look)
        assert {int(k): int(c) for k, c in zip(trie.key, counts) if k and c} == dict(want)
