import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def filled(lengths, capacity):
    """Sequences of the plan as {sequence: [(offset, length)]}."""
    u, c = np.unique(lengths, return_counts=True)
    plan = packing.make_plan(u, c, capacity)
    out = {}
    for length, n in zip(u, c):
        for s, o in zip(*packing.place(plan, np.full(n, length), np.arange(n))):
            out.setdefault(int(s), []).append((int(o), int(length)))
    assert len(out) == plan["sequences"]
    for parts in out.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        assert sum(n for _, n in parts) <= capacity
    return out


def best(lengths, capacity):
    """Fewest sequences, by search."""
    lengths = sorted(map(int, lengths), reverse=True)
    found = [len(lengths)]

    def go(i, bins):
        if len(bins) >= found[0]:
            return
        if i == len(lengths):
            found[0] = len(bins)
            return
        for room in set(bins):
            if room >= lengths[i]:
                rest = list(bins)
                rest.remove(room)
                go(i + 1, [*rest, room - lengths[i]])
        go(i + 1, [*bins, capacity - lengths[i]])

    go(0, [])
    return found[0]


def test_reduction_keeps_the_optimum():
    rng = np.random.default_rng(3)
    for _ in range(150):
        capacity = int(rng.integers(6, 25))
        lengths = rng.integers(1 + capacity // 6, capacity + 1, size=int(rng.integers(1, 9)))
        count = np.bincount(lengths, minlength=capacity + 1)
        fixed = sum(n for n, _ in packing.reduce_dominated(count, capacity))
        rest = np.repeat(np.arange(capacity + 1), count)
        assert fixed + best(rest, capacity) == best(lengths, capacity)


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(4)
    for capacity in (50, 4096):
        lengths = np.minimum(rng.lognormal(np.log(capacity / 8), 1.1, 4000).astype(int) + 1, capacity)
        assert len(filled(lengths, capacity)) <= 1.005 * -(-lengths.sum() // capacity) + 1


def test_pack_edges(spark):
    rows = [(1, 5, "x"), (2, 5, "x"), (3, None, "x"), (4, 0, None), (5, 99, "x"), (None, 10, "x"), (1, 5, "x")]
    out = packing.pack(spark.createDataFrame(rows, "id long, length long, sequence_id string"), 10).collect()
    by = {(r.id, r.length): (r.sequence_id, r.offset) for r in out}
    assert len(out) == 7 and by[3, None] == by[4, 0] == (None, None)
    assert sum(r.sequence_id == by[5, 99][0] for r in out) == 1
    assert len({r.sequence_id for r in out if r.length in (5, 10)}) == 3
    assert packing.pack(spark.createDataFrame([], "id long, length long"), 10).count() == 0


def test_pieces(spark):
    texts = [None, "", "The END. it's", "Σ ΑΣ Σ", "J̌ Å", "x" * 9000, "a <|endoftext|> b", "A<|ENDOFTEXT|>", "one\x1ctwo three", "word " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in packing.token_pieces(docs, PATH, 20).orderBy("doc_id", "piece").collect():
        assert r.start == 20 * r.piece and len(r.ids) == 4 * r.length <= 80
        got[r.doc_id] = got.get(r.doc_id, b"") + bytes(r.ids)
    library = Tokenizer.from_file(PATH)
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(got[i], "<u4").tolist() == want, t


def test_words_are_joined_and_marks_cut_off(spark):
    """Random texts of letters that fall apart, marks in all places, signs and digits."""
    import random

    rng = random.Random(12)
    library = Tokenizer.from_file(PATH)
    encoder = packing.WordEncoder(PATH)
    assert encoder.joins and encoder.loose_marks
    parts = ["ab", "Don't", "it's", "İstanbul", "ǰ", "각", "é", "e\u0301", "ﬁ", "ßa", "x1", "..", "a.", "b,", ",", "c!?", "d;", "ʰ", "中文", "؛", "z:\u0301", "<|endoftext|>", "'ll", "ñ."]
    gaps = [" ", " ", " ", "\n", "\t ", "", "\u00a0", "\x0b"]
    texts = ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.ids) for r in packing.token_pieces(docs, PATH, 10**6, None).collect()}
    for i, t in enumerate(texts):
        assert np.frombuffer(got.get(i, b""), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    out = packing.op10(spark, folder).toPandas()
    library = Tokenizer.from_file(PATH)
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = np.array([*library.encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        mine = out[out.doc_id == r.doc_id].sort_values("piece")
        assert list(mine.start) == list(range(0, len(ids), 4096)) and mine.length.sum() == len(ids)
        assert list(mine.ids_crc32) == [zlib.crc32(ids[k : k + 4096].tobytes()) for k in mine.start]
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= 4096
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 4096) + 1


def test_plan_stays_small():
    import time

    start = time.time()
    for lengths, counts in (([2000], [10**8]), ([2000, 1900], [10**8, 10**8]), ([1, 1365, 2048, 4096], [10**7, 10**8, 10**8 + 1, 5])):
        plan = packing.make_plan(np.array(lengths), np.array(counts), 4096)
        assert len(plan["rank"]) <= 4 * len(lengths)
        assert plan["sequences"] >= -(-sum(a * b for a, b in zip(lengths, counts)) // 4096)
    assert time.time() - start < 1


def test_clashing_names(spark):
    rows = [(i, 1 + i % 7, "a", "b", "c") for i in range(50)]
    df = spark.createDataFrame(rows, "id long, length long, size string, Rank string, __row string")
    out = packing.pack(df, 10)
    assert out.columns == [*df.columns, "sequence_id", "offset"] and out.filter("size = 'a' AND Rank = 'b' AND __row = 'c'").count() == 50
