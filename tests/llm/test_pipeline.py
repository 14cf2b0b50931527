import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import pii, quality

FOLDER = "/root/testdata/sf0.001"


def shingles(text, k):
    w = text.encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def survivors(docs, k=5, percent=80):
    """Smallest id of each component, by all pairs."""
    sets = {i: shingles(t, k) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a1, b1 = find(a), find(b)
                root[max(a1, b1)] = min(a1, b1)
    return {i for i in ids if find(i) == i}


def test_against_brute_force(spark):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    good = {r.doc_id for r in quality.op4(spark, FOLDER).filter("good").collect()}
    kept = survivors({i: given[i] for i in good})
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert set(out.doc_id) == kept and len(kept) < len(good) < len(given)
    for i in kept:
        (_, spans), = pii.all_spans([given[i].encode()], pii.trained())
        clean = pii.redacted(given[i].encode(), spans)
        ids = np.array([*library.encode(clean, add_special_tokens=False).ids, 1], "<u4")
        mine = out[out.doc_id == i].sort_values("start")
        assert list(mine.ids_crc32) == [zlib.crc32(ids[k : k + 4096].tobytes()) for k in mine.start] and mine.length.sum() == len(ids)
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()


@pytest.mark.parametrize("rows", [
    [],
    [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0)],
    [(1, "A fine text. It is short.", "en", "s", None)] * 2 + [(2, "A fine text. It is short.", None, "s", 25), (None, "Write to a@b.org soon. Or not.", "en", None, 30)],
])
def test_stages_take_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, FOLDER)
        if name != "packing":
            assert docs.columns == before.columns
    got = docs.collect()
    assert len(got) == (2 if len(rows) == 4 else 0)  # of three equal rows one


def test_rows_of_one_id(spark, tmp_path):
    """A second text of an id stays unless it has a near-copy; the smallest id of a group stays, none comes last."""
    a, b, c = ("one two three four five six seven eight nine ten " + w for w in ("alpha", "beta", "gamma delta epsilon zeta"))
    texts = {"a": " ".join([a] * 5 + ["end"]), "b": "quite another text of more than five words here", "c": c[::-1]}
    rows = [(7, texts["a"]), (3, texts["a"]), (3, texts["b"]), (None, texts["b"]), (3, texts["c"]), (3, texts["c"]), (None, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, row long")
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    out = corpus_pipeline.near_duplicates(spark, stored, FOLDER)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(3, texts["a"]), (3, texts["b"]), (3, texts["c"]), (None, ""), (8, None)], key=str)
