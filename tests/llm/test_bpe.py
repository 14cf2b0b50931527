import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.ByteBPE(PATH, leaf=8)


def ours(codec, text):
    return [i for ids in codec.encode_chunks(bpe.split(text.encode())) for i in ids]


EDGES = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n\n  b \n", "\t x", "x  y", " \n b", "a   b",
    "\x1c x \x1d", "it's we'll", "<|endoftext|>", "a <|endoftext|>  b", "é" * 50, "a" * 100, "ab" * 99, "你好" * 40, "🙂" * 30,
    "x<|endoftext|>" * 9, "1" * 77, "!?" * 60, "a" * 31 + " " * 40 + "b", "\n" * 50, "\r\n\r\n a", "\v\f b",
]


@pytest.mark.parametrize("text", EDGES)
def test_edges(codec, library, text):
    ids = ours(codec, text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    import numpy as np

    assert codec.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False) == text


def test_random_texts(codec, library):
    rng = random.Random(5)
    pools = ["ab ", "aeinorst", "  \n\tab.,'s", "éêü ß1", "the and of  ", "!#$% <|>", "你好a "]
    for _ in range(1500):
        pool = rng.choice(pools)
        text = "".join(rng.choice(pool) for _ in range(rng.randint(1, 120)))
        assert ours(codec, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_tables(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (2, "a b", "x"), (2, "a b", "x"), (None, "z" * 20_000, "x"), (3, "the " * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.decoded) for r in out if r.doc_id) == sorted(
        (False, i, len(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t, _ in rows if i
    )
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bpe.decode(null, PATH).first().decoded is None


def test_query(spark, library):
    import hashlib

    import numpy as np

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in bpe.op5(spark, "/root/testdata/sf0.001").collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
