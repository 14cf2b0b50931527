import random

import numpy as np
import pyarrow as pa

from tallyloom.llm import wordcache


def test_gather_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 9, 40)
    lengths[5] = 300
    table = rng.integers(0, 1000, lengths.sum()).astype("<u4")
    starts = np.cumsum(lengths) - lengths
    for most in (1, 7, 100, 10**6):
        monkeypatch.setattr(wordcache, "GATHERED_AT_ONCE", most)
        for n in (0, 1, 60):
            which = rng.integers(0, 40, n)
            out, ends = wordcache.gather(table, starts, lengths, which)
            want = [table[starts[i] : starts[i] + lengths[i]] for i in which]
            assert out.tolist() == [x for w in want for x in w] and ends.tolist() == np.cumsum([len(w) for w in want]).tolist()


def test_two_generations():
    asked = []

    def encode(chunks):
        asked.extend(chunks)
        return [list(c) for c in chunks]

    rng = random.Random(1)
    cache = wordcache.ChunkCache(encode, limit=10)
    for _ in range(200):
        lists = [[b"%d" % min(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randint(0, 6))] for _ in range(4)]
        out, ends = cache.join(pa.array(lists, pa.list_(pa.binary())))
        assert len(cache.new) < 10 and len(cache.old) < 10 + 24
        got = [out[a:b].tolist() for a, b in zip(np.append(0, ends), ends)]
        assert got == [[x for c in chunks for x in c] for chunks in lists]
    few = wordcache.ChunkCache(encode, limit=10)
    asked.clear()
    for i in range(300):  # chunks in use stay although others come and go
        few.look_up([b"rare%d" % i, b"often"], [False, True])
    assert asked.count(b"often") == 1 and len(asked) == 301
