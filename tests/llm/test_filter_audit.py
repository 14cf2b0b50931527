import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import filter_audit


def weights():
    return {"good": ("good_lost", F.col("quality") == 1), "toxic": ("toxic_lost", F.col("toxic") == 1)}


def brute(docs, labels, limits):
    """Apply all orders row by row."""
    def fails(i, text):
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        return {
            "A": len(words) < limits.min_words,
            "B": 100 * len(set(words)) < limits.distinct_percent * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > limits.capitals_percent * len(t),
            "D": bool(set(t) & set(limits.signs.decode())),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs),
        }

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = [(part or "", i, fails(i, t)) for i, t, part in docs]
    out, shapley = {}, {}
    for part in {p for p, _, _ in rows}:
        mine = [(i, f) for p, i, f in rows if p == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[c]]
                left = [(i, f) for i, f in left if not f[c]]
                shapley[part, c] = shapley.get((part, c), 0) + len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(f[c] for _, f in mine) - len(gone),
                    sum(f[c] and sum(f.values()) == 1 for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_against_all_orders(spark):
    rng = random.Random(5)
    words = ["a", "b", "Cc", "DD", "é", "x$", "　y", "z\x1cq"]
    limits = filter_audit.Limits(min_words=4, distinct_percent=60, capitals_percent=20)
    docs = []
    for i in range(60):
        text = rng.choice([None, "", " ", " \t ".join(rng.choices(words, k=rng.randint(1, 7)))])
        docs.append((rng.choice([i, i, i // 2, None]), text, rng.choice(["en", "de", None, ""])))
    docs += docs[:5]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in [*range(0, 60, 2), 4, 8, None]]
    frame = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, lang string, mask int, digest string")
    marks = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = result(filter_audit.filter_audit(frame, marks, weights(), limits))
    want = brute(docs, labels, limits)
    assert got == want and len(got) == 600 * len({d[2] or "" for d in docs})


def test_long_text_and_hot_copies(spark):
    docs = [(i, "word " * 50_000 if i == 3 else "same text", "en") for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = result(filter_audit.filter_audit(frame, marks, weights()))
    assert got["en", "EBACD", 1][:3] == (2, 398, 0)
    assert got["en", "AEBCD", 1][:2] == (1, 399) and got["en", "AEBCD", 2][:3] == (1, 0, 398)


def test_empty_and_wrong_letters(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(none, marks, weights()).count() == 0
    for letters in ("", "AA", "ABCDEFGHI"):
        with pytest.raises(ValueError):
            filter_audit.audit(none, letters, {})
