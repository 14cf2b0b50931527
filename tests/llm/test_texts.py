import re

import numpy as np
import pytest

from tallyloom.llm import crf, license, pii, quality

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, votes string, base string, license string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "x", "x") for i, t in enumerate(texts)], SCHEMA)


# -- quality


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r.good for r in quality.op4(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert np.mean([got[r.doc_id] == bool(r.quality) for r in labels]) > 0.98
    assert all(got[r.doc_id] for r in labels if r.quality)


def test_quality_edges(spark):
    texts = [None, "", " \n", "A plain sentence. And one more.", "A!! B!! C!!" * 50, "x" * 200_000] * 2
    out = {r.doc_id: r for r in quality.classify(frame(spark, texts), keep_all=True).collect()}
    assert len(out) == 12 and not any(out[i].good for i in (0, 1, 2, 6, 7, 8)) and out[0].votes == quality.NO_VOTES
    assert out[3].score == out[9].score and out[3].base == "x"
    assert quality.classify(frame(spark, [])).count() == 0
    assert quality.classify(frame(spark, ["All is well here."] * 3)).filter("good").count() == 3


def test_votes_are_estimated():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    fires = np.stack([~good & (rng.random(20_000) < r) for r in (0.9, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)], 1)
    prose = good & (rng.random(20_000) < 0.9)
    rows = ["".join("b" if f else "-" for f in r) + ("g" if p else "-") for r, p in zip(fires, prose)]
    kinds, at, n = np.unique(rows, return_inverse=True, return_counts=True)
    p, found = quality.fit_votes(list(kinds), n.astype(float))
    assert ((p[at] > 0.5) == good).mean() > 0.99 and abs(found[0, 0, 2] - 0.9) < 0.03


def test_votes_against_plain_em():
    """The same estimate by loops over every document, a point left out of the product."""
    import math

    patterns, counts = ["-" * 7 + "g", "b--b---g", "bb------", "-" * 8, "-b-----g", "-..-..-.", "b..-..-."], [40, 3, 5, 6, 2, 4, 1]
    got, _ = quality.fit_votes(patterns, np.array(counts, float), rounds=7)
    rows = [p for p, n in zip(patterns, counts) for _ in range(n)]
    p = {v: 0.1 if "b" in v else 0.9 if "g" in v else 0.6 for v in patterns}
    for _ in range(7):
        chance = {}
        for k in range(8):
            for c in (0, 1):
                weight = {v: 0.1 for v in "-gb"}
                for r in rows:
                    if r[k] != ".":
                        weight[r[k]] += p[r] if c else 1 - p[r]
                whole = {v: w / sum(weight.values()) for v, w in weight.items()}
                if c and k < 7:
                    high = min(whole["b"], quality.MAX_FALSE_ALARM)
                    rest = (1 - high) / (1 - whole["b"])
                    whole = {"-": whole["-"] * rest, "g": whole["g"] * rest, "b": high}
                chance[k, c] = whole
        prior = [sum(1 - p[r] for r in rows) + 1, sum(p[r] for r in rows) + 1]
        odds = {v: [prior[c] * math.prod(chance[k, c][x] for k, x in enumerate(v) if x != ".") for c in (0, 1)] for v in patterns}
        p = {v: g / (b + g) for v, (b, g) in odds.items()}
    assert np.allclose(got, [p[v] for v in patterns], atol=1e-9)


def test_scripts_that_do_not_part_words(spark):
    """Clean Chinese, Japanese, Thai and Korean texts stay, junk goes, whatever share they have."""
    import random

    rng = random.Random(1)
    han = sorted(set("今天的气很好我们一起去公园散步孩子在草地上跑来大人坐长椅聊河边有多花风从水面吹让觉得舒服"))
    kana = sorted(set("きょうはてんきがよいのでみんなでこうえんへいきましたこどもたちはくさのうえをはしる"))
    thai = ["วันนี้", "อากาศ", "ดีมาก", "และ", "เราไป", "เดินเล่น", "ที่สวน", "ด้วยกัน", "เด็กๆ", "วิ่ง", "บนสนาม", "หญ้า"]
    hangul = ["오늘은", "날씨가", "좋아서", "우리는", "공원에서", "산책을", "했다", "아이들은", "풀밭에서", "뛰어"]
    english = "the house river was small and people walked slowly along green fields with their children".split()

    def unparted(letters, mark):
        return "".join("".join(rng.choices(letters, k=rng.randint(6, 18))) + mark for _ in range(20))

    def parted(words, n=8):
        return ". ".join(" ".join(rng.choices(words, k=rng.randint(6, 14))).capitalize() for _ in range(n)) + "."

    kinds = {
        "en": [parted(english) for _ in range(300)], "junk": ["".join(rng.choices("!#$%|@~ aXZQ", k=300)) for _ in range(40)],
        "han": [unparted(han, "。") for _ in range(12)], "kana": [unparted(kana, "。\n") for _ in range(12)],
        "thai": ["".join(rng.choices(thai, k=60)) for _ in range(12)], "hangul": [parted(hangul) for _ in range(12)],
    }
    texts = [(k, t) for k, all_ in kinds.items() for t in all_]
    good = {r.doc_id for r in quality.classify(frame(spark, [t for _, t in texts])).filter("good").collect()}
    kept = {k: sum(i in good for i, (x, _) in enumerate(texts) if x == k) / len(all_) for k, all_ in kinds.items()}
    assert kept == {"en": 1, "junk": 0, "han": 1, "kana": 1, "thai": 1, "hangul": 1}
    assert quality.votes(kinds["thai"][0].encode()) == "--..-..." and quality.votes(kinds["han"][0].encode()) == "--..-..g"


def test_own_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "All is well here. It is so.", "a", "b")], "doc_id long, text string, __text string, Votes_ string")
    out = quality.classify(df, keep_all=True)
    assert out.columns == [*df.columns, "votes", "label", "score", "good"] and out.first()["__text"] == "a"


# -- personal data


def plain_spans(text):
    """The contract's patterns, tried as they are."""
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        even = [2 * x - 9 * (x > 4) for x in d[-2::-2]]
        if 12 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(even)) % 10 == 0:
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_patterns():
    import random

    rng = random.Random(4)
    pools = ["a.@-1", "0123456789 -", "1.2", "+1 (2)-3.4", "a@b.c_%+ é", "@@..aa"]
    for _ in range(4000):
        text = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("a@b.c_d@e.f 4242424242424242 +49 30 1234567 1.2.3.256") == plain_spans("a@b.c_d@e.f 4242424242424242 +49 30 1234567 1.2.3.256")
    for long in ("1" * 200_000, "a" * 200_000 + "@!", "1." * 100_000, "+1" + " " * 100_000):
        pii.base_spans(long)


def test_viterbi_is_best():
    import itertools

    rng = np.random.default_rng(6)
    moves = rng.normal(size=(3, 3))
    rows = [rng.normal(size=(n, 3)) for n in (1, 4, 6, 4, 0)]
    for e, got in zip(rows, crf.viterbi(rows, moves, 30)):
        value = lambda p: sum(e[i, k] for i, k in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))  # noqa: E731, B023
        assert len(got) == len(e) and (not len(e) or np.isclose(value(got), max(map(value, itertools.product(range(3), repeat=len(e))))))


def test_field_on_fresh_rows():
    """Held-out fillings of the labelled table."""
    field, right, all_ = pii.trained(), 0, 0
    for words in pii.labelled_words(2, seed=99):
        e = np.array([field.score(pii.shape_of(w)) for w, _ in words])
        got = crf.viterbi([e], field.moves)[0]
        right += int((got == [k for _, k in words]).sum())
        all_ += len(words)
        if got.any():
            assert any(field.is_worth(w) for w, _ in words)
    assert right / all_ > 0.97


def test_pii_edges(spark):
    texts = [None, "", "é a.b@c.de x\ncall +1 (555) 555-0123 é", "token = \"" + "a1b2c3d4e5" * 4 + "\"", "1234567812345678", "x " * 50_000 + "1.2.3.4", "plain words", "x " * 50_000 + "1.2.3.4"]
    out = {r.doc_id: r for r in pii.find(frame(spark, texts), redact=True).collect()}
    assert out[0].text is None and out[1].text == "" and out[6].text == "plain words" and not out[6].spans
    assert out[2].text == "é [EMAIL] x\ncall [PHONE] é" and [tuple(s) for s in out[2].base] == plain_spans(texts[2])
    assert out[3].text == 'token = "[SECRET]"' and not out[3].base and out[4].text == "[CARD]"
    assert out[5].text.endswith(" [IP]") and out[7].text == out[5].text
    assert pii.find(frame(spark, [])).count() == 0


def test_pii_query(spark):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in pii.op7(spark, FOLDER).collect():
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for *_, k in want) for x in pii.BASE]
        assert set(filter(None, pii.joined(want).split(","))) <= set(r.spans.split(","))


# -- licences


def brute(text, templates, threshold):
    """All stretches of all templates by plain sets, best first, without overlap."""
    w = license.words_of(text.encode())
    found = []
    for name, t in templates:
        u = license.words_of(t.encode())
        grams = set(zip(u, u[1:]))
        for a in range(len(w) - 1):
            for b in range(a + 2, len(w) + 1):
                s = set(zip(w[a:b], w[a + 1 : b]))
                if grams and (w[a], w[a + 1]) in grams and (w[b - 2], w[b - 1]) in grams:
                    d = 2 * len(s & grams) / (len(s) + len(grams))
                    if 2 * len(s & grams) >= threshold * (len(s) + len(grams)):
                        found.append((-len(s & grams), -d, a, b, name))
    taken, out = set(), []
    for _, d, a, b, name in sorted(found):
        if not taken & set(range(a, b)):
            taken |= set(range(a, b))
            out.append((name, a, b, -d))
    return sorted(out, key=lambda r: r[1])


def test_scan_against_brute_force(monkeypatch):
    import random

    rng = random.Random(7)
    templates = [("one", "a b c d e"), ("two", "b c a f"), ("three", "a b"), ("none", "a"), ("four", "c d e f a b d c"), ("two", "b c a f g"), ("five", "a a b b c")]
    for look in (1, 3, 256):
        monkeypatch.setattr(license, "_LOOK", look)
        for threshold in (0.4, 0.6, 0.8):
            scanner = license.Scanner(templates, threshold)
            for _ in range(150):
                # known words, a few foreign ones that repeat and many that don't
                pool = list("aabbccddeefg") + rng.choice([["x"], ["x", "y"] * 6, [f"n{i}" for i in range(12)]])
                text = " ".join(rng.choice(pool) for _ in range(rng.randint(0, 28)))
                assert scanner.scan(text.encode()) == brute(text, templates, threshold), text


def of(name):
    return max((t for n, t in license.NOTICES if n == name), key=len)


def test_foreign_words_inside_a_notice():
    scanner = license.Scanner(license.TEMPLATES, license.THRESHOLD)
    words = of("GPL-3.0").split()
    one_word = " ".join(words[:20] + ["foreign"] * 400 + words[20:])
    (name, a, b, d), = scanner.scan(one_word.encode())
    size = len(set(zip(license.words_of(of("GPL-3.0").encode()), license.words_of(of("GPL-3.0").encode())[1:])))
    assert (name, a, b) == ("GPL-3.0", 0, len(license.words_of(one_word.encode()))) and d == 2 * (size - 1) / (2 * size - 1 + 3)
    many = " ".join(words[:20] + [f"foreign{i}" for i in range(30)] + words[20:])
    assert all(b - a < 50 for _, a, b, _ in scanner.scan(many.encode()))  # no stretch across: 0.7


def test_families_are_told_apart():
    scanner = license.Scanner(license.TEMPLATES, license.THRESHOLD)
    for name, notice in license.NOTICES:
        text = f"Some words of another kind. {notice} And more of them."
        assert [n for n, *_ in scanner.scan(text.encode())] == [name], name
    for name, names in license.NAMES:
        for called in names:
            for lead in ("Licensed under the ", "This work is licensed under ", "this software is distributed under the terms of the "):
                assert [n for n, *_ in scanner.scan(f"x y {lead}{called}. z".encode())] == [name], (name, called)


def test_one_line_many_times():
    import time

    start = time.time()
    line = "Licensed under the Apache License, Version 2.0.\n"
    scanner = license.Scanner(license.TEMPLATES, license.THRESHOLD)
    got = scanner.scan((line * 3000).encode())
    assert len(got) == 3000 and {r[0] for r in got} == {"Apache-2.0"} and time.time() - start < 60


def test_license_edges(spark):
    texts = [None, "", "x\nLICENSED under the apache license version 2.0!! y", "word " * 100_000 + "Released under the MIT License.", "a license"]
    out = license.scan_licenses(frame(spark, texts + texts)).collect()
    assert sorted((r.doc_id, r.license, r.first_word, r.dice) for r in out) == [
        (2, "Apache-2.0", 1, 1.0), (3, "MIT", 100_000, 1.0), (7, "Apache-2.0", 1, 1.0), (8, "MIT", 100_000, 1.0)
    ]
    assert license.scan_licenses(frame(spark, [])).count() == 0
    assert license.scan_licenses(frame(spark, ["a b"]), [("x", "a")]).count() == 0


def test_license_query(spark):
    """Against plain sets on documents that hold a licence, cut to the stretch around it, and every planted line."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {}
    for r in license.op8(spark, FOLDER).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.first_word, r.last_word, r.dice))
    plain = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    assert got
    for d in docs:
        for line, name in plain.items():
            assert (line not in d.text) or name in {r[0] for r in got[d.doc_id]}
    few = [d for d in docs if d.doc_id in got][:4]
    short = [t for t in license.TEMPLATES if len(t[1]) < 90][::7]
    scanner = license.Scanner(short, license.THRESHOLD)
    for d in few:
        w = license.words_of(d.text.encode())
        a = max(0, got[d.doc_id][0][1] - 20)
        text = b" ".join(w[a : a + 60]).decode()
        assert scanner.scan(text.encode()) == brute(text, short, license.THRESHOLD)
