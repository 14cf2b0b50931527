"""Document quality from weak labels: heuristics, their accuracies by EM, a hashed linear scorer.

Each heuristic looks at one number of a text and votes bad or not at all; one looks for prose
and votes good or not at all. Heuristics that go by words and sentences say nothing of text whose
script doesn't part words, which is something else than not to vote. Expectation maximisation over
the counts of vote patterns (all documents, 2^heuristics rows or a small multiple of it at most)
finds how each heuristic votes on good and on bad documents, and so the probability that a pattern
is good. These probabilities, as soft labels, train a linear scorer on hashed byte trigrams, with
rows of every pattern, which then scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.registry import fresh, query, table
from tallyloom.llm.wordcache import text_groups

# name: bad above; at or below it, no vote. The numbers are made in `measures`.
HEURISTICS = {
    "capitals": 0.25,  # share of A-Z among letters
    "signs": 0.06,  # share of unusual signs among characters that aren't white space
    "doubled": 0.10,  # signs that follow the same sign, per word
    "bars": 0.04,  # column separators per word
    "repeats": 0.50,  # share of lines that repeat an earlier one
    "long_words": 25.0,  # characters per word
    "stutter": 0.10,  # share of words that equal the word before
}
# The one heuristic that can vote good: words per sentence mark and characters per word of prose.
PROSE = ((2.0, 40.0), (2.5, 12.0))
# Of these there is nothing to say where words aren't parted; prose is then characters per sentence mark.
WORDLY = ("doubled", "bars", "long_words", "stutter")
UNPARTED_PROSE = (4.0, 90.0)
# No heuristic is taken to vote bad on more than this share of good documents. Kinds of bad text
# that never occur together would else look like two classes of their own.
MAX_FALSE_ALARM = 0.002
FEATURES = 2048
# A text of so many bytes is scored half by its own features, half by the share of good texts.
SHORT = 30
# About so many documents fit the scorer, and half as many more that are shared out among the vote patterns;
# of each pattern those whose hash of id and text is small enough.
TRAINING_ROWS = 4000

_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True
_LEAD = np.arange(256) & 0xC0 != 0x80  # first bytes of a character
# UTF-8 sentence marks of East Asian text, in wide and in usual form.
_WIDE_MARKS = (b"\xe3\x80\x82", b"\xef\xbc\x8e", b"\xef\xbc\x81", b"\xef\xbc\x9f", b"\xef\xbd\xa1")


def unparted(a: np.ndarray) -> int:
    """Characters of scripts that don't part words: Han and Kana, Thai, Lao, Khmer, Burmese."""
    if not (a >= 0xE0).any():
        return 0
    east = int(((a >= 0xE3) & (a <= 0xE9)).sum() + (a == 0xF0).sum())  # U+3000 to U+9FFF and beyond the first plane
    first, second = a[:-1], a[1:]
    south = (first == 0xE0) & (second >= 0xB8) & (second <= 0xBB)  # U+0E00 to U+0EFF
    south |= (first == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))  # U+1000, U+1780
    return east + int(south.sum())


def measures(text: bytes) -> tuple[list[float], bool, bool] | None:
    """The heuristics' numbers in order, whether words are parted, whether it is prose; None without a word."""
    a = np.frombuffer(text, np.uint8)
    space = _SPACE[a]
    words = int((~space[1:] & space[:-1]).sum()) + int(len(a) > 0 and not space[0])
    if not words:
        return None
    count = np.bincount(a, minlength=256)
    points = int(count[_LEAD].sum())
    upper, letters = count[65:91].sum(), count[65:91].sum() + count[97:123].sum() + count[192:].sum()
    solid = points - int(space.sum())
    doubled = int((_SIGNS[a[1:]] & (a[1:] == a[:-1])).sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    numbers = [
        upper / max(1, letters), count[_SIGNS].sum() / solid, doubled / words, count[ord("|")] / words,
        1 - len(set(lines)) / len(lines), solid / words, stutter(text),
    ]
    marks = count[ord(".")] + count[ord("?")] + count[ord("!")]
    parted = 2 * unparted(a) <= letters
    if parted:
        (least, most), (short, long) = PROSE
        return numbers, True, least <= words / max(1, marks) <= most and short <= numbers[5] <= long
    marks += sum(text.count(m) for m in _WIDE_MARKS)
    return numbers, False, bool(marks) and UNPARTED_PROSE[0] <= solid / marks <= UNPARTED_PROSE[1]


def stutter(text: bytes) -> float:
    words = text.split()
    return sum(map(eq, words, words[1:])) / max(1, len(words))


def votes(text: bytes) -> str:
    """One letter per heuristic (b or -), then that of the prose heuristic (g or -); a point where it has nothing to say."""
    found = measures(text)
    if found is None:
        return NO_VOTES
    numbers, parted, prose = found
    letters = [
        "." if name in WORDLY and not parted else "b" if v > most else "-" for v, (name, most) in zip(numbers, HEURISTICS.items())
    ]
    # scripts without sentence marks can't look like prose, and that is nothing against them
    return "".join(letters) + ("g" if prose else "-" if parted else ".")


NO_VOTES = "-" * (len(HEURISTICS) + 1)


def fit_votes(patterns: list[str], counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each pattern, and P(vote | class) as [class, heuristic, vote]; a point takes no part."""
    kinds = np.array([["-gb.".index(v) for v in p] for p in patterns]).reshape(len(patterns), -1)
    onehot = kinds[:, :, None] == np.arange(3)
    p = np.where((kinds == 2).any(1), 0.1, np.where((kinds == 1).any(1), 0.9, 0.6))  # where EM starts
    for _ in range(rounds):
        weights = np.stack([counts * (1 - p), counts * p])
        table_ = np.einsum("cp,phv->chv", weights, onehot) + 0.1
        table_ /= table_.sum(2, keepdims=True)
        high = np.minimum(table_[1, :-1, 2], MAX_FALSE_ALARM)
        table_[1, :-1] *= ((1 - high) / (1 - table_[1, :-1, 2]))[:, None]
        table_[1, :-1, 2] = high
        prior = np.log(weights.sum(1) + 1)
        score = prior[:, None] + np.einsum("phv,chv->cp", onehot, np.log(table_))
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return p, table_


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams; the last one is that of repeated words."""
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(FEATURES + 1, np.float32)
    h = (a[:-2] * np.uint32(0x9E3779B1)) ^ (a[1:-1] * np.uint32(0x85EBCA6B)) ^ (a[2:] * np.uint32(0xC2B2AE35))
    counts = np.bincount((h * np.uint32(0x27D4EB2F)) >> np.uint32(21), minlength=FEATURES)
    return np.sqrt(np.append(counts / len(h), stutter(text))).astype(np.float32)


def fit_scorer(
    x: np.ndarray, p: np.ndarray, counts: np.ndarray | None = None, rounds: int = 400, l2: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes weighing the same (Adam, full batch).

    `counts`: how many documents a row stands for.
    """
    w, b = np.zeros(x.shape[1]), 0.0
    n = np.ones(len(p)) if counts is None else counts
    weight = n * p / max((n * p).sum(), 1e-9) + n * (1 - p) / max((n * (1 - p)).sum(), 1e-9)
    weight /= max(weight.sum(), 1e-9)  # sums to one
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        error = weight * (1 / (1 + np.exp(-np.clip(x @ w.astype(x.dtype) + b, -50, 50))) - p)
        g = np.append(error.astype(x.dtype) @ x + l2 * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", training_rows: int = TRAINING_ROWS, keep_all: bool = False,
) -> DataFrame:
    """id, votes, label (P(good) of the votes), score (the scorer's P(good)), good, for every row.

    With `keep_all` the input's columns stay, and earlier ones of the four names are replaced.
    A text is good with a score of 0.5 or more. Null, empty and blank texts have no votes and
    are not good. Repeated rows are scored alike.
    """
    added = ["votes", "label", "score", "good"]
    keep = [c for c in docs.columns if c not in added] if keep_all else [id_col]
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_groups(batches, "text"):
            found = [votes(t) for t in texts if t.strip()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["votes"])

    seen = read.select("text").mapInArrow(vote, "votes string").groupBy("votes").count().collect()  # one row per pattern
    patterns, counts = [r["votes"] for r in seen], np.array([r["count"] for r in seen], float)
    p, _ = fit_votes(patterns, counts) if seen else (np.zeros(0), None)
    label = dict(zip(patterns, map(float, p)))
    # rows as they come, and as many again of each pattern as of any other, while it has them
    share = dict(zip(patterns, training_rows / max(1.0, counts.sum()) + training_rows / 2 / max(1, len(patterns)) / counts))
    placed = read.withColumn("place", F.pmod(F.xxhash64("id", "text"), F.lit(2**31)) / 2**31)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches, "text"):
            found = [(votes(t), t) for t in texts]
            rows = [
                (features(t).tobytes(), v) for (v, t), at in zip(found, batch.column("place").to_pylist()) if t.strip() and at < share[v]
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["x", "votes"])

    # the limit only matters where rows repeat id and text so often that the hash can't tell them apart
    taken = placed.select("text", "place").mapInArrow(describe, "x binary, votes string").limit(2 * training_rows).toArrow()
    x = np.frombuffer(b"".join(taken.column("x").to_pylist()), np.float32).reshape(-1, FEATURES + 1)
    drawn = np.array([patterns.index(v) for v in taken.column("votes").to_pylist()], int)
    stands_for = (counts / np.maximum(1, np.bincount(drawn, minlength=len(patterns))))[drawn]
    w, b = fit_scorer(x, p[drawn], stands_for)
    good = float((counts * p).sum() / max(1.0, counts.sum())) if seen else 0.5
    usual = float(np.log(max(good, 1e-6) / max(1 - good, 1e-6)))
    text_ = fresh([*keep, *added], "text")[0]

    from pyspark.sql import types as T

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches, text_):
            found = [votes(t) for t in texts]
            known = np.array([label.get(v, 0.5) for v in found])
            made = np.array([features(t) @ w + b for t in texts])
            trust = np.array([len(t) / (len(t) + SHORT) for t in texts])
            scores = 1 / (1 + np.exp(-np.clip(usual + trust * (made - usual), -50, 50)))
            scores = np.where(np.array([not t.strip() for t in texts], bool), 0.0, scores)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(found), pa.array(known), pa.array(scores), pa.array(scores >= 0.5)],
                [*keep, *added],
            )

    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField("votes", T.StringType()), T.StructField("label", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("good", T.BooleanType())]
    )
    return docs.select(*keep, F.col(text_col).alias(text_)).mapInArrow(score, schema)


@query("op4_quality")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents; nothing of the labels table is used."""
    return classify(table(spark, folder, "documents", "doc_id", "text"))
