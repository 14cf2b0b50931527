"""Personal data in whole texts: fixed patterns, and a conditional random field over word shapes.

The patterns find what has a fixed form. The field, trained on the small labelled table below,
labels the words of a line by their shape and their neighbours' labels, and adds spans that the
patterns miss: card-like numbers, secrets, phone numbers without a country code and so on. A
line is decoded only if one of its words could be worth labelling: a run of labelled words
gains at most the sum of its words' best gains, so lines without a word of positive gain
have no labels whatever the rest.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import crf
from tallyloom.llm.registry import query, table
from tallyloom.llm.wordcache import text_groups

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
Span = tuple[int, int, str]

# The labelled table: [kind|text] marks personal data; # stands for any digit, ~ for any of 0-9a-f.
LABELLED = """
write to [email|anna.berg@mail#.example.org] before noon
contact: [email|j_doe##@post.example.com], or [email|x.y+z@a-b.example.net].
her address [email|kim.##@mail#.example.com]### is new
the host [ip|##.###.#.##] did not answer
server [ip|###.##.###.###]; port 8080
from [ip|1##.2##.#.#] to [ip|10.#.#.1##] in 20 ms
and [ip|2##.1##.##.##]!! again
paid with [card|4################] on 3 May
the card [card|5### #### #### ####] was lost
number [card|4###-####-####-####], expires 09/27
old [card|3###############]%%% card
of the card [card|4###############] and
call [phone|+1 (###) 555-####] now
ring [phone|+44 20 #### ####] or [phone|+49 30 #######]
phone [phone|(###) 555-####] after six
tel. [phone|###-###-####] or fax
mobile [phone|+1-###-555-####].
for [phone|+1 (###) 555-####]%%% the
key = [secret|"~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~"] was leaked
token = [secret|"~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~"]
token: [secret|~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~] expired
secret [secret|'a#b##c##d#e###f#a#b##c##d#e###f#'] here
in 19## and 20## the price rose by #.# %
version #.#.# of the tool, build ####
on 20##-##-## at ##:##:## it rained
chapter ## , page ### , line #
about # ### people and ## dogs
THE NUMBER IS ##!! AND SO ON!! OR NOT!!
a table | of | ## | values | ### | and words |
see section #.#.#.# no, see #.#
it cost $ #,### or ##.## euro
licensed under version #.# of the licence
words### and signs*** with%%% other&&& marks$$$
the quick brown fox, and the lazy dog. It was late.
Und die Frau geht nach Haus; es ist spät.
http://www.example.org/a/b?c=### is a page
@someone wrote to @other about #topic
room A-### , seat ##B , flight XY####
x = y + # ; z = f(x) - ##
year (####) , pages (##-##) , no. ###/##
"quoted" words 'single' ones (in brackets) [and] {more}
COVID-## , B2B , MP# , H#O , ISO-####
"""

_TABLE = bytes(
    ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else ord("d") if 48 <= b <= 57 else b for b in range(256)
)
_WORD = re.compile(rb"[^ \t-\r]+")
_EDGE = re.compile(r"[0-9A-Za-z+(@]")


def shape_of(word: bytes) -> bytes:
    """Letters as X or x, digits as d, all else as it is."""
    return word.translate(_TABLE)


def features(shape: bytes) -> list[str]:
    s = shape.decode()
    core = s.strip("\"'.,;:!?#$%&*|<>[]{}=~`") or s
    runs = re.sub(r"(.)\1+", r"\1+", core)
    size = lambda n: str(n) if n < 5 else "5-9" if n < 10 else "10-12" if n < 13 else "13-16" if n < 17 else "17-31" if n < 32 else "32+"
    digits, letters = core.count("d"), core.count("x") + core.count("X")
    switches = len(re.findall("d(?=[xX])|[xX](?=d)", core))
    out = ["bias", f"digits {size(digits)}", f"letters {size(letters)}", f"first {core[:1]}", f"dots {min(4, core.count('.'))}"]
    out += [f"digits {size(digits)} letters {size(letters)}", f"switches {min(4, switches // 2)}", f"dashes {min(4, core.count('-'))}"]
    if len(runs) <= 14:
        out.append(f"runs {runs}")
    if len(core) <= 12:
        out.append(f"core {core}")
    if "@" in core[1:]:
        out.append("at with dot" if "." in core.rpartition("@")[2] else "at")
    return out


def labelled_words(copies: int = 6, seed: int = 3) -> list[list[tuple[bytes, int]]]:
    """The labelled table as words with label numbers (0: none), with signs filled in."""
    rng, out = random.Random(seed), []
    for line in LABELLED.strip().split("\n") * copies:
        words: list[tuple[bytes, int]] = []
        for part in re.findall(r"\[\w+\|[^|\]]*\]\S*|\S+", line):
            m = re.match(r"\[(\w+)\|([^|\]]*)\](\S*)$", part)
            text, kind = (m[2], KINDS.index(m[1]) + 1) if m else (part, 0)
            text = re.sub("[#~]", lambda c: rng.choice("0123456789" if c[0] == "#" else "0123456789abcdef"), text)
            words += [(w.encode(), kind) for w in (text + (m[3] if m else "")).split()]
        out.append(words)
    return out


class Field:
    """The trained field, with the scores of word shapes at hand."""

    def __init__(self, rows: list[list[tuple[bytes, int]]]):
        self.index: dict[str, int] = {}
        data = []
        for words in rows:
            x = [[self.index.setdefault(f, len(self.index)) for f in features(shape_of(w))] for w, _ in words]
            data.append((x, [k for _, k in words]))
        self.weights, self.moves = crf.train(data, len(self.index), len(KINDS) + 1)
        self.prepare()

    def prepare(self) -> None:
        m = self.moves
        # what a labelled word can gain by moves: into, within and out of a run, against none to none
        self.by_move = float(max(0, (m[0, 1:].max() - m[0, 0]) + (m[1:, 0].max() - m[0, 0]), m[1:, :].max() - m[0, 0], m[0, 1:].max() - m[0, 0]))
        self.scores: dict[bytes, np.ndarray] = {}
        self.worth: dict[bytes, bool] = {}

    def __getstate__(self):
        return {"index": self.index, "weights": self.weights, "moves": self.moves}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.prepare()

    def score(self, shape: bytes) -> np.ndarray:
        found = self.scores.get(shape)
        if found is None:
            found = self.weights[[self.index[f] for f in features(shape) if f in self.index]].sum(0)
            if len(self.scores) < 100_000:
                self.scores[shape] = found
        return found

    def is_worth(self, word: bytes) -> bool:
        shape = shape_of(word)
        found = self.worth.get(shape)
        if found is None:
            s = self.score(shape)
            found = bool(s[1:].max() - s[0] + self.by_move > 0)
            if len(self.worth) < 100_000:
                self.worth[shape] = found
        return found

    def spans(self, texts: list[bytes]) -> list[list[Span]]:
        """Labelled runs of words per text, as code point spans without surrounding signs."""
        lines, where = [], []
        for i, text in enumerate(texts):
            if not any(map(self.is_worth, set(text.split()))):
                continue
            chars = 0
            for line in text.split(b"\n"):
                if any(map(self.is_worth, set(line.split()))):
                    words = list(_WORD.finditer(line))
                    lines.append(np.array([self.score(shape_of(w[0])) for w in words]))
                    where.append((i, chars, line, words))
                chars += len(line.decode()) + 1
        out: list[list[Span]] = [[] for _ in texts]
        for (i, start, line, words), labels in zip(where, crf.viterbi(lines, self.moves)):
            t = 0
            while t < len(labels):
                end = t + 1
                while end < len(labels) and labels[end] == labels[t]:
                    end += 1
                if labels[t]:
                    first, last = words[t].start(), words[end - 1].end()
                    found = line[first:last].decode()
                    inner = [m.start() for m in _EDGE.finditer(found)]
                    if inner:
                        begin = start + len(line[:first].decode())
                        out[i].append((begin + inner[0], begin + inner[-1] + 1, KINDS[labels[t] - 1]))
                t = end
        return out


@cache
def trained() -> Field:
    return Field(labelled_words())


# -- fixed patterns --------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits fails as the start of the run does; so only the latter is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, driven by the @ signs."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns that pass their checks, by start, then kind."""
    out: list[Span] = [(a, b, "email") for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if len(m[0]) <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((*m.span(), "phone"))
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def all_spans(texts: list[bytes], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and those with the field's spans that overlap none of them."""
    out = []
    for text, more in zip(texts, field.spans(texts)):
        base = base_spans(text.decode())
        extra, taken = [], sorted((a, b) for a, b, _ in base)
        ends = np.array([b for _, b in taken])
        ends = np.maximum.accumulate(ends) if len(ends) else ends
        starts = np.array([a for a, _ in taken])
        for a, b, kind in more:
            before = np.searchsorted(starts, b, "left")
            if not before or ends[before - 1] <= a:
                extra.append((a, b, kind))
        out.append((base, in_order(base + extra)))
    return out


def redacted(text: bytes, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by its first kind in brackets."""
    whole, out, at = text.decode(), [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [whole[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, whole[at:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: bool = False) -> DataFrame:
    """id, base spans, all spans (arrays of start, end, kind; code points, end exclusive) of every text.

    With `redact`, also the text with all spans replaced, and the input's other columns (earlier
    ones named base or spans are replaced). Null text is empty, and stays null when redacted.
    Rows stay one to one, repeated ones too. The field is trained on the driver in seconds.
    """
    field = trained()
    span = "array<struct<start:long,end:long,kind:string>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    keep = [c for c in docs.columns if c not in ("base", "spans", text_col)] if redact else [id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches, text_col):
            found = all_spans(texts, field)
            as_rows = lambda k: pa.array([[{"start": a, "end": b, "kind": c} for a, b, c in f[k]] for f in found], kind)
            columns = [*(batch.column(c) for c in keep), as_rows(0), as_rows(1)]
            if redact:
                null = batch.column(text_col).is_null().to_pylist()
                columns.append(pa.array([None if n else redacted(t, f[1]) for n, t, f in zip(null, texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*keep, "base", "spans", *[text_col] * redact])

    from pyspark.sql import types as T

    made = T._parse_datatype_string(f"base {span}, spans {span}" + f", `{text_col}` string" * redact)
    schema = T.StructType([docs.schema[c] for c in keep] + made.fields)
    return docs.select(*keep, text_col).mapInArrow(run, schema)


def as_text(column: str):
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


@query("op7_pii")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest of the patterns' spans, and all spans, of all documents."""
    found = find(table(spark, folder, "documents", "doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *map(count, BASE), F.sha2(as_text("base").cast("binary"), 256).alias("base_sha256"), as_text("spans").alias("spans")
    )
