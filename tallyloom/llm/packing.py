"""Best-fit packing of documents into sequences, with Martello-Toth dominance reduction.

How full a sequence can get depends on lengths only, so the plan is made on the histogram of
lengths: `capacity` numbers at most, whatever the corpus. The plan says which ranks of a
length go to which sequences; ranks are given out by Spark, and every row looks its place up.

The reduction fixes sets that provably dominate all others with the same document, and so
never cost a sequence: a document that nothing can join; two documents that fill a sequence
exactly; a document and the longest partner where only one more fits, or where two more fit
but no two together exceed that partner. The rest goes best-fit, longest first.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.registry import fresh, query, table
from tallyloom.llm.wordcache import CHUNKED_BYTES, ChunkCache, as_strings, load_tokenizer, shared, text_groups
from tallyloom.session import materialise

CAPACITY = 4096
END_ID = 1
# Words of letters that are encoded as one text.
JOINED = 128
# A mark between a letter and white space.
MARKS = ".,;:!?"
LOOSE = r"(\pL)([.,;:!?])([\t-\r ])"


# -- plan ------------------------------------------------------------------------------------


def reduce_dominated(count: np.ndarray, capacity: int) -> list[tuple[int, tuple]]:
    """Take dominating sets out of `count` (by length, changed in place).

    Returns (sequences, ((length, how many in each), ...)) per kind of fixed set.
    """
    fixed = []

    def fix(n: int, *parts: tuple[int, int]) -> None:
        for length, each in parts:
            count[length] -= n * each
        fixed.append((n, parts))

    if count[capacity]:
        fix(int(count[capacity]), (capacity, 1))
    for big in range(capacity - 1, (capacity - 1) // 2, -1):
        small = capacity - big
        if small == big and count[big] > 1:
            fix(int(count[big]) // 2, (big, 2))
        elif small != big and (n := int(min(count[big], count[small]))):
            fix(n, (big, 1), (small, 1))

    again = True
    while again:
        again = False
        for big in map(int, np.flatnonzero(count)[::-1]):
            while count[big]:
                count[big] -= 1
                rest = np.flatnonzero(count)
                few = np.repeat(rest[:3], np.minimum(count[rest[:3]], 3))[:3]
                partner = int(rest[np.searchsorted(rest, capacity - big, "right") - 1]) if len(rest) else 0
                count[big] += 1
                room = capacity - big
                if not len(few) or few[0] > room:
                    fix(int(count[big]) if big + big > capacity else 1, (big, 1))
                # Of equal documents all go at once: each that leaves takes partners away from the next,
                # so what can't be joined better stays so, and the longest partner stays while it lasts.
                elif len(few) < 2 or few[:2].sum() > room or (
                    (len(few) < 3 or few.sum() > room) and _best_pair(count, big, room) <= partner
                ):
                    if partner == big:
                        fix(int(count[big]) // 2, (big, 2))
                    else:
                        fix(int(min(count[big], count[partner])), (big, 1), (partner, 1))
                else:
                    break
                again = True
    return fixed


def _best_pair(count: np.ndarray, big: int, room: int) -> int:
    """The largest sum of two other documents that fits into `room`, 0 if none does."""
    count[big] -= 1
    have = np.flatnonzero(count[: room + 1])
    best = 0
    for a in map(int, have):
        b = have[have <= room - a]
        if a > room - a:
            break
        if len(b) and int(b[-1]) == a and count[a] < 2:
            b = b[:-1]
        if len(b):
            best = max(best, a + int(b[-1]))
    count[big] += 1
    return best


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[int, tuple]]:
    """Best-fit decreasing on the histogram: sequences with equal content are one group.

    A document goes where the least room is left; with equal documents the same sequence
    stays the best until it is full, so a group takes them all at once.
    """
    groups: dict[int, list[tuple[int, tuple]]] = {}
    open_at = np.zeros(capacity + 1, bool)

    def put(room: int, n: int, parts: tuple) -> None:
        groups.setdefault(room, []).append((n, parts))
        open_at[room] = True

    for size in map(int, np.flatnonzero(count)[::-1]):
        left = int(count[size])
        while left:
            found = np.flatnonzero(open_at[size:])
            if len(found):
                room = size + int(found[0])
                n, parts = groups[room].pop()
                open_at[room] = bool(groups[room])
            else:
                room, n, parts = capacity, -(-left // (capacity // size)), ()
            each = room // size
            full = min(n, left // each)
            if full:
                put(room - full_size(each, size), full, (*parts, (size, each)))
            left -= full * each
            n -= full
            if n and left:
                put(room - full_size(left, size), 1, (*parts, (size, left)))
                left, n = 0, n - 1
            if n and parts:
                put(room, n, parts)
    return [g for room in sorted(groups) for g in groups[room]]


def full_size(each: int, size: int) -> int:
    return each * size


def make_plan(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Runs of ranks: for each length from which rank on, to which sequences, at which place."""
    count = np.zeros(capacity + 1, np.int64)
    np.add.at(count, lengths, counts)
    kinds = reduce_dominated(count, capacity) + best_fit(count, capacity)
    used = np.zeros(capacity + 1, np.int64)
    rows, base = [], 0
    for n, parts in kinds:
        place = 0
        for length, each in parts:
            rows.append((length, used[length], base, n, place))
            used[length] += n * each
            place += length * each
        base += n
    rows = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "base", "n", "place"), rows.T)) | {"sequences": np.int64(base)}


def place(plan: dict[str, np.ndarray], lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the rank-th document of each length."""
    key = plan["length"] << 44 | plan["rank"]
    i = np.searchsorted(key, lengths << 44 | ranks, "right") - 1
    k = ranks - plan["rank"][i]
    return plan["base"][i] + k % plan["n"][i], plan["place"][i] + k // plan["n"][i] * lengths


# -- Spark -----------------------------------------------------------------------------------


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Documents as pieces of at most `capacity` tokens: id, piece, start, length, ids.

    `ids` are little-endian unsigned 32-bit integers. Null text is empty; without an end id an
    empty text has no piece. Other columns are left out, whatever their names; repeated ids
    stay separate rows. The tokenizer must drop white space and not merge across it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("words", tokenizer)
        encoder, cache = shared(key, lambda: _cached(tokenizer))
        end = np.array([] if end_id is None else [end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch, texts in text_groups(batches, "text", [key], CHUNKED_BYTES):
            owner, piece, ids = [], [], []
            words = as_strings([fold(t) for t in texts])
            if encoder.loose_marks:
                words = pc.replace_substring_regex(words, LOOSE, r"\1 \2\3")
            # a text that begins or ends with white space has an empty word there, which has no ids
            all_ids, ends = cache.join(pc.ascii_split_whitespace(words))
            for i, (a, b) in enumerate(zip(np.append(0, ends), ends)):
                whole = all_ids[a:b].tobytes() + end
                for k in range(0, len(whole), step):
                    owner.append(i)
                    piece.append(k // step)
                    ids.append(whole[k : k + step])
            piece = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(owner, pa.int64())), pa.array(piece),
                    pa.array(piece.astype(np.int64) * capacity),
                    pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                ],
                ["id", "piece", "start", "length", "ids"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("id", id_col)


def fold(text: bytes) -> bytes:
    """ASCII lower case, where the tokenizer's own lower-casing can't tell the difference.

    Marks of the block that \\xcc leads may compose with a letter in one case only, and
    control strings are matched before lower-casing; such texts are left as they are.
    """
    return text if b"\xcc" in text or b"<|" in text else text.lower()


def _cached(path: str) -> tuple[WordEncoder, ChunkCache]:
    encoder = WordEncoder(path)
    return encoder, ChunkCache(encoder.encode)


class WordEncoder:
    """Ids of words, many words of letters in one text where the ids tell where each word ends."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self.joins = bool(suffix)
        # Whether a mark after a letter is a piece of its own, and so may be cut off before it is looked up.
        alike = [self.ids([f"{w}{m}", f"{w} {m}"]) for w in ("ab", "é", "there") for m in MARKS]
        self.loose_marks = all(a == b for a, b in alike)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """A word of letters only has one piece, which ends with the one id that has the vocabulary's
        suffix. Letters that fall apart when they are normalised give more ends than words; the
        words of such a text are encoded one by one, like chunks of other signs."""
        out: list = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if self.joins and c.isalpha()]
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        for group, ids in zip(groups, self.ids([" ".join([chunks[i] for i in g]) for g in groups])):
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            if len(ends) == len(group) and ends[-1] == len(ids):
                for i, a, b in zip(group, [0, *ends], ends):
                    out[i] = ids[a:b]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.ids([chunks[i] for i in rest])):
            out[i] = ids
        return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """Add `sequence_id` and `offset` to rows with a length, in as few sequences as the plan finds.

    All columns stay; earlier columns of the two names are replaced. Sequence ids run from 0,
    offsets are gapless from 0. Rows without a positive length take no room and get nulls, a row
    longer than `capacity` gets a sequence of its own. Rows of one length may be dealt in any
    order. An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    size_, row_, salt_, n_, nth_, first_, rank_ = fresh(keep, "size", "row", "salt", "n", "nth", "first", "rank")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = F.least(F.col(length_col), F.lit(capacity)).cast("long")
    rows = materialise(
        pieces.select(
            *keep, F.when(F.col(length_col) > 0, size).alias(size_),
            F.monotonically_increasing_id().alias(row_),
        ),
        "pieces",
    ).withColumn(salt_, F.pmod(F.xxhash64(row_), F.lit(salts)))
    # No length is ranked in one task: ranks count up within (length, salt) first.
    counts = rows.filter(F.col(size_).isNotNull()).groupBy(size_, salt_).agg(F.count("*").alias(n_))
    histogram = counts.groupBy(size_).agg(F.sum(n_).alias(n_)).collect()  # capacity rows at most
    plan = make_plan(
        np.array([r[size_] for r in histogram], np.int64), np.array([r[n_] for r in histogram], np.int64), capacity
    )
    before = Window.partitionBy(size_).orderBy(salt_).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn(first_, F.coalesce(F.sum(n_).over(before), F.lit(0))).drop(n_)
    within = Window.partitionBy(size_, salt_).orderBy(row_)
    ranked = (
        rows.withColumn(nth_, F.row_number().over(within) - 1)
        .join(first, [size_, salt_], "left")
        .withColumn(rank_, (F.col(nth_) + F.col(first_)).cast("long"))
        .select(*keep, size_, rank_)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = batch.column(size_), batch.column(rank_)
            none = np.asarray(sizes.is_null())
            if len(plan["rank"]):
                at = place(plan, np.asarray(sizes.fill_null(1)), np.where(none, 0, np.asarray(ranks.fill_null(0))))
            else:
                at = (np.zeros(len(none), np.int64),) * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(x, pa.int64(), mask=none) for x in at],
                [*keep, "sequence_id", "offset"],
            )

    from pyspark.sql import types as T

    schema = T.StructType(
        [ranked.schema[c] for c in keep] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.mapInArrow(run, schema)


@query("op10_best_fit_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 4096 tokens; the digest of ids is taken before packing."""
    import public_tokenizers

    pieces = token_pieces(table(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
