"""Collocations: frequent phrases per language, scored at their weakest cut.

Texts are turned once into arrays of 64-bit word symbols (a word of two languages has two
symbols), with zeros between pieces. Candidates grow word by word and are Apriori-safe: a phrase
of k words is looked at only where both its parts of k - 1 words may be frequent, and is a candidate
if the phrases that share the first half of its 64-bit key occur often enough together, which
bounds its count from above. Candidates are then counted exactly: a double-array trie of them is
broadcast, numpy moves the states of all positions one word on at a time and bincounts the states
reached, and the tasks' counts are added up.

What is broadcast has a fixed size: a bit filter of 2 ** FILTER_BITS bits per level, filled by key, whose
false hits only cost time; and tries of at most about TRIE_PHRASES candidates with their prefixes. More
candidates make more tries, each with a pass of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm import double_array
from tallyloom.llm.registry import query, table
from tallyloom.llm.shingles import mix
from tallyloom.llm.wordcache import forget, release, text_groups
from tallyloom.session import materialise

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
FILTER_BITS = 25
TRIE_PHRASES = 500_000
# Symbols of a task: the more, the fewer tasks find the same phrases. Of a stored row: few, since a
# page of the file has a hundred rows at least and a batch ten thousand at most. Of a step in numpy.
TASK_SYMBOLS = 16_000_000
ROW_SYMBOLS = 256
STEP_SYMBOLS = 500_000
# Keys, and phrases or words, that a task gathers before it passes them on.
KEPT_KEYS = 2_000_000
KEPT_PHRASES = 200_000

_ENDS = b".,;:!?\n\x0b\x0c\r"
_END = b"."  # stands for all of them
_NO_WORD = (b"", _END)
_FOLD = bytes.maketrans(
    bytes(range(ord("A"), ord("Z") + 1)) + _ENDS + b"\t", bytes(range(ord("a"), ord("z") + 1)) + _END * len(_ENDS) + b" "
)
_U = np.uint64


# -- symbols ---------------------------------------------------------------------------------


def words_of(texts: list[bytes]) -> pa.DictionaryArray:
    """The words of all texts in lower case, with an end mark after every piece."""
    folded = (b"\n".join(texts) + b"\n").translate(_FOLD).replace(_END, b" . ")
    whole = pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, len(folded)], np.int32)), pa.py_buffer(folded))
    return pc.ascii_split_whitespace(whole).values.dictionary_encode()


def symbols_of(words: list[bytes], lang: str) -> np.ndarray:
    """The symbol of every word in a language; 0 for the end mark."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogateescape"))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((0 if w in _NO_WORD else digest(w, seed) or 1 for w in words), _U, len(words))


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.DictionaryArray, np.ndarray]]:
    """Words of some texts of one language, and the symbols of the different ones."""
    for batch, texts in text_groups(batches, "text"):
        langs = batch.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            words = words_of([t for t, x in zip(texts, langs) if x == lang])
            yield lang, words, symbols_of(words.dictionary.cast(pa.binary()).to_pylist(), lang)


def encode(docs: DataFrame) -> DataFrame:
    """Rows of `symbols` (little-endian unsigned 64-bit integers), and rows of lang and its words n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, known in _by_lang(batches):
            text = known[np.asarray(words.indices)]
            ends = np.flatnonzero(text == 0) + 1
            cuts = ends[np.searchsorted(ends, np.arange(ROW_SYMBOLS, len(text), ROW_SYMBOLS))]
            rows = [x.tobytes() for x in np.split(text, np.unique(cuts)) if len(x)]
            n = int(np.count_nonzero(text))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*rows, None], pa.binary()), pa.array([*[None] * len(rows), lang], pa.string()),
                    pa.array([*[None] * len(rows), n], pa.int64()),
                ],
                ["symbols", "lang", "n"],
            )

    return docs.mapInArrow(run, "symbols binary, lang string, n long")


def spell(docs: DataFrame, wanted) -> DataFrame:
    """symbol, lang and word of the words in a broadcast bit filter, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for lang, words, known in _by_lang(batches):
            new = (known != 0) & _has(wanted.value, known)
            new[new] = [x not in seen for x in known[new].tolist()]
            if len(seen) < KEPT_PHRASES:
                seen.update(known[new].tolist())
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[at].view(np.int64)), pa.array([lang] * len(at), pa.string()), words.dictionary.take(pa.array(at))],
                ["symbol", "lang", "word"],
            )

    return docs.mapInArrow(run, "symbol long, lang string, word string").dropDuplicates(["symbol"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The stored arrays, some rows of a batch at a time, without a copy."""
    forget()
    for batch in batches:
        column = batch.column("symbols")
        kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1] // 8
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + STEP_SYMBOLS, "right")) - 1)
            if n := int(ends[last] - ends[first]):
                yield np.frombuffer(data, _U, n, 8 * int(ends[first]))
            first = last
    release()


# -- candidates ------------------------------------------------------------------------------


def bit_filter(keys: DataFrame, key: str, width: int = 64) -> np.ndarray:
    """Bits of the leading FILTER_BITS bits of keys of `width` bits: a fixed number of rows of 4 KB comes to the driver."""
    at = F.shiftrightunsigned(key, width - FILTER_BITS) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in parts.collect():
        out[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys >> _U(64 - FILTER_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def grams(text: np.ndarray, filters: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of words, positions and keys of all phrases whose two shorter parts pass the filters.

    Lengths run from 1 to one more than there are filters; the key of a word is its symbol.
    """
    at = np.flatnonzero(text)
    keys = text[at]
    yield 1, at, keys
    for words, bits in enumerate(filters, 2):
        good = _has(bits, keys)
        at, keys = at[good], keys[good]
        both = np.flatnonzero(at[1:] == at[:-1] + 1)
        at, keys = at[both], longer_key(keys[both], text[at[both] + words - 1])
        yield words, at, keys


def longer_key(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Key of a phrase from that of all its words but the last, and the last."""
    return mix(key * _U(0x9E3779B97F4A7C15) + symbol)


def half_key_counts(encoded: DataFrame, filters: list) -> DataFrame:
    """half, n: how often keys with this first half occur among phrases one word longer than the filters reach.

    A half may come from several tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [b.value for b in filters]
        halves, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for text in _texts(batches):
            *_, (_, _, keys) = grams(text, bits)
            found, m = np.unique((keys >> _U(32)).astype(np.uint32), return_counts=True)
            halves, n = _merged(halves, n, found, m)
            if len(halves) > KEPT_KEYS:
                yield from _batches(["half", "n"], halves.view(np.int32), n)
                halves, n = halves[:0].copy(), n[:0].copy()
        yield from _batches(["half", "n"], halves.view(np.int32), n)

    return encoded.mapInArrow(run, "half int, n long")


def _merged(keys: np.ndarray, n: np.ndarray, more: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([keys, more]), np.concatenate([n, m])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


def _batches(names: list[str], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(columns[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[start : start + 100_000]) for c in columns], names)


def paths(encoded: DataFrame, filters: list, least: int) -> DataFrame:
    """key and path (symbols), once, of the phrases of two words and more that pass all filters.

    A task only passes on what it has `least` times itself, and everything once it has too much to
    remember. With `least` no more than min_count / tasks every frequent phrase comes from some task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, enough = [b.value for b in filters], least
        seen = {w: (np.zeros(0, _U), np.zeros(0, np.int64), np.zeros((0, w), _U)) for w in range(2, len(bits) + 1)}
        for text in _texts(batches):
            for words, at, keys in grams(text, bits[:-1]):
                if words == 1:
                    continue
                good = _has(bits[words - 1], keys)
                old, n, path = seen[words]
                keys = np.concatenate([old, keys[good]])
                keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
                new = first >= len(old)
                places = at[good][first[new] - len(old)]
                rows = np.empty((len(keys), words), _U)
                rows[~new] = path[first[~new]]
                rows[new] = text[places[:, None] + np.arange(words)]
                counts = np.bincount(back, minlength=len(keys))
                counts[back[: len(old)]] += n - 1  # an old key is itself among those counted
                seen[words] = keys, counts, rows
            if sum(len(k) for k, _, _ in seen.values()) > KEPT_PHRASES:
                enough = 1
                yield from _path_batches(seen, enough)
                seen = {w: (k[:0].copy(), n[:0].copy(), p[:0].copy()) for w, (k, n, p) in seen.items()}
        yield from _path_batches(seen, enough)

    return encoded.mapInArrow(run, "key long, path array<long>").dropDuplicates(["key"])


def _path_batches(seen: dict, least: int) -> Iterator[pa.RecordBatch]:
    for words, (keys, n, path) in seen.items():
        keys, path = keys[n >= least], path[n >= least]
        for start in range(0, len(keys), 50_000):
            part, rows = keys[start : start + 50_000], path[start : start + 50_000]
            offsets = pa.array(np.arange(len(part) + 1) * words, pa.int32())
            column = pa.ListArray.from_arrays(offsets, pa.array(rows.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), column], ["key", "path"])


# -- counting --------------------------------------------------------------------------------


def _trie_of(part: pa.Table) -> double_array.Trie:
    lengths = np.asarray(part["path"].combine_chunks().value_lengths())
    flat = np.asarray(part["path"].combine_chunks().flatten()).view(_U)
    start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    keys = np.asarray(part["key"])
    rows = [np.flatnonzero(lengths == k) for k in np.unique(lengths)]
    return double_array.build([flat[start[r][:, None] + np.arange(lengths[r[0]])] for r in rows], [keys[r] for r in rows])


def build_tries(candidates: DataFrame, phrases_each: int) -> DataFrame:
    """Tries of equal shares of the candidates, built in tasks: shard and the arrays."""

    def run(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        t = _trie_of(part)
        arrays = [x.tobytes() for x in (t.symbols, t.base, t.check, t.key)]
        return pa.table({"shard": [key[0].as_py()], **{n: [x] for n, x in zip(_ARRAYS, arrays)}, "depth": [t.depth]})

    shards = max(1, -(-candidates.count() // phrases_each))
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("long"))
    return dealt.groupBy("shard").applyInArrow(run, f"shard long, {', '.join(f'{n} binary' for n in _ARRAYS)}, depth long")


_ARRAYS = ("symbols", "base", "check", "key")


def count_in(encoded: DataFrame, trie) -> DataFrame:
    """key, n: the tasks' exact counts of a broadcast trie's phrases, and of their words by symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = trie.value
        counts = np.zeros(len(t.check), np.int64)
        for text in _texts(batches):
            t.add_counts(text, counts)
        found = np.flatnonzero((counts > 0) & (t.key != 0))
        yield from _batches(["key", "n"], t.key[found], counts[found])

    return encoded.mapInArrow(run, "key long, n long")


def phrase_counts(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, phrases_each: int = TRIE_PHRASES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, words, path, a) of all phrases of 2 to `max_words` words that occur `min_count` times,
    (path, a) of the same words and phrases, and (lang, n), all words of a language.

    `docs`: text, lang. Counts are exact but for clashes of 64-bit hashes.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    stored = materialise(encode(docs), "symbols")
    totals = stored.filter("symbols IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    size = totals.agg(F.sum("n")).collect()[0][0] or 0
    tasks = max(sc.defaultParallelism, -(-size // TASK_SYMBOLS))
    encoded = stored.filter("symbols IS NOT NULL").select("symbols").coalesce(tasks)

    filters, levels = [], []
    for _ in range(max_words):
        # a task has a half once, so there is nothing to add up before the exchange
        halves = half_key_counts(encoded, filters).repartition("half").groupBy("half").agg(F.sum("n").alias("n"))
        levels.append(materialise(halves.filter(F.col("n") >= min_count).select("half"), "halves"))
        filters.append(sc.broadcast(bit_filter(levels[-1], "half", 32)))
        if levels[-1].isEmpty():
            break
    halves = levels[0].limit(0)
    for level in levels[1:]:
        halves = halves.union(level)
    # halves of all lengths in one table: a key that only matches one of another length is counted for nothing
    found = paths(encoded, filters, -(-min_count // tasks)).withColumn("half", F.shiftright("key", 32).cast("int"))
    candidates = materialise(found.join(halves.distinct(), "half", "left_semi").drop("half"), "candidates")
    tries = materialise(build_tries(candidates, phrases_each), "tries")
    counted = candidates.select("key", F.lit(0).cast("long").alias("n")).limit(0)
    for r in tries.select("shard").toLocalIterator():
        row = tries.filter(F.col("shard") == r["shard"]).collect()[0]
        kinds = (_U, np.int32, np.int32, np.int64)
        arrays = [np.frombuffer(row[n], k) for n, k in zip(_ARRAYS, kinds)]
        trie = sc.broadcast(double_array.Trie(*arrays, row["depth"]))
        part = count_in(encoded, trie).groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
        counted = counted.union(materialise(part, "counts"))
        trie.unpersist()
    # words are in several tries, with the same count
    counted = counted.groupBy("key").agg(F.max("n").alias("a"))
    kept = materialise(candidates.join(counted, "key").select("path", "a"), "frequent")

    used = kept.select(F.explode("path").alias("key")).distinct()
    words = used.join(counted, "key").select(F.array("key").alias("path"), "a")
    spelling = sc.broadcast(bit_filter(used, "key"))
    spelled = materialise(spell(docs, spelling), "spelling")
    for f in [*filters, spelling]:
        f.unpersist()
    phrases = (
        kept.select("path", "a", F.posexplode("path").alias("i", "symbol"))
        .join(spelled, "symbol")
        .groupBy("path", "a")
        .agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
        .select("lang", F.col("w.word").alias("words"), "path", "a")
    )
    return materialise(phrases, "phrases"), words.union(kept), totals


# -- scores ----------------------------------------------------------------------------------


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, covered_percent: int = 100,
    phrases_each: int = TRIE_PHRASES, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Null text is empty, a null language is `und`. Repeated rows count as often as they occur, whole
    texts of any length are read, other columns play no role. Languages without a candidate have no
    row, nor has an empty table. Rank orders by score, a (both falling) and the phrase's
    bytes; phrases of a language differ, so there are no ties.
    """
    if max_words < 2 or min_count < 1:
        raise ValueError("phrases have two words or more and occur once or more")
    rows = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    phrases, known, totals = phrase_counts(rows, min_count, max_words, phrases_each)

    # A phrase inside a longer one is inside one that is a word longer, which is as frequent at least.
    inner = F.array(F.expr("slice(path, 1, size(path) - 1)"), F.expr("slice(path, 2, size(path) - 1)"))
    longer = phrases.filter(F.size("path") > 2).select(F.col("a").alias("more"), F.explode(inner).alias("path"))
    covers = longer.groupBy("path").agg(F.max("more").alias("more"))
    kept = phrases.join(covers, "path", "left").filter(
        F.col("more").isNull() | (100 * F.col("more") < covered_percent * F.col("a"))
    )

    cuts = kept.select("lang", "words", "path", "a", F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("slice(path, 1, k)"), "tail": F.expr("slice(path, k + 1, size(path) - k)")})
    heads = known.select(F.col("path").alias("head"), F.col("a").alias("l"))
    tails = known.select(F.col("path").alias("tail"), F.col("a").alias("r"))
    big = "decimal(17, 0)"  # products of two and three keep all digits; the quotient is at most 1000 * n
    score = F.expr(f"(1000BD * cast(a AS {big}) * cast(n AS {big})) div (cast(l AS {big}) * cast(r AS {big}))")
    scored = cuts.join(heads, "head").join(tails, "tail").join(totals, "lang").withColumn("score", score)
    weakest = scored.groupBy("lang", "words").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        weakest.select(
            "lang", F.array_join("words", " ").alias("phrase"), *[F.col("cut")[c].alias(c) for c in ("a", "l", "r", "n", "score")]
        )
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
parts AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
    FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY 1, 2, 3
),
totals AS (SELECT lang, sum(a)::HUGEINT AS n FROM parts WHERE k = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM parts WHERE a >= 100),
covered AS (
    SELECT DISTINCT lang, phrase FROM (
        SELECT lang, a, unnest([array_to_string(w[s:s + m - 1], ' ') FOR s IN range(1, k - m + 2)]) AS phrase, m
        FROM frequent, (SELECT unnest(range(2, 5)) AS m) WHERE m < k
    ) x JOIN frequent f USING (lang, phrase) WHERE 100 * x.a >= 100 * f.a
),
cuts AS (
    SELECT c.lang, c.phrase, c.a, cut, f.a AS l, g.a AS r, n, (1000::HUGEINT * c.a * n) // (f.a::HUGEINT * g.a) AS score
    FROM (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM frequent ANTI JOIN covered USING (lang, phrase) WHERE k > 1) c
    JOIN frequent f ON f.lang = c.lang AND f.phrase = array_to_string(c.w[1:cut], ' ')
    JOIN frequent g ON g.lang = c.lang AND g.phrase = array_to_string(c.w[cut + 1:c.k], ' ')
    JOIN totals t ON t.lang = c.lang
),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM cuts),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM weakest WHERE nth = 1
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


@query("op12_phrases", ORACLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 phrases of every language."""
    return collocations(table(spark, folder, "documents", "text", "lang"))
