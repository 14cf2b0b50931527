"""n-gram language model in an Elias-Fano trie, built and queried in Spark.

Level 1 holds the words' hashes, sorted; a word's id is its place. Level k holds, for every
(k-1)-gram, its successors: monotone pointers say where they begin, and a successor is stored
relative to its context - not as a word, but as its place among the successors of the context
without its first word - made monotone by adding the last number before the context's own.
Next to it are 8-bit codes of the discounted probability, and of each context's weight for the
shorter context. A probability is interpolated from the levels on the way:

    p(w | h) = max(count(h w) - discount, 0) / count(h) + discount * distinct(h) / count(h) * p(w | shorter h)

with (count + 1) / (all + distinct + 1) at the bottom. Levels are cut into shards by ranges of
contexts, one file each, built by one task each and mapped into memory where they are read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import elias_fano as ef
from tallyloom.llm.registry import query, table
from tallyloom.llm.shingles import mix
from tallyloom.llm.wordcache import forget, shared, text_groups
from tallyloom.session import materialise, scratch_path

ORDER = 3
DISCOUNT = 0.75
KEYS_AT_ONCE = 3_000_000
END = np.uint64(0x656E64206F662074)  # the end token, which is no word's hash
# Bytes whose words are hashed together; longer words are hashed one by one.
HASHED_AT_ONCE = 1 << 18
LONG_WORD = 64
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True


def to_code(p: np.ndarray) -> tuple[np.ndarray, float]:
    """8-bit codes of numbers of at most 1, and the lowest log10 among them.

    log10 between that and 0 is rounded to the nearest of 255 steps; 0 codes zero.
    """
    some = p[p > 0]
    lowest = min(float(np.log10(some.min())), -1e-9) if len(some) else -1.0
    with np.errstate(divide="ignore"):
        step = np.rint(np.maximum(np.log10(p), lowest) / lowest * 254)
    return np.where(p > 0, 255 - step, 0).astype(np.uint8), lowest


def of_code(lowest: float) -> np.ndarray:
    """The numbers of all codes."""
    steps = 255 - np.arange(256)
    return np.where(steps == 255, 0.0, 10 ** (steps * lowest / 254))


def _fits(contexts: int, successors: int) -> None:
    """A context and its successor share one signed 64-bit number."""
    if contexts * successors >= 1 << 63:
        raise OverflowError(f"{contexts} contexts of {successors} successors don't fit into 64 bits")


# -- files -----------------------------------------------------------------------------------


def _filesystem(uri: str):
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if not rest:
        raise ValueError(f"{uri} has no scheme: executors can't tell which store it is in")
    return fs.FileSystem.from_uri("s3:" + rest if scheme in ("s3a", "s3n") else uri)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark resolves it: on the default file system if it names none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def write_file(folder: str, data: bytes) -> str:
    """A new file of the shared folder; a second attempt of a task writes one of its own."""
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    path = f"{path}/{uuid.uuid4().hex}"
    with fs.open_output_stream(path) as out:
        out.write(data)
    return path


def map_file(folder: str, path: str) -> np.ndarray:
    """The file's bytes, mapped; from a store that can't be mapped, through a deleted local copy."""
    from pyarrow import fs

    store, _ = _filesystem(folder)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with store.open_input_stream(path) as stream, tempfile.TemporaryFile() as local:
        while part := stream.read(1 << 24):
            local.write(part)
        local.flush()
        return np.memmap(local, np.uint8, "r")


# -- trie ------------------------------------------------------------------------------------


class Trie:
    """The levels' shards as {level: [(first context, first id, path)]}, opened when first read."""

    def __init__(self, folder: str, tokens: int = 0, words: int = 0):
        self.folder, self.tokens, self.words = folder, tokens, words
        self.levels: list[tuple[np.ndarray, np.ndarray, list[str]]] = []
        self.sizes: list[int] = []
        self.open: dict[str, tuple] = {}

    def __getstate__(self):
        return self.__dict__ | {"open": {}}

    def add(self, shards: list[tuple[int, int, str]]) -> None:
        """A level from (first context or hash, size, path) of its shards."""
        shards = sorted(shards)
        first = np.array([s[0] for s in shards], np.uint64)
        ids = np.concatenate([[0], np.cumsum([s[1] for s in shards], dtype=np.int64)]).astype(np.int64)
        self.levels.append((first, ids[:-1], [s[2] for s in shards]))
        self.sizes.append(int(ids[-1]))

    def shard(self, level: int, i: int) -> dict:
        path = self.levels[level - 1][2][i]
        if path not in self.open:
            arrays, head = ef.open_arrays(map_file(self.folder, path))
            found = {"head": head, "arrays": arrays}
            for name in ("keys", "starts", "counts"):
                if f"{name}.shape" in arrays:
                    found[name] = ef.sequence(arrays, name)
            self.open[path] = found
        return self.open[path]

    def by_shard(self, level: int, contexts: np.ndarray, by_id: bool = False) -> Iterator[tuple[int, slice]]:
        """Stretches of sorted contexts (or ids) that lie in one shard."""
        first, ids, _ = self.levels[level - 1]
        cuts = np.searchsorted(contexts, ids if by_id else first)
        for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(contexts)])):
            if a < b:
                yield i, slice(a, b)

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        for i, part in self.by_shard(1, hashes):
            s = self.shard(1, i)
            inside = hashes[part] - np.uint64(s["head"]["first"])
            ok = inside <= np.uint64(s["head"]["last"])
            at = np.full(len(inside), -1, np.int64)
            at[ok] = s["keys"].find(inside[ok])
            out[part] = np.where(at >= 0, at + self.levels[0][1][i], -1)
        return out

    def counts(self, level: int, ids: np.ndarray) -> np.ndarray:
        """Counts of sorted ids."""
        out = np.zeros(len(ids), np.int64)
        for i, part in self.by_shard(level, ids, True):
            at = ids[part] - self.levels[level - 1][1][i]
            begin, end = self.shard(level, i)["counts"].access_two(at)
            out[part] = end - begin
        return out

    def children(self, level: int, contexts: np.ndarray, successors: np.ndarray, probabilities: bool = True):
        """For contexts (sorted) and successors: id or -1, alpha, context weight, first child's id."""
        ids, alpha = np.full(len(contexts), -1, np.int64), np.zeros(len(contexts))
        weight, begin = np.ones(len(contexts)), np.zeros(len(contexts), np.int64)
        for i, part in self.by_shard(level, contexts.astype(np.uint64)):
            s, base = self.shard(level, i), self.levels[level - 1][1][i]
            # what depends on the context alone is read once for each
            new = np.diff(contexts[part], prepend=-1) > 0
            local = contexts[part][new] - s["head"]["first"]
            inside = local < s["head"]["contexts"]
            local = np.where(inside, local, 0)
            a, b = s["starts"].access_two(local)
            some = inside & (a < b)
            prefix = np.where(a > 0, s["keys"].access(np.maximum(a - 1, 0)), 0)
            of = np.cumsum(new) - 1
            if probabilities:
                weight[part] = np.where(some, of_code(s["head"]["weight"])[s["arrays"]["weight"][local]], 1)[of]
            begin[part] = a[of] + base
            want = prefix[of] + successors[part] + 1
            may = np.flatnonzero(some[of] & (successors[part] >= 0) & (want <= s["head"]["last"]))
            at = s["keys"].find(want[may])
            hit = (at >= a[of[may]]) & (at < b[of[may]])
            may, at = may[hit] + part.start, at[hit]
            ids[may] = at + base
            if probabilities:
                alpha[may] = of_code(s["head"]["alpha"])[s["arrays"]["alpha"][at]]
        return ids, alpha, weight, begin

    def look_up(self, level: int, contexts: np.ndarray, successors: np.ndarray, probabilities: bool = True):
        """`children` for contexts in any order with repeats; a context of -1 has none."""
        known = np.flatnonzero(contexts >= 0)
        ids, alpha = np.full(len(contexts), -1, np.int64), np.zeros(len(contexts))
        weight, begin = np.ones(len(contexts)), np.zeros(len(contexts), np.int64)
        if len(known):
            span = int(successors.max(initial=0)) + 2
            _fits(int(contexts.max()) + 1, span)
            both, back = np.unique(contexts[known] * span + successors[known] + 1, return_inverse=True)
            for out, found in zip((ids, alpha, weight, begin), self.children(level, both // span, both % span - 1, probabilities)):
                out[known] = found[back]
        return ids, alpha, weight, begin

    def walk(self, hashes: np.ndarray, starts: np.ndarray, levels: int, probabilities: bool = True):
        """Per level k the ids of the k-grams that end at each token, -1 if unknown or cut off.

        Also the contexts and successors looked for, and what was found of probabilities.
        `starts` marks the first token of each text.
        """
        distinct, back = np.unique(hashes, return_inverse=True)
        word = self.word_ids(distinct)
        ids = word[back]
        yield 1, distinct, back, word, ids
        before = ids  # ids of the (k-1)-grams
        inside = ~starts
        relative = ids
        for level in range(2, levels + 1):
            contexts = np.where(inside, np.concatenate([[-1], before[:-1]]), -1)
            found = self.look_up(level, contexts, relative, probabilities) if level <= len(self.levels) else None
            yield level, contexts, relative, found
            if found is None:
                return
            now, _, _, begin = found
            relative = np.where(now >= 0, now - begin, -1)
            before = now
            inside = inside & np.concatenate([[False], inside[:-1]])


# -- building --------------------------------------------------------------------------------


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as a block has bytes."""

    base = 0x9E3779B97F4A7C15

    def __init__(self, n: int):
        inverse = pow(self.base, -1, 1 << 64)
        self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(n - 1, x, np.uint64))) for x in (self.base, inverse))


def word_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the words in bytes that end with white space, and where each begins.

    A word's key is a polynomial in its bytes, the difference of two running sums moved to the word's
    start, then mixed; so all words of a block are hashed at once. Of words that are longer than
    natural ones the bytes are hashed one by one.
    """
    space, keys, places, at = _SPACE[data], [], [], 0
    while at < len(data):
        end = min(at + HASHED_AT_ONCE, len(data))
        if end < len(data):  # cut behind a white space; a word longer than a block makes a block of its own
            gaps = np.flatnonzero(space[at:end])
            end = at + int(gaps[-1]) + 1 if len(gaps) else end + int(np.argmax(space[end:])) + 1
        part, gap = data[at:end], space[at:end]
        powers = shared(("powers",), lambda: _Powers(HASHED_AT_ONCE)) if end - at <= HASHED_AT_ONCE else _Powers(end - at)
        before = np.append(True, gap[:-1])
        first, last = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
        sums = np.append(np.uint64(0), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers.up[: len(part)]))
        size = (last - first).astype(np.uint64)
        key = mix((sums[last] - sums[first]) * powers.down[first] ^ size * np.uint64(0xD6E8FEB86659FD93))
        for i in np.flatnonzero(last - first > LONG_WORD).tolist():
            key[i] = xxhash.xxh64_intdigest(part[first[i] : last[i]].tobytes())
        keys.append(key)
        places.append(first + at)
        at = end
    return np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(places or [np.zeros(0, np.int64)])


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens, each text with its end token, and the marks of first tokens."""
    lowered = [t.lower() for t in texts]
    keys, places = word_keys(np.frombuffer(b"".join([t + b"\n" for t in lowered]), np.uint8))
    words = np.searchsorted(places, np.cumsum([len(t) + 1 for t in lowered]))  # up to the end of each text
    is_word = np.ones(len(keys) + len(texts), bool)
    is_word[words + np.arange(len(texts))] = False
    hashes = np.full(len(is_word), END, np.uint64)
    hashes[is_word] = keys
    return hashes, np.append(True, ~is_word[:-1])[: len(is_word)]


def _squeeze(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of equal weight, which compresses well."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def _spread(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8")[:, 0], dtype=np.uint64)


COUNTED = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _count(texts: Iterator[list[bytes]], keys_of, shard_of) -> Iterator[pa.RecordBatch]:
    """Distinct keys with counts, a row per shard, whenever KEYS_AT_ONCE keys have come together."""
    waiting: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(waiting), return_counts=True)
        waiting.clear()
        shards = shard_of(keys)
        cuts = np.flatnonzero(np.diff(shards, prepend=-1))
        rows = [(int(shards[a]), _squeeze(keys[a:b]), n[a:b].astype("<u4").tobytes()) for a, b in zip(cuts, [*cuts[1:], len(keys)])]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), COUNTED)], schema=COUNTED)

    for part in texts:
        waiting.append(keys_of(*tokens_of(part)))
        if sum(map(len, waiting)) > KEYS_AT_ONCE:
            yield flush()
    if sum(map(len, waiting)):
        yield flush()


def _merged(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([_spread(k) for k in t.column("keys").to_pylist()])
    n = np.frombuffer(b"".join(t.column("counts").to_pylist()), "<u4").astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _one_argument(f):
    """Spark tells grouped functions apart by their number of arguments."""
    return lambda t: f(t)


def build(docs: DataFrame, order: int = ORDER, discount: float = DISCOUNT, text_col: str = "text") -> Trie:
    """The model of all texts (null: empty). Its files are in the shared folder.

    A task holds one shard: a range of contexts with their distinct successors.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(text_col).alias("text"))
    folder = qualified(spark, scratch_path(spark, "model"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trie = Trie(folder)
    result = "first decimal(20,0), n long, tokens long, path string"

    def done(first: int, n: int, tokens: int, path: str) -> pa.Table:
        import decimal

        return pa.table({"first": pa.array([decimal.Decimal(first)], pa.decimal128(20, 0)), "n": [n], "tokens": [tokens], "path": [path]})

    def level_1(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = (1 << 64) // shards + 1
        return _count((t for _, t in text_groups(batches, "text")), lambda h, _: h, lambda k: (k // np.uint64(width)).astype(np.int64))

    def write_1(t: pa.Table) -> pa.Table:
        keys, n = _merged(t)
        first, last = int(keys[0]), int(keys[-1] - keys[0])
        total = np.concatenate([[0], np.cumsum(n)])
        arrays = ef.named("keys", ef.encode(keys - keys[0], last + 1)) | ef.named("counts", ef.encode(total, int(total[-1]) + 1))
        return done(first, len(keys), int(total[-1]), write_file(folder, ef.file_bytes(arrays, {"first": first, "last": last})))

    def make(level: int, counter, writer) -> int:
        counted = read.mapInArrow(counter, "shard int, keys binary, counts binary")
        rows = materialise(counted.groupBy("shard").applyInArrow(writer, result), f"level-{level}").collect()  # a row per shard
        trie.add([(int(r["first"]), r["n"], r["path"]) for r in rows])
        return sum(r["tokens"] for r in rows)

    trie.tokens = make(1, level_1, write_1)
    trie.words = trie.sizes[0]
    for level in range(2, order + 1):
        if not trie.sizes[-1]:
            break
        per = -(-trie.sizes[-1] // shards)
        span = trie.words + 1  # no context has more successors
        _fits(trie.sizes[-1] + 1, span)
        last_level = level == order

        def counter(batches: Iterator[pa.RecordBatch], level=level, per=per, span=span) -> Iterator[pa.RecordBatch]:
            def keys_of(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
                for at in trie.walk(hashes, starts, level, False):
                    if at[0] == level:
                        contexts, successors = at[1], at[2]
                ok = (contexts >= 0) & (successors >= 0)
                return (contexts[ok] * span + successors[ok]).astype(np.uint64)

            yield from _count((t for _, t in text_groups(batches, "text")), keys_of, lambda k: (k // np.uint64(span * per)).astype(np.int64))

        def writer(t: pa.Table, level=level, span=span, last_level=last_level) -> pa.Table:
            keys, n = _merged(t)
            context, successor = (keys // np.uint64(span)).astype(np.int64), (keys % np.uint64(span)).astype(np.int64)
            first = int(context[0])
            local = context - first
            contexts = int(local[-1]) + 1
            starts = np.searchsorted(local, np.arange(contexts + 1))
            seen = np.unique(context)
            of = trie.counts(level - 1, seen)
            size = np.ones(contexts)
            size[seen - first] = of
            many = np.diff(starts)
            # relative to the context: each value starts from the last one of the context before
            ends = starts[1:][many > 0] - 1
            base = np.zeros(contexts, np.int64)
            base[seen - first] = np.concatenate([[0], np.cumsum(successor[ends] + 1)[:-1]])
            value = base[local] + successor + 1
            alpha = np.maximum(n - discount, 0) / size[local]
            arrays = ef.named("keys", ef.encode(value, int(value[-1]) + 1)) | ef.named("starts", ef.encode(starts, len(keys) + 1))
            (alpha, alpha_low), (weight, weight_low) = to_code(alpha), to_code(np.minimum(discount * many / size, 1))
            arrays |= {"alpha": alpha, "weight": weight}
            if not last_level:
                total = np.concatenate([[0], np.cumsum(n)])
                arrays |= ef.named("counts", ef.encode(total, int(total[-1]) + 1))
            head = {"first": first, "contexts": contexts, "last": int(value[-1]), "alpha": alpha_low, "weight": weight_low}
            return done(first, len(keys), int(n.sum()), write_file(folder, ef.file_bytes(arrays, head)))

        make(level, counter, _one_argument(writer))
    return trie


def score(docs: DataFrame, trie: Trie, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, base_score, score (log10) of every text under the model.

    Null text is empty: one end token. Rows stay one to one. A model of no texts knows no token.
    Only the id and the text column are read.
    """
    order = len(trie.levels)
    bottom = np.log10(trie.tokens + trie.words + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_groups(batches, "text"):
            hashes, starts = tokens_of(texts)
            p = base = seen = None
            for at in trie.walk(hashes, starts, order):
                if at[0] == 1:
                    _, _, back, word, _ = at
                    known = np.flatnonzero(word >= 0)
                    c = np.zeros(len(word), np.int64)
                    c[known] = trie.counts(1, word[known])
                    base = (np.log10(c + 1) - bottom)[back]
                    seen = (c > 0)[back]
                    p = ((c + 1) / (trie.tokens + trie.words + 1))[back]
                else:
                    _, alpha, weight, _ = at[3]
                    p = alpha + weight * p
            begin = np.flatnonzero(starts)
            total = lambda x: np.add.reduceat(x, begin) if len(begin) else np.zeros(0, x.dtype)
            columns = [
                np.diff(begin, append=len(starts)), total(seen.astype(np.int64)), total(base), total(np.log10(p)),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, columns)], ["id", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


@query("op6_ngram_lm")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents under the model of those whose id's checksum isn't 2 modulo 7."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    trie = build(docs.filter(~held_out))
    out = score(docs, trie)
    return out.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(trie.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
