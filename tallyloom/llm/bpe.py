"""Byte-level BPE encoding and decoding of whole texts.

Text splits where no merge can cross: before a space that ends a run of other characters.
Such chunks are short and are encoded once per worker. What does not split (a long run of
letters or signs) is encoded as a tree: halves are encoded down to leaves, all leaves in one
parallel batch, and joined upwards. At a join a window of tokens around it is re-encoded; it
grows until its first token is the left side's and its last token the right side's. A token
sequence is the encoding of its text exactly when every two neighbours are, so agreement of
one token on either side settles the whole join.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.wordcache import CHUNKED_BYTES, ChunkCache, as_strings, gather, load_tokenizer, shared, text_groups

LEAF = 1024
WINDOW = 4
THREADS = 4

# A space next to other white space: such texts are cut at the start of each whole run.
_RUNS = tuple(b" " + c for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
_CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
# White space outside ASCII, in UTF-8: such texts are left to the tokenizer's own splitting.
_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_WIDE_PUNCTUATION = re.compile(rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]")
# Marks a chunk that stands as it is; any other chunk follows a space.
_AS_IS = b"\xff"


def split(text: bytes) -> list[bytes]:
    """Chunks whose encodings, one after the other, are the text's."""
    if not text:
        return []
    if any(w in text for w in _WIDE) or (b"\xe2\x80" in text and _WIDE_PUNCTUATION.search(text)):
        return [_AS_IS + text]
    if any(r in text for r in _RUNS):
        return [_AS_IS + c for c in _CHUNK.findall(text)]
    return (_AS_IS + text).split(b" ")


def split_all(texts: list[bytes]) -> pa.ListArray:
    """The chunks of every text."""
    plain = [
        not (any(w in t for w in _WIDE) or (b"\xe2\x80" in t and _WIDE_PUNCTUATION.search(t)) or any(r in t for r in _RUNS))
        for t in texts
    ]
    if all(plain):  # an empty text has one empty chunk here, which has no ids
        return pc.split_pattern(as_strings([_AS_IS + t for t in texts]), " ").cast(pa.list_(pa.binary()))
    return pa.array([(_AS_IS + t).split(b" ") if p else split(t) for t, p in zip(texts, plain)], pa.list_(pa.binary()))


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class ByteBPE:
    """The library's tokenizer, with tree concatenation for what it can't split."""

    def __init__(self, path: str, leaf: int = LEAF):
        self.tokenizer, self.leaf = load_tokenizer(path), leaf
        self.path = path
        back = {c: b for b, c in byte_letters().items()}
        self.names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        of_id = {i: bytes(back[c] for c in t) for i, t in self.names.items()}
        self.added = {}
        for i, t in self.tokenizer.get_added_tokens_decoder().items():
            self.added[t.content] = i
            of_id[i] = t.content.encode()
        each = [of_id.get(i, b"") for i in range(max(of_id) + 1)]
        self.bytes = np.frombuffer(b"".join(each), np.uint8)
        self.lengths = np.fromiter(map(len, each), np.int64, len(each))
        self.starts = np.cumsum(self.lengths) - self.lengths
        words = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.controls = re.compile("(" + "|".join(words) + ")") if words else None

    @cached_property
    def merger(self):
        """The same merges without any splitting; only long runs need it."""
        from tokenizers import Tokenizer

        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        spec |= {"pre_tokenizer": None, "added_tokens": [], "decoder": None, "normalizer": None, "post_processor": None}
        return Tokenizer.from_str(json.dumps(spec))

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        texts = [(c[1:] if c[:1] == _AS_IS else b" " + c).decode() for c in chunks]
        short = [t for t in texts if len(t) <= self.leaf]
        ids = iter(self.tokenizer.encode_batch_fast(short, add_special_tokens=False))
        return [next(ids).ids if len(t) <= self.leaf else self.encode_long(t) for t in texts]

    def encode_long(self, text: str) -> list[int]:
        """As the library does it: control strings first, then its split, then the merges."""
        out: list[int] = []
        for part in self.controls.split(text) if self.controls else [text]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    out += self.tree(word)
        return out

    def tree(self, word: str) -> list[int]:
        """Encode a word given in byte letters: leaves in parallel, then joins, level by level.

        The library lets go of the interpreter while it encodes, so parts of a level run at once
        in a few threads; only words of very many leaves are worth them.
        """
        n = 1
        while len(word) > n * self.leaf:
            n *= 2
        cuts = [len(word) * i // n for i in range(n + 1)]
        leaves = [word[a:b] for a, b in zip(cuts, cuts[1:])]
        if n < 4 * THREADS:
            level = self._leaves(leaves)
            while len(level) > 1:
                level = list(map(self.join, level[::2], level[1::2]))
            return level[0]
        with ThreadPoolExecutor(THREADS) as pool:
            parts = pool.map(self._leaves, [leaves[i : i + n // THREADS] for i in range(0, n, n // THREADS)])
            level = [ids for part in parts for ids in part]
            while len(level) > 1:
                level = list(pool.map(self.join, level[::2], level[1::2]))
        return level[0]

    def _leaves(self, leaves: list[str]) -> list[list[int]]:
        return [e.ids for e in self.merger.encode_batch_fast(leaves, add_special_tokens=False)]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        w = WINDOW
        while True:
            i, j = max(0, len(left) - w), min(len(right), w)
            window = "".join(self.names[t] for t in left[i:] + right[:j])
            mid = self.merger.encode(window, add_special_tokens=False).ids
            if (i == 0 or mid[0] == left[i]) and (j == len(right) or mid[-1] == right[j - 1]):
                return left[:i] + mid + right[j:]
            w *= 2

    def decode(self, ids: bytes) -> str:
        return self.decode_all(np.frombuffer(ids, "<u4"), np.array([len(ids) // 4]))[0]

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids that stand one after the other, one gather from the tokens' bytes for all."""
        out, upto = gather(self.bytes, self.starts, self.lengths, ids)
        whole, upto = out.tobytes(), np.append(0, upto)
        return [whole[a:b].decode("utf-8", "replace") for a, b in zip(upto[np.append(0, ends)].tolist(), upto[ends].tolist())]


def encode(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False,
) -> DataFrame:
    """Id, n_tokens and ids (little-endian unsigned 32-bit integers) of every whole text.

    With `decoded`, the text that the ids decode to as well, without a second pass. Null text
    is empty and has no tokens. Rows stay one to one, repeated ids too; other columns
    are left out, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared(("codec", tokenizer), lambda: ByteBPE(tokenizer))
        cache = shared(("bytes", tokenizer), lambda: ChunkCache(codec.encode_chunks))
        for batch, texts in text_groups(batches, "text", [("codec", tokenizer), ("bytes", tokenizer)], CHUNKED_BYTES):
            ids, ends = cache.join(split_all(texts))
            starts = np.append(0, ends[:-1])
            each = [ids[a:b].tobytes() for a, b in zip(starts, ends)]
            columns = [batch.column("id"), pa.array(ends - starts, pa.int64()), pa.array(each, pa.binary())]
            if decoded:
                columns.append(pa.array(codec.decode_all(ids, ends), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", "n_tokens", "ids", "decoded"][: 4 if decoded else 3]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary" + ", decoded string" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the text of the ids; null ids give null. An earlier column of the name is replaced."""
    keep = [c for c in encoded.columns if c != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared(("codec", tokenizer), lambda: ByteBPE(tokenizer))
        for batch in batches:
            texts = [None if x is None else codec.decode(x) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, out_col])

    from pyspark.sql import types as T

    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField(out_col, T.StringType())])
    return encoded.select(*keep).mapInArrow(run, schema)


@query("op5_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of the ids of every document and of the text they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    out = encode(table(spark, folder, "documents", "doc_id", "text"), path, decoded=True)
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
