"""Token ids of whole texts through a cache of short chunks, shared by the tokenising operators.

A tokenizer of the `tokenizers` library that never merges across certain places gives the
same ids for a text as for its chunks one after the other. Natural text repeats its chunks,
so Arrow numbers the different chunks of some texts, each worker encodes a chunk once, and numpy
gathers the ids of the texts from those of the chunks.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Chunks of a generation (about 200 bytes each). A full one becomes the old one and is asked second; what
# is found there moves on, so that chunks in use stay.
MAX_CHUNKS = 150_000
# Longer chunks are encoded each time.
MAX_CHUNK_BYTES = 4096
# New chunks encoded together.
ENCODE_AT_ONCE = 10_000
# Bytes of text looked at together, and in a cache of chunks; numbers gathered together.
GROUP_BYTES = 4_000_000
CHUNKED_BYTES = 5_000_000
GATHERED_AT_ONCE = 1_000_000


def load_tokenizer(path: str):
    """A tokenizer that neither cuts nor fills up, one thread per task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class ChunkCache:
    """Chunk (bytes or text) -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode: Callable[[list], list[list[int]]], limit: int = MAX_CHUNKS):
        self.encode, self.limit = encode, limit
        self.new: dict[bytes | str, bytes] = {}
        self.old: dict[bytes | str, bytes] = {}

    def look_up(self, chunks: list, often: list[bool]) -> list[bytes]:
        """The ids of different chunks; those that occur often are remembered first."""
        found = list(map(self.new.get, chunks))
        missing = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            ids = found[i] = self.old.get(chunks[i])
            if ids is None:
                missing.append(i)
            else:
                self.new[chunks[i]] = ids
        for start in range(0, len(missing), ENCODE_AT_ONCE):
            part = missing[start : start + ENCODE_AT_ONCE]
            ids = self.encode([chunks[i] for i in part])
            ends = list(accumulate(map(len, ids)))
            flat = np.fromiter(chain.from_iterable(ids), "<u4", ends[-1]).tobytes()
            for i, a, b in zip(part, [0, *ends], ends):
                found[i] = flat[4 * a : 4 * b]
        for keep in (True, False):
            for i in missing:
                if often[i] == keep and len(self.new) < self.limit and len(chunks[i]) <= MAX_CHUNK_BYTES:
                    self.new[chunks[i]] = found[i]
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        return found

    def join(self, chunks: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, given as lists of chunks, one after the other, and where each text ends."""
        numbered = chunks.flatten().dictionary_encode()
        which = np.asarray(numbered.indices)
        often = (np.bincount(which, minlength=len(numbered.dictionary)) > 1).tolist()
        ids = self.look_up(numbered.dictionary.to_pylist(), often)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        out, ends = gather(np.frombuffer(b"".join(ids), "<u4"), np.cumsum(lengths) - lengths, lengths, which)
        offsets = np.asarray(chunks.offsets)
        return out, np.append(0, ends)[offsets[1:] - offsets[0]]


def gather(table: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `table` that `which` names, one after the other, and where each ends.

    Some runs at a time, so that place numbers, which take more room than the runs, stay few.
    """
    size = lengths[which]
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, table.dtype)
    first = done = 0
    while first < len(which):
        last = max(first + 1, int(np.searchsorted(ends, done + GATHERED_AT_ONCE, "right")))
        runs, n = which[first:last], size[first:last]
        stop = int(ends[last - 1])
        if last == first + 1:
            out[done:stop] = table[starts[runs[0]] : starts[runs[0]] + n[0]]
        else:
            shift = np.repeat(starts[runs] - (ends[first:last] - n - done), n)
            out[done:stop] = table[np.arange(stop - done) + shift]
        first, done = last, stop
    return out, ends


def as_strings(texts: list[bytes]) -> pa.StringArray:
    """Bytes as strings for Arrow's text functions, which need not be valid UTF-8."""
    array = pa.array(texts, pa.binary())
    return pa.StringArray.from_buffers(len(array), array.buffers()[1], array.buffers()[2])


_caches: dict[tuple, object] = {}


def shared(key: tuple, make: Callable[[], object]):
    """One object per Python worker, kept from task to task until a task of another kind comes."""
    if key not in _caches:
        _caches[key] = make()
    return _caches[key]


def forget(keep: Iterable[tuple] = ()) -> None:
    """Drop what earlier tasks of this worker shared, but for the keys in `keep`."""
    for key in set(_caches).difference(keep):
        del _caches[key]


def release() -> None:
    """Free memory goes back to the system: workers live on, and the next task may need other memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def text_groups(
    batches: Iterable[pa.RecordBatch], column: str, keep: Iterable[tuple] = (), most: int = GROUP_BYTES,
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about `most` bytes of text (one row at least); null is empty.

    The worker drops what earlier tasks shared, but for the keys in `keep`.
    """
    forget(keep)
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                part = batch.slice(start, i - start)
                yield part, texts_of(part, column)
                start, total = i, 0
            total += size
        if start < len(sizes):
            part = batch.slice(start)
            yield part, texts_of(part, column)
    release()


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
