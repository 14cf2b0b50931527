"""Elias-Fano sequences in memory-mapped files.

A non-decreasing sequence of n numbers below u takes about 2 + log2(u / n) bits a number: the
low bits as they are, the high parts in unary, as a bit vector with a count of ones before
each 64-bit word. Access is a select of ones; search is a select of zeros, which gives the few
numbers with the same high part. All operations take arrays.
"""

from __future__ import annotations

import json

import numpy as np

_ONE = np.uint64(1)


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the rank-th set bit (from 0) in each 64-bit word."""
    at = np.zeros(len(words), np.uint64)
    rank = rank.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        w = np.uint64(width)
        ones = np.bitwise_count((words >> at) & ((_ONE << w) - _ONE)).astype(np.int64)
        beyond = rank >= ones
        rank -= ones * beyond
        at += w * beyond
    return at.astype(np.int64)


def _next_bit(words: np.ndarray, at: np.ndarray, zero: bool) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first one (or zero) from each place on, if its word has it, and the places where not."""
    w = np.minimum(at >> 6, len(words) - 1)
    word = ~words[w] if zero else words[w]
    rest = word >> (at & 63).astype(np.uint64)
    last = rest & (~rest + _ONE)  # the lowest bit alone
    found = at + np.bitwise_count(last - _ONE).astype(np.int64)
    return found, np.flatnonzero((rest == 0) | (at >> 6 >= len(words)))


def pack_low(values: np.ndarray, bits: int) -> np.ndarray:
    """The lowest bits of each value, one after the other, with room for unaligned reads."""
    parts = []
    for i in range(0, len(values), 65_536):  # a multiple of 8: parts end on bytes
        v = values[i : i + 65_536]
        parts.append(np.packbits((v[:, None] >> np.arange(bits, dtype=np.uint64)) & _ONE, bitorder="little") if bits else np.zeros(0, np.uint8))
    return np.concatenate([*[p.astype(np.uint8) for p in parts], np.zeros(8, np.uint8)])


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    values = np.asarray(values, np.uint64)
    n = len(values)
    bits = min(56, max(0, (max(1, universe) // max(1, n)).bit_length() - 1))
    high = (values >> np.uint64(bits)).astype(np.int64)
    size = n + (int(universe) >> bits) + 2
    unary = np.zeros(-(-size // 64) * 64, bool)
    unary[high + np.arange(n)] = True
    words = np.packbits(unary, bitorder="little").view("<u8")
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
    return {"low": pack_low(values, bits), "words": words, "before": before.astype("<u4" if n < 2**32 else "<u8"), "shape": np.array([n, bits], "<i8")}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.words, self.before = arrays["words"], arrays["before"]
        self.n, self.bits = map(int, arrays["shape"])
        low = arrays["low"]
        self.low = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))
        self.mask = np.uint64((1 << self.bits) - 1)
        self.zeros = np.arange(len(self.before), dtype=np.int64) * 64 - self.before.astype(np.int64)
        self.ones = self.before.astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i * self.bits
        return (self.low[at >> 3] >> (at & 7).astype(np.uint64)) & self.mask

    def _place(self, i: np.ndarray) -> np.ndarray:
        """Position of the i-th one of the unary part."""
        w = np.searchsorted(self.ones, i, "right") - 1
        return w * 64 + _select(self.words[w], i - self.ones[w])

    def _value(self, i: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((at - i).astype(np.uint64) << np.uint64(self.bits) | self._low(i)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        i = np.asarray(i, np.int64)
        return self._value(i, self._place(i))

    def access_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The i-th numbers and those after them, whose ones are next in the unary part."""
        i = np.asarray(i, np.int64)
        at = self._place(i)
        after, far = _next_bit(self.words, at + 1, False)
        after[far] = self._place(i[far] + 1)
        return self._value(i, at), self._value(i + 1, after)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero of the unary part; -1 for k = -1."""
        k0 = np.maximum(k, 0)
        w = np.minimum(np.searchsorted(self.zeros, k0, "right") - 1, len(self.words) - 1)
        at = w * 64 + _select(~self.words[w], k0 - self.zeros[w])
        return np.where(k < 0, -1, at)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of each x (below the universe), -1 if it isn't there; numbers must differ."""
        x = np.asarray(x, np.uint64)
        h, low = (x >> np.uint64(self.bits)).astype(np.int64), x & self.mask
        before = self._zero(h - 1)
        behind, far = _next_bit(self.words, before + 1, True)
        behind[far] = self._zero(h[far])
        a, b = before - (h - 1), behind - h
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        todo = np.flatnonzero(a < b)
        a, b, want = a[todo], b[todo], low[todo]  # binary search among equal high parts
        while len(todo):
            mid = (a + b) >> 1
            got = self._low(mid)
            hit, up = got == want, got < want
            out[todo[hit]] = mid[hit]
            a, b = np.where(up, mid + 1, a), np.where(up, b, mid)
            on = np.flatnonzero(~hit & (a < b))
            todo, a, b, want = todo[on], a[on], b[on], want[on]
        return out


def file_bytes(arrays: dict[str, np.ndarray], extra: dict) -> bytes:
    """Arrays behind a header that says where they are."""
    parts, at, index = [], 0, {}
    for name, a in arrays.items():
        data = np.ascontiguousarray(a).tobytes()
        index[name] = (at, a.dtype.str, len(a))
        pad = -len(data) % 8
        parts += [data, b"\0" * pad]
        at += len(data) + pad
    head = json.dumps({"index": index} | extra).encode()
    head += b" " * (-(len(head) + 8) % 8)
    return b"".join([len(head).to_bytes(8, "little"), head, *parts])


def open_arrays(data: np.ndarray) -> tuple[dict[str, np.ndarray], dict]:
    """The arrays of a mapped file (as bytes), without copying them."""
    size = int.from_bytes(data[:8].tobytes(), "little")
    head = json.loads(data[8 : 8 + size].tobytes())
    arrays = {}
    for name, (at, kind, n) in head["index"].items():
        start = 8 + size + at
        arrays[name] = data[start : start + n * np.dtype(kind).itemsize].view(kind)
    return arrays, head


def sequence(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    return EliasFano({k.removeprefix(f"{name}."): v for k, v in arrays.items() if k.startswith(f"{name}.")})


def named(name: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in arrays.items()}
