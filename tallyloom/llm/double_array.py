"""Double-array trie over 64-bit symbols, built from paths and walked by numpy.

A state s goes to base[s] + code(symbol) if check there says s. State 0 is the root, states
1 to the number of symbols are its children.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

_NONE = -(2**30)  # base of a state without children: leads nowhere
_LOOK = 4096  # places looked at together


@dataclass(frozen=True)
class Trie:
    symbols: np.ndarray  # uint64, sorted; code = index + 1
    base: np.ndarray  # int32
    check: np.ndarray  # int32
    key: np.ndarray  # int64, of the path that ends in a state, 0 if none does; of a single symbol itself
    depth: int

    def add_counts(self, text: np.ndarray, counts: np.ndarray) -> None:
        """Add how often each state is reached from any position of the text.

        All positions step at once: level d has the states of all paths of d symbols.
        """
        code = np.searchsorted(self.symbols, text)
        code[code == len(self.symbols)] = 0
        code = np.where(self.symbols[code] == text, code + 1, 0)
        code = np.append(code, 0)
        at = np.flatnonzero(code)
        state = code[at]
        counts += np.bincount(state, minlength=len(counts))
        for _ in range(self.depth - 1):
            at = at + 1
            step = code[at]
            to = self.base[state] + step
            good = (step > 0) & (to >= 0) & (to < len(self.check))
            at, state, to = at[good], state[good], to[good]
            good = self.check[to] == state
            at, state = at[good], to[good]
            counts += np.bincount(state, minlength=len(counts))


def build(paths: Sequence[np.ndarray], keys: Sequence[np.ndarray]) -> Trie:
    """Trie of all paths: one matrix per path length (rows are paths), with their keys (not 0)."""
    symbols = np.unique(np.concatenate([p.ravel() for p in paths]))
    depth = max(p.shape[1] for p in paths)
    places = _Places(len(symbols) + 1)
    base, check = [np.full(len(symbols) + 1, _NONE, np.int64)], [np.zeros(len(symbols) + 1, np.int64)]
    codes = [np.searchsorted(symbols, p) + 1 for p in paths]
    states = [c[:, 0].astype(np.int64) for c in codes]
    bases, parents, ends = {}, {}, {}
    for d in range(2, depth + 1):
        live = [i for i, c in enumerate(codes) if c.shape[1] >= d]
        pairs = np.unique(np.concatenate([states[i] * (len(symbols) + 1) + codes[i][:, d - 1] for i in live]))
        parent, code = np.divmod(pairs, len(symbols) + 1)
        heads, first, n = np.unique(parent, return_index=True, return_counts=True)
        for j in np.argsort(-n, kind="stable"):
            children = code[first[j] : first[j] + n[j]]
            bases[int(heads[j])] = b = places.take(children)
            parents.update(dict.fromkeys((b + children).tolist(), int(heads[j])))
        of = np.array([bases[int(h)] for h in heads], np.int64)
        for i in live:
            states[i] = of[np.searchsorted(heads, states[i])] + codes[i][:, d - 1]
            if codes[i].shape[1] == d:
                ends.update(zip(states[i].tolist(), keys[i].tolist()))
    size = max([len(symbols), *parents]) + 1
    base, check, key = np.full(size, _NONE, np.int32), np.full(size, -1, np.int32), np.zeros(size, np.int64)
    check[: len(symbols) + 1] = 0
    key[1 : len(symbols) + 1] = symbols.view(np.int64)
    for table, values in ((base, bases), (check, parents), (key, ends)):
        table[np.fromiter(values, np.int64, len(values))] = np.fromiter(values.values(), np.int64, len(values))
    return Trie(symbols, base, check, key, depth)


class _Places:
    """Places of the array that are still free."""

    def __init__(self, taken: int):
        self.used, self.low = np.zeros(taken + _LOOK, bool), taken
        self.used[:taken] = True

    def take(self, children: np.ndarray) -> int:
        """The first base that leaves every child a free place; they are taken."""
        rel, start = children - children[0], self.low
        while True:
            if len(self.used) < start + _LOOK + int(rel[-1]) + 1:
                self.used = np.append(self.used, np.zeros(len(self.used) + _LOOK + int(rel[-1]), bool))
            free = start + np.flatnonzero(~self.used[start : start + _LOOK])
            for c in range(0, len(free), max(1, _LOOK // len(rel))):
                some = free[c : c + max(1, _LOOK // len(rel))]
                fits = ~self.used[some[:, None] + rel].any(1)
                if fits.any():
                    at = int(some[fits.argmax()])
                    self.used[at + rel] = True
                    while self.low < len(self.used) and self.used[self.low : self.low + _LOOK].mean() > 0.95:
                        self.low += _LOOK
                    return at - int(children[0])
            start += _LOOK
