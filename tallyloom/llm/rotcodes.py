"""One-bit codes of randomly rotated unit vectors, with correction factors and error bounds.

A code holds the signs of the vector's coordinates in `rotations` random orthonormal bases. In
each basis the sign vector's own inner product with the vector is stored; dividing by it makes
the inner product of the signs with any query an unbiased estimate of the true one. The query
side is rounded to 4 bits per coordinate, so that an estimate is a few ANDs and bit counts.
"""

from __future__ import annotations

import numpy as np

QUERY_BITS = 4


class RotatedCodes:
    def __init__(self, dim: int, rotations: int = 4, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.dim, self.rotations = dim, rotations
        self.words = -(-dim // 64)
        frames = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(rotations)]
        self.frames = np.concatenate(frames, 1).astype(np.float32)

    def rotate(self, unit: np.ndarray) -> np.ndarray:
        return (unit.astype(np.float32) @ self.frames).reshape(len(unit), self.rotations, self.dim)

    def pack(self, bits: np.ndarray) -> np.ndarray:
        """Bits along the last axis as 64-bit words."""
        packed = np.packbits(bits, axis=-1, bitorder="little")
        pad = self.words * 8 - packed.shape[-1]
        packed = np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, pad)])
        return np.ascontiguousarray(packed).view("<u8")

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes [n, rotations, words] and factors [n, rotations] of unit vectors."""
        turned = self.rotate(unit)
        return self.pack(turned > 0), np.abs(turned).sum(2) / np.float32(np.sqrt(self.dim))

    def signs(self, codes: np.ndarray) -> np.ndarray:
        """The bits of codes, one per byte: [n, rotations * dim]."""
        flat = np.ascontiguousarray(codes).view(np.uint8).reshape(len(codes), self.rotations, -1)
        return np.unpackbits(flat, axis=2, count=self.dim, bitorder="little").reshape(len(codes), -1)

    def queries(self, unit: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bit planes, lowest value, step and sum per rotation of unit query vectors."""
        turned = self.rotate(unit)
        low = turned.min(2)
        step = np.maximum((turned.max(2) - low) / (2**QUERY_BITS - 1), np.float32(1e-9))
        level = np.rint((turned - low[..., None]) / step[..., None]).astype(np.uint8)
        planes = np.stack([self.pack(level >> j & 1) for j in range(QUERY_BITS)])
        total = low * self.dim + step * level.sum(2)
        return planes, low, step, total

    def bounds(self, codes: np.ndarray, factors: np.ndarray, queries: tuple[np.ndarray, ...], sigmas: float):
        """Estimated inner products [n, m] and half the width of their confidence interval."""
        planes, low, step, total = queries
        n, m = len(codes), low.shape[0]
        estimate, variance = np.zeros((n, m), np.float32), np.zeros((n, m), np.float32)
        root = np.float32(np.sqrt(self.dim))
        for r in range(self.rotations):
            dot = np.zeros((n, m), np.int32)
            for w in range(self.words):
                for j in range(QUERY_BITS):
                    dot += np.bitwise_count(codes[:, None, r, w] & planes[j][None, :, r, w]).astype(np.int32) << j
            ones = np.bitwise_count(codes[:, r]).sum(1).astype(np.float32)
            signed = 2 * (ones[:, None] * low[None, :, r] + dot * step[None, :, r]) - total[None, :, r]
            factor = np.maximum(factors[:, r], np.float32(1e-6))
            estimate += signed / (root * factor[:, None])
            spread = (1 - np.minimum(factor, 1) ** 2) / factor**2 / max(1, self.dim - 1)
            variance += spread[:, None] + (step[None, :, r] ** 2 / 12) / factor[:, None] ** 2
        return estimate / self.rotations, np.float32(sigmas) * np.sqrt(variance) / self.rotations


def vectors_of(column, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as doubles, and which of them are usable.

    Not usable: null, of another length, zero, or with a null or non-finite component.
    """
    n = len(column)
    out, good = np.zeros((n, dim)), np.zeros(n, bool)
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    fit = np.flatnonzero(lengths == dim)
    if len(fit):
        flat = column.take(fit.tolist()).flatten() if len(fit) < n else column.flatten()
        values = np.asarray(flat.fill_null(np.nan), np.float64).reshape(-1, dim)
        out[fit] = values
        with np.errstate(over="ignore"):
            squares = (values**2).sum(1)
        good[fit] = np.isfinite(values).all(1) & (squares > 0) & np.isfinite(squares)
    out[~good] = 0
    return out, good


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors**2).sum(1))[:, None]
