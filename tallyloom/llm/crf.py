"""A linear-chain conditional random field in numpy: training and batched Viterbi decoding."""

from __future__ import annotations

import numpy as np


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ragged rows as [n, longest, ...] with a mask."""
    longest = max(map(len, rows))
    out = np.zeros((len(rows), longest, *rows[0].shape[1:]), rows[0].dtype)
    mask = np.zeros((len(rows), longest), bool)
    for i, r in enumerate(rows):
        out[i, : len(r)], mask[i, : len(r)] = r, True
    return out, mask


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(sequences: list[tuple[list[list[int]], list[int]]], n_features: int, n_labels: int, rounds: int = 160, l2: float = 0.02):
    """Weights [feature, label] and moves [from, to] by maximum likelihood with an L2 penalty (Adam).

    A sequence is the active features of each position with the positions' labels.
    """
    labels, mask = _padded([np.array(y) for _, y in sequences])
    n, length = labels.shape
    active = np.zeros((n, length, n_features), np.float32)
    for i, (x, _) in enumerate(sequences):
        for t, features in enumerate(x):
            active[i, t, features] = 1
    gold = (labels[:, :, None] == np.arange(n_labels)) & mask[:, :, None]
    pairs = mask[:, 1:]
    seen_moves = np.zeros((n_labels, n_labels))
    np.add.at(seen_moves, (labels[:, :-1][pairs], labels[:, 1:][pairs]), 1)
    flat = active.reshape(-1, n_features)
    seen = flat.T @ gold.reshape(-1, n_labels)
    w, moves = np.zeros((n_features, n_labels)), np.zeros((n_labels, n_labels))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, moves)]
    for step in range(1, rounds + 1):
        score = (flat @ w).reshape(n, length, n_labels)
        ahead, back = score.copy(), np.zeros_like(score)
        for t in range(1, length):
            new = _logsum(ahead[:, t - 1, :, None] + moves, 1) + score[:, t]
            ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            new = _logsum(moves + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(mask[:, t + 1, None], new, 0)
        total = _logsum(ahead[:, -1], 1)
        marginal = np.exp(ahead + back - total[:, None, None]) * mask[:, :, None]
        joint = ahead[:, :-1, :, None] + moves + (score[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected_moves = (np.exp(np.minimum(joint, 0)) * pairs[:, :, None, None]).sum((0, 1))
        grads = ((flat.T @ marginal.reshape(-1, n_labels) - seen) / n + l2 * w / 10, (expected_moves - seen_moves) / n + l2 * moves / 10)
        for p, g, s in zip((w, moves), grads, state):
            s[0], s[1] = 0.9 * s[0] + 0.1 * g, 0.99 * s[1] + 0.01 * g * g
            p -= 0.2 * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.99**step)) + 1e-8)
    return w, moves


def viterbi(emissions: list[np.ndarray], moves: np.ndarray, cells: int = 2_000_000) -> list[np.ndarray]:
    """The best label sequence for each [length, labels] score array, in batches of like length."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(emissions)
    order = sorted((i for i in range(len(emissions)) if len(emissions[i])), key=lambda i: len(emissions[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(emissions[order[end]]) <= cells // moves.shape[0]:
            end += 1
        chosen = order[at:end]
        score, mask = _padded([emissions[i] for i in chosen])
        best, length = score[:, 0], score.shape[1]
        came = np.zeros(score.shape, np.int8)
        for t in range(1, length):
            ways = best[:, :, None] + moves
            came[:, t] = ways.argmax(1)
            best = np.where(mask[:, t, None], ways.max(1) + score[:, t], best)
        label = np.zeros(score.shape[:2], np.int64)
        label[:, -1] = best.argmax(1)
        rows = np.arange(len(chosen))
        for t in range(length - 1, 0, -1):
            label[:, t - 1] = np.where(mask[:, t], came[rows, t, label[:, t]], label[:, t])
        for k, i in enumerate(chosen):
            out[i] = label[k, : len(emissions[i])]
        at = end
    return out
