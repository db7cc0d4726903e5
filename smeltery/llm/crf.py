"""A linear-chain conditional random field in numpy: training and batched Viterbi decoding."""

from __future__ import annotations

import numpy as np

ROUNDS = 80
RATE = 0.15
DECAY = 1e-3


def padded(sequences: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids as (sequence, place, feature), padded with -1, and the lengths."""
    sizes = np.array([len(s) for s in sequences], np.int64)
    wide = max((len(f) for s in sequences for f in s), default=1)
    out = np.full((len(sequences), max(sizes.max(initial=0), 1), max(wide, 1)), -1, np.int64)
    for i, s in enumerate(sequences):
        for t, f in enumerate(s):
            out[i, t, :len(f)] = f
    return out, sizes


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Chain:
    """Weights of features by label, and of label pairs. ``allowed`` says which pairs may follow each other;
    row ``n_labels`` holds the labels that may begin."""

    def __init__(self, n_features: int, allowed: np.ndarray):
        self.n_labels = allowed.shape[1]
        self.emit = np.zeros((n_features + 1, self.n_labels))   # the last row, for no feature, stays zero
        self.move = np.zeros((self.n_labels + 1, self.n_labels))
        self.barred = np.where(allowed, 0.0, -1e9)

    def scores(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.emit[features].sum(2), self.move + self.barred

    def fit(self, features: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> "Chain":
        """Full-batch ascent of the penalised log-likelihood; the same table gives the same weights."""
        n, places, _ = features.shape
        k = self.n_labels
        inside = np.arange(places)[None, :] < sizes[:, None]
        at = np.nonzero(inside)
        gold = np.zeros((n, places, k))
        gold[at[0], at[1], labels[at]] = 1
        pairs = np.zeros_like(self.move)
        np.add.at(pairs, (np.full(n, k), labels[:, 0]), (sizes > 0).astype(float))
        both = np.nonzero(inside[:, 1:])
        np.add.at(pairs, (labels[:, :-1][both], labels[:, 1:][both]), 1)
        sums = [np.zeros_like(self.emit), np.zeros_like(self.move)]
        squares = [np.zeros_like(self.emit), np.zeros_like(self.move)]
        for step in range(1, ROUNDS + 1):
            e, m = self.scores(features)
            alpha, beta = np.zeros((n, places, k)), np.zeros((n, places, k))
            alpha[:, 0] = e[:, 0] + m[k]
            for t in range(1, places):
                go = e[:, t] + log_sum(alpha[:, t - 1, :, None] + m[None, :k], 1)
                alpha[:, t] = np.where(inside[:, t, None], go, alpha[:, t - 1])
            for t in range(places - 2, -1, -1):
                go = log_sum(m[None, :k] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(inside[:, t + 1, None], go, 0.0)
            z = log_sum(alpha[:, -1], 1)
            single = np.exp(alpha + beta - z[:, None, None]) * inside[:, :, None]
            want = np.zeros_like(self.move)
            want[k] = single[:, 0].sum(0)
            for t in range(1, places):
                joint = alpha[:, t - 1, :, None] + m[None, :k] + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
                want[:k] += (np.exp(np.minimum(joint, 0)) * inside[:, t, None, None]).sum(0)
            rest = np.zeros_like(self.emit)
            np.add.at(rest, features[at].ravel(), np.repeat((gold - single)[at], features.shape[2], 0))
            rest[-1] = 0
            for i, (weights, slope) in enumerate(((self.emit, rest / n), (self.move, (pairs - want) / n))):
                slope = slope - DECAY * weights
                sums[i] = 0.9 * sums[i] + 0.1 * slope
                squares[i] = 0.99 * squares[i] + 0.01 * slope ** 2
                weights += RATE * (sums[i] / (1 - 0.9 ** step)) / (np.sqrt(squares[i] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def decode(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best labels of each sequence, all sequences side by side."""
        n, places, _ = features.shape
        e, m = self.scores(features)
        k = self.n_labels
        best, back = e[:, 0] + m[k], np.zeros((n, places, k), np.int64)
        for t in range(1, places):
            paths = best[:, :, None] + m[None, :k]
            back[:, t] = paths.argmax(1)
            best = np.where((t < sizes)[:, None], e[:, t] + paths.max(1), best)
        out = np.zeros((n, places), np.int64)
        last = best.argmax(1)
        for t in range(places - 1, -1, -1):
            last = np.where(t == sizes - 1, best.argmax(1), last)
            out[:, t] = np.where(t < sizes, last, 0)
            last = np.where((t < sizes) & (t > 0), back[np.arange(n), t, last], last)
        return out
