"""A linear-chain conditional random field over binary features, in numpy: training on padded batches, Viterbi decoding of many sequences at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class CRF:
    """Weights: emission[feature, label], transition[from, to], start[label]. Feature 0 is always on."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    @classmethod
    def fit(cls, x: list[np.ndarray], y: list[np.ndarray], labels: int, steps: int = 300, rate: float = 0.1, l2: float = 1e-3) -> CRF:
        """Maximise the conditional likelihood by Adam. x: a 0/1 matrix [tokens, features] for each sequence."""
        n, t_max, f = len(x), max(map(len, x)), x[0].shape[1]
        feats, gold, mask = np.zeros((n, t_max, f)), np.zeros((n, t_max), int), np.zeros((n, t_max))
        for i, (a, b) in enumerate(zip(x, y)):
            feats[i, : len(a)], gold[i, : len(a)], mask[i, : len(a)] = a, b, 1
        theta = [np.zeros((f, labels)), np.zeros((labels, labels)), np.zeros(labels)]
        m, v = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
        one = np.eye(labels)
        pair_mask = mask[:, 1:]
        for step in range(1, steps + 1):
            em, tr, st = theta
            e = feats @ em
            alpha, beta = np.zeros((n, t_max, labels)), np.zeros((n, t_max, labels))
            alpha[:, 0] = st + e[:, 0]
            for t in range(1, t_max):
                new = _logsumexp(alpha[:, t - 1, :, None] + tr, 1) + e[:, t]
                alpha[:, t] = np.where(mask[:, t, None] > 0, new, alpha[:, t - 1])
            for t in range(t_max - 2, -1, -1):
                new = _logsumexp(tr + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(mask[:, t + 1, None] > 0, new, 0.0)
            z = _logsumexp(alpha[:, -1], 1)
            node = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
            edge = np.exp(alpha[:, :-1, :, None] + tr + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * pair_mask[..., None, None]
            truth = one[gold] * mask[..., None]
            grads = [
                np.einsum("ntf,ntl->fl", feats, truth - node) / n - l2 * em,
                (np.einsum("nta,ntb->ab", truth[:, :-1] * pair_mask[..., None], truth[:, 1:]) - edge.sum((0, 1))) / n - l2 * tr,
                (truth[:, 0] - node[:, 0]).sum(0) / n - l2 * st,
            ]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                theta[i] = theta[i] + rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        return cls(*theta)

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of many sequences by Viterbi. scores: emission scores [all tokens, labels], sequences one after the other."""
        lengths = np.asarray(lengths)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, int)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        first, size = starts[order], lengths[order]
        out = np.zeros(len(scores), np.int8)
        if not len(order):
            return out
        back = np.zeros(scores.shape, np.int8)
        best = self.start + scores[first]
        ends = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # sequences of at least t tokens
        for t in range(1, size[0]):
            k = ends[t]
            reach = best[:k, :, None] + self.transition
            at = first[:k] + t
            back[at] = reach.argmax(1)
            best[:k] = reach.max(1) + scores[at]
        label = best.argmax(1).astype(np.int8)
        for t in range(size[0] - 1, -1, -1):
            k = ends[t]
            at = first[:k] + t
            out[at] = label[:k]
            label[:k] = back[at, label[:k]] if t else label[:k]
        return out
