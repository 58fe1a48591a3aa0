"""A linear-chain conditional random field with two labels: trained by gradient ascent, decoded by Viterbi."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray  # features x 2
    moves: np.ndarray  # from x to
    starts: np.ndarray

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), 2))
        for k, names in enumerate(rows):
            known = [self.features[name] for name in names if name in self.features]
            if known:
                out[k] = self.weights[known].sum(axis=0)
        return out

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The best labels of a chain. Ties go to the first label."""
        if not rows:
            return []
        best, came = None, []
        (m00, m01), (m10, m11) = self.moves.tolist()
        for a, b in self.scores(rows).tolist():
            if best is None:
                best = (a + self.starts[0], b + self.starts[1])
                continue
            x, y = best
            came.append((0 if x + m00 >= y + m10 else 1, 0 if x + m01 >= y + m11 else 1))
            best = (max(x + m00, y + m10) + a, max(x + m01, y + m11) + b)
        label = 0 if best[0] >= best[1] else 1
        labels = [label]
        for step in reversed(came):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def train(chains: list[tuple[list[list[str]], list[int]]], steps: int = 60, rate: float = 0.5, penalty: float = 1e-3) -> Model:
    """The model of greatest penalised likelihood, by Adagrad over all chains at once. Deterministic."""
    chains = [chain for chain in chains if chain[0]]
    features = {name: k for k, name in enumerate(sorted({n for rows, _ in chains for names in rows for n in names}))}
    coded = [([np.array([features[n] for n in names], int) for names in rows], np.array(labels)) for rows, labels in chains]
    model = Model(features, np.zeros((len(features), 2)), np.zeros((2, 2)), np.zeros(2))
    squares = [np.full(x.shape, 1e-8) for x in (model.weights, model.moves, model.starts)]
    for _ in range(steps):
        gradients = [np.zeros(x.shape) for x in (model.weights, model.moves, model.starts)]
        for rows, labels in coded:
            n = len(rows)
            scores = np.array([model.weights[row].sum(axis=0) for row in rows])
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = scores[0] + model.starts
            for k in range(1, n):
                forward[k] = scores[k] + log_sum(forward[k - 1][:, None] + model.moves, 0)
            for k in range(n - 2, -1, -1):
                backward[k] = log_sum(model.moves + (scores[k + 1] + backward[k + 1])[None, :], 1)
            total = log_sum(forward[-1], 0)
            missed = np.eye(2)[labels] - np.exp(forward + backward - total)
            for row, miss in zip(rows, missed, strict=True):
                gradients[0][row] += miss
            for k in range(1, n):
                pair = forward[k - 1][:, None] + model.moves + (scores[k] + backward[k])[None, :] - total
                gradients[1] -= np.exp(pair)
                gradients[1][labels[k - 1], labels[k]] += 1
            gradients[2] += missed[0]
        for value, gradient, square in zip((model.weights, model.moves, model.starts), gradients, squares, strict=True):
            gradient -= penalty * len(coded) * value
            square += gradient**2
            value += rate * gradient / np.sqrt(square)
    return model
