"""Boosted regression trees in numpy for two classes, and probabilities calibrated on rows held out."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DEPTH, BINS = 3, 32


@dataclass
class Boosted:
    """Complete trees of one depth: a feature and a bound per inner node, a value per leaf; then a scale and offset."""

    features: list[np.ndarray] = field(default_factory=list)
    bounds: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    scale: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, bound, leaf in zip(self.features, self.bounds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.scale * self.margin(x) + self.offset)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2, ridge: float = 1.0) -> Boosted:
    """Trees on the gradient of the logistic loss, each node split where the gain of a second-order step is largest."""
    bounds = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    cells = np.stack([np.searchsorted(b, x[:, f], "left") for f, b in enumerate(bounds)], 1)
    model, margin = Boosted(), np.zeros(len(x))
    for _ in range(rounds):
        p = _logistic(margin)
        slope, curve = p - y, p * (1 - p)
        feature, bound = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
        node = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            for f, edges in enumerate(bounds):
                if not len(edges):
                    continue
                key = (node - first) * (BINS + 1) + cells[:, f]
                g, h = (np.bincount(key, v, width * (BINS + 1)).reshape(width, -1).cumsum(1) for v in (slope, curve))
                left = g[:, : len(edges)] ** 2 / (h[:, : len(edges)] + ridge)
                right = (g[:, -1:] - g[:, : len(edges)]) ** 2 / (h[:, -1:] - h[:, : len(edges)] + ridge)
                gain = left + right - g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = np.flatnonzero(top > best + 1e-9)
                best[better], feature[first + better], bound[first + better] = top[better], f, edges[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > bound[node])
        leaf = node - (2**DEPTH - 1)
        g, h = (np.bincount(leaf, v, 2**DEPTH) for v in (slope, curve))
        value = -rate * g / (h + ridge)
        margin += value[leaf]
        model.features.append(feature)
        model.bounds.append(bound)
        model.leaves.append(value)
    return model


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray, steps: int = 300) -> None:
    """Fit scale and offset of the margin on held-out rows, by gradient steps on the spread of the margins."""
    margin = model.margin(x)
    spread = max(float(margin.std()), 1e-6)
    z = margin / spread
    soft = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = spread, 0.0
    for _ in range(steps):
        error = _logistic(a * z + b) - soft
        a, b = max(a - 2 * (error * z).mean(), 1e-3), b - 2 * error.mean()
    model.scale, model.offset = a / spread, b


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least probability from which on a share of ``precision`` is right; more than 1 where there is none."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True)
    good = np.flatnonzero((right >= precision) & last[: len(y)])
    return float(p[order][good[-1]]) if len(good) else 2.0
