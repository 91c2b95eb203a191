"""Gradient-boosted trees for two classes, over binned numbers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BINS = 32


@dataclass
class Trees:
    """Complete trees of one depth: what each inner node asks, and the value of each end."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray
    value: np.ndarray  # trees x ends

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of the second class."""
        found = np.full(len(rows), self.start)
        index = np.arange(len(rows))
        depth = int(np.log2(self.value.shape[1]))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (rows[index, feature[at]] > limit[at])
            found += value[at - self.feature.shape[1]]
        return found


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25,
        ridge: float = 2.0) -> Trees:
    """Trees on the logistic loss, each level's splits found from sums by bin."""
    count, width = rows.shape
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, _BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(count, start)
    inner, ends = 2**depth - 1, 2**depth
    features, limits = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    values = np.zeros((trees, ends))
    for t in range(trees):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = labels - chance, chance * (1 - chance)
        at = np.zeros(count, np.int64)
        for level in range(depth):
            base, nodes = 2**level - 1, 2**level
            best = np.full(nodes, 1e-6)
            local = at - base
            for f in range(width):
                key = local * _BINS + binned[:, f]
                g = np.bincount(key, slope, nodes * _BINS).reshape(nodes, _BINS).cumsum(axis=1)
                h = np.bincount(key, bend, nodes * _BINS).reshape(nodes, _BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                gain = gain[:, : len(cuts[f])]
                if not gain.shape[1]:
                    continue
                where = gain.argmax(axis=1)
                found = gain[np.arange(nodes), where]
                better = found > best
                best[better] = found[better]
                features[t, base : base + nodes][better] = f
                limits[t, base : base + nodes][better] = cuts[f][where[better]]
            at = 2 * at + 1 + (rows[np.arange(count), features[t, at]] > limits[t, at])
        end = at - inner
        g, h = np.bincount(end, slope, ends), np.bincount(end, bend, ends)
        values[t] = rate * g / (h + ridge)
        score += values[t, end]
    return Trees(start, features, limits, values)
