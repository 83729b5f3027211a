"""Gradient-boosted trees for two classes, in numpy: small models that are trained here and stored as text.

Trees are complete binary trees of one depth, so that prediction is a few
vectorized gathers per tree whatever the number of rows.
"""

from __future__ import annotations

import numpy as np


class Boosted:
    def __init__(self, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, base: float, threshold: float = 0.5):
        self.feature, self.cut, self.leaf = np.asarray(feature, np.int32), np.asarray(cut, np.float64), np.asarray(leaf, np.float64)
        self.base, self.threshold = base, threshold
        self.depth = int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += leaf[node - (len(leaf) - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(np.asarray(x, np.float64))))

    def to_dict(self) -> dict:
        return {"feature": self.feature.tolist(), "cut": self.cut.tolist(), "leaf": self.leaf.round(6).tolist(), "base": round(self.base, 6), "threshold": round(self.threshold, 6)}

    @classmethod
    def from_dict(cls, d: dict) -> Boosted:
        return cls(d["feature"], d["cut"], d["leaf"], d["base"], d["threshold"])


def _best(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], lam: float) -> tuple[int, float, float]:
    total_g, total_h = g.sum(), h.sum()
    best = (0, np.inf, 1e-9)
    for f, cs in enumerate(cuts):
        for c in cs:
            right = x[:, f] > c
            gr, hr = g[right].sum(), h[right].sum()
            gl, hl = total_g - gr, total_h - hr
            gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - total_g * total_g / (total_h + lam)
            if gain > best[2]:
                best = (f, float(c), gain)
    return best


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, lam: float = 1.0, bins: int = 12) -> Boosted:
    """Newton boosting of the logistic loss; deterministic."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    p0 = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    score = np.full(len(x), base)
    cuts = [np.unique(np.quantile(np.unique(col), np.linspace(0, 1, bins + 1)[:-1])) for col in x.T] if len(x) else []
    features, thresholds, leaves = [], [], []
    inner, n_leaf = 2**depth - 1, 2**depth
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        f, c = np.zeros(inner, np.int32), np.full(inner, np.inf)
        node = np.zeros(len(x), np.int64)
        for at in range(inner):
            rows = np.flatnonzero(node == at)
            if len(rows):
                f[at], c[at], _gain = _best(x[rows], g[rows], h[rows], cuts, lam)
                node[rows] = 2 * at + 1 + (x[rows, f[at]] > c[at])
        leaf = np.zeros(n_leaf)
        place = node - inner
        for k in range(n_leaf):
            rows = place == k
            leaf[k] = rate * g[rows].sum() / (h[rows].sum() + lam) if rows.any() else 0.0
        score += leaf[place]
        features.append(f)
        thresholds.append(np.where(np.isinf(c), 1e30, c))
        leaves.append(leaf)
    return Boosted(np.array(features), np.array(thresholds), np.array(leaves), base)


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray) -> float:
    """Sets the threshold to the middle of the range of probabilities with the best F1 on held-out rows; returns that F1."""
    p, y = model.probability(x), np.asarray(y, bool)
    best, at = -1.0, []
    for t in np.unique(np.concatenate([p.round(4), np.linspace(0.05, 0.95, 19)])):
        hit = p >= t
        f1 = 2 * (hit & y).sum() / max(1, hit.sum() + y.sum())
        if f1 > best + 1e-9:
            best, at = f1, [t]
        elif abs(f1 - best) <= 1e-9:
            at.append(t)
    model.threshold = float((min(at) + max(at)) / 2)
    return float(best)
