"""Small tree ensembles over dense features, fitted on a bounded sample and applied inside tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 64


@dataclass
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def apply(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            f = self.feature[node]
            inner = f >= 0
            right = x[np.arange(len(x)), np.maximum(f, 0)] > self.cut[node]
            node = np.where(inner, self.left[node] + right, node)
        return self.value[node]


@dataclass
class Ensemble:
    base: float
    trees: list[Tree] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.apply(x)
        return out


def edges_of(x: np.ndarray) -> list[np.ndarray]:
    """Cut points per feature: at most ``BINS`` - 1 quantiles of the sample."""
    return [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]


def grow(x: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray, depth: int, least: float,
         smoothing: float, scale: float, rng: np.random.Generator | None = None, share: int | None = None) -> Tree:
    """One tree by histogram splits: a leaf is ``-scale * sum(gradient) / (sum(weight) + smoothing)``.

    With ``rng`` each node looks at ``share`` random features only.
    """
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], 1)
    feature, cut, left, value = [-1], [0.0], [0], [0.0]
    nodes = [(0, np.arange(len(x)), 0)]
    deepest = 0
    while nodes:
        node, rows, level = nodes.pop()
        g, w = gradient[rows], weight[rows]
        total_g, total_w = g.sum(), w.sum()
        value[node] = float(-scale * total_g / (total_w + smoothing))
        if level == depth or total_w < 2 * least:
            continue
        best = (1e-9, -1, 0)
        parent = total_g ** 2 / (total_w + smoothing)
        picked = range(x.shape[1]) if rng is None else rng.choice(x.shape[1], size=share, replace=False)
        for k in picked:
            if not len(edges[k]):
                continue
            b = binned[rows, k]
            gs = np.cumsum(np.bincount(b, g, len(edges[k]) + 1))[:-1]
            ws = np.cumsum(np.bincount(b, w, len(edges[k]) + 1))[:-1]
            with np.errstate(divide="ignore", invalid="ignore"):  # an empty side; masked below
                gain = gs ** 2 / (ws + smoothing) + (total_g - gs) ** 2 / (total_w - ws + smoothing) - parent
            gain[(ws < least) | (total_w - ws < least)] = -np.inf
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), int(k), at)
        if best[1] < 0:
            continue
        goes = binned[rows, best[1]] > best[2]
        feature[node], cut[node], left[node] = best[1], float(edges[best[1]][best[2]]), len(value)
        for side in (rows[~goes], rows[goes]):
            nodes.append((len(value), side, level + 1))
            feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
        deepest = max(deepest, level + 1)
    return Tree(np.array(feature), np.array(cut), np.array(left), np.array(value), deepest)


def boosted(x: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.15, depth: int = 4, least: float = 2.0) -> Ensemble:
    """Gradient-boosted trees for the log-odds of y in {0, 1}."""
    p = (y.sum() + 0.5) / (len(y) + 1)
    model = Ensemble(float(np.log(p / (1 - p))))
    edges, raw = edges_of(x), np.full(len(x), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        tree = grow(x, edges, p - y, np.maximum(p * (1 - p), 1e-6), depth, least * 0.1, 1.0, rate)
        model.trees.append(tree)
        raw += tree.apply(x)
    return model


def forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 10, least: float = 2.0, seed: int = 11) -> Ensemble:
    """A random forest: bootstrap rows, a random feature subset at every node; ``raw`` is the mean share of y = 1."""
    rng, edges = np.random.default_rng(seed), edges_of(x)
    share = max(1, int(np.ceil(np.sqrt(x.shape[1]))))
    model = Ensemble(0.0)
    for _ in range(trees):
        weight = np.bincount(rng.integers(0, len(x), len(x)), minlength=len(x)).astype(float)
        model.trees.append(grow(x, edges, -y * weight, weight, depth, least, 0.0, 1.0 / trees, rng, share))
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, mean) of the best non-decreasing fit; apply by linear interpolation."""
    at, start = np.unique(score, return_inverse=True)
    blocks: list[list[float]] = []
    for x, s, n in zip(at, np.bincount(start, y), np.bincount(start)):
        blocks.append([s, n, x, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, n2, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + n2, blocks[-1][2], high]
    knots = np.array([[x, s / n] for s, n, low, high in blocks for x in ((low,) if low == high else (low, high))])
    return knots[:, 0], knots[:, 1]
