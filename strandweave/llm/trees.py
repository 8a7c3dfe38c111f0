"""Small decision-tree ensembles, fitted on the driver and evaluated as SQL expressions.

Training sets are bounded (fixtures of labelled examples); the fitted trees become
nested CASE expressions, so scoring stays inside the JVM.
"""

from __future__ import annotations

import numpy as np

Node = tuple  # (value,) or (feature, threshold, left, right)


def fit_tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, least: int = 4, ridge: float = 1e-6, draw: np.random.Generator | None = None, features: int | None = None) -> Node:
    """A regression tree for targets g / h (h: row weights); with ``draw``, each split sees ``features`` random columns."""
    value = float(g.sum() / (h.sum() + ridge))
    if depth == 0 or len(x) < 2 * least:
        return (value,)
    best, at = 1e-12, None
    total = g.sum() ** 2 / (h.sum() + ridge)
    columns = draw.choice(x.shape[1], features or x.shape[1], replace=False) if draw is not None else range(x.shape[1])
    for f in sorted(int(c) for c in columns):
        order = np.argsort(x[:, f], kind="stable")
        v, gs, hs = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
        cuts = np.flatnonzero(v[1:] > v[:-1])
        cuts = cuts[(cuts + 1 >= least) & (len(v) - cuts - 1 >= least)]
        if not len(cuts):
            continue
        gain = gs[cuts] ** 2 / (hs[cuts] + ridge) + (gs[-1] - gs[cuts]) ** 2 / (hs[-1] - hs[cuts] + ridge) - total
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, at = float(gain[k]), (f, float((v[cuts[k]] + v[cuts[k] + 1]) / 2))
    if at is None:
        return (value,)
    left = x[:, at[0]] <= at[1]
    grow = lambda rows: fit_tree(x[rows], g[rows], h[rows], depth - 1, least, ridge, draw, features)
    return (*at, grow(left), grow(~left))


def predict(node: Node, x: np.ndarray) -> np.ndarray:
    if len(node) == 1:
        return np.full(len(x), node[0])
    left = x[:, node[0]] <= node[1]
    out = np.empty(len(x))
    out[left], out[~left] = predict(node[2], x[left]), predict(node[3], x[~left])
    return out


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 15, depth: int = 6, seed: int = 3) -> list[Node]:
    """Random forest: bootstrap rows, random columns at each split; the score is the mean leaf share of positives."""
    draw = np.random.default_rng(seed)
    width = max(1, int(np.sqrt(x.shape[1])) + 1)
    out = []
    for _ in range(trees):
        rows = draw.integers(0, len(x), len(x))
        out.append(fit_tree(x[rows], y[rows].astype(float), np.ones(len(x)), depth, 2, draw=draw, features=width))
    return out


def fit_boosting(x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 3, rate: float = 0.3) -> list[Node]:
    """Gradient boosting on the logistic loss with Newton leaves; the score is the logistic of the sum."""
    margin, out = np.zeros(len(x)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        node = fit_tree(x, rate * (y - p), p * (1 - p), depth, 3, ridge=1.0)
        margin += predict(node, x)
        out.append(node)
    return out


def tree_sql(node: Node, column: str) -> str:
    """The tree as SQL; ``column`` is a format for feature numbers, such as ``c.f{}``."""
    if len(node) == 1:
        return f"{node[0]:.8f}D"
    return f"CASE WHEN {column.format(node[0])} <= {node[1]:.8f}D THEN {tree_sql(node[2], column)} ELSE {tree_sql(node[3], column)} END"


def forest_sql(trees: list[Node], column: str) -> str:
    return f"(({' + '.join(f'({tree_sql(t, column)})' for t in trees)}) / {len(trees)}.0D)"


def boosting_sql(trees: list[Node], column: str) -> str:
    return f"(1.0D / (1.0D + exp(-({' + '.join(f'({tree_sql(t, column)})' for t in trees)}))))"


def calibrate(score: np.ndarray, y: np.ndarray, precision: float = 0.98, default: float = 0.9) -> float:
    """The lowest threshold that keeps the wanted precision on held-out examples."""
    for t in np.unique(score):
        if y[score >= t].mean() >= precision:
            return float(t)
    return default
