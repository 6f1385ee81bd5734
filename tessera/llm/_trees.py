"""Small decision trees, fitted on the driver to bounded tables and applied as SQL expressions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Node:
    """A leaf has a value only."""

    value: float
    feature: str = ""
    at: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def predict(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        if not self.feature:
            return np.full(n, self.value)
        low = x[self.feature] <= self.at
        return np.where(low, self.below.predict(x, n), self.above.predict(x, n))

    def column(self, x: dict[str, Column]) -> Column:
        if not self.feature:
            return F.lit(float(self.value))
        return F.when(x[self.feature] <= F.lit(float(self.at)), self.below.column(x)).otherwise(self.above.column(x))


def grow(x: dict[str, np.ndarray], y: np.ndarray, depth: int, least: int, weight: np.ndarray | None = None, pick: np.random.Generator | None = None, tries: int = 0) -> Node:
    """Least-squares tree. weight: second derivatives, for boosting. pick, tries: so many random features for each split, for forests."""
    h = np.ones(len(y)) if weight is None else weight
    value = float(y.sum() / (h.sum() + 1e-9)) if weight is not None else float(y.mean())
    if depth == 0 or len(y) < 2 * least:
        return Node(value)
    names = sorted(x)
    if pick is not None and tries < len(names):
        names = sorted(pick.choice(names, tries, replace=False).tolist())
    best, found = 1e-9, None
    total_y, total_h = y.sum(), h.sum()
    for name in names:
        order = np.argsort(x[name], kind="stable")
        v = x[name][order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        cut = cut[(cut + 1 >= least) & (len(v) - cut - 1 >= least)]
        if not len(cut):
            continue
        sy, sh = np.cumsum(y[order])[cut], np.cumsum(h[order])[cut]
        gain = sy**2 / (sh + 1e-9) + (total_y - sy) ** 2 / (total_h - sh + 1e-9) - total_y**2 / (total_h + 1e-9)
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, found = gain[k], (name, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    if found is None:
        return Node(value)
    name, at = found
    low = x[name] <= at
    part = lambda m: grow({k: a[m] for k, a in x.items()}, y[m], depth - 1, least, None if weight is None else h[m], pick, tries)
    return Node(value, name, at, part(low), part(~low))


@dataclass(frozen=True)
class Boosted:
    """Log odds as a sum of trees, then a logistic calibration a + b * odds."""

    start: float
    trees: tuple[Node, ...]
    rate: float
    a: float = 0.0
    b: float = 1.0

    def odds(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        return self.start + self.rate * sum((t.predict(x, n) for t in self.trees), np.zeros(n))

    def probability(self, x: dict[str, Column]) -> Column:
        total = F.lit(self.start)
        for t in self.trees:
            total = total + F.lit(self.rate) * t.column(x)
        return 1.0 / (1.0 + F.exp(-(F.lit(self.a) + F.lit(self.b) * total)))


def boost(x: dict[str, np.ndarray], y: np.ndarray, rounds: int = 24, depth: int = 3, rate: float = 0.3, least: int = 8, calibrate: tuple[dict[str, np.ndarray], np.ndarray] | None = None) -> Boosted:
    """Gradient boosting on the logistic loss with Newton leaves; the rows of `calibrate`, or else every fifth of x, calibrate the odds."""
    n = len(y)
    held = np.zeros(n, bool) if calibrate else np.arange(n) % 5 == 4
    fit = {k: v[~held] for k, v in x.items()}
    t = y[~held].astype(float)
    p = np.clip(t.mean(), 1e-3, 1 - 1e-3)
    start, odds, trees = float(np.log(p / (1 - p))), np.full(len(t), np.log(p / (1 - p))), []
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-odds))
        tree = grow(fit, t - q, depth, least, q * (1 - q) + 1e-3)
        trees.append(tree)
        odds = odds + rate * tree.predict(fit, len(t))
    model = Boosted(start, tuple(trees), rate)
    apart, c = calibrate if calibrate else ({k: v[held] for k, v in x.items()}, y[held])
    z, c = model.odds(apart, len(c)), c.astype(float)
    a, b = 0.0, 1.0
    for _ in range(50):  # Platt's calibration by Newton steps, kept near the identity
        q = 1 / (1 + np.exp(-(a + b * z)))
        g = np.array([(c - q).sum() - a, ((c - q) * z).sum() - (b - 1)])
        w = q * (1 - q)
        hess = np.array([[w.sum() + 1, (w * z).sum()], [(w * z).sum(), (w * z * z).sum() + 1]])
        da, db = np.linalg.solve(hess, g)
        a, b = a + da, b + db
    return Boosted(start, tuple(trees), rate, float(a), float(b))


def forest(x: dict[str, np.ndarray], y: np.ndarray, trees: int = 15, depth: int = 5, least: int = 5, seed: int = 11) -> list[Node]:
    """Random forest: each tree from a bootstrap of the rows and random features for each split."""
    random = np.random.Generator(np.random.PCG64(seed))
    tries = max(2, int(np.sqrt(len(x))) + 1)
    out = []
    for _ in range(trees):
        at = random.integers(0, len(y), len(y))
        out.append(grow({k: v[at] for k, v in x.items()}, y[at].astype(float), depth, least, None, random, tries))
    return out


def forest_probability(trees: list[Node], x: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for t in trees:
        total = total + t.column(x)
    return total / float(len(trees))


def threshold(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest threshold from which on the share of true rows is `precision` or more: half way to the next lower score; above all scores if there is none."""
    order = np.argsort(-score, kind="stable")
    s, share = score[order], np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(s[1:] < s[:-1], True)  # rows of one score are in together
    good = np.flatnonzero(last & (share >= precision))
    if not len(good):
        return 1.0
    k = int(good[-1])
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k] / 2)
