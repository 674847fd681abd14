"""Small models that are fitted on the driver, on bounded samples, and applied in Arrow batches."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_labels(labels: DataFrame, label: str, train: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Up to per_class training doc_ids of each label 0 and 1, the lowest by hash, and the counts of all training rows by label.

    A doc_id with several labels has the largest. The result is bounded by 2 * per_class rows."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    counts = {int(r["y"]): int(r["n"]) for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = lambda y: rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    return pick(0).unionByName(pick(1)), counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Isotonic:
    """Monotone calibration by pooling adjacent violators, with linear steps between block means."""

    x: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    y: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Isotonic:
        order = np.argsort(x, kind="stable")
        blocks: list[list[float]] = []  # weight, weighted y, weighted x
        for xi, yi, wi in zip(x[order], y[order], w[order]):
            blocks.append([wi, wi * yi, wi * xi])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
        if not blocks:
            return cls()
        return cls(np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.x, self.y)


@dataclass
class Boosted:
    """Gradient-boosted trees for logistic loss over binned dense features. A tree is three levels of (feature, bin) tests."""

    edges: list[np.ndarray]
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, w: np.ndarray, n_trees: int = 60, depth: int = 3, rate: float = 0.2, n_bins: int = 32, ridge: float = 1.0) -> Boosted:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) for j in range(x.shape[1])]
        model = cls(edges)
        b = model.bins(x)
        mean = np.clip(np.average(y, weights=w), 1e-4, 1 - 1e-4)
        model.base = float(np.log(mean / (1 - mean)))
        raw = np.full(len(y), model.base)
        for _ in range(n_trees):
            p = sigmoid(raw)
            g, h = w * (y - p), w * p * (1 - p)
            feature, cut, node = np.full(2**depth - 1, 0), np.full(2**depth - 1, n_bins + 1), np.zeros(len(y), int)
            for level in range(depth):
                first, width = 2**level - 1, 2**level
                best = np.full(width, 1e-9)
                for j in range(x.shape[1]):
                    size = len(edges[j]) + 1
                    at = (node - first) * size + b[:, j]
                    gs = np.bincount(at, g, width * size).reshape(width, size).cumsum(1)
                    hs = np.bincount(at, h, width * size).reshape(width, size).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                    gain[:, -1] = 0
                    k = gain.argmax(1)
                    for n in range(width):
                        if gain[n, k[n]] > best[n]:
                            best[n], feature[first + n], cut[first + n] = gain[n, k[n]], j, k[n]
                node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**depth - 1)
            value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
            raw += value[leaf]
            model.trees.append((feature, cut, value))
        return model

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features, by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0, steps: int = 12) -> Logistic:
        mean, scale = x.mean(0), x.std(0) + 1e-9
        z = np.c_[(x - mean) / scale, np.ones(len(x))]
        beta = np.zeros(z.shape[1])
        penalty = ridge * np.eye(len(beta))
        penalty[-1, -1] = 1e-6
        for _ in range(steps):
            p = sigmoid(z @ beta)
            step = np.linalg.solve((z * (w * p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, z.T @ (w * (y - p)) - penalty @ beta)
            beta += np.clip(step, -3, 3)
        return cls(mean, scale, beta)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(np.c_[(x - self.mean) / self.scale, np.ones(len(x))] @ self.weights)
