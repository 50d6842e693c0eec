"""Linear models on labelled samples of bounded size."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import share_of

SAMPLE = 20_000  # labelled rows that a model learns from


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, seed: int) -> DataFrame:
    """docs joined with about `bound` of the rows of labels (doc_id and more), chosen by hash.

    The bound also holds for what is broadcast. Several labels of one document count as one, the largest.
    """
    names = [c for c in labels.columns if c != "doc_id"]
    labels = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in names])
    chosen = labels.where(share_of(bound, labels.count(), seed, "doc_id"))
    return docs.join(F.broadcast(chosen), "doc_id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logit(p):
    return np.log(p) - np.log1p(-p)


def fit_dense(features: np.ndarray, label: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the constant, which is not penalised."""
    x = np.column_stack([features, np.ones(len(features))])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(30):
        p = sigmoid(x @ weights)
        curve = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(ridge), x.T @ (label - p) - ridge * weights)
        weights += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return weights


class Sparse:
    """Rows of 0/1 features, given as lists of feature numbers."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.column = np.concatenate([*rows, np.zeros(0, int)]).astype(np.int64)
        self.rows, self.width = len(rows), width

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.rows)

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, values[self.row], self.width)


def fit_sparse(
    features: Sparse, dense: np.ndarray, label: np.ndarray, use: np.ndarray, penalty: float = 0.2, steps: int = 120
) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on sparse and a few dense features, on the rows where `use` is 1.

    Accelerated gradient steps, each feature scaled by how many rows have it. Returns the
    weights of the sparse features, of the dense ones, and the constant.
    """
    x = np.column_stack([dense, np.ones(len(dense))])
    per_row = np.bincount(features.row, minlength=features.rows).max(initial=0) + x.shape[1]
    scale = 1 / (per_row**0.5 * features.transposed_times(use) / 4 + penalty), 1 / (per_row**0.5 * (x**2 * use[:, None]).sum(axis=0) / 4 + penalty)
    weights = [np.zeros(features.width), np.zeros(x.shape[1])]
    ahead, momentum = [w.copy() for w in weights], 1.0
    for _ in range(steps):
        error = use * (sigmoid(features.times(ahead[0]) + x @ ahead[1]) - label)
        slope = features.transposed_times(error) + penalty * ahead[0], x.T @ error + penalty * np.append(ahead[1][:-1], 0)
        new = [a - s * g for a, s, g in zip(ahead, scale, slope)]
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = [n + (momentum - 1) / after * (n - w) for n, w in zip(new, weights)]
        weights, momentum = new, after
    return weights[0], weights[1][:-1], float(weights[1][-1])
