"""Gaussian mixtures with full covariances, several starts fitted together by expectation-maximisation.

A round is one job: each task adds up, for every start at once, the responsibilities of its rows, their sums and their
products, and returns one row; the driver adds the tasks' rows and solves for the new parameters. Starts that have
converged rest. So ten starts cost the passes of the slowest one, not of all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that the starting centres are chosen from, change of the mean log-likelihood that ends a start, and what is added to variances.
SAMPLE, TOLERANCE, RIDGE = 2000, 1e-3, 1e-6


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])


def log_densities(x: np.ndarray, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> np.ndarray:
    """log(weight * density): starts x rows x components; the parameters have the axis of starts first."""
    chol = np.linalg.cholesky(covariances)
    half = np.log(np.diagonal(chol, axis1=-2, axis2=-1)).sum(axis=-1)
    out = np.empty((len(weights), len(x), weights.shape[1]))
    for s in range(len(weights)):
        for c in range(weights.shape[1]):
            u = np.linalg.solve(chol[s, c], (x - means[s, c]).T)
            out[s, :, c] = -0.5 * (u * u).sum(axis=0) - half[s, c] - 0.5 * x.shape[1] * np.log(2 * np.pi)
    with np.errstate(divide="ignore"):
        return out + np.log(weights)[:, None, :]


def _shares(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(responsibilities, log-likelihood of each row) from log densities."""
    top = logs.max(axis=-1, keepdims=True)
    e = np.exp(logs - top)
    total = e.sum(axis=-1, keepdims=True)
    return e / total, (top + np.log(total))[..., 0]


def _statistics(x: np.ndarray, shares: np.ndarray) -> list[np.ndarray]:
    """Weights, sums and products of the rows for each start and component."""
    return [shares.sum(axis=1), np.einsum("snc,nd->scd", shares, x), np.einsum("snc,nd,ne->scde", shares, x, x, optimize=True)]


def _parameters(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = n + 10 * np.finfo(float).eps
    means = sums / n[..., None]
    cov = products / n[..., None, None] - np.einsum("scd,sce->scde", means, means)
    return n / n.sum(axis=1, keepdims=True), means, cov + RIDGE * np.eye(means.shape[-1])


def _centres(x: np.ndarray, k: int, rng) -> np.ndarray:
    """k centres: far points first (k-means++), then a few rounds of k-means on the sample."""
    c = x[[rng.integers(len(x))]]
    while len(c) < k:
        d = ((x[:, None] - c) ** 2).sum(-1).min(axis=1)
        c = np.vstack([c, x[rng.choice(len(x), p=d / d.sum()) if d.sum() > 0 else rng.integers(len(x))]])
    for _ in range(20):
        own = ((x[:, None] - c) ** 2).sum(-1).argmin(axis=1)
        c = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(k)])
    return c


def _pass(df: DataFrame, cols: Sequence[str], starts: int, k: int, shares_of) -> tuple[list[np.ndarray], np.ndarray, int]:
    """One job over all rows: (statistics by start and component, log-likelihood by start, rows).

    ``shares_of(x)`` gives responsibilities (starts x rows x components) and log-likelihoods (starts x rows).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            x = _matrix(batch)
            for at in range(0, len(x), 4096):
                part = x[at:at + 4096]
                shares, row_ll = shares_of(part)
                flat = np.concatenate([a.ravel() for a in [*_statistics(part, shares), row_ll.sum(axis=1)]])
                total, n = flat if total is None else total + flat, n + len(part)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["s", "n"])

    got = df.select(*[F.col(c).cast("double") for c in cols]).mapInArrow(run, "s binary, n long").collect()  # a row for each task
    flat, d = sum(np.frombuffer(r["s"]) for r in got), len(cols)
    shapes = [(starts, k), (starts, k, d), (starts, k, d, d), (starts,)]
    parts = np.split(flat, np.cumsum([int(np.prod(s)) for s in shapes])[:-1])
    *stats, ll = [a.reshape(s) for a, s in zip(parts, shapes)]
    return stats, ll, sum(r["n"] for r in got)


class Mixture:
    """A fitted mixture: weights, means, covariances by component, and the log-likelihood of the rows it was fitted on."""

    def __init__(self, cols: Sequence[str], weights, means, covariances, log_likelihood: float, rounds: int, history: list):
        self.cols, self.weights, self.means, self.covariances = list(cols), weights, means, covariances
        self.log_likelihood, self.rounds, self.history = log_likelihood, rounds, history

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], k: int = 3, starts: int = 10, max_iter: int = 200, seed: int = 42) -> "Mixture":
        """df has no missing value in ``cols``. The starting centres come from a bounded sample, everything else from all rows."""
        d = len(cols)
        order = F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])
        sample = np.array([list(r) for r in df.select(*cols).orderBy(order).limit(SAMPLE).collect()], float).reshape(-1, d)
        if not len(sample):
            raise ValueError("no rows to fit")
        rng = np.random.default_rng(seed)
        centres = np.array([_centres(sample, k, rng) for _ in range(starts)])

        def nearest(x):
            own = ((x[None, :, None] - centres[:, None]) ** 2).sum(-1).argmin(axis=-1)
            return np.eye(k)[own], np.zeros((starts, len(x)))

        stats, _, _ = _pass(df, cols, starts, k, nearest)
        params = [list(p) for p in zip(*_parameters(*stats))]  # by start
        before, history, rounds = np.full(starts, -np.inf), [[] for _ in range(starts)], np.zeros(starts, int)
        live = list(range(starts))
        for _ in range(max_iter):
            now = [np.array([params[s][i] for s in live]) for i in range(3)]
            stats, ll, n = _pass(df, cols, len(live), k, lambda x, now=now: _shares(log_densities(x, *now)))
            new = list(zip(*_parameters(*stats)))
            still = []
            for i, s in enumerate(live):
                history[s].append(ll[i] / n)
                rounds[s] += 1
                done = abs(ll[i] / n - before[s]) < TOLERANCE
                before[s] = ll[i] / n
                if not done:
                    params[s] = list(new[i])
                    still.append(s)
            live = still
            if not live:
                break
        best = int(np.argmax(before))
        return cls(cols, *params[best], float(before[best]) * n, int(rounds[best]), history)

    def transform(self, df: DataFrame, probability: str = "probability", cluster: str = "cluster") -> DataFrame:
        """``df`` with the components' probabilities (an array) and the likeliest component."""
        w, m, c = self.weights[None], self.means[None], self.covariances[None]

        @F.pandas_udf("array<double>")
        def shares(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for cols in batches:
                x = np.column_stack([s.to_numpy(float) for s in cols])
                yield pd.Series(list(_shares(log_densities(x, w, m, c))[0][0]), dtype=object)

        out = df.withColumn(probability, shares(*[F.col(c).cast("double") for c in self.cols]))
        return out.withColumn(cluster, (F.array_position(F.col(probability), F.array_max(probability)) - 1).cast("int"))
