"""Gaussian mixtures with full, tied, diagonal or spherical covariance.

Each iteration is one Spark job: every task turns its rows into the sums
``(n, sum x, sum xx')`` per component, the sums are added up by Spark, and only
they reach the driver. The parameters travel back inside the next job.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.operators.centres import WEIGHT, as_blocks, blocks, merge_points, task_sums

COVARIANCES = ("full", "tied", "diag", "spherical")
#: Added to each density of a random start, as in Spark's estimator.
EPSILON = float(np.finfo(float).eps)
#: Doubles of a work array, small enough for a processor's cache.
WORK = 1 << 15


@dataclass
class Mixture:
    covariance_type: str
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = float("-inf")
    history: tuple[float, ...] = ()
    converged: bool = False
    #: Whether covariances may be singular: densities then lie in the directions that vary.
    singular: bool = False

    @property
    def k(self) -> int:
        return len(self.weights)

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        """Weighted log density of each row under each component."""
        n, d = x.shape
        out = np.empty((n, self.k))
        for j in range(self.k):
            if self.singular:
                root, height = _root(self.covariances[j])
                z = (x - self.means[j]) @ root
                out[:, j] = -0.5 * (z * z).sum(axis=1) + height
                continue
            lower = np.linalg.cholesky(self.covariances[j])
            z = np.linalg.solve(lower, (x - self.means[j]).T)
            out[:, j] = -0.5 * (z * z).sum(axis=0) - np.log(np.diag(lower)).sum()
        return out - 0.5 * d * math.log(2 * math.pi) + np.log(self.weights)

    def assign(self, df: DataFrame, points: str, output: str) -> DataFrame:
        mixture = self

        @F.pandas_udf("int")
        def most_likely(*x: pd.Series) -> pd.Series:
            return pd.Series(mixture.log_densities(np.column_stack(x)).argmax(axis=1).astype("int32"))

        return df.withColumn(output, most_likely(*_coordinates(points, self.means.shape[1])))

    def to_json(self) -> str:
        return json.dumps(
            {
                "covariance_type": self.covariance_type,
                "weights": self.weights.tolist(),
                "means": self.means.tolist(),
                "covariances": self.covariances.tolist(),
                "log_likelihood": self.log_likelihood,
                "singular": self.singular,
            }
        )

    @classmethod
    def from_json(cls, text: str) -> Mixture:
        d = json.loads(text)
        arrays = [np.array(d[f]) for f in ("weights", "means", "covariances")]
        return cls(d["covariance_type"], *arrays, log_likelihood=d["log_likelihood"], singular=d.get("singular", False))


def _coordinates(points: str, dims: int) -> list[Column]:
    """The array as plain double columns, which reach Python as NumPy blocks."""
    return [F.get(points, F.lit(i)).alias(f"x{i}") for i in range(dims)]


def fit_mixture(
    df: DataFrame,
    k: int,
    covariance_type: str = "full",
    *,
    points: str = "point",
    reg_covar: float = 1e-6,
    max_iter: int = 100,
    tol: float = 1e-3,
    seed: int = 42,
) -> Mixture:
    """Expectation maximisation from a k-means start over the array column ``points``.

    Equal points are merged first; the distinct ones are scanned once per iteration.
    """
    if covariance_type not in COVARIANCES:
        raise ValueError(f"unknown covariance type {covariance_type!r}, expected one of {COVARIANCES}")
    weight = [WEIGHT] if WEIGHT in df.columns else []
    merged = merge_points(df.select(array_to_vector(F.col(points)).alias("__v"), *weight), "__v")
    start = KMeans(k=k, seed=seed, featuresCol="__v", predictionCol="__c", weightCol=WEIGHT).fit(merged)
    df, _ = as_blocks(merged, "__v")
    centers = np.array(start.clusterCenters())
    k = len(centers)
    origin = centers.mean(axis=0)
    sums = _sums(df, k, origin, centers=centers)
    mixture = _maximise(sums, covariance_type, reg_covar, origin)
    history: list[float] = []
    for _ in range(max_iter):
        sums = _sums(df, k, origin, mixture=mixture)
        history.append(sums[3])
        mixture.log_likelihood = sums[3]
        if len(history) > 1 and abs(history[-1] - history[-2]) < tol:
            mixture.converged = True
            break
        mixture = _maximise(sums, covariance_type, reg_covar, origin)
        mixture.log_likelihood = history[-1]
    mixture.history = tuple(history)
    return mixture


def _sums(df, k, origin, *, mixture: Mixture | None = None, centers: np.ndarray | None = None):
    """``(n, sum x, sum xx', mean log-likelihood)``, with x taken from ``origin``."""
    d = len(origin)
    pairs = np.triu_indices(d)
    width = 1 + d + len(pairs[0])
    rows = max(64, WORK // max(width, k))

    def partial(batches):
        total = np.zeros((k, 2 + width))
        if mixture is not None:
            lowers = [np.linalg.cholesky(c) for c in mixture.covariances]
            roots = [np.linalg.inv(lower) for lower in lowers]
            middles = [(m - origin)[:, None] for m in mixture.means]
            heights = np.array([-np.log(np.diag(lower)).sum() for lower in lowers]) - 0.5 * d * math.log(2 * math.pi) + np.log(mixture.weights)
        for all_x, all_w in blocks(batches, d):
            for at in range(0, len(all_x), rows):
                x, w = all_x[at : at + rows], all_w[at : at + rows]
                y = np.ascontiguousarray((x - origin).T)
                p = np.empty((k, len(w)))
                if mixture is None:
                    p[:] = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1) == np.arange(k)[:, None]
                else:
                    for j in range(k):
                        z = roots[j] @ (y - middles[j])
                        z *= z
                        z.sum(axis=0, out=p[j])
                    p *= -0.5
                    p += heights[:, None]
                    top = p.max(axis=0)
                    p -= top
                    np.exp(p, out=p)
                    norm = p.sum(axis=0)
                    p /= norm
                    total[0, 0] += w @ (top + np.log(norm))
                p *= w
                total[0, 1] += w.sum()
                total[:, 2:] += p @ np.vstack([np.ones((1, len(w))), y, y[pairs[0]] * y[pairs[1]]]).T
        return total

    flat = task_sums(df, partial, (k, 2 + width))
    ll, count = flat[0, :2]
    squares = np.zeros((k, d, d))
    squares[:, pairs[0], pairs[1]] = squares[:, pairs[1], pairs[0]] = flat[:, 3 + d :]
    return flat[:, 2], flat[:, 3 : 3 + d], squares, float(ll / count), int(count)


def _maximise(sums, covariance_type: str, reg_covar: float, origin: np.ndarray) -> Mixture:
    n, s, ss, _, rows = sums
    k, d = s.shape
    n = n + 10 * np.finfo(float).eps
    centre = s / n[:, None]
    scatter = ss / n[:, None, None] - centre[:, :, None] * centre[:, None, :]
    if covariance_type == "tied":
        shared = (scatter * n[:, None, None]).sum(axis=0) / n.sum()
        cov = np.repeat(shared[None], k, axis=0)
    elif covariance_type == "diag":
        cov = np.stack([np.diag(np.diag(c)) for c in scatter])
    elif covariance_type == "spherical":
        cov = np.stack([np.eye(d) * np.trace(c) / d for c in scatter])
    else:
        cov = scatter
    cov = cov + reg_covar * np.eye(d)
    return Mixture(covariance_type, n / n.sum(), centre + origin, cov)


def _root(covariance: np.ndarray) -> tuple[np.ndarray, float]:
    """Directions that vary, scaled to variance one, and minus half the log of their determinant."""
    values, vectors = np.linalg.eigh(covariance)
    kept = values > EPSILON * values.max() * len(values)
    if not values.max() > 0:
        raise ValueError("a component without any variance; the mixture has no density")
    return vectors * np.where(kept, 1 / np.sqrt(np.where(kept, values, 1.0)), 0.0), -0.5 * float(np.log(values[kept]).sum())


def fit_random_starts(merged: DataFrame, vector: str, k: int, seeds: Sequence[int], *, max_iter: int = 100, tol: float = 1e-3) -> Mixture:
    """Full mixture without regularisation, best of several random starts by likelihood, the first one on ties.

    Spark's estimator without iterations draws the starts; iterations follow
    its rules: a start ends when its log-likelihood changes by no more than
    ``tol``. Unlike there, one job per iteration serves all starts. A start
    whose component falls together into one point is left out.
    """
    points, _ = as_blocks(merged, vector)
    mixtures, history = {}, {i: [float("-inf")] for i in range(len(seeds))}
    for i, seed in enumerate(seeds):
        drawn = GaussianMixture(k=k, maxIter=0, seed=seed, featuresCol=vector, weightCol=WEIGHT).fit(merged)
        parts = drawn.gaussiansDF.collect()
        means, covariances = (np.stack([f(r) for r in parts]) for f in (lambda r: r["mean"].toArray(), lambda r: r["cov"].toArray()))
        mixtures[i] = Mixture("full", np.array(drawn.weights), means, covariances, singular=True)
    origin = np.vstack([m.means for m in mixtures.values()]).mean(axis=0)
    moving = list(mixtures)
    for _ in range(max_iter):
        moving = [i for i in moving if all(c.any() for c in mixtures[i].covariances)]
        if not moving:
            break
        found = _start_sums(points, origin, [mixtures[i] for i in moving])
        still = []
        for i, (n, s, ss, likelihood) in zip(moving, found):
            centre = s / n[:, None]
            covariances = ss / n[:, None, None] - centre[:, :, None] * centre[:, None, :]
            history[i].append(likelihood)
            done = abs(history[i][-1] - history[i][-2]) <= tol
            mixtures[i] = Mixture("full", n / n.sum(), centre + origin, covariances, likelihood, tuple(history[i][1:]), done, True)
            if not done:
                still.append(i)
        moving = still
    usable = [m for m in mixtures.values() if m.history and all(np.linalg.eigvalsh(c).max() > 0 for c in m.covariances)]
    if not usable:
        raise ValueError(f"no start of {len(seeds)} keeps {k} components with any variance")
    return max(usable, key=lambda m: m.log_likelihood)


def _start_sums(points: DataFrame, origin: np.ndarray, starts: Sequence[Mixture]) -> list[tuple]:
    """``(n, sum x, sum xx', log-likelihood)`` of each start, with x taken from ``origin``: one job for all."""
    d, k, wide = len(origin), starts[0].k, len(starts)
    # The first component of all starts, then the second one, so that sums over components add whole slices.
    every = [(m, j) for j in range(k) for m in starts]
    roots, heights = zip(*[_root(m.covariances[j]) for m, j in every])
    roots = np.ascontiguousarray(np.stack(roots).transpose(2, 0, 1))
    shifts = np.einsum("jd,cjd->cj", np.array([m.means[j] - origin for m, j in every]), roots)[:, :, None]
    heights = (np.array(heights) - 0.5 * d * math.log(2 * math.pi) + np.log([m.weights[j] for m, j in every]))[:, None]
    pairs = np.triu_indices(d)
    width = 1 + d + len(pairs[0])
    rows = max(64, WORK // max(width, len(every)))

    def partial(batches):
        total = np.zeros((len(every), width + 1))
        for all_x, all_w in blocks(batches, d):
            for at in range(0, len(all_x), rows):
                y, w = np.ascontiguousarray((all_x[at : at + rows] - origin).T), all_w[at : at + rows]
                p = np.zeros((len(every), len(w)))
                for root, shift in zip(roots, shifts):
                    z = root @ y
                    z -= shift
                    z *= z
                    p += z
                p *= -0.5
                p += heights
                np.exp(p, out=p)
                p += EPSILON
                split = p.reshape(k, wide, len(w))
                norm = split.sum(axis=0)
                total[:wide, 0] += np.log(norm) @ w
                split *= w / norm
                total[:, 1:] += p @ np.vstack([np.ones((1, len(w))), y, y[pairs[0]] * y[pairs[1]]]).T
        return total

    flat = task_sums(points, partial, (len(every), width + 1))
    out = []
    for i in range(wide):
        own = flat[i::wide]
        squares = np.zeros((k, d, d))
        squares[:, pairs[0], pairs[1]] = squares[:, pairs[1], pairs[0]] = own[:, 2 + d :]
        out.append((own[:, 1], own[:, 2 : 2 + d], squares, float(flat[i, 0])))
    return out


def parameter_table(df: DataFrame, mixture: Mixture, features: Sequence[str]) -> DataFrame:
    rows = []
    for j in range(mixture.k):
        for i, f in enumerate(features):
            rows.append((j, float(mixture.weights[j]), f, float(mixture.means[j, i]), float(mixture.covariances[j, i, i])))
    return df.sparkSession.createDataFrame(rows, "cluster int, weight double, feature string, mean double, variance double")
