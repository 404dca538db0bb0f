"""Fitting clusterings and putting labels on rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import number, ref
from tablelab.operators.centres import WEIGHT, best_centres, merge_points
from tablelab.operators.hierarchy import merge_centres
from tablelab.operators.linkage import link_points
from tablelab.operators.mixture import Mixture, fit_mixture, fit_random_starts

# Names of the start rules and what the Spark estimator calls them.
INIT_MODES = {"k-means++": "k-means||", "k-means||": "k-means||", "random": "random"}
LABEL = "prediction"
MICRO_CLUSTERS = 200


@dataclass
class Clustering:
    """A fitted model over the vector column ``vector`` and the numbering of its labels.

    ``relabel[i]`` is the published label of raw cluster ``i``: by size
    descending, then centre, so that equal groupings get equal labels.
    """

    algorithm: str
    params: dict
    model: object
    relabel: list[int]
    vector: str = "features"
    details: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, label: str = LABEL) -> DataFrame:
        if isinstance(self.model, Mixture):
            with_point = df.withColumn("__point", vector_to_array(ref(self.vector)))
            raw = self.model.assign(with_point, "__point", "__raw").drop("__point")
        else:
            raw = self.model.transform(df).drop("__probability")
        code = F.get(F.array(*[F.lit(i) for i in self.relabel]), F.col("__raw"))
        return raw.withColumn(label, code).drop("__raw")


def order_labels(centers: np.ndarray, sizes: Sequence[float]) -> list[int]:
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], tuple(centers[i])))
    relabel = [0] * len(order)
    for new, old in enumerate(order):
        relabel[old] = new
    return relabel


def row_counts(model, merged: DataFrame, k: int) -> np.ndarray:
    """Rows of each raw cluster."""
    sizes = np.zeros(k)
    for r in model.transform(merged).groupBy("__raw").agg(F.sum(WEIGHT).alias("n")).collect():
        sizes[r["__raw"]] = r["n"]
    return sizes


def fit_kmeans(
    df: DataFrame,
    k: int,
    *,
    init: str = "k-means++",
    n_init: int = 10,
    max_iter: int = 300,
    tol: float = 1e-4,
    seed: int = 42,
    vector: str = "features",
) -> Clustering:
    """Best of ``n_init`` seeded restarts by within-cluster cost, all in one scan per iteration.

    ``df`` is scanned once, to merge equal points; the restarts scan these.
    """
    if init not in INIT_MODES:
        raise ValueError(f"unknown init {init!r}, expected one of {tuple(INIT_MODES)}")
    if k < 2 or n_init < 1:
        raise ValueError(f"{k} clusters from {n_init} starts; at least 2 clusters and 1 start are needed")
    merged = merge_points(df, vector)
    centers, sums = best_centres(merged, vector, k, [seed + i for i in range(n_init)], INIT_MODES[init], max_iter, tol)
    model = _model_of(df, centers, seed, vector)
    # The model has its own order of the centres.
    found = np.array(model.clusterCenters())
    place = [int(((centers - c) ** 2).sum(axis=1).argmin()) for c in found]
    relabel = order_labels(found, [float(sums.n[i]) for i in place])
    params = {"n_clusters": k, "init": init, "n_init": n_init, "max_iter": max_iter, "tol": tol}
    return Clustering("kmeans", params, model, relabel, vector, {"inertia": sums.cost})


def _model_of(df: DataFrame, centers: np.ndarray, seed: int, vector: str):
    """Spark's model with these centres, which can be saved like any other: each centre is the only point of its cluster."""
    rows = df.sparkSession.createDataFrame([(c.tolist(),) for c in np.unique(centers, axis=0)], "point array<double>")
    estimator = KMeans(k=max(2, len(centers)), initMode="random", maxIter=1, seed=seed, featuresCol=vector, predictionCol="__raw")
    return estimator.fit(rows.select(array_to_vector("point").alias(vector)).coalesce(1))


def fit_bisecting(df: DataFrame, k: int, *, max_iter: int = 20, seed: int = 42, vector: str = "features") -> Clustering:
    """Top-down hierarchical clustering, the form that needs no pair distances."""
    merged = merge_points(df, vector)
    model = BisectingKMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=vector, predictionCol="__raw", weightCol=WEIGHT).fit(merged)
    centers = np.array(model.clusterCenters())
    relabel = order_labels(centers, row_counts(model, merged, len(centers)))
    return Clustering("bisecting", {"n_clusters": k}, model, relabel, vector, {"inertia": model.summary.trainingCost})


def fit_hierarchical(
    df: DataFrame,
    k: int,
    *,
    linkage: str = "ward",
    distance: str = "euclidean",
    micro: int = MICRO_CLUSTERS,
    max_iter: int = 50,
    seed: int = 42,
    vector: str = "features",
) -> Clustering:
    """Bottom-up clustering of micro-clusters.

    Spark's k-means summarises the rows into at most ``micro`` centres; these
    are merged by the linkage, and rows follow their centre. Micro-clusters
    are cosine for ``distance="cosine"``, else Euclidean. For ``average``
    linkage the distance of centres stands for the mean distance of pairs.
    ``micro`` is part of the result's parameters.
    """
    measure = "cosine" if distance == "cosine" else "euclidean"
    merged = merge_points(df, vector)
    if measure == "cosine" and not merged.where(~F.exists(vector_to_array(ref(vector)), lambda x: x != 0)).isEmpty():
        raise ValueError("cosine distance is not defined for rows of zeros")
    model = KMeans(
        k=max(micro, k), maxIter=max_iter, seed=seed, featuresCol=vector, predictionCol="__raw", distanceMeasure=measure, weightCol=WEIGHT
    ).fit(merged)
    centers = np.array(model.clusterCenters())
    sizes = row_counts(model, merged, len(centers))
    groups = merge_centres(centers, np.maximum(sizes, 1), min(k, len(centers)), linkage, distance)
    count = groups.max() + 1
    total = np.array([sizes[groups == g].sum() for g in range(count)])
    middle = np.array([np.average(centers[groups == g], axis=0, weights=np.maximum(sizes[groups == g], 1)) for g in range(count)])
    order = order_labels(middle, total)
    params = {"n_clusters": k, "linkage": linkage, "affinity": distance, "micro": micro}
    return Clustering("agglo", params, model, [order[g] for g in groups], vector, {"micro_clusters": len(centers)})


def fit_single_linkage(
    df: DataFrame, k: int, *, distance: str = "euclidean", seed: int = 42, vector: str = "features", **options
) -> Clustering:
    """Single linkage of all distinct rows, without micro-clusters: the spanning tree cut at its ``k - 1`` longest edges.

    Exact and quadratic where points lie close together, so it is chosen by
    name. Labels cover the fitted points; other points get null. The tree is
    ``model.tree``.
    """
    model, sizes, middles = link_points(df, k, distance=distance, seed=seed, vector=vector, **options)
    params = {"n_clusters": k, "linkage": "single", "affinity": distance}
    return Clustering("single_linkage", params, model, order_labels(middles, sizes), vector, {"points": sum(sizes)})


def fit_gmm(
    df: DataFrame,
    k: int,
    *,
    covariance_type: str = "full",
    reg_covar: float = 1e-6,
    max_iter: int = 100,
    tol: float = 1e-3,
    n_init: int = 1,
    seed: int = 42,
    vector: str = "features",
) -> Clustering:
    """Gaussian mixture of any covariance type, ``reg_covar`` added to the diagonal.

    Best of ``n_init`` seeded starts by likelihood. Labels go by assigned rows.
    """
    points = merge_points(df, vector).select(vector_to_array(ref(vector)).alias("point"), WEIGHT)
    starts = [
        fit_mixture(points, k, covariance_type, reg_covar=reg_covar, max_iter=max_iter, tol=tol, seed=seed + i) for i in range(n_init)
    ]
    mixture = max(starts, key=lambda m: m.log_likelihood)
    params = {
        "n_components": k, "covariance_type": covariance_type, "max_iter": max_iter, "reg_covar": reg_covar, "tol": tol, "n_init": n_init
    }
    details = {"log_likelihood": mixture.log_likelihood, "converged": mixture.converged, "iterations": len(mixture.history)}
    return Clustering("gmm", params, mixture, _by_rows(mixture, points), vector, details)


def _by_rows(mixture: Mixture, points: DataFrame) -> list[int]:
    """Labels of the components, by the rows that go to each."""
    found = mixture.assign(points, "point", "__raw").groupBy("__raw").agg(F.sum(WEIGHT).alias("n")).collect()
    sizes = {r["__raw"]: r["n"] for r in found}
    return order_labels(mixture.means, [sizes.get(i, 0) for i in range(mixture.k)])


#: Random starts of Spark's mixture estimator.
STARTS = 8


def fit_gmm_builtin(
    df: DataFrame, k: int, *, max_iter: int = 100, tol: float = 1e-3, n_init: int = STARTS, seed: int = 42, vector: str = "features"
) -> Clustering:
    """The mixture of Spark's estimator: full covariance, random starts, no regularisation term.

    A poor start leaves groups together: the best of ``n_init`` by likelihood
    is kept. All starts share one scan of the distinct points per iteration.
    """
    merged = merge_points(df, vector)
    mixture = fit_random_starts(merged, vector, k, [seed + i for i in range(n_init)], max_iter=max_iter, tol=tol)
    points = merged.select(vector_to_array(ref(vector)).alias("point"), WEIGHT)
    params = {"n_components": k, "covariance_type": "full", "max_iter": max_iter, "n_init": n_init}
    return Clustering("gmm_builtin", params, mixture, _by_rows(mixture, points), vector, {"log_likelihood": mixture.log_likelihood})


# Parameter names of the grids, per algorithm, and the fit that takes them.
FITS = {
    "kmeans": (fit_kmeans, {"n_clusters": "k"}),
    "gmm": (fit_gmm, {"n_components": "k"}),
    "gmm_builtin": (fit_gmm_builtin, {"n_components": "k"}),
    "agglo": (fit_hierarchical, {"n_clusters": "k", "affinity": "distance"}),
    "bisecting": (fit_bisecting, {"n_clusters": "k"}),
    "single_linkage": (fit_single_linkage, {"n_clusters": "k", "affinity": "distance"}),
}


def fit_algorithm(df: DataFrame, algorithm: str, params: dict, *, seed: int = 42, vector: str = "features") -> Clustering:
    if algorithm not in FITS:
        raise ValueError(f"unknown algorithm {algorithm!r}, expected one of {tuple(FITS)}")
    fit, names = FITS[algorithm]
    return fit(df, **{names.get(p, p): v for p, v in params.items()}, seed=seed, vector=vector)


def nearest_center(df: DataFrame, features: Sequence[str], centers: dict, label: str = LABEL) -> DataFrame:
    """Label each row with the nearest of given centres, the first one on ties.

    The centres are literals of the projection: no join and no shuffle.
    """
    ordered = sorted(centers)
    gaps = []
    for i, name in enumerate(ordered):
        total: Column = F.lit(0.0)
        for f, x in zip(features, centers[name]):
            total = total + (number(df, f) - F.lit(float(x))) * (number(df, f) - F.lit(float(x)))
        gaps.append(F.struct(total.alias("gap"), F.lit(i).alias("i")))
    place = F.array_min(F.array(*gaps))["i"]
    return df.withColumn(label, F.get(F.array(*[F.lit(n) for n in ordered]), place))


