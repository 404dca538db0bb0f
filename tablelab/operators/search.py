"""Comparing and tuning clusterings: a driver loop over Spark jobs on one frame."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial
from itertools import product

import numpy as np
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.operators.centres import WEIGHT, merge_points
from tablelab.operators.cluster import LABEL, Clustering, fit_algorithm
from tablelab.operators.quality import MODES, cluster_metrics, merged_metrics, points_from_vector
from tablelab.session import in_parallel, materialise

PARALLELISM = 4
#: What a parameter set that does not fit the algorithm or the data raises.
PARAMETER_ERRORS = (ValueError, TypeError, ArithmeticError, np.linalg.LinAlgError, IllegalArgumentException)
HIGHER_IS_BETTER = {"silhouette": True, "calinski_harabasz": True, "davies_bouldin": False}

# The default search space of each algorithm.
SPACES = {
    "kmeans": {
        "n_clusters": {"type": "int", "low": 2, "high": 10},
        "init": {"type": "categorical", "choices": ["k-means++", "random"]},
        "n_init": {"type": "int", "low": 5, "high": 20},
        "max_iter": {"type": "int", "low": 100, "high": 500},
    },
    "gmm": {
        "n_components": {"type": "int", "low": 2, "high": 10},
        "covariance_type": {"type": "categorical", "choices": ["full", "tied", "diag", "spherical"]},
        "max_iter": {"type": "int", "low": 50, "high": 200},
        "reg_covar": {"type": "float", "low": 1e-6, "high": 1e-1, "log": True},
    },
    "agglo": {
        "n_clusters": {"type": "int", "low": 2, "high": 10},
        "linkage": {"type": "categorical", "choices": ["ward", "complete", "average", "single"]},
        "affinity": {"type": "categorical", "choices": ["euclidean", "l1", "l2", "manhattan", "cosine"]},
    },
}

TRIAL_SCHEMA = (
    "trial int, algorithm string, params map<string,string>, silhouette double, davies_bouldin double, "
    "calinski_harabasz double, n_clusters bigint, silhouette_mode string, error string"
)


@dataclass
class Trial:
    number: int
    algorithm: str
    params: dict
    metrics: dict = field(default_factory=dict)
    clustering: Clustering | None = None
    error: str | None = None


@dataclass
class Search:
    trials: list[Trial]
    metric: str

    def best(self) -> Trial:
        """Best trial by the metric, the first one on ties."""
        done = [t for t in self.trials if t.clustering is not None]
        if not done:
            raise ValueError("no trial succeeded: " + "; ".join(t.error or "" for t in self.trials))
        sign = -1 if HIGHER_IS_BETTER[self.metric] else 1
        return min(done, key=lambda t: (sign * t.metrics[self.metric], t.number))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = []
        for t in self.trials:
            values = [t.metrics.get(x) for x in ("silhouette", "davies_bouldin", "calinski_harabasz", "n_clusters", "silhouette_mode")]
            rows.append((t.number, t.algorithm, {k: str(v) for k, v in t.params.items()}, *values, t.error))
        return spark.createDataFrame(rows, TRIAL_SCHEMA)

    def by_clusters(self, spark: SparkSession) -> DataFrame:
        """Best value of the metric per algorithm and number of clusters."""
        pick = F.max if HIGHER_IS_BETTER[self.metric] else F.min
        done = self.table(spark).where(F.col("error").isNull())
        return done.groupBy("algorithm", "n_clusters").agg(pick(self.metric).alias(self.metric)).orderBy("algorithm", "n_clusters")

    def metrics_by_clusters(self, spark: SparkSession) -> DataFrame:
        """Best value of each of the three metrics per algorithm and number of clusters."""
        done = self.table(spark).where(F.col("error").isNull())
        best = [(F.max if up else F.min)(name).alias(name) for name, up in HIGHER_IS_BETTER.items()]
        return done.groupBy("algorithm", "n_clusters").agg(*best).orderBy("algorithm", "n_clusters")


def grid(options: dict[str, Sequence]) -> list[dict]:
    """Cross product of parameter lists."""
    names = list(options)
    return [dict(zip(names, values)) for values in product(*[options[n] for n in names])]


def run_trials(
    df: DataFrame,
    todo: Sequence[tuple[str, dict]],
    *,
    key: Sequence[str],
    metric: str = "silhouette",
    mode: str = "squared",
    seed: int = 42,
    vector: str = "features",
    first_number: int = 0,
    require_two: bool = False,
    parallelism: int = PARALLELISM,
    merged: DataFrame | None = None,
) -> Search:
    """Fit and measure each ``(algorithm, params)``; a failed one is kept with its message.

    ``parallelism`` trials submit their jobs side by side, so that the short
    stages of one fit fill the gaps of another. Equal points are merged once for
    all trials (``merged`` if that is done); what needs the rows themselves (exact single linkage, Euclidean
    silhouettes) takes ``df``.
    """
    if metric not in HIGHER_IS_BETTER:
        raise ValueError(f"unknown metric {metric!r}, expected one of {tuple(HIGHER_IS_BETTER)}")

    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    merged = merge_points(df, vector) if merged is None else merged

    def attempt(number: int, algorithm: str, params: dict) -> Trial:
        trial = Trial(number, algorithm, params)
        try:
            clustering = fit_algorithm(df if algorithm == "single_linkage" else merged, algorithm, params, seed=seed, vector=vector)
            if mode == "squared":
                trial.metrics = merged_metrics(clustering.transform(merged), vector, LABEL, WEIGHT)
            else:
                trial.metrics = cluster_metrics(points_from_vector(clustering.transform(df), vector, LABEL, key), mode=mode)
            if require_two and trial.metrics["n_clusters"] < 2:
                trial.error = "one cluster"
            else:
                trial.clustering = clustering
        except PARAMETER_ERRORS as problem:  # one bad parameter set must not end the search; a failed job must
            trial.error = f"{type(problem).__name__}: {str(problem).splitlines()[0][:300]}"
        return trial

    tasks = [partial(attempt, first_number + i, algorithm, params) for i, (algorithm, params) in enumerate(todo)]
    return Search(in_parallel(tasks, parallelism), metric)


def compare_clusterings(
    df: DataFrame, algorithms: dict[str, dict[str, Sequence]], *, key: Sequence[str], ready: bool = False, **options
) -> Search:
    """All grid points of all algorithms on one materialised frame (``ready`` if it is one)."""
    todo = [(name, params) for name, lists in algorithms.items() for params in grid(lists)]
    return run_trials(df if ready else materialise(df, key), todo, key=key, **options)


def draw_params(space: dict, rng: np.random.Generator) -> dict:
    out = {}
    for name, spec in space.items():
        if spec["type"] == "int":
            out[name] = int(rng.integers(spec["low"], spec["high"] + 1))
        elif spec["type"] == "categorical":
            out[name] = spec["choices"][int(rng.integers(len(spec["choices"])))]
        elif spec.get("log"):
            out[name] = float(math.exp(rng.uniform(math.log(spec["low"]), math.log(spec["high"]))))
        else:
            out[name] = float(rng.uniform(spec["low"], spec["high"]))
    return out


def tune_random(
    df: DataFrame,
    algorithm: str,
    *,
    key: Sequence[str],
    n_trials: int = 50,
    space: dict | None = None,
    seed: int = 42,
    ready: bool = False,
    **options,
) -> Search:
    """Seeded random draws from a typed space, judged by silhouette."""
    rng = np.random.default_rng(seed)
    chosen = space or SPACES[algorithm]
    todo = [(algorithm, draw_params(chosen, rng)) for _ in range(n_trials)]
    return run_trials(df if ready else materialise(df, key), todo, key=key, seed=seed, require_two=True, **options)


def space_grid(space: dict, n_trials: int) -> dict[str, list]:
    """Lists for a full grid: integer ranges get a step, floats an even spacing."""
    out = {}
    for name, spec in space.items():
        if spec["type"] == "int":
            step = max(1, (spec["high"] - spec["low"]) // min(n_trials, 5))
            out[name] = list(range(spec["low"], spec["high"] + 1, step))
        elif spec["type"] == "categorical":
            out[name] = list(spec["choices"])
        elif spec.get("log"):
            out[name] = [float(x) for x in np.geomspace(spec["low"], spec["high"], min(5, n_trials))]
        else:
            out[name] = [float(x) for x in np.linspace(spec["low"], spec["high"], min(5, n_trials))]
    return out


def tune_grid(
    df: DataFrame,
    algorithm: str,
    *,
    key: Sequence[str],
    n_trials: int = 50,
    space: dict | None = None,
    ready: bool = False,
    **options,
) -> Search:
    """The full grid over the space; one-cluster results do not count."""
    lists = space_grid(space or SPACES[algorithm], n_trials)
    todo = [(algorithm, p) for p in grid(lists)]
    return run_trials(df if ready else materialise(df, key), todo, key=key, require_two=True, **options)
