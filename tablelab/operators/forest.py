"""One-column isolation forests, fitted on bounded subsamples drawn by Spark.

On one column an isolation tree is a step function of the value, so a whole
forest is one sorted list of breakpoints with a score each. Scoring a row is a
binary search in that list, done by a built-in expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import long_form, number, ref
from tablelab.functions.ordering import insertion_point, number_array

EULER_GAMMA = 0.5772156649015329
AUTO_OFFSET = 0.5
OVERDRAW = 1.3
POOL_FACTOR = 2.0


def mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search among ``n`` values (Liu, Ting, Zhou 2008)."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


@dataclass
class ForestFit:
    column: str
    n: int
    breaks: list[float]
    scores: list[float]
    offset: float = AUTO_OFFSET
    outliers: int = 0
    score_stats: dict = field(default_factory=dict)

    def step(self, value: Column) -> Column:
        return insertion_point(value, number_array(self.breaks), len(self.breaks))

    def score(self, value: Column) -> Column:
        """Anomaly score in (0, 1), higher is more anomalous; NULL for NULL."""
        return F.when(value.isNotNull(), F.get(number_array(self.scores), self.step(value)))

    def flag(self, value: Column) -> Column:
        """Outlier test, as membership in the flagged value intervals."""
        marks = [s > self.offset for s in self.scores]
        edges = [b for b, was, now in zip(self.breaks, marks, marks[1:]) if was != now]
        odd = insertion_point(value, number_array(edges), len(edges)) % 2 == (0 if marks[0] else 1)
        return F.coalesce(odd & value.isNotNull(), F.lit(False))


def _tree_steps(values: np.ndarray, rng: np.random.Generator, depth_limit: int) -> list[tuple[float, float]]:
    """Leaves of one random tree, left to right, as ``(start of interval, path length)``."""
    values = np.sort(values)
    leaves: list[tuple[float, float]] = []
    stack = [(0, len(values), 0, -math.inf)]
    while stack:
        first, last, depth, start = stack.pop()
        size = last - first
        if size <= 1 or depth >= depth_limit or values[first] == values[last - 1]:
            leaves.append((start, depth + mean_path(size)))
            continue
        cut = rng.uniform(values[first], values[last - 1])
        middle = int(np.searchsorted(values, cut, side="right"))
        middle = min(max(middle, first + 1), last - 1)
        right_start = float(np.nextafter(max(cut, values[middle - 1]), math.inf))
        stack.append((middle, last, depth + 1, right_start))
        stack.append((first, middle, depth + 1, start))
    return leaves


def fit_forest(
    df: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    *,
    n_estimators: int = 100,
    max_samples: float | str = "auto",
    contamination: float | str = "auto",
    seed: int = 42,
) -> list[ForestFit]:
    """Fit one forest per column. ``key`` identifies rows, so the draw is repeatable."""
    columns = list(columns)
    counts = df.agg(*[F.count(number(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    n = {c: counts[f"n{i}"] for i, c in enumerate(columns)}
    columns = [c for c in columns if n[c] > 0]
    if not columns:
        return []
    wanted = {c: _sample_size(max_samples, n[c]) for c in columns}
    sampled = _draw(df, columns, key, n, wanted, n_estimators, seed)

    def grow(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        column, tree = group
        take = wanted[column]
        values = rows.nsmallest(take, ["draw", "value"])["value"].to_numpy()
        rng = np.random.default_rng([seed, columns.index(column), int(tree)])
        leaves = _tree_steps(values, rng, math.ceil(math.log2(max(take, 2))))
        starts = [x for x, _ in leaves]
        paths = np.array([p for _, p in leaves])
        return pd.DataFrame({"column": column, "start": starts, "change": np.diff(paths, prepend=0.0)})

    # At most ``max_samples`` leaves per tree reach the driver.
    leaves = sampled.groupBy("column", "tree").applyInPandas(grow, "column string, start double, change double").collect()
    changes: dict[str, dict[float, list[float]]] = {c: {} for c in columns}
    for leaf in leaves:
        changes[leaf["column"]].setdefault(leaf["start"], []).append(leaf["change"])
    fits = []
    for c in columns:
        # Exact sums, so that the order in which tasks finish leaves no trace.
        mine = sorted((start, math.fsum(parts)) for start, parts in changes[c].items())
        depth = np.cumsum([d for _, d in mine]) / n_estimators
        scale = mean_path(wanted[c]) or 1.0
        fits.append(ForestFit(c, n[c], [float(x) for x, _ in mine[1:]], [float(2.0 ** (-d / scale)) for d in depth]))
    _summarise(df, fits, contamination)
    return fits


def _sample_size(max_samples: float | str, n: int) -> int:
    """Rows per tree: at most 256 for ``auto``, a share of the rows for a float, else the number itself."""
    if max_samples == "auto":
        return min(256, n)
    if isinstance(max_samples, float):
        if not 0 < max_samples <= 1:
            raise ValueError(f"a share of rows lies above 0 and at most at 1, not {max_samples}")
        return max(1, int(max_samples * n))
    if max_samples < 1:
        raise ValueError(f"max_samples must be positive, not {max_samples}")
    return min(int(max_samples), n)


def _draw(df, columns, key, n, wanted, trees, seed) -> DataFrame:
    """Rows ``(column, tree, value, draw)``, about ``OVERDRAW * wanted`` per tree.

    A hash of the row key decides whether a row enters the pool of a column and
    which trees get it. The number drawn does not depend on the table size.
    """
    cells = {}
    for i, c in enumerate(columns):
        share = min(1.0, POOL_FACTOR * trees * wanted[c] / n[c])
        copies = min(float(trees), OVERDRAW * wanted[c] * trees / (share * n[c]))
        mixed = F.xxhash64(*[ref(k) for k in key], F.lit(seed), F.lit(i))
        draw = F.pmod(mixed, F.lit(1 << 30)) / float(1 << 30)
        chosen = F.when(draw < share, number(df, c))
        cells[c] = F.struct(chosen.alias("x"), mixed.alias("h"), F.lit(copies).alias("copies"))
    strides = [s for s in range(1, trees + 1) if math.gcd(s, trees) == 1]
    h = F.col("value.h")
    rows = long_form(df, cells).where(F.col("value.x").isNotNull())
    extra = F.pmod(F.xxhash64(h, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    times = F.floor("value.copies") + F.when(extra < F.col("value.copies") % 1, 1).otherwise(0)
    stride = F.get(F.array(*[F.lit(s) for s in strides]), F.pmod(F.xxhash64(h, F.lit("stride")), F.lit(len(strides))).cast("int"))
    start = F.pmod(F.xxhash64(h, F.lit("tree")), F.lit(trees))
    spread = F.transform(
        F.sequence(F.lit(0), (times - 1).cast("int")), lambda j: F.pmod(start + j * stride, F.lit(trees)).cast("int")
    )
    return (
        rows.where(times >= 1)
        .select("column", F.col("value.x").alias("x"), h.alias("h"), F.explode(spread).alias("tree"))
        .select("column", "tree", F.col("x").alias("value"), F.xxhash64("h", "tree").alias("draw"))
    )


def _summarise(df: DataFrame, fits: Sequence[ForestFit], contamination) -> None:
    """Outlier counts and score statistics from one count of rows per step."""
    breaks = {f.column: np.array(f.breaks) for f in fits}

    def partial(batches):
        counts = {c: np.zeros(len(b) + 1, dtype="int64") for c, b in breaks.items()}
        for batch in batches:
            for c, b in breaks.items():
                v = batch[c].to_numpy(dtype=float)
                counts[c] += np.bincount(np.searchsorted(b, v[~np.isnan(v)], side="right"), minlength=len(b) + 1)
        for c, n in counts.items():
            used = np.flatnonzero(n)
            yield pd.DataFrame({"column": c, "step": used.astype("int32"), "n": n[used]})

    parts = df.select(*[number(df, c).alias(c) for c in breaks]).mapInPandas(partial, "column string, step int, n bigint")
    counted = parts.groupBy("column", "step").agg(F.sum("n").alias("n")).collect()
    for f in fits:
        mine = [(f.scores[r["step"]], r["n"]) for r in counted if r["column"] == f.column]
        score = np.array([s for s, _ in mine])
        weight = np.array([w for _, w in mine], dtype=float)
        order = np.argsort(score)
        score, weight = score[order], weight[order]
        if contamination != "auto":
            f.offset = _weighted_quantile(score, weight, 1.0 - float(contamination))
        mean = float(np.average(score, weights=weight))
        f.outliers = int(weight[score > f.offset].sum())
        f.score_stats = {
            "min": float(score.min()),
            "max": float(score.max()),
            "mean": mean,
            "std": float(math.sqrt(np.average((score - mean) ** 2, weights=weight))),
        }


def _weighted_quantile(sorted_values: np.ndarray, counts: np.ndarray, prob: float) -> float:
    ends = np.cumsum(counts)
    position = (ends[-1] - 1) * prob
    low = sorted_values[np.searchsorted(ends, math.floor(position), side="right")]
    high = sorted_values[np.searchsorted(ends, min(math.floor(position) + 1, ends[-1] - 1), side="right")]
    return float(low + (high - low) * (position - math.floor(position)))
