"""Clustering quality over labelled points.

Rows come as ``(key..., label, point array<double>)``, see :func:`points`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import number, ref
from tablelab.operators import boxes
from tablelab.session import in_parallel, materialise

MAX_LABELS = 10_000
CELL_ROWS = 4096
#: Larger tables get larger stripes, up to so many rows and doubles: sums leave a cell once per row, so fewer cells move less.
LARGEST_STRIPE, STRIPE_DOUBLES, STRIPES = 32_768, 1 << 21, 24
#: Rows and columns of pairs held at once, small enough for a processor's cache.
TILE = (64, 1024)
#: From so many features on, distances come from a matrix product, in tiles of their own.
PRODUCT_DIMS, PRODUCT_TILE = 8, (128, 256)
#: Tasks that share the cells: many more than cores, so that one with several cells doesn't end last.
CELL_TASKS = 400
#: From so many rows of few features on, importance sums its distances by boxes of near points.
BOX_ROWS = 50_000
MODES = ("squared", "euclidean")
CHUNK = 256


def points(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str]) -> DataFrame:
    cells = F.array(*[number(df, f) for f in features])
    return _labelled(df, key, label, cells)


def points_from_vector(df: DataFrame, vector: str, label: str, key: Sequence[str]) -> DataFrame:
    return _labelled(df, key, label, vector_to_array(ref(vector)))


def points_from_array(df: DataFrame, column: str, label: str, key: Sequence[str]) -> DataFrame:
    return _labelled(df, key, label, ref(column).cast("array<double>"))


def _labelled(df: DataFrame, key: Sequence[str], label: str, cells: Column) -> DataFrame:
    """One ``id`` column from the key, so that partial sums can be added per row."""
    parts = [ref(k) for k in key]
    # JSON of the named parts: it leaves NULL parts out by name, so ('a', NULL) and (NULL, 'a') differ.
    row_id = parts[0] if len(parts) == 1 else F.to_json(F.struct(*[p.cast("string").alias(f"k{i}") for i, p in enumerate(parts)]))
    return df.where(ref(label).isNotNull()).select(row_id.alias("id"), ref(label).alias("label"), cells.alias("point"))


@dataclass
class Moments:
    labels: list
    n: np.ndarray
    mean: np.ndarray
    var: np.ndarray

    @property
    def k(self) -> int:
        return len(self.labels)


def cluster_moments(pts: DataFrame, dims: int | None = None) -> Moments:
    """Size, mean and population variance per label: one combining aggregate."""
    if dims is None:
        dims = pts.agg(F.max(F.size("point"))).first()[0] or 0
    cells = [F.get("point", F.lit(i)) for i in range(dims)]
    table = pts.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in cells]).alias("mean"),
        F.array(*[F.var_pop(c) for c in cells]).alias("var"),
    )
    rows = table.limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels; a clustering metric needs a cluster label")
    rows.sort(key=lambda r: r["label"])
    return Moments(
        [r["label"] for r in rows],
        np.array([r["n"] for r in rows], dtype=float),
        np.array([r["mean"] for r in rows], dtype=float).reshape(len(rows), dims),
        np.array([r["var"] for r in rows], dtype=float).reshape(len(rows), dims),
    )


def _with_index(pts: DataFrame, m: Moments, *, centers: bool = False) -> DataFrame:
    """Add ``c`` (0..k-1) and, if asked, the centre of the row's own cluster."""
    rows = [(label, i, m.mean[i].tolist()) for i, label in enumerate(m.labels)]
    kind = pts.schema["label"].dataType.simpleString()
    table = pts.sparkSession.createDataFrame(rows, f"label {kind}, c int, center array<double>")
    joined = pts.join(F.broadcast(table), "label")
    return joined if centers else joined.drop("center")


def calinski_harabasz(m: Moments) -> float:
    if m.k < 2:
        return 0.0
    total = m.n.sum()
    middle = (m.n[:, None] * m.mean).sum(axis=0) / total
    between = float((m.n[:, None] * (m.mean - middle) ** 2).sum())
    within = float((m.n[:, None] * m.var).sum())
    return 1.0 if within == 0 else float(between * (total - m.k) / (within * (m.k - 1)))


def davies_bouldin(pts: DataFrame, m: Moments) -> float:
    if m.k < 2:
        return math.inf
    gap = F.aggregate(
        F.zip_with("point", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x
    )
    spread_rows = _with_index(pts, m, centers=True).groupBy("c").agg(F.avg(F.sqrt(gap)).alias("s")).collect()
    spread = np.zeros(m.k)
    for r in spread_rows:
        spread[r["c"]] = r["s"]
    return _worst_ratios(m, spread)


def _worst_ratios(m: Moments, spread: np.ndarray) -> float:
    worst = np.zeros(m.k)
    apart_any = False
    for i in range(m.k):
        apart = np.sqrt(((m.mean - m.mean[i]) ** 2).sum(axis=1))
        apart_any = apart_any or bool((apart > 0).any())
        apart[apart == 0] = np.inf
        ratio = (spread + spread[i]) / apart
        ratio[i] = 0.0
        worst[i] = ratio.max()
    if not apart_any or np.allclose(spread, 0):
        return 0.0
    return float(worst.mean())


def _pair_sums(pts: DataFrame, m: Moments, drop_features: bool, cell_rows: int) -> DataFrame:
    """Weighted distance sums from every distinct point to every cluster.

    Equal points of one cluster are merged first. Points are hashed into
    stripes of about ``cell_rows``; each unordered pair of stripes is one task
    group, which returns only sums per point and cluster, never pairs. Distance
    is symmetric, so a cell serves both of its stripes. Hashing the row key,
    not the label, keeps stripes even when one cluster holds most rows.

    Columns: ``id, c, w, variant, s0..s(k-1)``. Variant -1 uses all features,
    variant f leaves feature f out.
    """
    k, dims = m.k, m.mean.shape[1]
    distinct = (
        _with_index(pts, m).groupBy("point", "c").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("id"))
    )
    rows = int(m.n.sum())
    if rows > cell_rows:
        distinct = materialise(distinct)
        rows = distinct.count()
    largest = min(LARGEST_STRIPE, max(1, STRIPE_DOUBLES // max(dims, 1)))
    stripes = max(1, math.ceil(rows / max(cell_rows, min(largest, math.ceil(rows / STRIPES)))))
    stripe = F.pmod(F.xxhash64("id"), F.lit(stripes))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stripes - 1).cast("long")))
    spread = distinct.withColumn("stripe", stripe).withColumn("other", other)
    cell = F.least("stripe", "other") * F.lit(stripes) + F.greatest("stripe", "other")
    variants = [-1, *range(dims)] if drop_features else [-1]
    origin = (m.n[:, None] * m.mean).sum(axis=0) / m.n.sum()

    def cell_sums(rows: pd.DataFrame) -> pd.DataFrame:
        low = rows["stripe"].min()
        left = rows[rows["stripe"] == low]
        right = rows[rows["stripe"] != low]
        # A cell of two stripes may have drawn rows from one of them only.
        alone = len(right) == 0
        if alone and int(rows["other"].iloc[0]) != int(low):
            none = rows.iloc[:0][["id", "c", "w"]]
            return none.assign(variant=pd.Series([], dtype="int32"), sums=pd.Series([], dtype=object))
        a = np.stack(left["point"].to_list()) - origin
        b = a if alone else np.stack(right["point"].to_list()) - origin
        to_a = _memberships(left, k)
        to_b = to_a if alone else _memberships(right, k)
        sums_a = np.zeros((len(variants), len(a), k))
        sums_b = np.zeros((len(variants), k, len(b)))
        product = not drop_features and dims >= PRODUCT_DIMS
        tile = PRODUCT_TILE if product else TILE
        factors = _gap_factors(a, b) if product else None
        from_a = np.ascontiguousarray(to_a.T)
        for j in range(0, len(b), tile[1]):
            for i in range(0, len(a), tile[0]):
                high, wide = slice(i, i + tile[0]), slice(j, j + tile[1])
                squared, parts = (_product_gaps(a, b, factors, high, wide), []) if product else _squared_gaps(a[high], b[wide], drop_features)
                gap = squared if product else np.empty_like(squared)
                for v, f in enumerate(variants):
                    if f < 0:
                        np.sqrt(squared, out=gap)
                    else:
                        np.subtract(squared, parts[f], out=gap)
                        np.maximum(gap, 0.0, out=gap)
                        np.sqrt(gap, out=gap)
                    sums_a[v, high] += gap @ to_b[wide]
                    if not alone:
                        sums_b[v, :, wide] += from_a[:, high] @ gap
        out = []
        for side, sums in ((left, sums_a),) if alone else ((left, sums_a), (right, sums_b.transpose(0, 2, 1))):
            for v, f in enumerate(variants):
                out.append(
                    pd.DataFrame(
                        {"id": side["id"].to_numpy(), "c": side["c"].to_numpy(), "w": side["w"].to_numpy(), "variant": f,
                         "sums": list(sums[v])}
                    )
                )
        return pd.concat(out, ignore_index=True)

    kind = pts.schema["id"].dataType.simpleString()
    parts = (
        spread.select("id", "c", "w", "point", "stripe", "other", cell.alias("cell"))
        .repartition(min(CELL_TASKS, stripes * (stripes + 1) // 2), "cell")
        .groupBy("cell")
        .applyInPandas(cell_sums, f"id {kind}, c int, w bigint, variant int, sums array<double>")
    )
    totals = [F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(k)]
    return parts.groupBy("id", "c", "w", "variant").agg(*totals)


def _squared_gaps(a: np.ndarray, b: np.ndarray, by_feature: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    """Squared distances of all pairs and, if asked, each feature's part of them."""
    total, parts = np.zeros((len(a), len(b))), []
    for x, y in zip(a.T, b.T):
        part = np.subtract(x[:, None], y)
        np.multiply(part, part, out=part)
        total += part
        if by_feature:
            parts.append(part)
    return total, parts


def _gap_factors(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices whose product has the squared distances of all pairs: ``-2a, |a|^2, 1`` times ``b, 1, |b|^2``."""
    own, other = (a * a).sum(axis=1), (b * b).sum(axis=1)
    return np.column_stack([-2 * a, own, np.ones(len(a))]), np.ascontiguousarray(np.column_stack([b, np.ones(len(b)), other]).T)


def _product_gaps(a: np.ndarray, b: np.ndarray, factors: tuple[np.ndarray, np.ndarray], high: slice, wide: slice) -> np.ndarray:
    """Squared distances of the pairs of a tile."""
    x, y = factors[0][high], factors[1][:, wide]
    total = x @ y
    own, other = x[:, -2], y[-1]
    # Where nearly all cancels out, too few digits are left. Most tiles have no such pair.
    if not total.min() >= 1e-6 * (own.max() + other.max()):
        i, j = np.nonzero(total < 1e-6 * (own[:, None] + other))
        for start in range(0, len(i), CHUNK * 4):
            part = slice(start, start + CHUNK * 4)
            total[i[part], j[part]] = ((a[high][i[part]] - b[wide][j[part]]) ** 2).sum(axis=1)
    return total


def _memberships(rows: pd.DataFrame, k: int) -> np.ndarray:
    out = np.zeros((len(rows), k))
    out[np.arange(len(rows)), rows["c"].to_numpy()] = rows["w"].to_numpy()
    return out


def silhouette_rows(
    pts: DataFrame, m: Moments, *, drop_features: bool = False, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Silhouette width of each distinct point: ``(id, c, w, variant, width)``."""
    k = m.k
    sums = F.array(*[F.col(f"s{j}") for j in range(k)])
    sizes = F.array(*[F.lit(float(x)) for x in m.n])
    own_size = F.get(sizes, F.col("c"))
    near = F.get(sums, F.col("c")) / (own_size - 1)
    far = F.array_min(F.transform(sums, lambda x, i: F.when(i != F.col("c"), x / F.get(sizes, i))))
    widest = F.greatest("near", "far")
    width = F.when((own_size == 1) | (widest == 0), F.lit(0.0)).otherwise((F.col("far") - F.col("near")) / widest)
    table = _pair_sums(pts, m, drop_features, cell_rows)
    near_safe = F.when(own_size > 1, near).otherwise(F.lit(0.0))
    return (
        table.withColumn("near", near_safe).withColumn("far", far).select("id", "c", "w", "variant", width.alias("width"))
    )


def silhouette(pts: DataFrame, m: Moments, *, cell_rows: int = CELL_ROWS) -> float:
    """Mean Euclidean silhouette over all rows, exact (quadratic work)."""
    if m.k < 2:
        return -1.0
    table = silhouette_rows(pts, m, cell_rows=cell_rows)
    return float(table.agg(F.sum(F.col("width") * F.col("w")) / F.sum("w")).first()[0])


def silhouette_without(pts: DataFrame, m: Moments, *, cell_rows: int = CELL_ROWS) -> tuple[float, list[float]]:
    """Silhouette with all features, and with each one left out.

    One pass over all pairs; with many rows of few features, a run by boxes
    (:mod:`boxes`) for each: the same sums, the pairs far apart by expansions.
    """
    dims = m.mean.shape[1]
    if m.k < 2:
        return 0.0, [0.0] * dims
    if m.n.sum() >= BOX_ROWS and 1 <= dims <= boxes.MOST_FEATURES and m.k <= boxes.MOST_LABELS:
        return _without_by_boxes(pts, m)
    table = silhouette_rows(pts, m, drop_features=True, cell_rows=cell_rows)
    found = table.groupBy("variant").agg((F.sum(F.col("width") * F.col("w")) / F.sum("w")).alias("s")).collect()
    by_variant = {r["variant"]: float(r["s"]) for r in found}
    return by_variant[-1], [by_variant[f] for f in range(dims)]


def _without_by_boxes(pts: DataFrame, m: Moments) -> tuple[float, list[float]]:
    dims = m.mean.shape[1]
    names = [f"x{i}" for i in range(dims)]
    rows = _with_index(pts, m).select("c", *[F.get("point", F.lit(i)).alias(f) for i, f in enumerate(names)])
    distinct = materialise(rows.groupBy("c", *names).agg(F.count(F.lit(1)).alias("w")))
    points = distinct.count()
    endless = distinct.agg(*[F.max(F.abs(f) == math.inf).alias(f) for f in names]).first()

    def one(left_out: int) -> float:
        kept = [f for i, f in enumerate(names) if i != left_out]
        if not kept:
            return 0.0
        if any(endless[f] for f in kept):
            return math.nan
        # As in SQL: a distance to a missing value adds nothing, and its row has no width.
        known = distinct.dropna(subset=kept)
        merged = known if left_out < 0 else known.groupBy("c", *kept).agg(F.sum("w").alias("w"))
        return boxes.mean_silhouette(merged, kept, m.n, points)

    found = in_parallel([lambda f=f: one(f) for f in (-1, *range(dims))], dims + 1)
    return found[0], found[1:]


def silhouette_squared(pts: DataFrame, m: Moments) -> float:
    """Silhouette with squared Euclidean distance: linear cost, exact over all rows."""
    if m.k < 2:
        return -1.0
    rows = _with_index(pts, m).select(array_to_vector("point").alias("features"), F.col("c").cast("double").alias("c"))
    return float(ClusteringEvaluator(featuresCol="features", predictionCol="c").evaluate(rows))


def squared_without(pts: DataFrame, m: Moments) -> tuple[float, list[float]]:
    """Squared silhouette with all features, and with each one left out: linear work, one pass.

    The mean squared distance of a point to a cluster is, feature by feature,
    the squared distance to the mean plus the variance there. Sums before and
    behind a feature give what is left without it, so that a feature of large
    numbers doesn't drown the others.
    """
    dims = m.mean.shape[1]
    if m.k < 2:
        return 0.0, [0.0] * dims
    mean, var, sizes = m.mean, m.var, m.n

    def widths(batches):
        total = np.zeros(dims + 1)
        rows = 0
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK * 4):
                part = batch.slice(start, CHUNK * 4)
                own = part.column("c").to_numpy(zero_copy_only=False)
                x = part.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                gaps = np.zeros((m.k, len(x), dims + 1))
                for j in range(m.k):
                    terms = (x - mean[j]) ** 2 + var[j]
                    before = np.cumsum(np.hstack([np.zeros((len(x), 1)), terms]), axis=1)
                    behind = np.cumsum(np.hstack([np.zeros((len(x), 1)), terms[:, ::-1]]), axis=1)[:, ::-1]
                    gaps[j, :, 0] = before[:, -1]
                    gaps[j, :, 1:] = before[:, :-1] + behind[:, 1:]
                place = np.arange(len(x))
                size = sizes[own][:, None]
                near = gaps[own, place] * (size / np.maximum(size - 1, 1))
                gaps[own, place] = np.inf
                far = gaps.min(axis=0)
                widest = np.maximum(near, far)
                flat = (size == 1) | (widest == 0)
                total += np.where(flat, 0.0, (far - near) / np.where(flat, 1.0, widest)).sum(axis=0)
                rows += len(x)
        yield pa.RecordBatch.from_pydict({"variant": np.arange(dims + 1, dtype=np.int32), "total": total, "rows": np.full(dims + 1, rows, np.int64)})

    sums = _with_index(pts, m).select("c", "point").mapInArrow(widths, "variant int, total double, rows long")
    found = sums.groupBy("variant").agg((F.sum("total") / F.sum("rows")).alias("s")).collect()
    by_variant = {r["variant"]: float(r["s"]) for r in found}
    return by_variant[0], [by_variant[f + 1] for f in range(dims)]


def cluster_metrics(pts: DataFrame, *, mode: str = "squared", dims: int | None = None, cell_rows: int = CELL_ROWS) -> dict:
    """All metrics of one labelling. One cluster gives -1, infinity and 0.

    ``mode`` names the distance of the silhouette: ``squared`` (linear work) or
    ``euclidean`` (quadratic work). Both use all rows, whatever their number.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    m = cluster_moments(pts, dims)
    measure = silhouette_squared(pts, m) if mode == "squared" else silhouette(pts, m, cell_rows=cell_rows)
    return {
        "n_clusters": m.k,
        "silhouette": measure,
        "silhouette_mode": mode,
        "davies_bouldin": davies_bouldin(pts, m),
        "calinski_harabasz": calinski_harabasz(m),
    }


def merged_metrics(labelled: DataFrame, vector: str, label: str, weight: str) -> dict:
    """The metrics of :func:`cluster_metrics` with ``squared`` distances, from distinct points and their numbers of rows."""
    pts = labelled.where(ref(label).isNotNull()).select(ref(label).alias("label"), vector_to_array(ref(vector)).alias("point"), ref(weight).alias("w"))
    some = pts.first()
    dims = len(some["point"]) if some else 0
    cells = [F.sum(F.get("point", F.lit(i)) * F.col("w")) / F.sum("w") for i in range(dims)]
    rows = pts.groupBy("label").agg(F.sum("w").alias("n"), F.array(*cells).alias("mean")).orderBy("label").limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels; a clustering metric needs a cluster label")
    labels = [r["label"] for r in rows]
    size, mean = np.array([r["n"] for r in rows], dtype=float), np.array([r["mean"] for r in rows], dtype=float).reshape(len(rows), dims)
    k, codes = len(labels), np.array(labels)

    def parts(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK * 4):
                part = batch.slice(start, CHUNK * 4)
                own = np.searchsorted(codes, part.column("label").to_numpy(zero_copy_only=False))
                x = part.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                yield own, x, part.column("w").to_numpy(zero_copy_only=False)

    def total(body, width: int) -> np.ndarray:
        """Sum over the tasks of ``body``, rows of ``width`` numbers by cluster."""

        def one(batches):
            out = np.zeros((k, width))
            for own, x, w in parts(batches):
                for c, v in enumerate(body(own, x, w)):
                    out[:, c] += np.bincount(own, v, k)
            yield pa.RecordBatch.from_pydict({"sums": [out.tobytes()]})

        return sum((np.frombuffer(r["sums"]).reshape(k, width) for r in pts.mapInArrow(one, "sums binary").collect()), np.zeros((k, width)))

    def spreads(own, x, w):
        squares = (x - mean[own]) ** 2
        return [w * np.sqrt(squares.sum(axis=1)), *(w * squares.T)]

    found = total(spreads, dims + 1) / size[:, None]
    m = Moments(labels, size, mean, found[:, 1:])

    def widths(own, x, w):
        gaps = np.stack([((x - mean[j]) ** 2 + m.var[j]).sum(axis=1) for j in range(k)])
        place = np.arange(len(x))
        near = gaps[own, place] * (size[own] / np.maximum(size[own] - 1, 1))
        gaps[own, place] = np.inf
        far = gaps.min(axis=0)
        widest = np.maximum(near, far)
        flat = (size[own] == 1) | (widest == 0)
        return [w * np.where(flat, 0.0, (far - near) / np.where(flat, 1.0, widest))]

    return {
        "n_clusters": k,
        "silhouette": float(total(widths, 1).sum() / size.sum()) if k > 1 else -1.0,
        "silhouette_mode": "squared",
        "davies_bouldin": _worst_ratios(m, found[:, 0]) if k > 1 else math.inf,
        "calinski_harabasz": calinski_harabasz(m),
    }


METRIC_SCHEMA = (
    "n_clusters bigint, silhouette double, silhouette_mode string, davies_bouldin double, calinski_harabasz double"
)


def metric_table(pts: DataFrame, **options) -> DataFrame:
    found = cluster_metrics(pts, **options)
    return pts.sparkSession.createDataFrame([tuple(found.values())], METRIC_SCHEMA)
