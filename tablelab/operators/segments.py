"""Describing the groups: sizes, profiles, importance of features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelab.functions.columns import clean, draw_share, long_form, number, numeric_columns, ref, tidy
from tablelab.functions.stats import f_upper_tail
from tablelab.operators.quality import CELL_ROWS, MAX_LABELS, MODES, cluster_moments, points, silhouette_without, squared_without

NO_MODE = "N/A"


def cluster_sizes(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(ref(label).alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
    # The window runs over one row per cluster.
    share = F.col("size") / F.sum("size").over(Window.partitionBy()) * 100
    return counts.select("cluster", "size", share.alias("percent"))


def _features(df: DataFrame, label: str, features: Sequence[str] | None, exclude: Sequence[str] = ()) -> list[str]:
    return list(features) if features is not None else numeric_columns(df, [label, *exclude])


def cluster_profiles(
    df: DataFrame, label: str, features: Sequence[str] | None = None, *, exclude: Sequence[str] = ()
) -> DataFrame:
    """Size, share, mean and sample deviation of each numeric column per cluster."""
    names = _features(df, label, features, exclude)
    stats = []
    for f in names:
        stats += [F.avg(number(df, f)).alias(f"{f}_mean"), F.stddev_samp(number(df, f)).alias(f"{f}_std")]
    table = df.groupBy(ref(label).alias("cluster")).agg(F.count(F.lit(1)).alias("size"), *stats)
    share = F.col("size") / F.sum("size").over(Window.partitionBy()) * 100
    return table.select("cluster", "size", share.alias("percent"), *[ref(f"{f}_{s}") for f in names for s in ("mean", "std")])


def _means(df: DataFrame, label: str, names: Sequence[str]) -> DataFrame:
    """``(cluster, feature, mean)`` in long form from one grouped aggregate."""
    wide = df.groupBy(ref(label).alias("cluster")).agg(*[F.avg(number(df, f)).alias(f"m{i}") for i, f in enumerate(names)])
    values = {f: F.col(f"m{i}") for i, f in enumerate(names)}
    return long_form(wide, values, ["cluster"]).select("cluster", F.col("column").alias("feature"), F.col("value").alias("mean"))


def cluster_zscores(
    df: DataFrame, label: str, features: Sequence[str] | None = None, *, exclude: Sequence[str] = ()
) -> DataFrame:
    """Cluster means as deviations from the global mean, in global sample deviations."""
    names = _features(df, label, features, exclude)
    overall = df.agg(
        *[f(number(df, c)).alias(f"{t}{i}") for i, c in enumerate(names) for t, f in (("m", F.avg), ("s", F.stddev_samp))]
    )
    whole = tidy(
        overall, [(F.lit(c), F.col(f"m{i}"), F.col(f"s{i}")) for i, c in enumerate(names)], ["feature", "all_mean", "all_std"]
    )
    # One row per feature, so the broadcast is bounded by the column count.
    joined = _means(df, label, names).join(F.broadcast(whole), "feature")
    z = F.when(F.col("all_std") > 0, (F.col("mean") - F.col("all_mean")) / F.col("all_std"))
    return joined.select("cluster", "feature", z.alias("z"))


def cluster_radar(
    df: DataFrame, label: str, features: Sequence[str] | None = None, *, exclude: Sequence[str] = ()
) -> DataFrame:
    """Cluster means scaled to 0..1 across clusters; a feature without spread gives 0."""
    names = _features(df, label, features, exclude)
    over = Window.partitionBy("feature")
    low, high = F.min("mean").over(over), F.max("mean").over(over)
    scaled = F.when(high > low, (F.col("mean") - low) / (high - low)).otherwise(F.lit(0.0))
    return _means(df, label, names).select("cluster", "feature", scaled.alias("value"))


def anova_rows(df: DataFrame, label: str, names: Sequence[str]) -> list[tuple[str, float | None, float | None]]:
    """``(feature, F, p)`` from counts, means and variances per cluster, one scan."""
    stats = []
    for i, f in enumerate(names):
        v = number(df, f)
        stats += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}")]
    groups = df.where(ref(label).isNotNull()).groupBy(ref(label).alias("cluster")).agg(*stats)
    rows = groups.limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels in {label}; the test needs a cluster label")
    out = []
    for i, f in enumerate(names):
        filled = [(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"]) for r in rows if r[f"n{i}"]]
        k, n = len(filled), sum(size for size, _, _ in filled)
        if k < 2:
            out.append((f, 0.0, 1.0))
            continue
        middle = sum(size * mean for size, mean, _ in filled) / n
        between = sum(size * (mean - middle) ** 2 for size, mean, _ in filled) / (k - 1)
        within = sum(size * var for size, _, var in filled) / (n - k) if n > k else math.nan
        if within == 0:
            score = math.inf if between > 0 else math.nan
        else:
            score = between / within
        out.append((f, score, f_upper_tail(score, k - 1, n - k) if n > k else math.nan))
    return out


def anova_f(
    df: DataFrame, label: str, features: Sequence[str] | None = None, *, exclude: Sequence[str] = ()
) -> DataFrame:
    rows = anova_rows(df, label, _features(df, label, features, exclude))
    return df.sparkSession.createDataFrame(rows, "feature string, f_score double, p_value double")


def silhouette_drop(
    df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], *, mode: str = "squared", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Fall of the silhouette when a feature is left out, all features in one pass.

    ``mode`` names the distance: ``squared`` (linear work) or ``euclidean``
    (quadratic work, by name only). Both use all rows.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    pts = points(df, features, label, key)
    moments = cluster_moments(pts, len(features))
    base, without = squared_without(pts, moments) if mode == "squared" else silhouette_without(pts, moments, cell_rows=cell_rows)
    rows = [(f, base, w, base - w) for f, w in zip(features, without)]
    return df.sparkSession.createDataFrame(rows, "feature string, base double, without double, importance double")


def combined_importance(
    df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], *, mode: str = "squared", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """ANOVA and silhouette scores, each scaled to 0..1, and their mean. ``mode`` as in :func:`silhouette_drop`."""
    anova = anova_f(df, label, features)
    drop = silhouette_drop(df, label, features, key, mode=mode, cell_rows=cell_rows).select("feature", "importance")
    table = anova.join(drop, "feature").select(
        "feature",
        F.col("f_score").alias("anova_score"),
        F.col("p_value").alias("anova_p_value"),
        F.col("importance").alias("silhouette_score"),
    )
    whole = Window.partitionBy()  # one row per feature

    def scaled(name: str):
        low, high = F.min(name).over(whole), F.max(name).over(whole)
        return F.when(high > low, (F.col(name) - low) / (high - low)).otherwise(F.lit(0.5))

    table = table.withColumn("anova_norm", scaled("anova_score")).withColumn("silhouette_norm", scaled("silhouette_score"))
    combined = (F.col("anova_norm") + F.col("silhouette_norm")) / 2
    return table.withColumn("combined_importance", combined).orderBy(F.col("combined_importance").desc(), "feature")


def top_features(
    df: DataFrame, label: str, n: int, features: Sequence[str] | None = None, *, exclude: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` best features by F, or by variance where F is not defined.

    Variance takes over with one cluster, or a cluster of fewer than two rows.
    """
    names = _features(df, label, features, exclude)
    sizes = df.groupBy(ref(label).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    shape = sizes.agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
    if shape["k"] <= 1 or shape["least"] < 2:
        row = df.agg(*[F.var_samp(number(df, f)).alias(f"v{i}") for i, f in enumerate(names)]).first()
        scores = [(f, row[f"v{i}"], "variance") for i, f in enumerate(names)]
    else:
        scores = [(f, s, "anova_f") for f, s, _ in anova_rows(df, label, names)]
    ranked = sorted(scores, key=lambda s: (-(s[1] if s[1] is not None and not math.isnan(s[1]) else -math.inf), names.index(s[0])))
    rows = [(i + 1, *s) for i, s in enumerate(ranked[:n])]
    return df.sparkSession.createDataFrame(rows, "rank int, feature string, score double, rule string")


def cluster_centroids(df: DataFrame, label: str, dims: Sequence[str]) -> DataFrame:
    return df.groupBy(ref(label).alias("cluster")).agg(*[F.avg(number(df, d)).alias(d) for d in dims])


def cluster_scatter_sample(
    df: DataFrame, label: str, dims: Sequence[str], fractions: dict, key: Sequence[str], seed: int = 42
) -> DataFrame:
    """Labelled points for plotting, a share per cluster, repeatable by key hash."""
    keep = F.lit(False)
    for value, share in fractions.items():
        keep = keep | ((ref(label) == F.lit(value)) & draw_share(key, seed, share))
    return df.where(keep).select(*[ref(k) for k in key], ref(label).alias("cluster"), *[ref(d) for d in dims])


def cluster_spend_summary(df: DataFrame, label: str, mean_of: str, pattern: str) -> DataFrame:
    """Mean of one column, and mean row total of all columns whose name holds ``pattern``."""
    spend = [c for c in numeric_columns(df) if pattern in c and c != label]
    total = F.lit(0.0)
    for c in spend:
        total = total + F.coalesce(number(df, c), F.lit(0.0))
    average = (F.sum(total) / F.count(F.lit(1))) if spend else F.lit(None).cast("double")
    return df.groupBy(ref(label).alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"), F.avg(number(df, mean_of)).alias("mean_value"), average.alias("mean_spend")
    )


def cluster_mode(df: DataFrame, label: str, column: str) -> DataFrame:
    """Most frequent value per cluster, the smallest on ties."""
    counts = df.groupBy(ref(label).alias("cluster"), clean(df, column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("rank"), "value")))
    top = counts.groupBy("cluster").agg(best.alias("best"))
    return top.select(
        "cluster", F.coalesce(F.col("best.value").cast("string"), F.lit(NO_MODE)).alias("mode"), (-F.col("best.rank")).alias("n")
    )
