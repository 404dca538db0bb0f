"""Outlier detection per numeric column and treatment of what was found."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import long_form, number, numeric_columns, ref
from tablelab.functions.frequent import modes
from tablelab.functions.quantiles import quantiles
from tablelab.operators.forest import ForestFit, fit_forest

MIN_VALUES = 10
FOREST_FROM_COLUMNS = 5
METHODS = ("auto", "iqr", "zscore", "isolation_forest")


@dataclass
class Detection:
    column: str
    method: str
    n: int
    outliers: int
    percent: float
    threshold: float | None = None
    lower: float | None = None
    upper: float | None = None
    q1: float | None = None
    q3: float | None = None
    mean: float | None = None
    std: float | None = None
    max_z: float | None = None
    forest: ForestFit | None = None

    def flag(self, df: DataFrame) -> Column:
        """True for outliers; false for missing cells."""
        v = number(df, self.column)
        if self.method == "iqr":
            return F.coalesce((v < self.lower) | (v > self.upper), F.lit(False))
        if self.method == "zscore":
            return F.coalesce(_z(v, self.mean, self.std) > self.threshold, F.lit(False)) if self.std else F.lit(False)
        return self.forest.flag(v)


@dataclass
class Treatment:
    column: str
    action: str
    detection: Detection
    lower: float | None = None
    upper: float | None = None
    value: float | None = None
    shift: float = 0.0
    function: str = "log"


def _z(value: Column, mean: float, std: float) -> Column:
    return F.abs((value - F.lit(mean)) / F.lit(std))


def detect(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    *,
    threshold: float | None = None,
    key: Sequence[str] = (),
    exclude: Sequence[str] = (),
    exact: bool = True,
    n_estimators: int = 100,
    max_samples: int | str = "auto",
    contamination: float | str = "auto",
    seed: int = 42,
) -> list[Detection]:
    """Detections of every checked column, also of those without an outlier.

    ``auto`` takes the IQR rule below five numeric columns, else the isolation
    forest. Columns with fewer than ten values are skipped.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, expected one of {METHODS}")
    skipped = {*key, *exclude}
    names = [c for c in (columns if columns is not None else numeric_columns(df)) if c not in skipped and c in df.columns]
    if method == "auto":
        method = "iqr" if len(names) < FOREST_FROM_COLUMNS else "isolation_forest"
    if not names:
        return []
    if method == "iqr":
        return _detect_iqr(df, names, 1.5 if threshold is None else threshold, exact)
    if method == "zscore":
        return _detect_zscore(df, names, 3.0 if threshold is None else threshold)
    if not key:
        raise ValueError("isolation_forest needs key columns, to draw its subsamples repeatably")
    fits = fit_forest(
        df, names, key, n_estimators=n_estimators, max_samples=max_samples, contamination=contamination, seed=seed
    )
    return [
        Detection(f.column, method, f.n, f.outliers, f.outliers / f.n * 100, f.offset, forest=f)
        for f in fits
        if f.n >= MIN_VALUES
    ]


def _detect_iqr(df, names, threshold, exact) -> list[Detection]:
    values = {c: number(df, c) for c in names}
    sizes = [F.count(values[c]).alias(f"n{i}") for i, c in enumerate(names)]
    cuts, row = quantiles(df, values, [0.25, 0.75], exact=exact, extra=sizes)
    found = []
    for i, c in enumerate(names):
        n = row[f"n{i}"]
        if n < MIN_VALUES:
            continue
        q1, q3 = cuts[c]
        reach = threshold * (q3 - q1)
        found.append(Detection(c, "iqr", n, 0, 0.0, threshold, q1 - reach, q3 + reach, q1, q3))
    return _count(df, found)


def _detect_zscore(df, names, threshold) -> list[Detection]:
    aggregates = []
    for i, c in enumerate(names):
        v = number(df, c)
        aggregates += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}")]
        aggregates += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    row = df.agg(*aggregates).first()
    found = []
    for i, c in enumerate(names):
        n, mean, std = row[f"n{i}"], row[f"m{i}"], row[f"s{i}"]
        if n < MIN_VALUES:
            continue
        std = 0.0 if row[f"lo{i}"] == row[f"hi{i}"] else std
        furthest = max(abs(row[f"lo{i}"] - mean), abs(row[f"hi{i}"] - mean)) / std if std else None
        found.append(Detection(c, "zscore", n, 0, 0.0, threshold, mean=mean, std=std, max_z=furthest))
    return _count(df, found)


def _count(df: DataFrame, found: list[Detection]) -> list[Detection]:
    if found:
        row = df.agg(*[F.count(F.when(d.flag(df), 1)).alias(f"o{i}") for i, d in enumerate(found)]).first()
        for i, d in enumerate(found):
            d.outliers = row[f"o{i}"]
            d.percent = d.outliers / d.n * 100
    return found


def reported(detections: Sequence[Detection]) -> list[Detection]:
    """Only columns with at least one outlier are reported and treated."""
    return [d for d in detections if d.outliers > 0]


def detection_table(df: DataFrame, detections: Sequence[Detection]) -> DataFrame:
    fields = ["column", "method", "n", "outliers", "percent", "threshold", "lower", "upper", "q1", "q3", "mean", "std", "max_z"]
    rows = []
    for d in detections:
        stats = d.forest.score_stats if d.forest else {}
        rows.append(tuple(getattr(d, f) for f in fields) + tuple(stats.get(s) for s in ("min", "max", "mean", "std")))
    schema = (
        "column string, method string, n bigint, outliers bigint, percent double, threshold double, lower double, "
        "upper double, q1 double, q3 double, mean double, std double, max_z double, score_min double, "
        "score_max double, score_mean double, score_std double"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def outlier_rows(df: DataFrame, detections: Sequence[Detection], key: Sequence[str]) -> DataFrame:
    """Key, column and value of every outlier cell."""
    cells = {d.column: F.when(d.flag(df), number(df, d.column)) for d in detections}
    return long_form(df, cells, [ref(k) for k in key]).where(F.col("value").isNotNull())


def fit_treatment(
    df: DataFrame,
    detections: Sequence[Detection],
    treatment: str = "auto",
    *,
    k: float = 3.0,
    impute_method: str = "median",
    transform_method: str = "log",
) -> list[Treatment]:
    """Choose the action and its numbers per column.

    ``auto`` goes by the outlier share: below 5 % cap, below 15 % impute, else
    transform. ``k`` is the number of deviations of the z-score cap.
    """
    chosen = []
    for d in reported(detections):
        action = treatment
        if treatment == "auto":
            share = d.percent / 100.0
            action = "cap" if share < 0.05 else "impute" if share < 0.15 else "transform"
        if action not in ("remove", "cap", "impute", "transform"):
            raise ValueError(f"unknown treatment {treatment!r}")
        chosen.append(Treatment(d.column, action, d, function=transform_method))
    quartiles = [t.column for t in chosen if t.action == "cap" and t.detection.method == "isolation_forest"]
    centred = [t.column for t in chosen if t.action == "impute" and impute_method not in ("mean", "mode")]
    simple = [t.column for t in chosen if t.action == "transform" or (t.action == "impute" and impute_method == "mean")]
    extra = [f(number(df, c)).alias(f"{a}{i}") for i, c in enumerate(simple) for a, f in (("mean", F.avg), ("min", F.min))]
    values = {c: number(df, c) for c in [*quartiles, *centred]}
    cuts, row = quantiles(df, values, [0.25, 0.5, 0.75], extra=extra) if values or extra else ({}, None)
    imputed = [t.column for t in chosen if t.action == "impute"]
    common = modes(df, imputed) if imputed and impute_method == "mode" else {}
    for t in chosen:
        d = t.detection
        if t.action == "cap":
            if d.method == "iqr":
                t.lower, t.upper = d.lower, d.upper
            elif d.method == "zscore":
                t.lower, t.upper = d.mean - k * d.std, d.mean + k * d.std
            else:
                q1, _, q3 = cuts[t.column]
                t.lower, t.upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        elif t.action == "impute":
            if impute_method == "mean":
                t.value = row[f"mean{simple.index(t.column)}"]
            elif impute_method == "mode":
                t.value = float(common.get(t.column, 0))
            else:
                t.value = cuts[t.column][1]
        elif t.action == "transform":
            low = row[f"min{simple.index(t.column)}"]
            needs = low <= 0 if transform_method == "log" else low < 0
            t.shift = abs(low) + 1.0 if needs else 0.0
    return chosen


def apply_treatment(df: DataFrame, treatments: Sequence[Treatment], keep_rows: bool = False) -> DataFrame:
    """One filter for all removals (none with ``keep_rows``) and one projection for all other actions."""
    out = df
    removals = [t for t in treatments if t.action == "remove" and not keep_rows]
    if removals:
        hit = F.lit(False)
        for t in removals:
            hit = hit | t.detection.flag(df)
        out = df.where(~hit)
    by_column = {t.column: t for t in treatments if t.action != "remove"}
    if not by_column:
        return out
    return out.select(*[_treated(out, by_column[c]).alias(c) if c in by_column else ref(c) for c in out.columns])


def _treated(df: DataFrame, t: Treatment) -> Column:
    v = number(df, t.column)
    if t.action == "cap":
        # Not greatest/least: these skip NULL and would fill missing cells.
        return F.when(v < t.lower, F.lit(t.lower)).when(v > t.upper, F.lit(t.upper)).otherwise(v)
    if t.action == "impute":
        return F.when(t.detection.flag(df), F.lit(t.value)).otherwise(v)
    shifted = v + F.lit(t.shift)
    return F.ln(shifted) if t.function == "log" else F.sqrt(shifted)


def outlier_summary(df: DataFrame, detections: Sequence[Detection], rows_before: int, rows_after: int) -> DataFrame:
    """Totals over the reported columns, with row counts before and after treatment."""
    hit = reported(detections)
    total = sum(d.outliers for d in hit)
    rate = total / (rows_before * len(hit)) * 100 if hit and rows_before else 0.0
    method = hit[0].method if hit else None
    row = (method, total, len(hit), rate, rows_before, rows_after, rows_before - rows_after)
    schema = (
        "method string, total_outliers bigint, columns_hit bigint, overall_percent double, rows_before bigint, "
        "rows_after bigint, rows_removed bigint"
    )
    return df.sparkSession.createDataFrame([row], schema)


def handle_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "auto",
    treatment: str = "auto",
    *,
    k: float = 3.0,
    impute_method: str = "median",
    transform_method: str = "log",
    **options,
) -> DataFrame:
    """Detect and treat. A table without numeric columns comes back unchanged."""
    detections = detect(df, columns, method, **options)
    treatments = fit_treatment(
        df, detections, treatment, k=k, impute_method=impute_method, transform_method=transform_method
    )
    return apply_treatment(df, treatments)


