"""Profiling aggregates: one tidy table per report part."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelab.functions.columns import (
    clean,
    long_form,
    number,
    numeric_columns,
    ref,
    string_columns,
    tidy,
)
from tablelab.functions.comoments import correlation, pair_sums
from tablelab.functions.frequent import frequent_values
from tablelab.functions.quantiles import Central, quantiles


def _type_class(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def table_shape(df: DataFrame) -> DataFrame:
    """One row per column: position, type, row count, column count, columns of its type."""
    kinds = [_type_class(df, c) for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"))
    parts = [
        (F.lit(c), F.lit(i), F.lit(k), F.col("n_rows"), F.lit(len(kinds)), F.lit(kinds.count(k)))
        for i, (c, k) in enumerate(zip(df.columns, kinds))
    ]
    return tidy(row, parts, ["column", "position", "type", "n_rows", "n_columns", "columns_of_type"])


def missing_stats(df: DataFrame) -> DataFrame:
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(clean(df, c).isNull(), 1)).alias(f"__m{i}") for i, c in enumerate(df.columns)],
    )
    total = sum((F.col(f"__m{i}") for i in range(len(df.columns))), F.lit(0).cast("long"))
    parts = []
    for i, c in enumerate(df.columns):
        n = F.col(f"__m{i}")
        share = F.when(F.col("__rows") > 0, n / F.col("__rows") * 100).otherwise(0.0)
        parts.append((F.lit(c), n, F.round(share, 2), F.lit(_type_class(df, c)), total))
    return tidy(row, parts, ["column", "missing", "percent", "type", "total_missing"])


def most_missing(df: DataFrame, n: int = 5) -> DataFrame:
    stats = missing_stats(df).where(F.col("missing") > 0)
    return stats.orderBy(F.col("missing").desc(), "column").limit(n)


def numeric_stats(df: DataFrame, columns: Sequence[str] | None = None, *, exact: bool = True) -> DataFrame:
    """Moments, quartiles and zero counts of each numeric column.

    Skew and kurtosis carry the small-sample bias correction. All columns
    share two scans: moments plus quantile sketch, then exact quartiles.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    values = {c: number(df, c) for c in names}
    extra = []
    for i, c in enumerate(names):
        extra += [F.min(values[c]).alias(f"min{i}"), F.max(values[c]).alias(f"max{i}")]
        extra.append(F.count(F.when(values[c] == 0, 1)).alias(f"zeros{i}"))
    central: dict[str, Central] = {}
    cuts, row = quantiles(df, values, [0.25, 0.5, 0.75], exact=exact, extra=extra, central=central)
    rows = []
    for i, c in enumerate(names):
        n, zeros = central[c].n, row[f"zeros{i}"]
        low, high = row[f"min{i}"], row[f"max{i}"]
        q1, median, q3 = cuts[c]
        std, skew, kurt = _shape(central[c], low == high)
        share = zeros / n * 100 if n else None
        rows.append((c, n, central[c].mean, std, low, high, median, q1, q3, skew, kurt, zeros, share))
    schema = (
        "column string, n bigint, mean double, std double, min double, max double, median double, q1 double, "
        "q3 double, skew double, kurtosis double, zeros bigint, zeros_percent double"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def _shape(c: Central, constant: bool) -> tuple[float | None, float | None, float | None]:
    """Sample deviation, and skew and kurtosis with the small-sample correction."""
    n = c.n
    if constant:
        return (0.0 if n >= 2 else None), (0.0 if n >= 3 else None), (0.0 if n >= 4 else None)
    if n < 2:
        return None, None, None
    m2, m3, m4 = (p / n for p in c.powers[1:])
    skew = kurt = None
    if n >= 3:
        skew = m3 / m2**1.5 * math.sqrt(n * (n - 1)) / (n - 2)
    if n >= 4:
        kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2**2 - 3) + 6)
    return math.sqrt(c.powers[1] / (n - 1)), skew, kurt


def categorical_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values, missing cells and the most frequent value per text column.

    Distinct values are told apart by prints of 128 bits, so values themselves
    are not shuffled; the top value comes from bounded summaries.
    """
    names = list(columns) if columns is not None else string_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, unique_count bigint, missing_count bigint, top_value string, top_count bigint, top_percent double")
    values = {c: clean(df, c) for c in names}
    prints = {c: F.when(v.isNotNull(), F.struct(F.xxhash64(v).alias("p0"), F.xxhash64(F.lit(1), v).alias("p1"))) for c, v in values.items()}
    # Missing cells are counted in the same shuffle, as the NULL value of a column.
    counts = long_form(df, prints).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    there = F.col("value").isNotNull()
    table = counts.groupBy("column").agg(
        F.count("value").alias("unique_count"),
        F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).alias("missing_count"),
        F.sum(F.when(there, F.col("n"))).alias("present"),
    )
    # One row per column.
    top = frequent_values(df, values)[0].select("column", F.col("value").alias("top_value"), F.col("n").alias("top"))
    return table.join(F.broadcast(top), "column", "left").select(
        "column",
        "unique_count",
        "missing_count",
        "top_value",
        F.coalesce("top", F.lit(0)).alias("top_count"),
        F.coalesce(F.col("top") / F.col("present") * 100, F.lit(0.0)).alias("top_percent"),
    )


def top_values(df: DataFrame, columns: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """Most frequent values per column; equal counts are ordered by value.

    A summary and, if need be, a count of the candidates: see
    :func:`tablelab.functions.frequent.frequent_values`.
    """
    names = list(columns) if columns is not None else string_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint, rank int")
    return frequent_values(df, {c: clean(df, c) for c in names}, n)[0]


def row_prints(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Three 64-bit prints of a row, ``p0`` to ``p2``; missing cells count by their place.

    Two different rows of a table agree in all three with a probability of
    about 1 in 10**34 for 10**12 rows, so equal prints stand for equal rows.
    """
    cells = [clean(df, c) for c in names]
    gaps = [c.isNull() for c in cells]
    orders = ([*cells, *gaps], [F.lit(1), *gaps, *cells], [F.lit(2), *cells[::-1], *gaps])
    return [F.xxhash64(*order).alias(f"p{i}") for i, order in enumerate(orders)]


PRINTS = ("p0", "p1", "p2")


def duplicate_stats(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one, and their share. Prints are shuffled, rows are not."""
    groups = df.select(*row_prints(df, df.columns)).groupBy(*PRINTS).agg(F.count(F.lit(1)).alias("n"))
    totals = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d"), F.sum("n").alias("t"))
    share = F.when(F.col("t") > 0, F.col("d") / F.col("t") * 100).otherwise(0.0)
    return totals.select(F.col("d").alias("duplicate_rows"), share.alias("duplicate_percent"))


def duplicate_rows(df: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier one over ``columns`` (all but the key).

    Prints and keys are grouped, the least key of a group with a combining
    minimum; only rows that repeat are then looked up by their key. A group of
    copies of any size never has to meet in one task.
    """
    names = list(columns) if columns is not None else [c for c in df.columns if c not in key]
    keys = [f"k{i}" for i in range(len(key))]
    rows = df.select(F.struct(*[ref(k).alias(n) for k, n in zip(key, keys)]).alias("row"), *row_prints(df, names))
    groups = rows.groupBy(*PRINTS).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")).where(F.col("n") > 1)
    repeats = rows.join(groups, [*PRINTS]).where(~F.col("row").eqNullSafe(F.col("first"))).select("row.*").toDF(*[f"__{k}" for k in keys])
    match = F.lit(True)
    for k, n in zip(key, keys):
        match = match & ref(k).eqNullSafe(F.col(f"__{n}"))
    return df.join(repeats, match, "left_semi")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, high: float = 0.8) -> DataFrame:
    """Pearson correlation over pairwise complete rows, in long form.

    One scan for any number of columns; no pair reaches the driver.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "col1 string, col2 string, correlation double, is_high boolean")
    pairs = correlation(pair_sums(df, [number(df, c) for c in names]))
    name = F.array(*[F.lit(c) for c in names])
    is_high = (F.col("i") < F.col("j")) & F.coalesce(F.abs("r") > high, F.lit(False))

    def row(one: str, two: str, flag: Column) -> Column:
        return F.struct(F.get(name, F.col(one)).alias("col1"), F.get(name, F.col(two)).alias("col2"), F.col("r").alias("correlation"), flag.alias("is_high"))

    both = F.array(row("i", "j", is_high), row("j", "i", F.lit(False)))
    return pairs.select(F.inline(F.when(F.col("i") < F.col("j"), both).otherwise(F.slice(both, 1, 1))))


def _ranges(df: DataFrame, names: Sequence[str]) -> tuple[dict, dict]:
    values = {c: number(df, c) for c in names}
    extra = []
    for i, c in enumerate(names):
        v = values[c]
        extra += [f(v).alias(f"{t}{i}") for t, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
        extra += [F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}")]
    cuts, row = quantiles(df, values, [0.25, 0.5, 0.75], extra=extra)
    stats = {c: {t: row[f"{t}{i}"] for t in ("n", "lo", "hi", "mean", "std")} for i, c in enumerate(names)}
    return stats, cuts


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bins (last one closed) with counts, mean and median per column."""
    names = list(columns) if columns is not None else numeric_columns(df)
    stats, cuts = _ranges(df, names)
    names = [c for c in names if stats[c]["n"]]
    edges, slots = {}, {}
    for c in names:
        lo, hi = stats[c]["lo"], stats[c]["hi"]
        edges[c] = (lo, hi) if hi > lo else (lo - 0.5, hi + 0.5)
        place = F.floor((number(df, c) - edges[c][0]) / (edges[c][1] - edges[c][0]) * bins)
        slots[c] = F.least(place, F.lit(bins - 1)).cast("int")
    counted = long_form(df, slots).where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    frame = [
        (c, b, edges[c][0] + (edges[c][1] - edges[c][0]) * b / bins, stats[c]["mean"], cuts[c][1])
        for c in names
        for b in range(bins)
    ]
    grid = df.sparkSession.createDataFrame(frame, "column string, bin int, left double, mean double, median double")
    counted = counted.select(F.col("column"), F.col("value").alias("bin"), "n")
    return grid.join(F.broadcast(counted), ["column", "bin"], "left").select(
        "column", "bin", "left", F.coalesce("n", F.lit(0)).alias("n"), "mean", "median"
    )


def density_curve(df: DataFrame, columns: Sequence[str] | None = None, points: int = 200, cut: float = 0.0) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth) on an even grid from min to max.

    Every row counts, none is binned. Each task adds its rows into one vector
    of ``points`` sums per column; only these vectors are shuffled.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    stats, _ = _ranges(df, names)
    names = [c for c in names if stats[c]["n"] and stats[c]["n"] > 1 and stats[c]["std"]]
    schema = "column string, point int, mass double"
    if not names:
        return df.sparkSession.createDataFrame([], "column string, point int, x double, density double")
    width = {c: stats[c]["std"] * stats[c]["n"] ** (-0.2) for c in names}
    grids = {}
    for c in names:
        lo, hi = stats[c]["lo"] - cut * width[c], stats[c]["hi"] + cut * width[c]
        grids[c] = lo + (hi - lo) * np.arange(points) / (points - 1)

    def partial(batches):
        sums = {c: np.zeros(points) for c in names}
        for batch in batches:
            for c in names:
                x = batch[c].to_numpy(dtype=float)
                x = x[~np.isnan(x)]
                for start in range(0, len(x), 4096):
                    u = (grids[c][:, None] - x[None, start : start + 4096]) / width[c]
                    sums[c] += np.exp(-0.5 * u * u).sum(axis=1)
        yield pd.DataFrame(
            {"column": np.repeat(names, points), "point": np.tile(np.arange(points), len(names)).astype("int32"),
             "mass": np.concatenate([sums[c] for c in names])}
        )

    masses = df.select(*[number(df, c).alias(c) for c in names]).mapInPandas(partial, schema)
    total = masses.groupBy("column", "point").agg(F.sum("mass").alias("mass"))
    frame = [
        (c, i, float(x), stats[c]["n"] * width[c] * math.sqrt(2 * math.pi))
        for c in names
        for i, x in enumerate(grids[c])
    ]
    grid = df.sparkSession.createDataFrame(frame, "column string, point int, x double, norm double")
    return total.join(F.broadcast(grid), ["column", "point"]).select(
        "column", "point", "x", (F.col("mass") / F.col("norm")).alias("density")
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns) if columns is not None else numeric_columns(df)
    stats, cuts = _ranges(df, names)
    names = [c for c in names if stats[c]["n"]]
    outside = []
    for i, c in enumerate(names):
        q1, _, q3 = cuts[c]
        v, reach = number(df, c), 1.5 * (q3 - q1)
        outside.append(F.count(F.when((v < q1 - reach) | (v > q3 + reach), 1)).alias(f"o{i}"))
    if not names:
        row = df.agg(F.count(F.lit(1)))
    else:
        row = df.agg(*outside)
    parts = []
    for i, c in enumerate(names):
        s, (q1, median, q3) = stats[c], cuts[c]
        numbers = [s["lo"], q1, median, s["mean"], q3, s["hi"], q3 - q1]
        parts.append((F.lit(c), *[F.lit(float(x)) for x in numbers], F.col(f"o{i}")))
    return tidy(row, parts, ["column", "min", "q1", "median", "mean", "q3", "max", "iqr", "outliers"])


def scatter_sample(df: DataFrame, columns: int | None = None, limit: int | None = None, seed: int = 42) -> DataFrame:
    """Complete rows over all numeric columns, or the first ``columns`` ones; all rows unless ``limit`` is given."""
    names = numeric_columns(df)[:columns]
    rows = df.select(*[clean(df, c).alias(c) for c in names]).na.drop()
    if limit is None:
        return rows
    return rows.orderBy(F.xxhash64(*[ref(c) for c in names], F.lit(seed)), *[ref(c) for c in names]).limit(limit)


def type_advice(df: DataFrame) -> DataFrame:
    """Columns that would fit a narrower type, or a dictionary of repeated text."""
    texts, numbers = string_columns(df), numeric_columns(df)
    parts = []
    spans = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(number(df, c)).alias(f"{t}{i}") for i, c in enumerate(numbers) for t, f in (("lo", F.min), ("hi", F.max))],
    )
    for i, c in enumerate(numbers):
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        advice = F.when((lo >= 0) & (hi < 256), "uint8").when((lo >= 0) & (hi < 65535), "uint16")
        parts.append((F.lit(c), advice, lo, hi, F.lit(None).cast("double")))
    names = ["column", "advice", "min", "max", "distinct_ratio"]
    spark = df.sparkSession
    empty = spark.createDataFrame([], "column string, advice string, min double, max double, distinct_ratio double")
    out = tidy(spans, parts, names) if parts else empty
    if texts:
        cells = long_form(df, {c: ref(c) for c in texts})
        counts = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        ratio = F.count("value") / F.sum("n")
        ratios = counts.groupBy("column").agg(ratio.alias("distinct_ratio"))
        none = F.lit(None).cast("double")
        out = out.unionByName(
            ratios.where(F.col("distinct_ratio") < 0.5).select(
                "column", F.lit("dictionary").alias("advice"), none.alias("min"), none.alias("max"), "distinct_ratio"
            )
        )
    return out.where(F.col("advice").isNotNull())


def _section(name: str, table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Melt one report part to ``(section, column, metric, value)``."""
    label = F.concat_ws(" / ", *[ref(k).cast("string") for k in key])
    cells = F.array(
        *[F.struct(F.lit(c).alias("metric"), ref(c).cast("string").alias("value")) for c in table.columns if c not in key]
    )
    return table.select(F.lit(name).alias("section"), label.alias("column"), F.inline(cells))


def profile_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All report parts in one tidy table ``(section, column, metric, value)``."""
    df = df if columns is None else df.select(*[ref(c) for c in columns])
    parts = [
        _section("shape", table_shape(df), ["column"]),
        _section("missing", missing_stats(df), ["column"]),
        _section("duplicates", duplicate_stats(df), []),
        _section("types", type_advice(df), ["column"]),
    ]
    if numeric_columns(df):
        parts.append(_section("numeric", numeric_stats(df), ["column"]))
    if string_columns(df):
        parts.append(_section("categorical", categorical_stats(df), ["column"]))
        parts.append(_section("top_values", top_values(df), ["column", "rank"]))
    if len(numeric_columns(df)) >= 2:
        parts.append(_section("correlation", correlation_matrix(df), ["col1", "col2"]))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


