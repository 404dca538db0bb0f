"""Sums over pairs of columns, for the rows that have both: one scan for any number of columns.

A task multiplies its rows as matrices, with zeros and a mask where a value is
missing, and returns one row per pair of columns. Values are taken from an
origin near the middle of their column, so that squares lose no digits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that show where the middle of a column lies; the result doesn't depend on them but for rounding.
ORIGIN_ROWS = 1000
#: Rows that are multiplied together.
ROWS = 8192

SUMS = ("n", "x", "y", "xx", "yy", "xy")


def _origin(cells: DataFrame) -> np.ndarray:
    """By column a value of the first rows, the middle one; 0 without any."""
    first = np.array([tuple(r) for r in cells.limit(ORIGIN_ROWS).collect()], dtype=float).reshape(-1, len(cells.columns))
    out = np.zeros(first.shape[1])
    for i, column in enumerate(first.T):
        there = np.sort(column[np.isfinite(column)])
        if len(there):
            out[i] = there[len(there) // 2]
    return out


def pair_sums(df: DataFrame, values: list[Column], weight: Column | None = None) -> DataFrame:
    """i, j (i <= j), n, x, y, xx, yy, xy over the rows where both columns have a value.

    Sums are of differences from a column's origin. NaN counts as missing;
    infinite values are kept and make the sums of their pairs NaN or infinite.
    With ``weight`` a row stands for so many equal ones.
    """
    cells = df.select(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)])
    origin, width, weighted = _origin(cells), len(values), weight is not None
    if weighted:
        cells = df.select(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)], weight.cast("double").alias("weight"))
    low, high = np.triu_indices(width)

    def multiply(batches):
        total = np.zeros((4, width, width))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns[:width]]).astype(float, copy=False)
                there = ~np.isnan(x)
                mask = there.astype(float)
                times = mask * part.column("weight").to_numpy(zero_copy_only=False)[:, None] if weighted else mask
                with np.errstate(invalid="ignore", over="ignore"):
                    x = np.where(there, x - origin, 0.0)
                    for t, (a, b) in zip(total, ((times, mask), (x, times), (x * x, times), (x * times if weighted else x, x))):
                        t += a.T @ b
        n, one, two, both = total
        columns = [n[low, high].round().astype(np.int64), one[low, high], one[high, low], two[low, high], two[high, low], both[low, high]]
        yield pa.RecordBatch.from_arrays([pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), *map(pa.array, columns)], names=["i", "j", *SUMS])

    sums = cells.mapInArrow(multiply, "i int, j int, n long, x double, y double, xx double, yy double, xy double")
    # Without rows there may be no task; every pair gets its row.
    pairs = df.sparkSession.range(width).select(F.col("id").cast("int").alias("i"), F.explode(F.sequence(F.col("id").cast("int"), F.lit(width - 1))).alias("j"))
    none = pairs.select("i", "j", F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(s) for s in SUMS[1:]])
    return sums.unionByName(none).groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])


def correlation(sums: DataFrame) -> DataFrame:
    """i, j, r: Pearson's correlation of each pair; null with fewer than two rows or without spread."""

    n = F.nullif(F.col("n"), F.lit(0))

    def spread(one: str, two: str) -> Column:
        square = F.col(one) * F.col(one) / n
        left = F.col(two) - square
        # What is left of rounding alone is no spread.
        return F.when(left > 1e-14 * F.col(two), left)

    apart = (F.col("xy") - F.col("x") * F.col("y") / n) / F.sqrt(spread("x", "xx")) / F.sqrt(spread("y", "yy"))
    r = F.when((F.col("n") > 1) & apart.isNotNull() & ~F.isnan(apart), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), apart)))
    return sums.select("i", "j", F.when(F.col("i") == F.col("j"), F.when(apart.isNotNull(), 1.0)).otherwise(r).alias("r"))
