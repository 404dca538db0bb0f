"""Column scaling with stored parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import number, numeric_columns, ref
from tablelab.functions.quantiles import quantiles

METHODS = ("standard", "minmax", "robust")


@dataclass
class Scale:
    column: str
    method: str
    center: float
    scale: float
    minimum: float
    maximum: float


def fit_scale(
    df: DataFrame,
    method: str = "standard",
    columns: Sequence[str] | None = None,
    *,
    exclude: Sequence[str] = (),
    exact: bool = True,
) -> list[Scale]:
    """Centre and divisor per column; a constant column is divided by one."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, expected one of {METHODS}")
    names = [c for c in (columns if columns is not None else numeric_columns(df)) if c not in exclude]
    if not names:
        return []
    values = {c: number(df, c) for c in names}
    extra = []
    for i, c in enumerate(names):
        v = values[c]
        extra += [f(v).alias(f"{a}{i}") for a, f in (("m", F.avg), ("s", F.stddev_pop), ("lo", F.min), ("hi", F.max))]
    if method == "robust":
        cuts, row = quantiles(df, values, [0.25, 0.5, 0.75], exact=exact, extra=extra)
    else:
        cuts, row = {}, df.agg(*extra).first()
    out = []
    for i, c in enumerate(names):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None:
            continue
        if method == "standard":
            center, width = row[f"m{i}"], row[f"s{i}"]
        elif method == "minmax":
            center, width = lo, hi - lo
        else:
            q1, center, q3 = cuts[c]
            width = q3 - q1
        out.append(Scale(c, method, center, width if width and lo != hi else 1.0, lo, hi))
    return out


def apply_scale(df: DataFrame, scales: Sequence[Scale]) -> DataFrame:
    by_column = {s.column: s for s in scales}
    return df.select(
        *[
            ((number(df, c) - F.lit(by_column[c].center)) / F.lit(by_column[c].scale)).alias(c) if c in by_column else ref(c)
            for c in df.columns
        ]
    )


def scale(df: DataFrame, method: str = "standard", columns: Sequence[str] | None = None, **options) -> DataFrame:
    return apply_scale(df, fit_scale(df, method, columns, **options))


def scale_table(df: DataFrame, scales: Sequence[Scale]) -> DataFrame:
    schema = "column string, method string, center double, scale double, minimum double, maximum double"
    return df.sparkSession.createDataFrame([astuple(s) for s in scales], schema)
