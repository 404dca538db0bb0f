"""Categorical encoding: one-hot, label, frequency and the automatic choice."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import ref, string_columns, value_counts
from tablelab.functions.lookup import lookup_join
from tablelab.functions.ordering import ROWS_PER_BUCKET, global_row_number
from tablelab.session import materialise

ONE_HOT_LIMIT = 1000


@dataclass
class Encoding:
    """Fitted encoding of one column. Label and frequency keep a dictionary frame."""

    column: str
    kind: str
    distinct: int
    total: int
    octets: int = 0
    categories: list[str] = field(default_factory=list)
    dictionary: DataFrame | None = None


def _sizes(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[int, int, int]]:
    """Distinct values, non-missing rows and bytes of the distinct values per column, in one job."""
    rows = (
        value_counts(df, names).groupBy("column").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("t"), F.sum(F.octet_length(F.col("value").cast("string"))).alias("b")).collect()
        if names
        else []
    )
    found = {r["column"]: (r["d"], r["t"], r["b"]) for r in rows}
    return {c: found.get(c, (0, 0, 0)) for c in names}


def fit_encoding(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "auto",
    *,
    threshold: int = 10,
    order_by: Sequence[str] = (),
    exclude: Sequence[str] = (),
    one_hot_limit: int = ONE_HOT_LIMIT,
) -> list[Encoding]:
    """``auto`` one-hot encodes up to ``threshold`` distinct values, else label encodes.

    Label codes count from 0 in order of first appearance under ``order_by``.
    """
    kinds = {"auto": None, "onehot": "onehot", "label": "label", "frequency": "frequency"}
    if method not in kinds:
        raise ValueError(f"unknown method {method!r}, expected one of {tuple(kinds)}")
    names = [c for c in (columns if columns is not None else string_columns(df)) if c not in exclude]
    sizes = _sizes(df, names)
    out = []
    for c in names:
        kind = kinds[method] or ("onehot" if sizes[c][0] <= threshold else "label")
        if kind == "onehot" and sizes[c][0] > one_hot_limit:
            raise ValueError(f"{c} has {sizes[c][0]} distinct values, more than the one-hot limit of {one_hot_limit}")
        if kind == "label" and not order_by:
            raise ValueError(f"label encoding of {c} needs order_by")
        out.append(Encoding(c, kind, *sizes[c]))
    wide = [e for e in out if e.kind == "onehot"]
    if wide:
        for r in value_counts(df, [e.column for e in wide]).select("column", "value").collect():
            next(e for e in wide if e.column == r["column"]).categories.append(r["value"])
        for e in wide:
            e.categories.sort()
    for e in out:
        if e.kind == "label":
            e.dictionary = label_dictionary(df, e.column, order_by, e.distinct)
        elif e.kind == "frequency":
            counts = df.where(ref(e.column).isNotNull()).groupBy(ref(e.column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            e.dictionary = counts.withColumn("code", F.col("n") / F.lit(e.total))
    return out


def label_dictionary(
    df: DataFrame, column: str, order_by: Sequence[str], distinct: int, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``(value, n, code)``; first appearances are ranked without a single-task window."""
    groups = df.where(ref(column).isNotNull()).groupBy(ref(column).alias("value"))
    n = F.count(F.lit(1)).alias("n")
    if len(order_by) == 1:
        firsts = groups.agg(n, F.min(ref(order_by[0])).alias("k0"))
    else:
        first = F.min(F.struct(*[ref(k).alias(f"k{i}") for i, k in enumerate(order_by)])).alias("first")
        firsts = groups.agg(n, first).select("value", "n", "first.*")
    keys = [*[f"k{i}" for i in range(len(order_by))], "value"]
    if distinct > rows_per_bucket:
        firsts = materialise(firsts)
    ranked = global_row_number(firsts, keys, "code", total=distinct, rows_per_bucket=rows_per_bucket)
    return ranked.select("value", "n", "code")


def apply_encoding(df: DataFrame, encodings: Sequence[Encoding]) -> DataFrame:
    """Encoded columns keep their place, one-hot columns replace theirs at the end."""
    out = df
    for e in encodings:
        if e.kind != "onehot":
            joined = lookup_join(out, e.dictionary, e.column, size=e.distinct, total=e.total, octets=e.octets)
            out = joined.select(*[F.col("__code").alias(c) if c == e.column else ref(c) for c in out.columns])
    wide = [e for e in encodings if e.kind == "onehot"]
    if not wide:
        return out
    gone = {e.column for e in wide}
    kept = [ref(c) for c in out.columns if c not in gone]
    flags = [
        F.coalesce(ref(e.column) == F.lit(v), F.lit(False)).alias(f"{e.column}_{v}") for e in wide for v in e.categories
    ]
    return out.select(*kept, *flags)


def encode(df: DataFrame, columns: Sequence[str] | None = None, method: str = "auto", **options) -> DataFrame:
    return apply_encoding(df, fit_encoding(df, columns, method, **options))


def one_hot(df: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    return encode(df, columns, "onehot", **options)


def label_encode(df: DataFrame, columns: Sequence[str] | None = None, *, order_by: Sequence[str]) -> DataFrame:
    return encode(df, columns, "label", order_by=order_by)


def frequency_encode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return encode(df, columns, "frequency")


