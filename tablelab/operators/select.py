"""Projections, filters and row alignment."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import boolean_columns, clean, draw_share, numeric_columns, ref, string_columns


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[ref(c) for c in [*keep, *numeric_columns(df, keep)]])


def select_categorical(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[ref(c) for c in [*keep, *string_columns(df, keep)]])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def split_target(df: DataFrame, target: str, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Features without the target, and the target beside the same key."""
    if target not in df.columns:
        return df, df.select(*[ref(k) for k in key])
    return df.drop(target), df.select(*[ref(k) for k in key], ref(target))


def bool_to_int(df: DataFrame) -> DataFrame:
    flags = set(boolean_columns(df))
    return df.select(*[ref(c).cast("int").alias(c) if c in flags else ref(c) for c in df.columns])


def model_inputs(df: DataFrame, key: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Key columns, then all numeric and boolean columns with booleans as 0/1."""
    wanted = set(numeric_columns(df)) | set(boolean_columns(df))
    names = [c for c in df.columns if c in wanted and c not in key and c not in drop]
    return bool_to_int(df.select(*[ref(k) for k in key], *[ref(c) for c in names]))


def parse_timestamp(df: DataFrame, column: str, pattern: str | None = None) -> DataFrame:
    """Text to timestamp in place; text that cannot be read becomes NULL."""
    text = ref(column).cast("string")
    parsed = F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
    return df.withColumn(column, parsed)


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    condition = F.lit(True)
    for c in columns:
        condition = condition & clean(df, c).isNotNull()
    return df.where(condition)


def null_shares(df: DataFrame) -> dict[str, float]:
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(clean(df, c).isNull(), 1)).alias(c) for c in df.columns],
    ).first()
    return {c: (row[c] / row["__rows"] if row["__rows"] else 0.0) for c in df.columns}


def drop_sparse_columns(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    shares = null_shares(df)
    return df.select(*[ref(c) for c in df.columns if not shares[c] > threshold])


def align_to_source(source: DataFrame, labelled: DataFrame, key: Sequence[str], label: str = "prediction") -> DataFrame:
    """Labels beside the original rows that survived cleaning, matched by key."""
    return source.join(labelled.select(*[ref(k) for k in key], ref(label)), list(key), "inner")


def sample_split(
    df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42, *, mode: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows. The hash mode depends on the key and seed alone."""
    if mode == "random":
        train, test = df.randomSplit([1 - test_size, test_size], seed=seed)
        return train, test
    in_test = in_test_set(key, test_size, seed)
    return df.where(~in_test), df.where(in_test)


def in_test_set(key: Sequence[str], test_size: float, seed: int) -> Column:
    return draw_share(key, seed, test_size)


def group_filter(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(ref(column) == F.lit(value))


