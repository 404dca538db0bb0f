"""Calendar parts of date and timestamp columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import datetime_columns, ref

PARTS = ("year", "month", "day", "dayofweek", "is_weekend", "is_month_start", "is_month_end")


def date_part(column: Column, part: str) -> Column:
    """One part. Weekdays count from Monday = 0; flags are 0 for missing dates."""
    if part == "year":
        return F.year(column)
    if part == "month":
        return F.month(column)
    if part == "day":
        return F.dayofmonth(column)
    if part == "dayofweek":
        return F.weekday(column)
    if part == "is_weekend":
        flag = F.weekday(column).isin(5, 6)
    elif part == "is_month_start":
        flag = F.dayofmonth(column) == 1
    elif part == "is_month_end":
        flag = F.to_date(column) == F.last_day(column)
    else:
        raise ValueError(f"unknown date part {part!r}")
    return F.coalesce(flag.cast("int"), F.lit(0))


def add_date_part(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.select("*", date_part(ref(column), part).alias(f"{column}_{part}"))


def date_features(df: DataFrame, columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """All parts of the given columns, or of every date column; of the first ``limit`` ones on request."""
    names = list(columns) if columns is not None else datetime_columns(df)[:limit]
    return df.select("*", *[date_part(ref(c), p).alias(f"{c}_{p}") for c in names for p in PARTS])
