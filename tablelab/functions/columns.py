"""Column classes, missing-value tests and shared column-wise aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.FloatType, T.DoubleType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, *FRACTIONAL)
DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def ref(name: str) -> Column:
    """Column by exact name, also when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def _of_type(df: DataFrame, types: tuple, exclude: Iterable[str]) -> list[str]:
    skipped = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types) and f.name not in skipped]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return _of_type(df, NUMERIC, exclude)


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return _of_type(df, (T.StringType,), exclude)


def datetime_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return _of_type(df, DATETIME, exclude)


def boolean_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return _of_type(df, (T.BooleanType,), exclude)


def clean(df: DataFrame, name: str) -> Column:
    """The column with NaN read as NULL, so both count as missing."""
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return F.nanvl(ref(name), F.lit(None).cast(df.schema[name].dataType))
    return ref(name)


def number(df: DataFrame, name: str) -> Column:
    return clean(df, name).cast("double")


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column; call once on entry."""
    if not _of_type(df, FRACTIONAL, ()):
        return df
    return df.select(*[clean(df, c).alias(c) for c in df.columns])


def draw_share(key: Sequence[str], seed: int, share: Column | float) -> Column:
    """Whether a row is drawn: the first 28 bits of md5 over seed and key, so that any engine draws the same rows."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(ref(k).cast("string"), F.lit("")) for k in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("bigint") < share * (1 << 28)


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def tidy(row: DataFrame, parts: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate into one row per part."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(part, names)]) for part in parts]
    return row.select(F.inline(F.array(*structs)))


def long_form(df: DataFrame, values: dict[str, Column], keep: Sequence[Column] = ()) -> DataFrame:
    """Rows ``(keep..., column, value)`` for columns of one common type."""
    cells = F.array(*[F.struct(F.lit(name).alias("column"), value.alias("value")) for name, value in values.items()])
    return df.select(*keep, F.inline(cells))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` over non-missing cells of same-typed columns.

    Counts combine before the shuffle, so a value holding a third of the rows
    reaches its reducer as one row per map task.
    """
    cells = long_form(df, {c: clean(df, c) for c in columns})
    return cells.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def literal(df: DataFrame, name: str, value) -> Column:
    """A literal of the column's own type, independent of the Python time zone."""
    kind = df.schema[name].dataType
    if isinstance(kind, DATETIME):
        return F.lit(str(value)).cast(kind)
    return F.lit(value).cast(kind)
