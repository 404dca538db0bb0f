"""Readers and writers for flat tables (CSV, JSON) and for labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.functions.columns import ref, string_columns

# The words a CSV reader of the usual data tools takes as missing.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    na_words: Sequence[str] = NA_WORDS,
    *,
    multi_line: bool = True,
    bad_cells: str = "error",
    **options,
) -> DataFrame:
    """CSV with a header row. Cells holding one of ``na_words`` are missing.

    Typed columns are read as text first, so that ``NA`` in a number column
    becomes NULL instead of making the line malformed. Without a schema one
    scan finds integer, double and boolean columns; the rest stays text, and
    dates become timestamps only through ``parse_timestamp``.

    Quoted cells may hold line breaks; a file is then one task's work. With
    ``multi_line=False`` large files are split, and no cell may hold a break.
    A cell that is neither missing nor of its column's type is an error naming
    it, or NULL with ``bad_cells="null"``.
    """
    if bad_cells not in ("error", "null"):
        raise ValueError(f"bad_cells is 'error' or 'null', not {bad_cells!r}")
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).options(**options)
    if schema is None:
        return _infer_types(_blank_na(reader.csv(path), na_words))
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    raw = _blank_na(reader.schema(as_text).csv(path), na_words)
    return raw.select(*[_typed(f, bad_cells).alias(f.name) for f in wanted.fields])


def _typed(field: T.StructField, bad_cells: str) -> Column:
    cell, value = ref(field.name), ref(field.name).try_cast(field.dataType)
    if bad_cells == "null":
        return value
    message = F.concat(F.lit(f"column {field.name}: not {field.dataType.simpleString()}: "), cell)
    return F.when(cell.isNotNull() & value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)


def _infer_types(text: DataFrame) -> DataFrame:
    candidates = ("bigint", "double", "boolean")
    counts = []
    for i, c in enumerate(text.columns):
        counts.append(F.count(ref(c)).alias(f"n{i}"))
        counts += [F.count(ref(c).try_cast(t)).alias(f"{t}{i}") for t in candidates[:2]]
        counts.append(F.count(F.when(F.lower(ref(c)).isin("true", "false"), 1)).alias(f"boolean{i}"))
    row = text.agg(*counts).first()
    out = []
    for i, c in enumerate(text.columns):
        fits = [t for t in candidates if row[f"n{i}"] and row[f"{t}{i}"] == row[f"n{i}"]]
        out.append(ref(c).cast(fits[0]).alias(c) if fits else ref(c))
    return text.select(*out)


def _blank_na(df: DataFrame, na_words: Sequence[str]) -> DataFrame:
    text = set(string_columns(df))
    return df.select(
        *[F.when(~ref(c).isin(list(na_words)), ref(c)).alias(c) if c in text else ref(c) for c in df.columns]
    )


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, lines: bool = False
) -> DataFrame:
    """One array of records (``lines=False``) or one record per line."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, multiLine=not lines)


READERS = {"csv": read_csv, "json": read_json}


def read_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """Pick the reader from the file extension; a missing path is an error on read."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension not in READERS:
        raise ValueError(f"no reader for files ending in .{extension}: {path}")
    return READERS[extension](spark, path, **options)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, one record per row. NULL fields are kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_predictions(
    labelled: DataFrame,
    path: str,
    *,
    label: str = "prediction",
    include_features: bool = True,
    mode: str = "errorifexists",
) -> DataFrame:
    """Store labelled rows (or the label alone) with the label named ``cluster``.

    Returns the label distribution.
    """
    kept = [ref(c) for c in labelled.columns if c != label] if include_features else []
    rows = labelled.select(*kept, ref(label).alias("cluster"))
    write_csv(rows, path, mode)
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
