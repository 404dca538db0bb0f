"""The most frequent values of columns, exact, without shuffling all distinct values.

One scan keeps a bounded summary per task and column: values with counts. When
a summary overflows, the rarest values go, and the largest count that went adds
to the error: no value is counted short by more. Summaries add up, errors too.

A column whose summaries never overflowed is counted exactly. Else the values
that may belong to the most frequent ones, within the error, are counted in a
second scan; no other value can be as frequent as the last one of them. Where
that proof fails, as in a column of values that hardly repeat, or too many
values qualify, all values are counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.functions.columns import FRACTIONAL, clean, long_form
from tablelab.session import in_parallel, materialise

#: Values that a summary keeps, and candidates of a column that are counted by broadcast.
COUNTERS, CANDIDATES = 4096, 20_000


def _kept(table: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """The most frequent rows of a table of values and counts, and the largest count that goes."""
    if table.num_rows <= counters:
        return table, 0
    table = table.sort_by([("n", "descending")])
    return table.slice(0, counters), table.column("n")[counters].as_py()


def _added(held: pa.Table | None, part: pa.Array, counters: int) -> tuple[pa.Table, int]:
    """The summary with one more batch of values, and by how much more its counts may be short."""
    found = pc.value_counts(part.drop_null())
    table = pa.table({"value": found.field("values"), "n": found.field("counts")})
    if held is not None:
        table = pa.concat_tables([held, table]).group_by("value").aggregate([("n", "sum")]).select(["value", "n_sum"]).rename_columns(["value", "n"])
    return _kept(table, counters)


def summaries(df: DataFrame, values: dict[str, Column], counters: int = COUNTERS) -> DataFrame:
    """column, value, n (at most so much short of the truth as the error); the error is in the row of the null value.

    The columns are of one type. A task returns at most ``counters`` rows per column.
    """
    names = list(values)
    cells = df.select(*[(v + F.lit(0.0) if fractional else v).alias(f"v{i}") for i, (v, fractional) in enumerate(_typed(df, values))])
    kind = cells.schema[0].dataType

    def count(batches):
        held: list[tuple[pa.Table | None, int]] = [(None, 0)] * len(names)
        for batch in batches:
            for i, (table, error) in enumerate(held):
                table, more = _added(table, batch.column(i), counters)
                held[i] = (table, error + more)
        for name, (table, error) in zip(names, held):
            if table is not None:
                size = table.num_rows
                rows = pa.table({"column": pa.array([name] * size, pa.string()), "value": table.column("value"), "n": table.column("n").cast(pa.int64())})
                yield from rows.combine_chunks().to_batches()
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.nulls(1, table.schema.field("value").type), pa.array([error], pa.int64())], names=["column", "value", "n"])

    schema = T.StructType([T.StructField("column", T.StringType()), T.StructField("value", kind), T.StructField("n", T.LongType())])
    return cells.mapInArrow(count, schema).groupBy("column", "value").agg(F.sum("n").alias("n"))


def _typed(df: DataFrame, values: dict[str, Column]) -> list[tuple[Column, bool]]:
    """The columns, and whether they are fractional: adding zero turns -0.0 into 0.0, which Spark groups together."""
    kinds = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())]).schema
    return [(v, isinstance(f.dataType, FRACTIONAL)) for v, f in zip(values.values(), kinds)]


def frequent_values(
    df: DataFrame, values: dict[str, Column], n: int = 1, *, counters: int = COUNTERS, candidates: int = CANDIDATES
) -> tuple[DataFrame, dict[str, str]]:
    """(column, value, n, rank) of the ``n`` most frequent values, equal counts by value; and how each column was counted.

    Null values don't count. ``summary``: one scan; ``recount``: a second one
    for the candidates; ``all``: all distinct values.
    """
    counters = max(counters, n)
    merged = materialise(summaries(df, values, counters))
    present = merged.where("value IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value")))
    # Two rows per column: the error, and the last of the most frequent values.
    place = F.row_number().over(Window.partitionBy("column", F.isnull("value")).orderBy(F.col("n").desc(), F.col("value")))
    known = merged.withColumn("place", place).where(F.col("value").isNull() | (F.col("place") == n)).select("column", "n", F.isnull("value").alias("error")).collect()
    errors, last = ({r["column"]: r["n"] for r in known if r["error"] == e} for e in (True, False))
    how = {c: "summary" if not errors.get(c) else "recount" if errors[c] < last.get(c, 0) else "all" for c in values}
    some = {c: last[c] - errors[c] for c in values if how[c] == "recount"}
    parts = [present.where(F.col("column").isin([c for c in values if how[c] == "summary"]))]
    if some:
        least = F.create_map(*[F.lit(x) for c, x in some.items() for x in (c, x)])
        chosen = present.where(F.col("column").isin(list(some)) & (F.col("n") >= least[F.col("column")])).select("column", "value")
        many = {r["column"] for r in chosen.groupBy("column").count().where(F.col("count") > candidates).collect()}
        how |= dict.fromkeys(many, "all")
        again = [c for c in some if c not in many]
        if again:
            cells = long_form(df, {c: values[c] for c in again})
            # At most ``candidates`` values per column.
            found = cells.join(F.broadcast(chosen.where(F.col("column").isin(again))), ["column", "value"])
            parts.append(found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    rest = [c for c in values if how[c] == "all"]
    if rest:
        cells = long_form(df, {c: values[c] for c in rest}).where("value IS NOT NULL")
        parts.append(cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("rank", rank).where(F.col("rank") <= n), how


def modes(df: DataFrame, columns: Sequence[str], where: dict[str, Column] | None = None) -> dict:
    """Most frequent value per column, the smallest on ties; absent if all missing."""
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)

    def of_type(names: list[str]) -> dict:
        values = {c: F.when(where[c], clean(df, c)) if where and c in where else clean(df, c) for c in names}
        # One row per column.
        return {r["column"]: r["value"] for r in frequent_values(df, values)[0].collect()}

    found = in_parallel([partial(of_type, names) for names in by_type.values()], len(by_type))
    return {c: v for part in found for c, v in part.items()}
