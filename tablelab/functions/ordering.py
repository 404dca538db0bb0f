"""Global order without a single-task window.

Rows are cut into range buckets by key boundaries taken from a hashed key
sample; the bucket is a pure function of the key, so a retried task puts a row
where the first attempt did. Work inside a bucket is an ordinary window, and
only one small summary per bucket crosses bucket borders.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelab.functions.columns import all_of, clean, ref, same

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096
BUCKET = "__bucket"


def insertion_point(value: Column, bounds: Column, size: int) -> Column:
    """Number of entries of the sorted array ``bounds`` that are <= ``value``."""
    if size == 0:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(size.bit_length()))]

    def advance(position: Column, step: Column) -> Column:
        ahead = position + step
        return F.when((ahead <= size) & (F.get(bounds, ahead - 1) <= value), ahead).otherwise(position)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def number_array(values: Sequence[float]) -> Column:
    """A double array as one foldable literal, cheap to send for thousands of values."""
    if not values:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def range_bounds(
    df: DataFrame,
    keys: Sequence[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    max_buckets: int = MAX_BUCKETS,
    total: int | None = None,
) -> list[tuple]:
    """Boundary keys, as text, that cut ``df`` into buckets of about equal size."""
    total = df.count() if total is None else total
    buckets = min(max_buckets, math.ceil(total / rows_per_bucket))
    if buckets <= 1:
        return []
    share = min(1.0, 40.0 * buckets / total)
    draw = F.pmod(F.xxhash64(*[ref(k) for k in keys]), F.lit(1 << 30)) < int(share * (1 << 30))
    order = [ref(k).asc_nulls_first() for k in keys]
    # Drawn keys come with their row counts, once each: about 40 per bucket, however many rows share one.
    sample = (
        df.select(*[ref(k) for k in keys])
        .where(draw)
        .groupBy(*[ref(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"))
        .orderBy(*order)
        .select(*[ref(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)], "__n")
        .collect()
    )
    drawn = sum(r["__n"] for r in sample)
    cuts, passed = [], 0
    for r in sample:
        # A cut before the first key of each further bucket's share.
        if passed and passed * buckets // drawn > (len(cuts) and cuts[-1][1]):
            cuts.append((tuple(r)[:-1], passed * buckets // drawn))
        passed += r["__n"]
    return [key for key, _ in cuts]


def bucket_of(df: DataFrame, keys: Sequence[str], bounds: Sequence[tuple]) -> Column:
    if not bounds:
        return F.lit(0)
    kinds = [df.schema[k].dataType for k in keys]
    names = [f"k{i}" for i in range(len(keys))]
    table = F.array(
        *[F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(bound, kinds, names)]) for bound in bounds]
    )
    key = F.struct(*[ref(k).alias(n) for k, n in zip(keys, names)])
    return insertion_point(key, table, len(bounds))


def ordered_fill(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    directions: Sequence[str] = ("forward",),
    *,
    where: dict[str, Column] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Fill missing cells from the nearest non-missing row in key order.

    ``directions`` are tried in turn (``forward``, then ``backward`` for what is
    left). ``order_by`` must order the rows of one partition without ties. A
    partition value of any size is cut over buckets like the whole table is.
    """
    keys = [*partition_by, *order_by]
    bounds = range_bounds(df, keys, rows_per_bucket)
    marked = df.withColumn(BUCKET, bucket_of(df, keys, bounds))
    values = {c: F.when(where[c], clean(df, c)) if where and c in where else clean(df, c) for c in columns}
    near = Window.partitionBy(BUCKET, *[ref(p) for p in partition_by])
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    local: dict[tuple[str, str], Column] = {}
    for direction in directions:
        # A backward fill is a forward fill over the reversed order: the frame
        # then only grows, where "current row to end" would be rescanned per row.
        order = [ref(k).asc_nulls_first() if direction == "forward" else ref(k).desc_nulls_last() for k in order_by]
        frame = near.orderBy(*order).rowsBetween(*up_to_here)
        for c in columns:
            local[(c, direction)] = F.last(values[c], ignorenulls=True).over(frame)

    def filled(carry) -> list[Column]:
        out = []
        for c in df.columns:
            if c not in columns:
                out.append(ref(c))
                continue
            tries = [clean(df, c)]
            for d in directions:
                tries += [F.col(f"__{d}_{columns.index(c)}"), *carry(columns.index(c), d)]
            out.append(F.coalesce(*tries).alias(c))
        return out

    windowed = marked.select("*", *[local[(c, d)].alias(f"__{d}_{columns.index(c)}") for c in columns for d in directions])
    if not bounds:
        return windowed.select(*filled(lambda i, d: []))

    summary = marked
    if partition_by:
        # Only a partition value named by a boundary can lie in two buckets.
        named = sorted({b[: len(partition_by)] for b in bounds}, key=str)
        text = df.sparkSession.createDataFrame(named, ", ".join(f"__s{i} string" for i in range(len(partition_by))))
        split = text.select(*[F.col(f"__s{i}").cast(df.schema[p].dataType) for i, p in enumerate(partition_by)])
        on = all_of([same(ref(p), F.col(f"__s{i}")) for i, p in enumerate(partition_by)])
        summary = marked.join(F.broadcast(split), on, "left_semi")
    picks = [
        _edge(values[c], order_by, d).alias(f"__edge_{d}_{i}") for i, c in enumerate(columns) for d in directions
    ]
    edges = summary.groupBy(BUCKET, *[ref(p) for p in partition_by]).agg(*picks)
    across = Window.partitionBy(*[ref(p) for p in partition_by])
    carries = []
    for i in range(len(columns)):
        for d in directions:
            order = F.col(BUCKET).asc() if d == "forward" else F.col(BUCKET).desc()
            frame = across.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
            carries.append(F.last(f"__edge_{d}_{i}", ignorenulls=True).over(frame).alias(f"__carry_{d}_{i}"))
    names = [f"__p{i}" for i in range(len(partition_by))]
    carried = edges.select(
        F.col(BUCKET).alias("__carry_bucket"), *[ref(p).alias(n) for p, n in zip(partition_by, names)], *carries
    )
    # At most two rows per boundary, so the broadcast size is bounded by MAX_BUCKETS.
    match = all_of(
        [F.col(BUCKET) == F.col("__carry_bucket"), *[same(ref(p), F.col(n)) for p, n in zip(partition_by, names)]]
    )
    joined = windowed.join(F.broadcast(carried), match, "left")
    return joined.select(*filled(lambda i, d: [F.col(f"__carry_{d}_{i}")]))


def _edge(value: Column, order_by: Sequence[str], direction: str) -> Column:
    """Last (first) non-missing value of a bucket; rows without a key come first.

    A single key is compared as it is, so that number columns aggregate by hash.
    """
    pick = F.max_by if direction == "forward" else F.min_by
    has = value.isNotNull()
    if len(order_by) > 1:
        return pick(value, F.when(has, F.struct(*[ref(k) for k in order_by])))
    key = ref(order_by[0])
    keyed, unkeyed = pick(value, F.when(has, key)), F.max(F.when(key.isNull(), value))
    return F.coalesce(keyed, unkeyed) if direction == "forward" else F.coalesce(unkeyed, keyed)


def global_row_number(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    *,
    total: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Position of each row, from 0, in the order of ``order_by`` (no ties)."""
    bounds = range_bounds(df, order_by, rows_per_bucket, total=total)
    marked = df.withColumn(BUCKET, bucket_of(df, order_by, bounds))
    inner = F.row_number().over(Window.partitionBy(BUCKET).orderBy(*[ref(k).asc_nulls_first() for k in order_by]))
    if not bounds:
        return marked.withColumn(name, (inner - 1).cast("long")).drop(BUCKET)
    sizes = {r[BUCKET]: r["count"] for r in marked.groupBy(BUCKET).count().collect()}
    starts, total = [], 0
    for b in range(len(bounds) + 1):
        starts.append(total)
        total += sizes.get(b, 0)
    offset = F.get(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), F.col(BUCKET))
    return marked.withColumn(name, (offset + inner - 1).cast("long")).drop(BUCKET)
