"""Filling and dropping of missing values: fit small rules, then one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.functions.columns import DATETIME, FRACTIONAL, NUMERIC, all_of, clean, literal, number, ref
from tablelab.functions.frequent import modes
from tablelab.functions.ordering import ROWS_PER_BUCKET, ordered_fill
from tablelab.functions.quantiles import quantiles

NO_MODE = "MISSING"
PATTERN_LIMIT = 100_000
WORD_BITS = 32
ORDERED = {"ffill": ("forward",), "bfill": ("backward",), "ffill_bfill": ("forward", "backward")}
STRATEGIES = ("auto", "mean", "median", "mode", "ffill", "bfill", "zero", "constant")


@dataclass
class FillRule:
    """What to do with one column. ``alive`` names the drop-row columns before it."""

    column: str
    strategy: str
    missing_before: int
    fill_value: object = None
    alive: tuple[str, ...] = ()

    def record(self) -> dict:
        out = asdict(self)
        value = self.fill_value
        out["fill_value"] = value if value is None or isinstance(value, (bool, int, float, str)) else str(value)
        return out


def missing_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(clean(df, c).isNull(), 1)).alias(f"__m{i}") for i, c in enumerate(df.columns)],
    ).first()
    return row["__rows"], {c: row[f"__m{i}"] for i, c in enumerate(df.columns)}


def fit_fill(
    df: DataFrame,
    strategy: str = "auto",
    columns: Sequence[str] | None = None,
    *,
    constant_value=0,
    threshold: float = 0.8,
    text_zero: bool = False,
    exact: bool = True,
    exclude: Sequence[str] = (),
) -> list[FillRule]:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, expected one of {STRATEGIES}")
    names = [c for c in (columns if columns is not None else df.columns) if c not in exclude]
    if strategy == "auto":
        return _fit_auto(df, names, threshold, exact)
    _, missing = missing_counts(df.select(*[ref(c) for c in names]))
    holed = [c for c in names if missing[c]]
    numbers = [c for c in holed if isinstance(df.schema[c].dataType, NUMERIC)]
    values: dict[str, object] = {}
    if strategy == "mean" and numbers:
        row = df.agg(*[F.avg(number(df, c)).alias(f"v{i}") for i, c in enumerate(numbers)]).first()
        values = {c: row[f"v{i}"] for i, c in enumerate(numbers)}
    elif strategy == "median" and numbers:
        cuts, _ = quantiles(df, {c: number(df, c) for c in numbers}, [0.5], exact=exact)
        values = {c: cuts[c][0] for c in numbers}
    elif strategy == "mode":
        values = modes(df, holed)
        values.update({c: NO_MODE for c in holed if c not in values and _is_text(df, c)})
    elif strategy in ("zero", "constant"):
        value = 0 if strategy == "zero" else constant_value
        for c in holed:
            if c in numbers and not isinstance(value, str):
                values[c] = value
            elif _is_text(df, c) and (isinstance(value, str) or text_zero):
                values[c] = str(value)
            elif isinstance(df.schema[c].dataType, T.BooleanType) and isinstance(value, bool):
                values[c] = value
    if strategy in ORDERED:
        return [FillRule(c, strategy, missing[c]) for c in holed]
    return [
        FillRule(c, strategy if values.get(c) is not None else "not_applied", missing[c], values.get(c)) for c in holed
    ]


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _fit_auto(df: DataFrame, names: Sequence[str], threshold: float, exact: bool) -> list[FillRule]:
    """Replay the column-order rules: each row drop changes what later columns see.

    The null-pattern counts are enough to replay every decision, so one grouped
    count replaces a scan per column. Fill values then need one further pass,
    each column restricted to the rows alive at its turn.
    """
    rules: list[FillRule] = []
    dropping: list[str] = []
    count = _pattern_counter(df, names)
    for c in names:
        rows, missing = count(c, tuple(dropping))
        if missing == 0:
            continue
        percent = missing / rows * 100
        kind = df.schema[c].dataType
        alive = tuple(dropping)
        if percent > threshold * 100:
            rules.append(FillRule(c, "drop_column", missing, alive=alive))
        elif percent < 1:
            rules.append(FillRule(c, "drop_rows", missing, alive=alive))
            dropping.append(c)
        elif isinstance(kind, NUMERIC):
            rules.append(FillRule(c, "median", missing, alive=alive))
        elif isinstance(kind, DATETIME):
            rules.append(FillRule(c, "ffill_bfill", missing, alive=alive))
        else:
            rules.append(FillRule(c, "mode", missing, alive=alive))
    medians = [r for r in rules if r.strategy == "median"]
    if medians:
        cells = {r.column: F.when(_alive(df, r.alive), number(df, r.column)) for r in medians}
        cuts, _ = quantiles(df, cells, [0.5], exact=exact)
        for r in medians:
            r.fill_value = cuts[r.column][0]
    common = [r for r in rules if r.strategy == "mode"]
    if common:
        found = modes(df, [r.column for r in common], {r.column: _alive(df, r.alive) for r in common})
        for r in common:
            default = NO_MODE if _is_text(df, r.column) else None
            r.fill_value = found.get(r.column, default)
    return rules


def _pattern_counter(df: DataFrame, names: Sequence[str]):
    """``count(column, dropped) -> (rows alive, missing among them)``."""
    # One bit per column, in as few numbers as hold them.
    gaps = [F.when(clean(df, c).isNull(), F.lit(1 << i % WORD_BITS)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(names)]
    words = [reduce(add, gaps[i : i + WORD_BITS]).alias(f"w{i // WORD_BITS}") for i in range(0, len(gaps), WORD_BITS)]
    patterns = df.groupBy(*words).agg(F.count(F.lit(1)).alias("n")).limit(PATTERN_LIMIT + 1).collect()
    position = {c: i for i, c in enumerate(names)}
    if len(patterns) <= PATTERN_LIMIT:

        def is_gap(pattern, column):
            return pattern[position[column] // WORD_BITS] >> position[column] % WORD_BITS & 1

        def from_patterns(column, dropped):
            alive = [p for p in patterns if not any(is_gap(p, d) for d in dropped)]
            return sum(p["n"] for p in alive), sum(p["n"] for p in alive if is_gap(p, column))

        return from_patterns

    seen: dict[tuple, tuple] = {}

    def from_scans(column, dropped):
        # A new scan only after a row-drop decision; it counts all columns at once.
        if dropped not in seen:
            seen[dropped] = missing_counts(df.select(*[ref(c) for c in names]).where(_alive(df, dropped)))
        rows, missing = seen[dropped]
        return rows, missing[column]

    return from_scans


def _alive(df: DataFrame, dropped: Sequence[str]) -> Column:
    return all_of([clean(df, d).isNotNull() for d in dropped])


def apply_fill(
    df: DataFrame,
    rules: Sequence[FillRule],
    *,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    keep_rows: bool = False,
) -> DataFrame:
    """Apply fitted rules. Mean and median fills turn integer columns into doubles.

    ``keep_rows`` leaves in the rows that a drop-row rule would take out.
    """
    out = df
    for strategy, directions in ORDERED.items():
        chosen = [r for r in rules if r.strategy == strategy]
        if not chosen:
            continue
        if not order_by:
            raise ValueError(f"{strategy} of {[r.column for r in chosen]} needs order_by")
        out = ordered_fill(
            out,
            [r.column for r in chosen],
            order_by,
            partition_by,
            directions,
            where={r.column: _alive(df, r.alive) for r in chosen if r.alive},
            rows_per_bucket=rows_per_bucket,
        )
    rows_dropped = [r.column for r in rules if r.strategy == "drop_rows"]
    if rows_dropped and not keep_rows:
        out = out.where(_alive(out, rows_dropped))
    columns_dropped = {r.column for r in rules if r.strategy == "drop_column"}
    by_column = {r.column: r for r in rules if r.strategy not in ORDERED and r.fill_value is not None}
    projection = []
    for c in out.columns:
        if c in columns_dropped:
            continue
        projection.append(_filled(out, by_column[c]).alias(c) if c in by_column else ref(c))
    return out.select(*projection)


def _filled(df: DataFrame, rule: FillRule) -> Column:
    kind = df.schema[rule.column].dataType
    if isinstance(rule.fill_value, float) and not isinstance(kind, FRACTIONAL):
        return F.coalesce(number(df, rule.column), F.lit(rule.fill_value))
    return F.coalesce(clean(df, rule.column), literal(df, rule.column, rule.fill_value))


def fill_missing(
    df: DataFrame,
    strategy: str = "auto",
    columns: Sequence[str] | None = None,
    *,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    **options,
) -> DataFrame:
    if strategy in ORDERED and columns is not None:
        rules = [FillRule(c, strategy, 0) for c in columns]
    else:
        rules = fit_fill(df, strategy, columns, **options)
    return apply_fill(df, rules, order_by=order_by, partition_by=partition_by, rows_per_bucket=rows_per_bucket)


def fill_datetime(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str] = ()):
    """Previous value in key order, else the next one."""
    return ordered_fill(df, columns, order_by, partition_by, ("forward", "backward"))


def missing_report(before: DataFrame, after: DataFrame, rules: Sequence[FillRule]) -> DataFrame:
    """Strategy, fill value and missing counts of each column that had gaps."""
    _, left = missing_counts(after)
    rows = [
        (r.column, r.strategy, None if r.fill_value is None else str(r.fill_value), r.missing_before, left.get(r.column))
        for r in rules
    ]
    schema = "column string, strategy string, fill_value string, missing_before bigint, missing_after bigint"
    return before.sparkSession.createDataFrame(rows, schema)
