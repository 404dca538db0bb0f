"""Table preparation: missing values, outliers, encoding, date parts, scaling.

Fitting runs a few aggregate jobs and keeps small parameters; applying them is
one lazy projection chain, for the fitted table as for new rows.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablelab.functions.columns import clean, datetime_columns, normalise_missing
from tablelab.operators.dates import date_features
from tablelab.operators.encode import Encoding, apply_encoding, fit_encoding
from tablelab.operators.missing import FillRule, apply_fill, fit_fill, missing_counts
from tablelab.operators.outliers import Detection, Treatment, apply_treatment, detect, fit_treatment
from tablelab.operators.scale import Scale, apply_scale, fit_scale
from tablelab.session import scratch_path

STEPS = ("missing", "outliers", "encode", "dates", "scale")


@dataclass
class Preparation:
    """Fitted parameters of every step; ``transform`` applies them to any rows."""

    key: list[str]
    order_by: list[str]
    fills: list[FillRule] = field(default_factory=list)
    detections: list[Detection] = field(default_factory=list)
    treatments: list[Treatment] = field(default_factory=list)
    encodings: list[Encoding] = field(default_factory=list)
    dates: list[str] = field(default_factory=list)
    scales: list[Scale] = field(default_factory=list)

    def step(self, name: str, df: DataFrame, keep_rows: bool = False) -> DataFrame:
        if name == "missing":
            return apply_fill(df, self.fills, order_by=self.order_by, keep_rows=keep_rows) if self.fills else df
        if name == "outliers":
            return apply_treatment(df, self.treatments, keep_rows)
        if name == "encode":
            return apply_encoding(df, self.encodings)
        if name == "dates":
            return date_features(df, self.dates) if self.dates else df
        return apply_scale(df, self.scales) if self.scales else df

    def details(self, name: str) -> dict[str, str]:
        """What the fitted step does, by column."""
        if name == "missing":
            return {f.column: f.strategy for f in self.fills}
        if name == "outliers":
            return {t.column: t.action for t in self.treatments}
        if name == "encode":
            return {e.column: e.kind for e in self.encodings}
        if name == "dates":
            return {c: "parts" for c in self.dates}
        return {s.column: s.method for s in self.scales}

    def transform(self, df: DataFrame, keep_rows: bool = False) -> DataFrame:
        """All steps in order. ``keep_rows`` returns one row per row of ``df``; cells without a rule stay missing."""
        out = normalise_missing(df)
        for name in STEPS:
            out = self.step(name, out, keep_rows)
        return out


def fit_preparation(
    df: DataFrame,
    key: Sequence[str],
    *,
    order_by: Sequence[str] | None = None,
    missing: str | None = "auto",
    outlier_method: str = "auto",
    outlier_treatment: str | None = "cap",
    outlier_options: dict | None = None,
    encode: str | None = "auto",
    encode_threshold: int = 10,
    dates: bool = True,
    scale: str | None = "standard",
    drop_threshold: float = 0.8,
    exclude: Sequence[str] = (),
    exact: bool = True,
) -> Preparation:
    """Fit all steps in order. ``None`` leaves a step out.

    Key and excluded columns are carried along untouched. With five or more
    numeric columns the automatic outlier method is the isolation forest, which
    then only decides which columns are capped at 1.5 IQR.
    """
    prep = Preparation(list(key), list(order_by or key))
    fixed = [*key, *exclude]
    out = normalise_missing(df)
    if missing is not None:
        prep.fills = fit_fill(out, missing, exclude=fixed, threshold=drop_threshold, exact=exact)
        out = prep.step("missing", out)
    if outlier_treatment is not None:
        options = {"method": outlier_method, "key": key, "exclude": exclude, "exact": exact, **(outlier_options or {})}
        prep.detections = detect(out, **options)
        prep.treatments = fit_treatment(out, prep.detections, outlier_treatment)
        out = prep.step("outliers", out)
    if encode is not None:
        prep.encodings = fit_encoding(
            out, method=encode, threshold=encode_threshold, order_by=prep.order_by, exclude=fixed
        )
        out = prep.step("encode", out)
    if dates:
        prep.dates = datetime_columns(out, fixed)
        out = prep.step("dates", out)
    if scale is not None:
        prep.scales = fit_scale(out, scale, exclude=fixed, exact=exact)
    return prep


def prepare_table(df: DataFrame, key: Sequence[str], **options) -> tuple[DataFrame, Preparation]:
    prep = fit_preparation(df, key, **options)
    return prep.transform(df), prep


def step_audit(df: DataFrame, prep: Preparation) -> DataFrame:
    """Rows, columns and missing cells before and after each step.

    Counted by plain aggregates, one per step, so that retried tasks cannot
    count twice.
    """
    rows = []
    out = normalise_missing(df)
    count, missing = missing_counts(out)
    for i, name in enumerate(STEPS):
        before = (count, len(out.columns))
        after = prep.step(name, out)
        if after is not out:
            count, missing = missing_counts(after)
        out = after
        rows.append((i + 1, name, before[0], count, before[1], len(out.columns), sum(missing.values())))
    schema = (
        "position int, step string, rows_before bigint, rows_after bigint, cols_before bigint, cols_after bigint, "
        "nulls_after bigint"
    )
    return df.sparkSession.createDataFrame(rows, schema)


RUN_SCHEMA = (
    "position int, step string, rows_before bigint, rows_after bigint, cols_before bigint, cols_after bigint, nulls_before bigint, "
    "nulls_after bigint, columns_treated bigint, details map<string,string>, seconds double"
)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, int, int, float]:
    """The frame written and read again, its rows, missing cells and seconds: counted while it is written, without a job of their own."""
    seen = Observation(name)
    missing = [F.count(F.when(clean(df, c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(df.columns)]
    path = scratch_path(df.sparkSession, f"step-{name}")
    start = time.perf_counter()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *missing).write.parquet(path)
    seconds = time.perf_counter() - start
    got = seen.get
    return df.sparkSession.read.schema(df.schema).parquet(path), got["rows"], sum(v for k, v in got.items() if k != "rows"), seconds


def run_steps(df: DataFrame, prep: Preparation, keep_rows: bool = False) -> tuple[DataFrame, DataFrame]:
    """The prepared rows, and per step: rows, columns and missing cells before and after, what was done to which column, seconds.

    Each step that changes the frame is written once to the shared folder and
    counted by metrics observed on that same write; the next step reads what
    was written, so no step runs twice and a lost executor costs a re-read.
    The write is the last stage of its job, where Spark counts each task once,
    also a retried one. Steps without a fitted rule cost nothing and take the
    counts of the step before. An empty table gives five rows of zeros.
    """
    out, rows, missing, _ = _written(normalise_missing(df), "input")
    audit = []
    for i, name in enumerate(STEPS):
        before, seconds = (rows, len(out.columns), missing), 0.0
        after = prep.step(name, out, keep_rows)
        if after is not out:
            out, rows, missing, seconds = _written(after, name)
        done = prep.details(name)
        audit.append((i + 1, name, before[0], rows, before[1], len(out.columns), before[2], missing, len(done), done, seconds))
    return out, df.sparkSession.createDataFrame(audit, RUN_SCHEMA)
