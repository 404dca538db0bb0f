import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablelab.functions import lookup
from tablelab.functions.columns import value_counts
from tablelab.functions.frequent import modes
from tablelab.functions.ordering import bucket_of, global_row_number, insertion_point, number_array, ordered_fill, range_bounds
from tablelab.functions.quantiles import Central, quantiles
from tablelab.functions.stats import f_upper_tail

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("n", [1, 2, 3, 11, 499, 501, 3000, 40_000])
@pytest.mark.parametrize("shape", ["normal", "hot", "constant", "two"])
def test_quantiles_are_exact(spark, n, shape):
    rng = np.random.default_rng(n)
    x = rng.normal(size=n)
    if shape == "hot":
        x = np.where(rng.random(n) < 0.6, 0.25, x)
    elif shape == "constant":
        x = np.full(n, 0.1)
    elif shape == "two":
        x = np.where(rng.random(n) < 0.5, 1.0, 2.0)
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(4)
    column = {"x": F.when(F.col("x") < 100, F.col("x"))}
    for options in ({}, {"accuracy": 100, "list_limit": 20}):
        found, _ = quantiles(df, column, PROBS, **options)
        assert found["x"] == pytest.approx(list(np.quantile(x, PROBS)), abs=1e-12)


def test_quantiles_skip_missing_and_report_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    central: dict[str, Central] = {}
    found, row = quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.5], extra=[F.count(F.lit(1)).alias("rows")], central=central)
    assert found == {"a": [2.0], "b": [None]}
    assert row["rows"] == 3
    assert central["a"].powers[1] == pytest.approx(2.0) and central["b"].n == 0


def test_insertion_point_counts_entries_not_above(spark):
    bounds = [1.0, 2.0, 2.0, 5.0]
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.0, 4.9, 5.0, 9.0)], "x double")
    got = [r[0] for r in df.select(insertion_point(F.col("x"), number_array(bounds), len(bounds))).collect()]
    assert got == [0, 1, 1, 3, 3, 4, 4]


def test_buckets_keep_order_with_null_and_composite_keys(spark):
    rows = [(random.Random(i).choice([None, "a", "b", "c"]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, i int")
    bounds = range_bounds(df, ["g", "i"], rows_per_bucket=100)
    placed = df.withColumn("b", bucket_of(df, ["g", "i"], bounds)).collect()
    ordered = sorted(placed, key=lambda r: ((r["g"] is not None, r["g"] or ""), r["i"]))
    buckets = [r["b"] for r in ordered]
    assert len(bounds) > 5 and buckets == sorted(buckets)


@pytest.mark.parametrize("rows_per_bucket", [40, 10_000])
@pytest.mark.parametrize("by_user", [False, True])
def test_ordered_fill_matches_pandas(spark, rows_per_bucket, by_user):
    rng = np.random.default_rng(5)
    n = 1500
    pdf = pd.DataFrame({"t": rng.permutation(n), "u": np.where(rng.random(n) < 0.5, 7, rng.integers(0, 40, n))})
    pdf["x"] = np.where(rng.random(n) < 0.9, np.nan, rng.integers(0, 1000, n)).astype(float)
    df = spark.createDataFrame(pdf)
    part = ["u"] if by_user else []
    got = ordered_fill(df, ["x"], ["t"], part, ("forward", "backward"), rows_per_bucket=rows_per_bucket)
    pdf = pdf.sort_values("t")
    if by_user:
        want = pdf.groupby("u")["x"].transform(lambda s: s.ffill().bfill())
    else:
        want = pdf["x"].ffill().bfill()
    have = got.toPandas().sort_values("t")["x"]
    assert len(have) == n
    np.testing.assert_array_equal(have.to_numpy(), want.to_numpy())


def test_global_row_number_over_many_buckets(spark):
    df = spark.range(3000).select(F.hash("id").alias("h"), "id")
    got = global_row_number(df, ["h", "id"], "n", rows_per_bucket=100).orderBy("h", "id").collect()
    assert [r["n"] for r in got] == list(range(3000))


def test_lookup_join_of_large_dictionary_with_hot_value(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    rows = [(i, "hot" if i % 3 else (None if i % 2 else f"v{i}")) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, v string")
    counts = value_counts(df, ["v"]).select("value", "n", F.length("value").alias("code"))
    got = lookup.lookup_join(df, counts, "v", size=counts.count(), total=900)
    assert {(r["i"], r["__code"]) for r in got.collect()} == {(i, len(v) if v else None) for i, v in rows}
    assert got.count() == 900


def test_modes_take_smallest_on_ties_per_type(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (2, "b", None), (1, "a", None)], "i int, s string, e double")
    assert modes(df, ["i", "s", "e"]) == {"i": 1, "s": "a"}


@pytest.mark.parametrize("f,a,b", [(0.5, 2, 10), (4.0, 2, 10), (1.0, 5, 5), (30.0, 3, 200), (1.01, 9, 100_000)])
def test_f_upper_tail_against_integration(f, a, b):
    t = np.linspace(1e-9, 1.0, 400_001)[:-1]  # x = f + t / (1 - t)
    x = f + t / (1 - t)
    log_pdf = (
        0.5 * (a * np.log(a * x) + b * math.log(b) - (a + b) * np.log(a * x + b)) - np.log(x)
        - (math.lgamma(a / 2) + math.lgamma(b / 2) - math.lgamma((a + b) / 2))
    )
    y = np.exp(log_pdf) / (1 - t) ** 2
    area = float(((y[1:] + y[:-1]) / 2 * np.diff(t)).sum())
    assert f_upper_tail(f, a, b) == pytest.approx(area, rel=1e-4, abs=1e-9)
