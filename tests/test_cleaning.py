import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablelab.operators import dates, encode, missing, outliers, profile, scale, select
from tablelab.operators.forest import fit_forest
from tablelab.sources import files


def frame(spark, pdf, schema=None):
    return spark.createDataFrame(pdf, schema)


# ---- sources


def test_csv_reads_na_words_and_bad_numbers_as_missing(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,x,s\n1,NA,"a ""b"""\n2,2.5,null\n3,,plain\n')
    rows = files.read_table(spark, str(path), schema="id int, x double, s string").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, 'a "b"'), (2, 2.5, None), (3, None, "plain")]


def test_csv_types_are_found_around_na_words(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,x,b,s,e,d\n1,NA,true,a,,2024-01-01\nnull,2.5,False,3,NA,2024-01-02\n")
    df = files.read_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "boolean", "string", "string", "string"]
    assert df.where("i IS NULL").count() == 1 and df.where("b").count() == 1


def test_json_array_of_records(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('[{"a": 1, "b": "x"},\n {"a": 2, "b": null}]')
    rows = files.read_table(spark, str(path), schema="a int, b string").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, None)]


def test_unknown_extension_and_missing_path(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_table(spark, str(tmp_path / "t.xlsx"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.read_csv(spark, str(tmp_path / "none.csv"), "a int").collect()


# ---- profile


def test_numeric_stats_edge_cases(spark):
    df = spark.createDataFrame(
        [(5.0, None, float("nan")), (5.0, None, 1.0), (5.0, None, 2.0), (5.0, None, 6.0)], "const double, empty double, nan double"
    )
    rows = {r["column"]: r for r in profile.numeric_stats(df).collect()}
    assert rows["const"]["std"] == 0.0 and rows["const"]["skew"] == 0.0
    assert rows["empty"]["n"] == 0 and rows["empty"]["mean"] is None and rows["empty"]["zeros_percent"] is None
    assert rows["nan"]["n"] == 3 and rows["nan"]["mean"] == 3.0
    assert rows["nan"]["skew"] == pytest.approx(pd.Series([1.0, 2.0, 6.0]).skew())


def test_numeric_stats_match_pandas(spark):
    x = pd.Series(np.random.default_rng(0).exponential(3.0, 5000))
    got = profile.numeric_stats(frame(spark, pd.DataFrame({"x": x}))).first()
    assert got["skew"] == pytest.approx(x.skew()) and got["kurtosis"] == pytest.approx(x.kurtosis())
    assert got["std"] == pytest.approx(x.std()) and got["q1"] == pytest.approx(x.quantile(0.25))


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, s string")
    assert profile.numeric_stats(df).first()["n"] == 0
    assert profile.duplicate_stats(df).first()["duplicate_rows"] == 0
    assert missing.fit_fill(df, "auto") == []
    assert outliers.handle_outliers(df, treatment="cap", method="iqr").count() == 0


def test_duplicate_rows_with_one_huge_group_and_nulls(spark):
    rows = [(i, None if i % 3 else 1, "x") for i in range(300)] + [(1000, 9, "y")]
    df = spark.createDataFrame(rows, "id int, a int, b string")
    got = {r["id"] for r in profile.duplicate_rows(df, ["id"]).collect()}
    assert got == {i for i in range(300)} - {0, 1}


def test_histogram_of_constant_column_and_density_mass(spark):
    df = spark.createDataFrame([(2.0, float(i)) for i in range(50)], "c double, x double")
    bins = profile.histogram(df, ["c"]).where(F.col("n") > 0).collect()
    assert len(bins) == 1 and bins[0]["n"] == 50
    curve = profile.density_curve(df, ["c", "x"], cut=3.0).orderBy("point").toPandas()
    assert set(curve["column"]) == {"x"}
    step = curve["x"].iloc[1] - curve["x"].iloc[0]
    assert curve["density"].sum() * step == pytest.approx(1.0, abs=0.01)


def test_scatter_sample_limit_is_repeatable(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2).alias("b"))
    one, two = (profile.scatter_sample(df.repartition(k), limit=20).collect() for k in (2, 5))
    assert sorted(one) == sorted(two) and len(one) == 20


# ---- missing


def pandas_auto(pdf, threshold=0.8):
    """The column-order rules, replayed row by row in pandas."""
    data, used = pdf.copy(), {}
    for c in list(data.columns):
        n = data[c].isnull().sum()
        if n == 0:
            continue
        percent = n / len(data) * 100
        if percent > threshold * 100:
            data = data.drop(columns=[c])
            used[c] = "drop_column"
        elif percent < 1:
            data = data.dropna(subset=[c])
            used[c] = "drop_rows"
        elif pd.api.types.is_numeric_dtype(data[c]):
            data[c] = data[c].fillna(data[c].median())
            used[c] = "median"
        else:
            mode = data[c].mode()
            data[c] = data[c].fillna(mode[0] if len(mode) else "MISSING")
            used[c] = "mode"
    return data, used


@pytest.mark.parametrize("limit", [100_000, 0])
def test_auto_fill_replays_the_sequential_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(missing, "PATTERN_LIMIT", limit)
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n, dtype=float)})
    for name, share in (("a", 0.008), ("b", 0.011), ("c", 0.3), ("d", 0.9), ("e", 0.0095), ("f", 0.05)):
        pdf[name] = np.where(rng.random(n) < share, np.nan, rng.normal(size=n))
    pdf["s"] = np.where(rng.random(n) < 0.1, None, rng.choice(["x", "y", "z"], n))
    want, used = pandas_auto(pdf)
    rules = missing.fit_fill(frame(spark, pdf), "auto")
    assert {r.column: r.strategy for r in rules} == used
    got = missing.apply_fill(frame(spark, pdf), rules).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want.reset_index(drop=True), check_dtype=False)


@pytest.mark.parametrize("nulls,strategy", [(1, "median"), (80, "median"), (81, "drop_column")])
def test_auto_fill_limits_are_strict(spark, nulls, strategy):
    df = spark.range(100).select(F.when(F.col("id") >= nulls, F.col("id").cast("double")).alias("x"))
    assert [r.strategy for r in missing.fit_fill(df, "auto")] == [strategy]


def test_datetime_fill_sees_only_surviving_rows(spark):
    rows = [(i, None if i == 1 else i, f"2024-01-{i % 28 + 1:02d}" if i in (1, 5) or i > 110 else None) for i in range(220)]
    df = spark.createDataFrame(rows, "id int, n int, d string").withColumn("d", F.to_date("d"))
    got = missing.fill_missing(df, "auto", order_by=["id"]).orderBy("id").collect()
    assert len(got) == 219 and str(got[0]["d"]) == "2024-01-06" and str(got[100]["d"]) == "2024-01-06"


def test_mode_without_values_and_not_applied(spark):
    df = spark.createDataFrame([(None, None), (None, 1.0)], "s string, x double")
    assert missing.fill_missing(df, "mode").where("s = 'MISSING'").count() == 2
    rules = {r.column: r.strategy for r in missing.fit_fill(df, "mean")}
    assert rules == {"s": "not_applied", "x": "mean"}


def test_median_of_integers_becomes_double(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert sorted(r[0] for r in missing.fill_missing(df, "median").collect()) == [1.0, 1.5, 2.0]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (4.0,), (None,)], "x double")
    assert [r[0] for r in missing.fill_missing(df, "constant", constant_value=9).collect()] == [9.0, 4.0, 9.0]


# ---- outliers


def test_cap_leaves_missing_cells(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (None,)], "x double")
    got = [r[0] for r in outliers.handle_outliers(df, method="iqr", treatment="cap").collect()]
    assert got.count(None) == 1 and max(x for x in got if x is not None) < 100


def test_short_columns_and_zero_deviation(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(9)], "c double, x double")
    assert outliers.detect(df, method="iqr") == []
    df = spark.createDataFrame([(0.1,)] * 30, "c double")
    found = outliers.detect(df, method="zscore")
    assert found[0].outliers == 0 and found[0].std == 0.0


@pytest.mark.parametrize("percent,action", [(4.99, "cap"), (5.0, "impute"), (14.99, "impute"), (15.0, "transform")])
def test_auto_treatment_limits(spark, percent, action):
    df = spark.createDataFrame([(float(i),) for i in range(1, 40)], "x double")
    d = outliers.Detection("x", "iqr", 39, 1, percent, 1.5, 2.0, 30.0)
    assert outliers.fit_treatment(df, [d], "auto")[0].action == action


def test_remove_drops_rows_hit_in_any_column(spark):
    rows = [(i, float(i % 7), float(i % 5)) for i in range(100)] + [(200, 900.0, 1.0), (201, 1.0, 900.0), (202, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    got = {r["id"] for r in outliers.handle_outliers(df, ["x", "y"], "iqr", "remove").collect()}
    assert got == set(range(100)) | {202}


def test_no_numeric_columns_returns_input(spark):
    df = spark.createDataFrame([("a",)], "s string")
    assert outliers.handle_outliers(df).collect() == df.collect()


def test_forest_scores_planted_extremes_high_and_is_repeatable(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": range(2000), "x": np.r_[rng.normal(size=1990), np.full(10, 40.0)], "k": 3.0})
    df = frame(spark, pdf)
    fits = fit_forest(df, ["x", "k"], ["id"], n_estimators=40)
    again = fit_forest(df.repartition(7), ["x", "k"], ["id"], n_estimators=40)
    assert fits == again
    scored = df.select("id", fits[0].score(F.col("x")).alias("s"), fits[0].flag(F.col("x")).alias("f")).toPandas()
    planted = scored[scored["id"] >= 1990]
    assert planted["f"].all() and planted["s"].min() > scored["s"].median()
    assert (scored["f"] == (scored["s"] > 0.5)).all()
    assert fits[0].outliers == scored["f"].sum()
    assert fits[1].outliers == 0


def test_forest_contamination_sets_the_share(spark):
    df = spark.range(1000).select("id", F.pow(F.rand(7), 2.0).alias("x"))
    fit = fit_forest(df, ["x"], ["id"], n_estimators=20, contamination=0.1)[0]
    assert fit.outliers <= 100 and fit.outliers >= 80


# ---- encoding, dates, scaling


def test_ten_and_eleven_values(spark):
    rows = [(i, f"v{i % 10}", f"w{i % 11}") for i in range(110)]
    df = spark.createDataFrame(rows, "id int, ten string, eleven string")
    kinds = {e.column: e.kind for e in encode.fit_encoding(df, order_by=["id"])}
    assert kinds == {"ten": "onehot", "eleven": "label"}


def test_one_hot_limit_and_unseen_values(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    with pytest.raises(ValueError, match="limit"):
        encode.one_hot(df, one_hot_limit=1)
    fitted = encode.fit_encoding(df, method="onehot")
    new = spark.createDataFrame([("zzz",)], "s string")
    assert tuple(encode.apply_encoding(new, fitted).first()) == (False, False)


def test_label_codes_with_many_buckets(spark):
    rows = [(i, f"v{(i * 7919) % 400}") for i in range(1200)]
    df = spark.createDataFrame(rows, "id int, s string")
    table = encode.label_dictionary(df, "s", ["id"], 400, rows_per_bucket=50)
    first = {}
    for i, v in rows:
        first.setdefault(v, len(first))
    assert {r["value"]: r["code"] for r in table.collect()} == first


def test_saturday_is_five_and_missing_flags_are_zero(spark):
    df = spark.createDataFrame([("2024-06-01",), (None,)], "d string").select(F.to_date("d").alias("d"))
    one, two = dates.date_features(df).collect()
    assert (one["d_dayofweek"], one["d_is_weekend"], one["d_is_month_start"]) == (5, 1, 1)
    assert two["d_year"] is None and two["d_is_weekend"] == 0


@pytest.mark.parametrize("method", scale.METHODS)
def test_constant_column_scales_to_zero(spark, method):
    df = spark.createDataFrame([(0.1, float(i)) for i in range(30)], "c double, x double")
    got = scale.scale(df, method).toPandas()
    assert got["c"].abs().max() < 1e-9 and math.isfinite(got["x"].sum())


def test_split_is_independent_of_partitioning(spark):
    df = spark.range(1000)
    one = {r[0] for r in select.sample_split(df.repartition(3), ["id"])[1].collect()}
    two = {r[0] for r in select.sample_split(df.repartition(8), ["id"])[1].collect()}
    assert one == two and 150 < len(one) < 250
