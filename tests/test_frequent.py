"""Most frequent values against plain counts, by each of the three ways."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablelab.functions.frequent import frequent_values, modes
from tablelab.operators import profile


def plain(values, n):
    held = Counter(v for v in values if v is not None)
    return sorted(held.items(), key=lambda x: (-x[1], x[0]))[:n]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(6000):
        skewed = rng.choice(["hot", "warm", "mild"]) if rng.random() < 0.5 else f"v{rng.randrange(3000)}"
        out.append((i, skewed, f"u{i}", rng.choice(["a", "b", "c", None]), f"t{i % 50}", None))
    rng.shuffle(out)
    return out


def test_all_three_ways(spark, rows):
    df = spark.createDataFrame(rows, "id int, skewed string, single string, few string, even string, none string").repartition(7)
    names = ["skewed", "single", "few", "even", "none"]
    for n in (1, 3, 10):
        for counters, expected in ((4096, {"summary", "all"}), (30, {"recount", "summary", "all"})):
            got, how = frequent_values(df, {c: F.col(c) for c in names}, n, counters=counters)
            got = got.collect()
            for k, c in enumerate(names, 1):
                mine = [(r["value"], r["n"]) for r in sorted(got, key=lambda r: r["rank"]) if r["column"] == c]
                assert mine == plain([r[k] for r in rows], n), (c, n, counters, how)
            assert set(how.values()) <= expected and how["few"] == how["none"] == "summary"
            if counters == 30:
                assert how["single"] == "all" and how["even"] == "all"
                assert how["skewed"] == "recount" or n == 10


def test_too_many_candidates_are_counted_whole(spark, rows):
    df = spark.createDataFrame(rows, "id int, skewed string, single string, few string, even string, none string")
    got, how = frequent_values(df, {"skewed": F.col("skewed")}, 2, counters=40, candidates=1)
    assert how == {"skewed": "all"} and [(r["value"], r["n"]) for r in got.orderBy("rank").collect()] == plain([r[1] for r in rows], 2)


def test_types_ties_and_gaps(spark):
    df = spark.createDataFrame([(1, 0.0, None, True), (2, -0.0, None, False), (1, float("nan"), None, True), (2, 5.0, None, None), (None, 5.0, None, False)], "n int, x double, s string, b boolean")
    df = df.withColumn("t", F.timestamp_seconds(F.col("n"))).withColumn("d", F.col("n").cast("decimal(10,2)"))
    got = modes(df, df.columns)
    assert got["n"] == 1 and got["x"] == 0.0 and "s" not in got and got["b"] is False and got["t"].second == 1 and int(got["d"]) == 1
    assert modes(df.limit(0), ["n", "s"]) == {}
    assert modes(df, ["n"], {"n": F.col("n") > 1}) == {"n": 2}
    assert profile.top_values(df.select("n")).count() == 0 and profile.categorical_stats(df.select("n")).count() == 0
    stats = profile.categorical_stats(df.select("s")).first()
    assert (stats["unique_count"], stats["missing_count"], stats["top_value"], stats["top_count"], stats["top_percent"]) == (0, 5, None, 0, 0.0)


def test_shuffle_does_not_grow_with_distinct_values(spark):
    from tablelab.functions.frequent import summaries

    df = spark.range(0, 200_000, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    assert summaries(df, {"v": F.col("v")}, 100).count() <= 4 * 101
    got, how = frequent_values(df, {"v": F.col("v")}, counters=100)
    assert how == {"v": "recount"} and [tuple(r) for r in got.select("value", "n").collect()] == [("hot", 66667)]
