"""Learning tuner, linear silhouette drop, correlation in one scan, prints of rows."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelab.operators import profile, quality, search, segments
from tablelab.operators.tuner import Sampler, tune_learning

SPACE = {
    "a": {"type": "int", "low": 2, "high": 40},
    "b": {"type": "float", "low": 1e-6, "high": 1e-1, "log": True},
    "c": {"type": "categorical", "choices": ["p", "q", "r", "s"]},
    "d": {"type": "float", "low": -1.0, "high": 1.0},
}


def score(p):
    return -((p["a"] - 17) ** 2) / 100 - (math.log10(p["b"]) + 3) ** 2 + (1.0 if p["c"] == "r" else 0.0)


def best_of(seed, startup, n=60):
    sampler = Sampler(SPACE, seed, startup)
    found = []
    for _ in range(n):
        p = sampler.propose()
        sampler.learn(p, score(p))
        found.append(score(p))
    return found


def test_sampler_beats_random_draws():
    learned, drawn = [best_of(s, 10) for s in range(15)], [best_of(s, 10**9) for s in range(15)]
    assert statistics.mean(map(max, learned)) > statistics.mean(map(max, drawn)) + 0.1
    goal = 0.9
    first = lambda runs: statistics.mean(next((i for i, x in enumerate(r) if x > goal), len(r)) for r in runs)
    assert first(learned) < 0.7 * first(drawn)
    # The later half of the trials is better than the earlier one.
    assert statistics.mean(x for r in learned for x in r[30:]) > statistics.mean(x for r in learned for x in r[:30]) + 0.5


def test_sampler_is_seeded_typed_and_copes_with_failures():
    assert best_of(3, 5, 25) == best_of(3, 5, 25) != best_of(4, 5, 25)
    sampler = Sampler(SPACE, 1, startup=3)
    for i in range(40):
        batch = [sampler.propose() for _ in range(4)]
        for p in batch:
            assert isinstance(p["a"], int) and 2 <= p["a"] <= 40 and 1e-6 <= p["b"] <= 0.1 and p["c"] in "pqrs" and -1 <= p["d"] <= 1
            sampler.learn(p, [None, math.nan, 0.5, 0.5][i % 4])
    nothing = Sampler(SPACE, 1, startup=2)
    for _ in range(10):
        nothing.learn(nothing.propose(), None)
    single = Sampler({"a": {"type": "int", "low": 3, "high": 3}, "c": {"type": "categorical", "choices": ["x"]}}, 1, startup=1)
    for _ in range(5):
        single.learn(single.propose(), 1.0)
    assert {tuple(p.items()) for p, _ in single.tried} == {(("a", 3), ("c", "x"))}
    # A small space is gone through before anything is tried twice.
    small = Sampler({"a": {"type": "int", "low": 1, "high": 6}}, 2, startup=3)
    for _ in range(12):
        p = small.propose()
        small.learn(p, -abs(p["a"] - 4))
    assert {p["a"] for p, _ in small.tried} == set(range(1, 7))


def test_tuning_finds_planted_groups(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, 3) + 40 * np.array([i % 5, (i % 5) ** 2 % 7, i % 2])]) for i in range(400)]
    from pyspark.ml.functions import array_to_vector

    frame = spark.createDataFrame(rows, "id long, p array<double>").select("id", array_to_vector("p").alias("features"))
    space = {"n_clusters": {"type": "int", "low": 2, "high": 25}}
    found = tune_learning(frame, "kmeans", key=["id"], n_trials=14, space=space, startup=6, seed=2)
    assert len(found.trials) == 14 and [t.number for t in found.trials] == list(range(14))
    grid = search.compare_clusterings(frame, {"kmeans": {"n_clusters": [found.best().params["n_clusters"]]}}, key=["id"])
    assert grid.best().metrics["silhouette"] == pytest.approx(found.best().metrics["silhouette"])
    learned = [t.params["n_clusters"] for t in found.trials[6:]]
    assert statistics.mean(abs(k - 10) for k in learned) < statistics.mean(abs(k - 10) for k in range(2, 26))


def plain_squared(x, labels):
    """Mean silhouette with squared distances, pair by pair."""
    out = []
    for i, own in enumerate(labels):
        gaps = {}
        for j, other in enumerate(labels):
            if i != j:
                gaps.setdefault(other, []).append(float(((x[i] - x[j]) ** 2).sum()))
        if own not in gaps:
            out.append(0.0)
            continue
        near, far = statistics.mean(gaps[own]), min(statistics.mean(g) for k, g in gaps.items() if k != own)
        out.append(0.0 if max(near, far) == 0 else (far - near) / max(near, far))
    return statistics.mean(out)


def test_squared_drop_is_the_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (60, 4)) * np.array([1, 1e6, 1e-3, 0]) + np.array([5, 0, 0, 3])
    labels = [int(v) for v in rng.integers(0, 3, 59)] + [9]
    x[np.array(labels) == 1, 2] += 0.01
    df = spark.createDataFrame([(i, c, *map(float, r)) for i, (c, r) in enumerate(zip(labels, x))] + [(99, None, 1.0, 1.0, 1.0, 1.0)], "id int, cluster int, a double, b double, c double, d double")
    got = {r["feature"]: r for r in segments.silhouette_drop(df, "cluster", ["a", "b", "c", "d"], ["id"]).collect()}
    base = plain_squared(x, labels)
    for i, f in enumerate("abcd"):
        rest = plain_squared(np.delete(x, i, axis=1), labels)
        assert got[f]["base"] == pytest.approx(base, abs=1e-9) and got[f]["without"] == pytest.approx(rest, abs=1e-9)
    assert base == pytest.approx(quality.silhouette_squared(quality.points(df, list("abcd"), "cluster", ["id"]), quality.cluster_moments(quality.points(df, list("abcd"), "cluster", ["id"]), 4)), abs=1e-9)
    one = segments.silhouette_drop(df.where("cluster = 1"), "cluster", ["a", "b"], ["id"]).collect()
    assert [r["importance"] for r in one] == [0, 0]
    with pytest.raises(ValueError, match="unknown mode"):
        segments.silhouette_drop(df, "cluster", ["a"], ["id"], mode="other")


def test_correlation_of_many_columns_in_one_scan(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (300, 120)) + 1e7
    x[:, 1] = x[:, 0] * 2 + rng.normal(0, 0.01, 300)
    x[:, 2] = 5.0
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 3] = np.nan
    x[2:, 4] = np.nan
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{i} double" for i in range(120)))
    got = {(r["col1"], r["col2"]): r for r in profile.correlation_matrix(df).collect()}
    assert len(got) == 120 * 120 and got["c0", "c1"]["is_high"] and not got["c1", "c0"]["is_high"]
    for i in range(0, 120, 7):
        for j in range(120):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            plain = np.corrcoef(a, b)[0, 1] if len(a) > 1 and a.std() > 0 and b.std() > 0 else None
            r = got[f"c{i}", f"c{j}"]["correlation"]
            assert (r is None) == (plain is None) and (r is None or r == pytest.approx(plain, abs=1e-7))
            assert got[f"c{j}", f"c{i}"]["correlation"] == r
    assert got["c2", "c2"]["correlation"] is None and got["c5", "c5"]["correlation"] == 1
    assert profile.correlation_matrix(df.select()).count() == 0
    assert [r["correlation"] for r in profile.correlation_matrix(df.limit(0).select("c0", "c1")).collect()] == [None] * 4


def test_prints_of_rows(spark):
    rng = random.Random(2)
    values = [None, "", "a", "b", "ab"]
    rows = [(i, rng.choice(values), rng.choice(values), rng.choice([None, math.nan, 0.0, -0.0, 1.5]), rng.choice([None, 1, 2])) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, x string, y string, v double, n int")
    plain = lambda r: tuple(None if isinstance(c, float) and math.isnan(c) else c + 0.0 if isinstance(c, float) else c for c in r[1:])
    seen, repeats = set(), set()
    for r in rows:
        (repeats.add(r[0]) if plain(r) in seen else seen.add(plain(r)))
    assert {r["id"] for r in profile.duplicate_rows(df, ["id"]).collect()} == repeats
    assert profile.duplicate_stats(df.drop("id")).first()["duplicate_rows"] == len(repeats)
    assert profile.duplicate_rows(df.limit(0), ["id"]).count() == 0 and profile.duplicate_stats(df.limit(0)).first()["duplicate_percent"] == 0
    # A group that holds most rows, and a key of two columns.
    crowd = spark.range(5000).select((F.col("id") % 70).alias("k"), F.col("id"), F.when(F.col("id") % 100 == 0, F.col("id")).alias("z"))
    assert profile.duplicate_rows(crowd, ["k", "id"]).count() == 5000 - 51
