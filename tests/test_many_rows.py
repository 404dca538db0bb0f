"""Work and task sizes that must not grow with copies of rows, and results that must not change by it."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablelab.operators import centres, cluster, missing, mixture, quality, reduce, search
from tablelab.operators.mixture import fit_mixture
from tablelab.plans import segment
from tablelab.session import materialise


@pytest.fixture(scope="module")
def copies(spark):
    """A cloud of 300 points; the first of them come many times."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 3)), 2) + np.repeat([[0, 0, 0], [6, 0, 0], [0, 7, 2]], 100, axis=0)
    times = np.where(np.arange(300) < 40, 25, 1)
    rows = np.repeat(x, times, axis=0)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(rows)), "point": rows.tolist()}), "id long, point array<double>")
    return df.withColumn("features", array_to_vector("point")).repartition(4).cache(), rows


def test_materialise_cuts_large_partitions(spark):
    """One key for all rows made one partition; now the size decides."""
    rows = spark.range(0, 200_000, 1, 8).select("id", F.lit(1).alias("key"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        frame = materialise(rows, ["id"])
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    assert frame.rdd.getNumPartitions() > 4 and frame.count() == 200_000


def test_equal_points_are_merged_with_their_number(copies):
    df, rows = copies
    merged = centres.merge_points(df, "features")
    assert merged.count() == len(np.unique(rows, axis=0))
    assert merged.agg(F.sum(centres.WEIGHT)).first()[0] == len(rows)
    assert centres.merge_points(merged, "features") is merged


def test_distinct_points_are_dealt_by_size(spark):
    """They all went to as many tasks as there are shuffle partitions."""
    rows = spark.range(0, 120_000, 1, 4).select(array_to_vector(F.array(F.col("id") % 60_000 * 0.5, F.when(F.col("id") < 60_000, -0.0).otherwise(0.0))).alias("features"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    seen = []
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(centres, "FEW_ROWS", 100_000)
            patch.setattr(centres, "materialise", lambda df, by=(): seen.append(df) or materialise(df, by))
            merged = centres.merge_points(rows, "features")
        plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    assert "hashpartitioning(point#" in plan and f", {centres.DEALT})" in plan
    assert [tuple(r) for r in merged.groupBy(centres.WEIGHT).count().collect()] == [(2.0, 60_000)]


def test_points_held_by_a_task_are_merged_exactly(monkeypatch):
    x = np.array([[1.0, 2.0], [3.0, 4.0], [1.0, 2.0], [5.0, 6.0], [3.0, 4.0]])
    for hashes in (centres._hashes, lambda x: np.zeros(len(x), np.uint64)):
        monkeypatch.setattr(centres, "_hashes", hashes)
        points, weights = centres._merged(x, np.array([1.0, 2, 3, 4, 5]))
        total = {}
        for p, w in zip(points, weights):
            total[tuple(p)] = total.get(tuple(p), 0) + w
        assert total == {(1, 2): 4, (3, 4): 7, (5, 6): 4}


def test_sums_of_nearest_centres(copies):
    """Of several sets at once, with centres that come twice: the first one takes the points."""
    df, rows = copies
    blocks, _ = centres.as_blocks(centres.merge_points(df, "features"), "features")
    sets = [rows[[0, 900, 900]], rows[[5, 1100]]]
    for sums in (centres.costed_sums, centres.centre_sums):
        for centre, found in zip(sets, sums(blocks, sets)):
            gaps = ((rows[:, None] - centre[None]) ** 2).sum(axis=2)
            own = gaps.argmin(axis=1)
            assert np.allclose(found.n, np.bincount(own, minlength=len(centre)))
            assert np.allclose(found.x, [rows[own == j].sum(axis=0) for j in range(len(centre))])
            assert found.cost == pytest.approx(gaps.min(axis=1).sum() if sums is centres.costed_sums else 0.0)


def test_mixture_sums_are_those_of_the_densities(copies):
    df, rows = copies
    fitted = cluster.fit_gmm(df, 3, max_iter=3).model
    blocks, _ = centres.as_blocks(centres.merge_points(df, "features"), "features")
    origin = fitted.means.mean(axis=0)
    n, s, ss, likelihood, count = mixture._sums(blocks, 3, origin, mixture=fitted)
    logs = fitted.log_densities(rows)
    norm = np.log(np.exp(logs).sum(axis=1))
    share, y = np.exp(logs - norm[:, None]), rows - origin
    assert count == len(rows) and likelihood == pytest.approx(norm.mean())
    assert np.allclose(n, share.sum(axis=0)) and np.allclose(s, share.T @ y)
    assert np.allclose(ss, np.einsum("nk,nd,ne->kde", share, y, y))


@pytest.mark.parametrize("init", ["k-means++", "random"])
def test_kmeans_cost_sizes_and_fixed_point(copies, init):
    df, rows = copies
    fitted = cluster.fit_kmeans(df, 3, init=init, n_init=4)
    found = np.array(fitted.model.clusterCenters())
    own = ((rows[:, None] - found[None]) ** 2).sum(axis=2)
    assert fitted.details["inertia"] == pytest.approx(own.min(axis=1).sum())
    means = np.array([rows[own.argmin(axis=1) == j].mean(axis=0) for j in range(3)])
    assert np.abs(means - found).max() < 1e-3
    sizes = [r["count"] for r in fitted.transform(df).groupBy("prediction").count().orderBy("prediction").collect()]
    assert sizes == sorted(sizes, reverse=True) and sum(sizes) == len(rows)


def test_kmeans_restarts_share_their_jobs(copies, monkeypatch):
    rounds = []
    monkeypatch.setattr(centres, "centre_sums", lambda p, sets, run=centres.centre_sums: rounds.append(len(sets)) or run(p, sets))
    cluster.fit_kmeans(copies[0], 3, n_init=8, max_iter=5)
    assert len(rounds) <= 7 and max(rounds) == 8


def test_draws_do_not_depend_on_partitions(copies):
    df, _ = copies
    one, many = (centres.best_centres(centres.merge_points(df.repartition(n), "features"), "features", 4, [1, 2], "k-means||", 50, 1e-6)[0] for n in (1, 6))
    assert np.allclose(np.sort(one, axis=0), np.sort(many, axis=0))


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([([0.0, 1.0],)] * 5 + [([2.0, 3.0],)], "point array<double>").select(array_to_vector("point").alias("features"))
    fitted = cluster.fit_kmeans(df, 4, n_init=2)
    assert len(fitted.model.clusterCenters()) == 2 and fitted.details["inertia"] == 0


def test_weighted_metrics_are_those_of_the_rows(copies):
    df, _ = copies
    fitted = cluster.fit_kmeans(df, 4, n_init=1)
    whole = quality.cluster_metrics(quality.points_from_vector(fitted.transform(df), "features", "prediction", ["id"]))
    merged = quality.merged_metrics(fitted.transform(centres.merge_points(df, "features")), "features", "prediction", centres.WEIGHT)
    assert merged == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in whole.items()}


def test_mixture_counts_rows(copies):
    df, rows = copies
    m = fit_mixture(df.select("point"), 3, "full", max_iter=3)
    assert m.weights.sum() == pytest.approx(1.0) and np.allclose(m.weights @ m.means, rows.mean(axis=0))


def test_builtin_mixture_labels_by_rows(copies):
    df, rows = copies
    sizes = [r["count"] for r in cluster.fit_gmm_builtin(df, 3).transform(df).groupBy("prediction").count().orderBy("prediction").collect()]
    assert sizes == sorted(sizes, reverse=True) and sum(sizes) == len(rows)


def test_trials_work_on_merged_points(copies, monkeypatch):
    seen = []
    monkeypatch.setattr(search, "fit_algorithm", lambda df, *a, run=search.fit_algorithm, **o: seen.append(df.count()) or run(df, *a, **o))
    df, rows = copies
    done = search.compare_clusterings(df, {"kmeans": {"n_clusters": [2, 3], "n_init": [2]}}, key=["id"], ready=True)
    assert [t.error for t in done.trials] == [None, None] and max(seen) == len(np.unique(rows, axis=0))


def test_pair_distances_by_product_keep_their_digits():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(70, 20)) + 50
    b = np.vstack([a[:30] + 1e-7, a[30:60], rng.normal(size=(10, 20)) + 50])
    exact = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    assert np.allclose(quality._squared_gaps(a, b, False)[0], exact, rtol=1e-7, atol=0)


def test_tiles_by_product_keep_their_digits():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(70, 20))
    b = np.vstack([a[:30] + 1e-7, a[30:60], rng.normal(size=(10, 20)), np.zeros((1, 20))])
    exact = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    factors = quality._gap_factors(a, b)
    for high, wide in ((slice(0, 64), slice(0, 32)), (slice(64, 128), slice(32, 71))):
        assert np.allclose(quality._product_gaps(a, b, factors, high, wide), exact[high, wide], rtol=1e-7, atol=0)


def test_cells_of_pairs_are_dealt_to_many_tasks(spark):
    """Their number was that of the shuffle partitions."""
    x = np.random.default_rng(1).normal(size=(400, 9)).round(3)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(400), "c": np.arange(400) % 3, "p": x.tolist()}), "id long, c int, p array<double>")
    pts = quality.points_from_array(df, "p", "c", ["id"])
    m = quality.cluster_moments(pts)
    plan = quality._pair_sums(pts, m, False, 4)._jdf.queryExecution().executedPlan().toString()
    cells = int(re.search(r"hashpartitioning\(cell#\d+L, (\d+)\)", plan).group(1))
    assert cells > 100 and cells != int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert quality.silhouette(pts, m, cell_rows=4) == pytest.approx(quality.silhouette(pts, m, cell_rows=4096))


def test_larger_tables_get_larger_stripes(spark):
    x = np.random.default_rng(1).normal(size=(400, 2)).round(3)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(400), "c": np.arange(400) % 3, "p": x.tolist()}), "id long, c int, p array<double>")
    pts = quality.points_from_array(df, "p", "c", ["id"])
    m = quality.cluster_moments(pts)
    parts = quality._pair_sums(pts, m, False, 4)
    assert parts.count() == 400
    assert quality.silhouette(pts, m, cell_rows=4) == pytest.approx(quality.silhouette(pts, m, cell_rows=4096))


def test_mixture_starts_share_their_jobs(copies, monkeypatch):
    """Eight starts took a job each per iteration."""
    jobs = []
    monkeypatch.setattr(mixture, "task_sums", lambda *a, run=mixture.task_sums: jobs.append(1) or run(*a))
    fitted = cluster.fit_gmm_builtin(copies[0], 3, max_iter=6)
    assert len(jobs) == 6 and fitted.details["log_likelihood"] == fitted.model.history[-1]


def test_mixture_is_that_of_sparks_estimator(spark):
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(600, 3)) * [1, 2, 0.5] + np.repeat([[0, 0, 0], [9, 0, 0], [0, 20, 4]], [100, 200, 300], axis=0)
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "point array<double>").select(array_to_vector("point").alias("features")).cache()
    fitted = cluster.fit_gmm_builtin(df, 3)
    theirs = max((GaussianMixture(k=3, maxIter=100, tol=1e-3, seed=i).fit(df) for i in range(4)), key=lambda m: m.summary.logLikelihood)
    assert fitted.details["log_likelihood"] == pytest.approx(theirs.summary.logLikelihood, abs=0.05)
    found = sorted(((r["mean"].toArray(), r["cov"].toArray()) for r in theirs.gaussiansDF.collect()), key=lambda g: g[0][0] + 3 * g[0][1])
    for j, (mean, covariance) in zip(np.argsort(fitted.model.means @ [1, 3, 0]), found):
        assert np.allclose(fitted.model.means[j], mean, atol=0.01) and np.allclose(fitted.model.covariances[j], covariance, atol=0.01)
    assert np.allclose(fitted.model.weights @ fitted.model.means, rows.mean(axis=0))


def test_mixture_with_a_column_that_does_not_vary(spark):
    rng = np.random.default_rng(2)
    rows = np.column_stack([rng.normal(size=200) + np.repeat([0, 30], 100), rng.normal(size=200), np.full(200, 4.0)])
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "point array<double>").select(array_to_vector("point").alias("features"))
    fitted = cluster.fit_gmm_builtin(df, 2)
    assert [r["count"] for r in fitted.transform(df).groupBy("prediction").count().collect()] == [100, 100]
    again = mixture.Mixture.from_json(fitted.model.to_json())
    assert (again.log_densities(rows) == fitted.model.log_densities(rows)).all()


def test_mixture_of_one_point_is_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0],)] * 4, "point array<double>").select(array_to_vector("point").alias("features"))
    with pytest.raises(ValueError, match="variance"):
        cluster.fit_gmm_builtin(df, 2)


@pytest.fixture(scope="module")
def features(spark):
    """Three groups of 200 rows, 20 copies of each, in three numbers and a flag."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(600, 3)), 2) + np.repeat([[0, 0, 0], [40, 0, 5], [0, 70, 20]], 200, axis=0)
    rows = pd.DataFrame(np.tile(x, (20, 1)), columns=["a", "b", "d"])
    rows["flag"] = rows["a"] > 20
    return spark.createDataFrame(rows.assign(id=range(len(rows)))).repartition(4).cache()


def test_components_of_weighted_rows(features):
    names = ["a", "b", "d"]
    plain = reduce.fit_pca(features, names, variance=0.9)
    merged = centres.merge_rows(features, names)
    assert merged.count() == features.select(*names).distinct().count()
    found = reduce.fit_pca(merged, names, variance=0.9, means=plain.means, weight=centres.WEIGHT)
    assert found.k == plain.k and found.ratios == pytest.approx(plain.ratios)
    assert np.allclose(found.loadings, plain.loadings)
    one, other = (np.array([r["components"].toArray() for r in f.transform(features.orderBy("id")).collect()]) for f in (plain, found))
    assert np.allclose(one, other)


def test_weighted_points_are_merged_again(copies):
    df, rows = copies
    merged = centres.merge_points(df, "features")
    again = centres.merge_again(merged.unionByName(merged), "features")
    assert again.count() == merged.count()
    assert again.agg(F.sum(centres.WEIGHT)).first()[0] == 2 * len(rows)


@pytest.mark.parametrize("mode,written", [("squared", 0), ("euclidean", 1)])
def test_large_tables_are_segmented_by_distinct_rows(features, monkeypatch, mode, written):
    """All rows were projected, dealt out and written, for each of five scans."""
    grids = {"kmeans": {"n_clusters": [2, 3], "n_init": [2]}}
    few = segment.segment_table(features, ["id"], grids, mode=mode)
    frames = []
    monkeypatch.setattr(centres, "FEW_ROWS", 1000)
    monkeypatch.setattr(segment, "materialise", lambda df, by=(): frames.append(by) or materialise(df, by))
    many = segment.segment_table(features, ["id"], grids, mode=mode, tune="kmeans", tune_trials=1, tune_space={"n_clusters": {"type": "int", "low": 3, "high": 3}})
    assert len(frames) == written
    assert many.model.features == few.model.features and many.model.defaults == pytest.approx(few.model.defaults)
    for one, other in zip(few.search.trials, many.search.trials):
        assert {k: v for k, v in one.metrics.items() if k != "silhouette_mode"} == pytest.approx({k: v for k, v in other.metrics.items() if k != "silhouette_mode"})
    assert sorted(map(tuple, many.labels().collect())) == sorted(map(tuple, few.labels().collect()))
    assert sorted(map(tuple, many.model.predict(features).collect())) == sorted(map(tuple, few.labels().collect()))


def test_gaps_of_many_columns(spark):
    """More columns than one number has bits."""
    names = [f"c{i}" for i in range(70)]
    rows = [tuple(None if (r * 7 + i) % 10 < 3 and i % 3 else float(r) for i in range(70)) for r in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    count = missing._pattern_counter(df, names)
    for dropped in ((), ("c1",), ("c1", "c32", "c68")):
        alive = [r for r in rows if all(r[names.index(d)] is not None for d in dropped)]
        assert [count(c, dropped) for c in names] == [(len(alive), sum(r[i] is None for r in alive)) for i in range(70)]
