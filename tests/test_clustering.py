import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tablelab.operators import cluster, quality, reduce, search, segments
from tablelab.operators.hierarchy import merge_centres, pair_distances
from tablelab.operators.mixture import fit_mixture
from tablelab.plans import prepare, segment, store


@pytest.fixture(scope="module")
def groups():
    """Three planted groups, the sizes and spreads of the clustering fixture."""
    rng = np.random.default_rng(42)
    parts = []
    for g, (n, age, income, spending, visits) in enumerate(
        [(166, (25, 3), (30000, 5000), (500, 100), 2), (166, (40, 4), (60000, 10000), (1500, 300), 5), (168, (50, 5), (100000, 20000), (5000, 1000), 8)]
    ):
        parts.append(
            pd.DataFrame(
                {"age": rng.normal(*age, n), "income": rng.normal(*income, n), "spending": rng.normal(*spending, n),
                 "frequency": rng.poisson(visits, n), "true_cluster": g}
            )
        )
    pdf = pd.concat(parts, ignore_index=True)
    pdf["customer_id"] = np.arange(1, len(pdf) + 1)
    return pdf


@pytest.fixture(scope="module")
def vectors(spark, groups):
    features = ["age", "income", "spending", "frequency"]
    scaled = (groups[features] - groups[features].mean()) / groups[features].std(ddof=0)
    pdf = pd.DataFrame({"customer_id": groups["customer_id"], "true_cluster": groups["true_cluster"], "point": scaled.to_numpy().tolist()})
    df = spark.createDataFrame(pdf, "customer_id long, true_cluster int, point array<double>")
    return df.withColumn("features", array_to_vector("point")).repartition(3).cache()


def agreement(labelled):
    """Share of rows in the majority true group of their cluster."""
    pdf = labelled.select("true_cluster", "prediction").toPandas()
    return pdf.groupby("prediction")["true_cluster"].agg(lambda s: s.value_counts().iloc[0]).sum() / len(pdf)


def test_planted_groups_are_recovered(vectors):
    fits = [cluster.fit_kmeans(vectors, 3, n_init=2), cluster.fit_hierarchical(vectors, 3, micro=60), cluster.fit_gmm_builtin(vectors, 3)]
    fits += [cluster.fit_gmm(vectors, 3, covariance_type=c) for c in ("full", "tied", "diag", "spherical")]
    for fit in fits:
        labelled = fit.transform(vectors)
        assert agreement(labelled) > 0.9, fit.params
        sizes = [r["count"] for r in labelled.groupBy("prediction").count().orderBy("prediction").collect()]
        assert sum(sizes) == 500 and len(sizes) == 3


def test_kmeans_labels_by_size_and_inertia_falls(vectors):
    fits = [cluster.fit_kmeans(vectors, k, n_init=3) for k in (2, 4, 6)]
    inertia = [f.details["inertia"] for f in fits]
    assert inertia == sorted(inertia, reverse=True)
    sizes = [r["count"] for r in fits[1].transform(vectors).groupBy("prediction").count().orderBy("prediction").collect()]
    assert sizes == sorted(sizes, reverse=True)


@pytest.mark.parametrize("kind", ["full", "tied", "diag", "spherical"])
def test_mixture_likelihood_never_falls(vectors, kind):
    m = fit_mixture(vectors.select("point"), 3, kind, max_iter=15, tol=0)
    assert all(b >= a - 1e-6 for a, b in zip(m.history, m.history[1:]))
    assert m.weights.sum() == pytest.approx(1.0)
    if kind == "spherical":
        assert np.allclose(m.covariances[0], np.eye(4) * m.covariances[0][0, 0])
    if kind == "tied":
        assert np.allclose(m.covariances[0], m.covariances[2])


def test_mixture_regularisation_survives_a_constant_feature(spark):
    rows = [(float(i % 7), 1.0) for i in range(60)] + [(50.0 + i % 5, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double").select(F.array("a", "b").alias("point"))
    m = fit_mixture(df, 2, "full", reg_covar=1e-3)
    assert sorted(np.round(m.weights, 2)) == [0.5, 0.5]


def brute_merge(x, k, linkage, distance):
    clusters = [[i] for i in range(len(x))]
    gap = pair_distances(x, distance)

    def between(a, b):
        if linkage == "ward":
            d = x[a].mean(axis=0) - x[b].mean(axis=0)
            return len(a) * len(b) / (len(a) + len(b)) * (d @ d)
        block = gap[np.ix_(a, b)]
        return {"single": block.min(), "complete": block.max(), "average": block.mean()}[linkage]

    while len(clusters) > k:
        pairs = [(between(clusters[i], clusters[j]), i, j) for i in range(len(clusters)) for j in range(i + 1, len(clusters))]
        _, i, j = min(pairs)
        clusters[i] += clusters.pop(j)
    return {frozenset(c) for c in clusters}


@pytest.mark.parametrize("linkage", ["ward", "complete", "average", "single"])
def test_merging_matches_brute_force(linkage):
    x = np.random.default_rng(8).normal(size=(40, 3))
    for distance in ("euclidean",) if linkage == "ward" else ("euclidean", "l1", "cosine"):
        got = merge_centres(x, np.ones(40), 4, linkage, distance)
        assert {frozenset(np.flatnonzero(got == g)) for g in range(4)} == brute_merge(x, 4, linkage, distance)


def test_ward_refuses_other_distances():
    with pytest.raises(ValueError):
        merge_centres(np.zeros((3, 2)), np.ones(3), 2, "ward", "l1")


# ---- quality


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


@pytest.mark.parametrize("cell_rows", [20, 10_000])
def test_silhouette_matches_brute_force(spark, cell_rows):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(150, 3)), 1)
    x[30:80] = x[30]  # many equal points in one cluster
    labels = np.where(np.arange(150) < 110, 0, rng.integers(1, 4, 150))
    labels[149] = 9  # a cluster of one row
    pdf = pd.DataFrame({"id": [f"r{i}" for i in range(150)], "c": labels, "p": x.tolist()})
    df = spark.createDataFrame(pdf, "id string, c int, p array<double>")
    pts = quality.points_from_array(df, "p", "c", ["id"])
    m = quality.cluster_moments(pts)
    assert quality.silhouette(pts, m, cell_rows=cell_rows) == pytest.approx(brute_silhouette(x, labels), abs=1e-9)
    base, without = quality.silhouette_without(pts, m, cell_rows=cell_rows)
    assert base == pytest.approx(brute_silhouette(x, labels), abs=1e-9)
    for f in range(3):
        assert without[f] == pytest.approx(brute_silhouette(np.delete(x, f, axis=1), labels), abs=1e-6)


def test_one_cluster_rule(spark):
    df = spark.createDataFrame([(i, 0, [float(i)]) for i in range(5)], "id int, c int, p array<double>")
    found = quality.cluster_metrics(quality.points_from_array(df, "p", "c", ["id"]))
    assert (found["silhouette"], found["davies_bouldin"], found["calinski_harabasz"]) == (-1.0, math.inf, 0.0)
    assert found["n_clusters"] == 1


def test_top_features_falls_back_to_variance(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0), (0, 2.0, 9.0), (1, 3.0, -7.0)], "c int, a double, b double")
    rows = segments.top_features(df, "c", 1).collect()
    assert [(r["feature"], r["rule"]) for r in rows] == [("b", "variance")]


# ---- reduction


def test_components_are_centred_uncorrelated_and_oriented(spark, groups):
    df = spark.createDataFrame(groups)
    features = ["age", "income", "spending", "frequency"]
    fitted = reduce.fit_pca(df, features, k=4)
    assert sum(fitted.ratios) == pytest.approx(1.0)
    x = reduce.project(df, fitted, ["customer_id"]).toPandas()[[f"pc{i}" for i in range(1, 5)]].to_numpy()
    assert np.abs(x.mean(axis=0)).max() < 1e-6
    corr = np.corrcoef(x.T) - np.eye(4)
    assert np.abs(corr).max() < 1e-6
    top = fitted.loadings[np.abs(fitted.loadings).argmax(axis=0), np.arange(4)]
    assert (top > 0).all()
    assert reduce.fit_pca(df, features, variance=0.5).k == 1


def test_missing_model_input_names_the_column(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 3.0)], "id int, a double, b double")
    with pytest.raises(ValueError, match="b"):
        segment.segment_table(df, ["id"], {"kmeans": {"n_clusters": [2]}})


# ---- search and runs


def test_failed_trials_are_kept_with_a_message(vectors):
    grids = {"kmeans": {"n_clusters": [3], "n_init": [1]}, "agglo": {"n_clusters": [3], "linkage": ["ward"], "affinity": ["l1"]}}
    found = search.compare_clusterings(vectors.select("customer_id", "features"), grids, key=["customer_id"])
    assert [t.error is None for t in found.trials] == [True, False]
    assert found.best().algorithm == "kmeans"


def test_best_takes_first_on_ties_and_knows_direction():
    def trial(i, s, d):
        return search.Trial(i, "kmeans", {}, {"silhouette": s, "davies_bouldin": d}, clustering=object())

    trials = [trial(0, 0.5, 2.0), trial(1, 0.7, 3.0), trial(2, 0.7, 1.0)]
    assert search.Search(trials, "silhouette").best().number == 1
    assert search.Search(trials, "davies_bouldin").best().number == 2


def test_default_grid_steps():
    lists = search.space_grid(search.SPACES["kmeans"], 30)
    assert lists["n_clusters"] == list(range(2, 11)) and lists["n_init"] == [5, 8, 11, 14, 17, 20]
    assert lists["max_iter"] == [100, 180, 260, 340, 420, 500]
    assert len(search.space_grid(search.SPACES["gmm"], 30)["reg_covar"]) == 5


@pytest.mark.parametrize("algorithms", [{"kmeans": {"n_clusters": [3], "n_init": [1]}}, {"gmm": {"n_components": [3], "covariance_type": ["diag"]}}])
def test_saved_model_predicts_the_same(spark, groups, tmp_path, algorithms):
    pdf = groups.copy()
    pdf["city"] = np.where(pdf.index % 3 == 0, "Hue", "Hanoi")
    pdf["street"] = [f"street {i % 12}" for i in range(len(pdf))]
    pdf.loc[3:30, "income"] = np.nan
    df = spark.createDataFrame(pdf).drop("true_cluster")
    prep = prepare.fit_preparation(df, ["customer_id"])
    found = segment.segment_table(prep.transform(df), ["customer_id"], algorithms, preparation=prep)
    store.save_model(found.model, found.best.metrics, str(tmp_path / "m"), spark)
    model = store.load_model(spark, str(tmp_path / "m"))
    want = {(r[0], r[1]) for r in found.labels().collect()}
    assert {(r[0], r[1]) for r in model.predict(df).collect()} == want
    assert len(want) == 500
    card = store.model_card(spark, str(tmp_path / "m")).first()
    assert card["n_clusters"] == 3 and card["verdict"] in ("strong", "reasonable", "weak", "poor")


def test_every_new_row_gets_a_label(spark, groups):
    pdf = groups.copy()
    pdf["street"] = [f"street {i % 12}" for i in range(len(pdf))]
    pdf.loc[3:4, "income"] = np.nan  # under one percent: these rows are dropped in training
    df = spark.createDataFrame(pdf).drop("true_cluster")
    prep = prepare.fit_preparation(df, ["customer_id"])
    assert prep.transform(df).count() == 498
    found = segment.segment_table(prep.transform(df), ["customer_id"], {"kmeans": {"n_clusters": [3], "n_init": [1]}}, preparation=prep)
    new = df.withColumns({c: F.lit(None).cast("double") for c in ("income", "age") if c in df.columns}).withColumn("street", F.lit("nowhere"))
    labels = [r["prediction"] for r in found.model.predict(new).collect()]
    assert len(labels) == 500 and None not in labels


def test_target_column_is_set_aside(spark, groups):
    df = spark.createDataFrame(groups)
    found = segment.segment_table(df, ["customer_id"], {"kmeans": {"n_clusters": [3], "n_init": [1]}}, target_column="true_cluster")
    assert "true_cluster" not in found.model.features
    assert found.target.columns == ["customer_id", "true_cluster"]


def test_vectors_helper_round_trip(vectors):
    row = vectors.select("point", vector_to_array("features").alias("back")).first()
    assert list(row["point"]) == list(row["back"])


def test_reports_of_a_run_read_back(spark, groups, tmp_path):
    from tablelab.plans import export
    from tablelab.sources.files import read_csv

    df = spark.createDataFrame(groups).drop("true_cluster").withColumn("odd", F.col("frequency") % 2 == 1)
    prep = prepare.fit_preparation(df, ["customer_id"], outlier_method="iqr")
    written = export.export_preparation(df, prep, str(tmp_path / "prep"))
    assert read_csv(spark, written["processed_data"]).count() == 500
    assert read_csv(spark, written["steps"]).count() == 5
    inputs = prep.transform(df)
    found = segment.segment_table(inputs, ["customer_id"], {"kmeans": {"n_clusters": [2, 3], "n_init": [1]}}, preparation=prep)
    written = export.export_segmentation(found, inputs, str(tmp_path / "run"))
    assert read_csv(spark, written["trials"]).count() == 2
    labels = read_csv(spark, written["predictions"])
    assert labels.count() == 500 and dict(labels.dtypes)["cluster"] == "bigint"
    top = read_csv(spark, written["feature_importance"])
    assert top.count() == len(found.model.features)
