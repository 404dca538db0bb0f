"""Queries over reduction, clustering, quality, group description and runs (R, C, Q, G, X)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.base import FEATURES, customer_features, query, r, rounded, table
from tablelab.operators import cluster, quality, reduce, search, segments
from tablelab.operators.scale import scale
from tablelab.operators.tuner import tune_learning
from tablelab.plans import export, prepare, segment, store
from tablelab.session import materialise, scratch_path

# ---- principal components

PAIR = ["l_quantity", "l_extendedprice"]

# Two columns have a closed form: eigenvalues and eigenvector of a 2 x 2 covariance.
EIGEN = """s AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_samp(l_quantity) AS a, var_samp(l_extendedprice) AS c,
 covar_samp(l_quantity, l_extendedprice) AS b FROM lineitem),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1, (a + c) / 2 - sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l2 FROM s),
v AS (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS vx, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS vy FROM e)"""


@query(
    "r01_pca_fixed",
    f"WITH {EIGEN} SELECT l_orderkey, l_linenumber, round(((l_quantity - mx) * vx + (l_extendedprice - my) * vy) * sign(vy), 4) + 0.0 AS pc1 FROM lineitem, v",
)
def r01(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *PAIR)
    fitted = reduce.fit_pca(lines, PAIR, k=1)
    return rounded(reduce.project(lines, fitted, ["l_orderkey", "l_linenumber"]), 4)


def _vectors(spark, sf, dims=64):
    wide = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(dims)]
    return table(spark, sf, "embeddings").select("vec_id", "label", *wide), [f"e{i}" for i in range(dims)]


@query("r02_pca_by_variance")
def r02(spark, sf):
    rows, names = _vectors(spark, sf)
    fitted = reduce.fit_pca(rows, names, variance=0.95)
    kept = reduce.project(rows, fitted, ["vec_id"])
    return kept.agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(fitted.k).alias("components"),
        F.lit(sum(fitted.ratios[: fitted.k])).alias("variance_kept"),
        F.avg("pc1").alias("mean_pc1"),
        F.corr("pc1", "pc2").alias("corr_pc1_pc2"),
    )


@query(
    "r03_pca_report",
    f"WITH {EIGEN} SELECT CAST(1 AS INTEGER) AS component, round(l1 / (l1 + l2), 9) + 0.0 AS ratio, round(l1 / (l1 + l2), 9) + 0.0 AS cumulative FROM v "
    "UNION ALL SELECT 2, round(l2 / (l1 + l2), 9) + 0.0, 1.0::DOUBLE FROM v",
)
def r03(spark, sf):
    lines = table(spark, sf, "lineitem")
    fitted = reduce.fit_pca(lines, PAIR, k=2)
    return rounded(reduce.variance_table(lines, fitted), 9)


@query("r03_pca_loadings")
def r03_loadings(spark, sf):
    rows, names = _vectors(spark, sf)
    fitted = reduce.fit_pca(rows, names, k=5)
    return reduce.top_loadings(rows, fitted, 10)


# ---- clustering

ALGORITHMS = {
    "kmeans": {"n_clusters": [3, 4, 5, 6], "init": ["k-means++"], "n_init": [10], "max_iter": [300]},
    "gmm": {"n_components": [3, 4, 5], "covariance_type": ["full", "tied"], "max_iter": [100]},
}
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey"]
FRAME_KEY = ["c_custkey"]
FRAME_COLUMNS = ["c_acctbal", "n_orders", "total_price", "mean_discount"]


def _line_frame(spark, sf):
    """Standardised lineitem measures as model vectors."""
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    rows = scale(table(spark, sf, "lineitem").select(*LINE_ID, *names), "standard", names)
    return materialise(reduce.assemble(names, "features").transform(rows).select(*LINE_ID, "features"), LINE_ID)


def _customer_frame(spark, sf):
    """Standardised features per customer; one without orders has counts and sums of 0."""
    rows = customer_features(spark, sf).na.fill(0)
    rows = scale(rows.select(*FRAME_KEY, *FRAME_COLUMNS), "standard", FRAME_COLUMNS)
    made = reduce.assemble(FRAME_COLUMNS, "features").transform(rows.select(*FRAME_KEY, *[F.col(c).cast("double").alias(c) for c in FRAME_COLUMNS]))
    return materialise(made.select(*FRAME_KEY, "features"), FRAME_KEY)


def _groups(frame, fitted):
    """Size and centre of each cluster."""
    labelled = fitted.transform(frame).withColumn("x", vector_to_array("features"))
    width = len(labelled.select("x").first()["x"])
    means = [F.avg(F.get("x", F.lit(i))).alias(f"center_{i}") for i in range(width)]
    return labelled.groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("size"), *means)


@query("c01_kmeans")
def c01(spark, sf):
    frame = _line_frame(spark, sf)
    return _groups(frame, cluster.fit_kmeans(frame, 3))


@query("c02_gmm_full")
def c02(spark, sf):
    frame = _line_frame(spark, sf)
    return _groups(frame, cluster.fit_gmm_builtin(frame, 3))


def _gmm_query(name, covariance, **options):
    @query(name)
    def run(spark, sf):
        frame = _line_frame(spark, sf)
        return _groups(frame, cluster.fit_gmm(frame, 3, covariance_type=covariance, **options))

    return run


_gmm_query("c03_gmm_tied", "tied")
_gmm_query("c04_gmm_diag", "diag")
_gmm_query("c05_gmm_spherical", "spherical")
_gmm_query("c06_gmm_regularised", "full", reg_covar=1e-2)


@query("c07_cluster_hierarchical")
def c07(spark, sf):
    frame = _customer_frame(spark, sf)
    out = None
    for linkage in ("ward", "complete", "average", "single"):
        part = _groups(frame, cluster.fit_hierarchical(frame, 4, linkage=linkage)).withColumn("linkage", F.lit(linkage))
        out = part if out is None else out.unionByName(part)
    return out


@query("c07_cluster_bisecting")
def c07_bisecting(spark, sf):
    frame = _line_frame(spark, sf)
    return _groups(frame, cluster.fit_bisecting(frame, 4))


# Three groups of lines far apart, in columns of their own: every method must find them.
PLANTED = ["x0", "x1", "x2"]
SHIFTS = {"x0": ("l_quantity", 1, 1000), "x1": ("l_discount", 2, 3000), "x2": ("l_tax", 0, 2000)}
PLANTED_CELLS = ", ".join(f"{c} + CASE WHEN l_linenumber % 3 = {g} THEN {by} ELSE 0 END AS {x}" for x, (c, g, by) in SHIFTS.items())
PLANTED_GROUPS = f"""SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, avg(x0), avg(x1), avg(x2)) - 1 AS INTEGER) AS cluster, count(*) AS size,
 {", ".join(r(f"avg({x})", f"center_{i}") for i, x in enumerate(PLANTED))} FROM (SELECT l_linenumber % 3 AS g, {PLANTED_CELLS} FROM lineitem) GROUP BY g"""


def _planted(spark, sf, *more):
    cells = [(F.col(c) + F.when(F.col("l_linenumber") % 3 == g, float(by)).otherwise(0.0)).alias(x) for x, (c, g, by) in SHIFTS.items()]
    return table(spark, sf, "lineitem").select(*LINE_ID, *cells, *more)


def _planted_query(name, fit):
    @query(name, PLANTED_GROUPS)
    def run(spark, sf):
        vectors = reduce.assemble(PLANTED, "features").transform(_planted(spark, sf)).select(*LINE_ID, "features")
        frame = materialise(vectors, LINE_ID)
        return rounded(_groups(frame, fit(frame)))


_planted_query("c01_kmeans_planted", lambda f: cluster.fit_kmeans(f, 3))
_planted_query("c02_gmm_full_planted", lambda f: cluster.fit_gmm_builtin(f, 3))
_planted_query("c03_gmm_tied_planted", lambda f: cluster.fit_gmm(f, 3, covariance_type="tied"))
_planted_query("c04_gmm_diag_planted", lambda f: cluster.fit_gmm(f, 3, covariance_type="diag"))
_planted_query("c05_gmm_spherical_planted", lambda f: cluster.fit_gmm(f, 3, covariance_type="spherical"))
_planted_query("c06_gmm_regularised_planted", lambda f: cluster.fit_gmm(f, 3, reg_covar=1e-2))
_planted_query("c07_bisecting_planted", lambda f: cluster.fit_bisecting(f, 3))
for _linkage in ("ward", "complete", "average", "single"):
    _planted_query(f"c07_{_linkage}_planted", lambda f, linkage=_linkage: cluster.fit_hierarchical(f, 3, linkage=linkage))
_planted_query("c07_single_exact_planted", lambda f: cluster.fit_single_linkage(f, 3))
_planted_query("c08_compare_planted", lambda f: search.compare_clusterings(
    f, {"kmeans": {"n_clusters": [2, 3, 4]}, "gmm": {"n_components": [3, 4]}, "agglo": {"n_clusters": [2, 3]}}, key=LINE_ID, ready=True
).best().clustering)
_planted_query("c10_tune_grid_planted", lambda f: search.tune_grid(
    f, "agglo", key=LINE_ID, ready=True, space={"n_clusters": {"type": "int", "low": 2, "high": 4}, "linkage": {"type": "categorical", "choices": ["ward", "average"]}}
).best().clustering)


_planted_query("c09_tune_learning_planted", lambda f: tune_learning(
    f, "kmeans", key=LINE_ID, ready=True, n_trials=14, space={"n_clusters": {"type": "int", "low": 2, "high": 12}, "n_init": {"type": "int", "low": 1, "high": 2}}
).best().clustering)


@query("c08_compare_clusterings")
def c08(spark, sf):
    return search.compare_clusterings(_customer_frame(spark, sf), ALGORITHMS, key=FRAME_KEY, ready=True).table(spark)


@query("c08_metric_by_clusters")
def c08_by(spark, sf):
    grids = {"kmeans": {"n_clusters": [2, 3, 4]}, "agglo": {"n_clusters": [2, 3, 4]}}
    return search.compare_clusterings(_customer_frame(spark, sf), grids, key=FRAME_KEY, ready=True).by_clusters(spark)


@query("c09_tune_random")
def c09(spark, sf):
    return search.tune_random(_customer_frame(spark, sf), "kmeans", key=FRAME_KEY, n_trials=5, ready=True).table(spark)


@query("c09_tune_learning")
def c09_learning(spark, sf):
    """The default space; more trials than start at random, so that some are learned."""
    return tune_learning(_customer_frame(spark, sf), "kmeans", key=FRAME_KEY, n_trials=12, ready=True).table(spark)


@query("c10_tune_grid")
def c10(spark, sf):
    space = {"n_clusters": {"type": "int", "low": 2, "high": 4}, "linkage": {"type": "categorical", "choices": ["ward", "average"]}}
    return search.tune_grid(_customer_frame(spark, sf), "agglo", key=FRAME_KEY, space=space, ready=True).table(spark)


@query(
    "c11_assign_clusters",
    """WITH centers AS (SELECT l_returnflag AS name, avg(l_quantity) AS q, avg(l_extendedprice / 1000) AS p, avg(l_discount * 100) AS d FROM lineitem
    WHERE l_linestatus = 'O' GROUP BY 1), rows AS (SELECT row_number() OVER () AS i, l_orderkey, l_linenumber, l_quantity AS q, l_extendedprice / 1000 AS p, l_discount * 100 AS d FROM lineitem)
    SELECT any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber,
    arg_min(name, (rows.q - centers.q) * (rows.q - centers.q) + (rows.p - centers.p) * (rows.p - centers.p) + (rows.d - centers.d) * (rows.d - centers.d)) AS prediction
    FROM rows, centers GROUP BY i""",
)
def c11(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.col("l_quantity").alias("q"),
        (F.col("l_extendedprice") / 1000).alias("p"), (F.col("l_discount") * 100).alias("d"),
    )
    dims = ["q", "p", "d"]
    found = segments.cluster_centroids(rows.where(F.col("l_linestatus") == "O"), "l_returnflag", dims).collect()
    centers = {row["cluster"]: [row[d] for d in dims] for row in found}
    return cluster.nearest_center(rows, dims, centers).select("l_orderkey", "l_linenumber", "prediction")


def _small_run(spark, sf, rows):
    """A short preparation and segmentation of the customer table."""
    preparation = prepare.fit_preparation(rows, ["c_custkey"], outlier_method="iqr")
    prepared = preparation.transform(rows)
    found = segment.segment_table(
        prepared, ["c_custkey"], {"kmeans": {"n_clusters": [3, 4]}}, preparation=preparation
    )
    return found


@query("c12_predict_new")
def c12(spark, sf):
    rows = table(spark, sf, "customer")
    known = rows.where(F.col("c_custkey") % 5 != 0)
    model = _small_run(spark, sf, known).model
    return model.predict(rows.where(F.col("c_custkey") % 5 == 0)).groupBy("prediction").agg(F.count(F.lit(1)).alias("size"))


# New lines with a gap where training had none and with a category that training lacks: one label for each.
PREDICTED = """WITH g AS (SELECT l_linenumber % 3 AS g, CAST(row_number() OVER (ORDER BY count(*) DESC) - 1 AS INTEGER) AS prediction
 FROM lineitem WHERE l_orderkey % 5 <> 0 GROUP BY 1)
 SELECT l_orderkey, l_linenumber, l_partkey, prediction FROM lineitem JOIN g ON l_linenumber % 3 = g WHERE l_orderkey % 5 = 0"""


def _planted_model(spark, sf):
    """A model of the planted groups, and rows it has not seen."""
    rows = _planted(spark, sf, "l_returnflag")
    known = rows.where(F.col("l_orderkey") % 5 != 0)
    preparation = prepare.fit_preparation(known, LINE_ID, outlier_method="iqr")
    found = segment.segment_table(preparation.transform(known), LINE_ID, {"kmeans": {"n_clusters": [3]}}, preparation=preparation)
    new = rows.where(F.col("l_orderkey") % 5 == 0)
    new = new.withColumn("x2", F.when(F.col("l_partkey") % 7 != 0, F.col("x2")))
    return found, new.withColumn("l_returnflag", F.when(F.col("l_partkey") % 11 == 0, F.lit("new")).otherwise(F.col("l_returnflag")))


@query("c12_predict_planted", PREDICTED)
def c12_planted(spark, sf):
    found, new = _planted_model(spark, sf)
    return found.model.predict(new)


@query("x05_reload_planted", PREDICTED)
def x05_planted(spark, sf):
    found, new = _planted_model(spark, sf)
    path = scratch_path(spark, "planted")
    store.save_model(found.model, found.best.metrics, path, spark)
    return store.load_model(spark, path).predict(new)


# ---- quality, with the given label of each embedding

PAIR_SQL = """p AS (SELECT a.vec_id AS id, a.label AS own, b.label AS other, sum({distance}) AS total
 FROM embeddings a, embeddings b GROUP BY 1, 2, 3),
n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
w AS (SELECT id, any_value(m.n) AS own_n, max(CASE WHEN own = other THEN total / (m.n - 1) END) AS near, min(CASE WHEN own <> other THEN total / o.n END) AS far
 FROM p JOIN n m ON own = m.label JOIN n o ON other = o.label GROUP BY id)
SELECT {r} FROM w"""
DISTANCE = "list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
WIDTH = "avg(CASE WHEN own_n = 1 THEN 0 ELSE (far - near) / greatest(far, near) END)"

LONG = """x AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS m, var_pop(v) AS s, count(*) AS n FROM x GROUP BY 1, 2)"""


def _embedding_points(spark, sf):
    return quality.points_from_array(table(spark, sf, "embeddings"), "embedding", "label", ["vec_id"])


@query("q01_silhouette", "WITH " + PAIR_SQL.format(distance=DISTANCE, r=r(WIDTH, "silhouette")))
def q01(spark, sf):
    pts = _embedding_points(spark, sf)
    value = quality.silhouette(pts, quality.cluster_moments(pts, 64))
    return rounded(spark.createDataFrame([(value,)], "silhouette double"))


@query("q02_silhouette_squared", "WITH " + PAIR_SQL.format(distance=f"{DISTANCE} * {DISTANCE}", r=r(WIDTH, "silhouette_squared")))
def q02(spark, sf):
    pts = _embedding_points(spark, sf)
    value = quality.silhouette_squared(pts, quality.cluster_moments(pts, 64))
    return rounded(spark.createDataFrame([(value,)], "silhouette_squared double"))


@query(
    "q03_davies_bouldin",
    f"""WITH {LONG}, d AS (SELECT vec_id, x.label, sqrt(sum((v - m) * (v - m))) AS g FROM x JOIN c USING (label, i) GROUP BY 1, 2),
    s AS (SELECT label, avg(g) AS s FROM d GROUP BY 1), g AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS apart FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2),
    w AS (SELECT g.i, max((si.s + sj.s) / apart) AS worst FROM g JOIN s si ON g.i = si.label JOIN s sj ON g.j = sj.label GROUP BY 1) SELECT {r('avg(worst)', 'davies_bouldin')} FROM w""",
)
def q03(spark, sf):
    pts = _embedding_points(spark, sf)
    value = quality.davies_bouldin(pts, quality.cluster_moments(pts, 64))
    return rounded(spark.createDataFrame([(value,)], "davies_bouldin double"))


@query(
    "q04_calinski_harabasz",
    f"""WITH {LONG}, o AS (SELECT i, avg(v) AS g, count(*) AS n FROM x GROUP BY 1), k AS (SELECT count(DISTINCT label) AS k FROM c)
    SELECT round((sum(c.n * (m - g) * (m - g)) / (any_value(k) - 1)) / (sum(c.n * s) / (any_value(o.n) - any_value(k))), 6) + 0.0 AS calinski_harabasz FROM c JOIN o USING (i), k""",
)
def q04(spark, sf):
    value = quality.calinski_harabasz(quality.cluster_moments(_embedding_points(spark, sf), 64))
    return rounded(spark.createDataFrame([(value,)], "calinski_harabasz double"))


@query(
    "q05_cluster_count",
    """SELECT 'label' AS labelling, count(DISTINCT label) AS n_clusters, false AS one_cluster FROM embeddings
    UNION ALL SELECT 'one', 1, true FROM (SELECT count(*) FROM embeddings)""",
)
def q05(spark, sf):
    pts = _embedding_points(spark, sf)
    rows = []
    for name, labelled in (("label", pts), ("one", pts.withColumn("label", F.lit(0)))):
        found = quality.cluster_metrics(labelled, mode="squared", dims=64)
        alone = (found["silhouette"], found["davies_bouldin"], found["calinski_harabasz"]) == (-1.0, float("inf"), 0.0)
        rows.append((name, found["n_clusters"], alone))
    return spark.createDataFrame(rows, "labelling string, n_clusters bigint, one_cluster boolean")


# ---- description of given groups

LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FLAG = "l_returnflag"


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(FLAG, *LINES)


@query("g01_cluster_sizes", f"SELECT l_returnflag AS cluster, count(*) AS size, {r('count(*) / sum(count(*)) OVER () * 100', 'percent')} FROM lineitem GROUP BY 1")
def g01(spark, sf):
    return rounded(segments.cluster_sizes(_lines(spark, sf), FLAG))


@query(
    "g02_cluster_profiles",
    f"SELECT l_returnflag AS cluster, count(*) AS size, {r('count(*) / sum(count(*)) OVER () * 100', 'percent')}, "
    + ", ".join(f"{r(f'avg({c})', c + '_mean')}, {r(f'stddev_samp({c})', c + '_std')}" for c in LINES)
    + " FROM lineitem GROUP BY 1",
)
def g02(spark, sf):
    return rounded(segments.cluster_profiles(_lines(spark, sf), FLAG))


@query(
    "g03_cluster_zscores",
    " UNION ALL ".join(
        f"SELECT l_returnflag AS cluster, '{c}' AS feature, {r(f'(avg({c}) - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem)', 'z', 8)} FROM lineitem GROUP BY 1"
        for c in LINES
    ),
)
def g03(spark, sf):
    return rounded(segments.cluster_zscores(_lines(spark, sf), FLAG), 8)


@query(
    "g04_cluster_radar",
    " UNION ALL ".join(
        f"SELECT cluster, '{c}' AS feature, {r('(m - min(m) OVER ()) / (max(m) OVER () - min(m) OVER ())', 'value')} FROM (SELECT l_returnflag AS cluster, avg({c}) AS m FROM lineitem GROUP BY 1)"
        for c in LINES
    ),
)
def g04(spark, sf):
    return rounded(segments.cluster_radar(_lines(spark, sf), FLAG))


def _anova_sql(columns, source="lineitem", label=FLAG):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * s) / (sum(n) - count(*))) AS f FROM
        (SELECT {label}, count({c}) AS n, avg({c}) AS m, var_pop({c}) AS s, (SELECT avg({c}) FROM {source}) AS g FROM {source} GROUP BY 1)"""
        for c in columns
    )


@query("g05_anova_f", f"SELECT feature, {r('f', 'f_score')} FROM ({_anova_sql(LINES)})")
def g05(spark, sf):
    return rounded(segments.anova_f(_lines(spark, sf), FLAG).drop("p_value"))


# Three groups: two degrees of freedom above, for which the tail of F has a closed form.
@query(
    "g05_anova_p",
    f"SELECT feature, {r('f', 'f_score')}, {r('pow(1 + 2 * f / m, -m / 2)', 'p_value')} FROM ({_anova_sql(LINES)}), (SELECT count(*) - 3.0 AS m FROM lineitem)",
)
def g05_p(spark, sf):
    return rounded(segments.anova_f(_lines(spark, sf), FLAG))


CUSTOMER = ["c_acctbal", "c_nationkey", "c_custkey_share"]
SCALED_CUSTOMER = """t AS (SELECT c_custkey, c_mktsegment, c_acctbal / 1000 AS c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
 c_custkey / 100.0 AS c_custkey_share FROM customer)"""


def _customer_points(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", (F.col("c_acctbal") / 1000).alias("c_acctbal"), F.col("c_nationkey").cast("double").alias("c_nationkey"),
        (F.col("c_custkey") / F.lit(100.0)).alias("c_custkey_share"),
    )


def _drop_ctes():
    """Silhouette with all features and without each, from one pair pass."""
    squares = {c: f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in CUSTOMER}
    variants = [("all", list(CUSTOMER)), *[(c, [x for x in CUSTOMER if x != c]) for c in CUSTOMER]]
    sums = ", ".join(f"sum(sqrt({' + '.join(squares[x] for x in used)})) AS d{i}" for i, (_, used) in enumerate(variants))
    widths = ", ".join(
        f"max(CASE WHEN own = other THEN d{i} / (m.n - 1) END) AS near{i}, min(CASE WHEN own <> other THEN d{i} / o.n END) AS far{i}"
        for i in range(len(variants))
    )
    means = ", ".join(f"avg((far{i} - near{i}) / greatest(far{i}, near{i})) AS s{i}" for i in range(len(variants)))
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, s0 AS base, s{i} AS without FROM s" for i, (c, _) in enumerate(variants) if i)
    return f"""{SCALED_CUSTOMER}, p AS (SELECT a.c_custkey AS id, a.c_mktsegment AS own, b.c_mktsegment AS other, {sums} FROM t a, t b GROUP BY 1, 2, 3),
    n AS (SELECT c_mktsegment AS label, count(*) AS n FROM t GROUP BY 1),
    w AS (SELECT id, {widths} FROM p JOIN n m ON own = m.label JOIN n o ON other = o.label GROUP BY id),
    s AS (SELECT {means} FROM w), drops AS ({rows})"""


@query("g06_silhouette_drop", f"WITH {_drop_ctes()} SELECT feature, {r('base', 'base', 8)}, {r('without', 'without', 8)}, {r('base - without', 'importance', 8)} FROM drops")
def g06(spark, sf):
    return rounded(segments.silhouette_drop(_customer_points(spark, sf), "c_mktsegment", CUSTOMER, ["c_custkey"], mode="euclidean"), 8)


@query(
    "g07_combined_importance",
    f"""WITH {_drop_ctes()}, joined AS (SELECT feature, f, base - without AS d FROM drops JOIN ({_anova_sql(CUSTOMER, 't', 'c_mktsegment')}) USING (feature)),
    norm AS (SELECT *, (f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER ()) AS fa, (d - min(d) OVER ()) / (max(d) OVER () - min(d) OVER ()) AS da FROM joined)
    SELECT feature, {r('f', 'anova_score')}, {r('d', 'silhouette_score')}, {r('fa', 'anova_norm')}, {r('da', 'silhouette_norm')}, {r('(fa + da) / 2', 'combined_importance')} FROM norm""",
)
def g07(spark, sf):
    table_ = segments.combined_importance(_customer_points(spark, sf), "c_mktsegment", CUSTOMER, ["c_custkey"], mode="euclidean")
    return rounded(table_.drop("anova_p_value"))


# The same with squared distances, over all numeric columns of all lines, by return flag.
ALL_LINES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _squared_drop_ctes():
    """Mean squared distances to a cluster from its means and variances; all lines, linear work."""
    moments = ", ".join(f"avg({c}) AS m{i}, var_pop({c}) AS v{i}" for i, c in enumerate(ALL_LINES))
    terms = [f"((t.x{i} - g.m{i}) * (t.x{i} - g.m{i}) + g.v{i})" for i in range(len(ALL_LINES))]
    sums = [" + ".join(terms), *[" + ".join(t for j, t in enumerate(terms) if j != i) for i in range(len(terms))]]
    gaps = ", ".join(f"{s} AS d{i}" for i, s in enumerate(sums))
    widths = ", ".join(f"max(CASE WHEN own = label THEN d{i} * n / (n - 1) END) AS near{i}, min(CASE WHEN own <> label THEN d{i} END) AS far{i}" for i in range(len(sums)))
    means = ", ".join(f"avg((far{i} - near{i}) / greatest(far{i}, near{i})) AS s{i}" for i in range(len(sums)))
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, s0 AS base, s{i + 1} AS without FROM s" for i, c in enumerate(ALL_LINES))
    return f"""t AS (SELECT row_number() OVER () AS id, l_returnflag AS own, {", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(ALL_LINES))} FROM lineitem),
    g AS (SELECT l_returnflag AS label, count(*) AS n, {moments} FROM lineitem GROUP BY 1), p AS (SELECT t.id, t.own, g.label, g.n, {gaps} FROM t, g),
    w AS (SELECT id, {widths} FROM p GROUP BY id), s AS (SELECT {means} FROM w), drops AS ({rows})"""


@query(
    "g06_silhouette_drop_squared",
    f"WITH {_squared_drop_ctes()} SELECT feature, {r('base', 'base')}, {r('without', 'without')}, {r('base - without', 'importance')} FROM drops",
)
def g06_squared(spark, sf):
    return rounded(segments.silhouette_drop(table(spark, sf, "lineitem"), FLAG, ALL_LINES, LINE_ID))


@query(
    "g07_combined_importance_squared",
    f"""WITH {_squared_drop_ctes()}, joined AS (SELECT feature, f, base - without AS d FROM drops JOIN ({_anova_sql(ALL_LINES)}) USING (feature)),
    norm AS (SELECT *, (f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER ()) AS fa, (d - min(d) OVER ()) / (max(d) OVER () - min(d) OVER ()) AS da FROM joined)
    SELECT feature, {r('f', 'anova_score')}, {r('d', 'silhouette_score')}, {r('fa', 'anova_norm')}, {r('da', 'silhouette_norm', 4)}, {r('(fa + da) / 2', 'combined_importance', 4)} FROM norm""",
)
def g07_squared(spark, sf):
    scores = rounded(segments.combined_importance(table(spark, sf, "lineitem"), FLAG, ALL_LINES, LINE_ID).drop("anova_p_value"))
    return scores.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in ("silhouette_norm", "combined_importance")})


@query("g08_top_features", f"SELECT CAST(row_number() OVER (ORDER BY f DESC) AS INTEGER) AS rank, feature, {r('f', 'score')}, 'anova_f' AS rule FROM ({_anova_sql(LINES)}) ORDER BY f DESC LIMIT 2")
def g08(spark, sf):
    return rounded(segments.top_features(_lines(spark, sf), FLAG, 2))


@query("g09_cluster_centroids", "SELECT l_returnflag AS cluster, " + ", ".join(r(f"avg({c})", c) for c in LINES) + " FROM lineitem GROUP BY 1")
def g09(spark, sf):
    return rounded(segments.cluster_centroids(_lines(spark, sf), FLAG, LINES))


@query(
    "g10_cluster_scatter_sample",
    "SELECT vec_id, label AS cluster, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(3))
    + " FROM embeddings WHERE CAST('0x' || substr(md5('42|' || vec_id), 1, 7) AS BIGINT) < 0.2 * 268435456",
)
def g10(spark, sf):
    rows, _ = _vectors(spark, sf, 3)
    return segments.cluster_scatter_sample(rows, "label", ["e0", "e1", "e2"], {i: 0.2 for i in range(10)}, ["vec_id"])


@query(
    "g11_cluster_spend_summary",
    f"""WITH {FEATURES} SELECT c_mktsegment AS cluster, count(*) AS size, round(avg(c_acctbal), 4) + 0.0 AS mean_value,
    round(sum(coalesce(spend_open, 0) + coalesce(spend_final, 0)) / count(*), 4) + 0.0 AS mean_spend FROM features GROUP BY 1""",
)
def g11(spark, sf):
    return rounded(segments.cluster_spend_summary(customer_features(spark, sf), "c_mktsegment", "c_acctbal", "spend"), 4)


@query(
    "g12_cluster_mode",
    """SELECT cluster, arg_min(value, (-n, value)) AS mode, max(n) AS n FROM (SELECT o_orderstatus AS cluster, o_orderpriority AS value, count(*) AS n
    FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def g12(spark, sf):
    return segments.cluster_mode(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


# ---- whole runs

STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _order_gaps(spark, sf):
    price = F.when(F.col("o_orderkey") % 20 != 0, F.when(F.col("o_orderkey") % 333 == 1, F.col("o_totalprice") * 50).otherwise(F.col("o_totalprice")))
    return table(spark, sf, "orders").withColumn("o_totalprice", price)


def _prepared_sql():
    lo, hi = "(q1 - 1.5 * (q3 - q1))", "(q3 + 1.5 * (q3 - q1))"
    numbers = {
        "o_custkey": "o_custkey",
        "o_totalprice": "price",
        "o_orderdate_year": "year(o_orderdate)",
        "o_orderdate_month": "month(o_orderdate)",
        "o_orderdate_day": "day(o_orderdate)",
        "o_orderdate_dayofweek": "isodow(o_orderdate) - 1",
        "o_orderdate_is_weekend": "CAST(isodow(o_orderdate) >= 6 AS INTEGER)",
        "o_orderdate_is_month_start": "CAST(day(o_orderdate) = 1 AS INTEGER)",
        "o_orderdate_is_month_end": "CAST(CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS INTEGER)",
    }
    cells = ", ".join(f'round(({e} - avg({e}) OVER ()) / stddev_pop({e}) OVER (), 6) + 0.0 AS "{n}"' for n, e in numbers.items())
    flags = ", ".join(
        [f"o_orderstatus = '{s}' AS \"o_orderstatus_{s}\"" for s in STATUSES] + [f"o_orderpriority = '{p}' AS \"o_orderpriority_{p}\"" for p in PRIORITIES]
    )
    return f"""WITH g AS (SELECT * EXCLUDE (o_totalprice), CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 333 = 1 THEN o_totalprice * 50 ELSE o_totalprice END AS t FROM orders),
    f AS (SELECT *, coalesce(t, (SELECT quantile_cont(t, 0.5) FROM g)) AS t2 FROM g), q AS (SELECT quantile_cont(t2, 0.25) AS q1, quantile_cont(t2, 0.75) AS q3 FROM f),
    c AS (SELECT *, CASE WHEN t2 < {lo} THEN {lo} WHEN t2 > {hi} THEN {hi} ELSE t2 END AS price FROM f, q)
    SELECT o_orderkey, {cells}, {flags} FROM c"""


@query("x01_prepare_table", _prepared_sql())
def x01(spark, sf):
    prepared, _ = prepare.prepare_table(_order_gaps(spark, sf), ["o_orderkey"], outlier_method="iqr")
    return rounded(prepared.drop("o_orderdate"))


@query("x01_export_reports")
def x01_export(spark, sf):
    orders = _order_gaps(spark, sf)
    preparation = prepare.fit_preparation(orders, ["o_orderkey"], outlier_method="iqr")
    written = export.export_preparation(orders, preparation, scratch_path(spark, "prepared"))
    out = None
    for name, path in sorted(written.items()):
        part = spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).alias("rows")).withColumn("report", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("x02_segment_table")
def x02(spark, sf):
    prepared, preparation = prepare.prepare_table(table(spark, sf, "customer"), ["c_custkey"], outlier_method="iqr")
    found = segment.segment_table(
        prepared, ["c_custkey"], {"kmeans": {"n_clusters": [3, 4]}, "agglo": {"n_clusters": [3]}}, tune="kmeans",
        tune_trials=2, tune_space={"n_clusters": {"type": "int", "low": 2, "high": 5}, "n_init": {"type": "int", "low": 1, "high": 2}},
        preparation=preparation,
    )
    return found.search.table(spark)


@query("x02_export_reports")
def x02_export(spark, sf):
    rows = table(spark, sf, "customer")
    found = _small_run(spark, sf, rows)
    inputs = found.model.preparation.transform(rows)
    written = export.export_segmentation(found, inputs, scratch_path(spark, "run"))
    out = None
    for name, path in sorted(written.items()):
        if name == "model":
            continue
        part = spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).alias("rows")).withColumn("report", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def flagship(spark, sf):
    report = segment.segment_end_to_end(
        customer_features(spark, sf),
        ["c_custkey"],
        {"kmeans": {"n_clusters": [3, 4, 5]}, "gmm": {"n_components": [3], "covariance_type": ["tied"]}},
        mean_of="c_acctbal",
        spend_pattern="spend",
        mode_of="c_mktsegment",
    )
    return segment.segment_overview(report)


@query("x03_segment_end_to_end")
def x03(spark, sf):
    return flagship(spark, sf)


@query(
    "x04_step_audit",
    """WITH n AS (SELECT count(*) AS n FROM orders), m AS (SELECT count(*) AS m FROM orders WHERE o_orderkey % 20 = 0)
    SELECT CAST(column0 AS INTEGER) AS position, column1 AS step, n AS rows_before, n AS rows_after, CAST(column2 AS BIGINT) AS cols_before, CAST(column3 AS BIGINT) AS cols_after,
    CAST(0 AS BIGINT) AS nulls_after FROM (VALUES (1, 'missing', 6, 6), (2, 'outliers', 6, 6), (3, 'encode', 6, 12), (4, 'dates', 12, 19), (5, 'scale', 19, 19)) AS v(column0, column1, column2, column3), n""",
)
def x04(spark, sf):
    orders = _order_gaps(spark, sf)
    return prepare.step_audit(orders, prepare.fit_preparation(orders, ["o_orderkey"], outlier_method="iqr"))


@query(
    "x04_step_run",
    """WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 20 = 0) AS m FROM orders)
    SELECT CAST(column0 AS INTEGER) AS position, column1 AS step, n AS rows_before, n AS rows_after, CAST(column2 AS BIGINT) AS cols_before, CAST(column3 AS BIGINT) AS cols_after,
    CASE WHEN column0 = 1 THEN m ELSE 0 END AS nulls_before, CAST(0 AS BIGINT) AS nulls_after, column4 AS details
    FROM (VALUES (1, 'missing', 6, 6, 'o_totalprice:median'), (2, 'outliers', 6, 6, 'o_totalprice:cap'), (3, 'encode', 6, 12, 'o_orderpriority:onehot,o_orderstatus:onehot'), (4, 'dates', 12, 19, 'o_orderdate:parts'), (5, 'scale', 19, 19, 'o_custkey:standard,' || (SELECT string_agg('o_orderdate_' || p || ':standard', ',' ORDER BY p) FROM (VALUES ('year'), ('month'), ('day'), ('dayofweek'), ('is_weekend'), ('is_month_start'), ('is_month_end')) AS d(p)) || ',o_totalprice:standard')) AS v(column0, column1, column2, column3, column4), n""",
)
def x04_run(spark, sf):
    orders = _order_gaps(spark, sf)
    _, audit = prepare.run_steps(orders, prepare.fit_preparation(orders, ["o_orderkey"], outlier_method="iqr"))
    done = F.transform(F.array_sort(F.map_entries("details")), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return audit.withColumn("details", F.array_join(done, ",")).drop("seconds", "columns_treated")


@query("x05_save_load_model")
def x05(spark, sf):
    rows = table(spark, sf, "customer")
    found = _small_run(spark, sf, rows)
    path = scratch_path(spark, "model")
    store.save_model(found.model, found.best.metrics, path, spark)
    again = store.load_model(spark, path).predict(rows).select("c_custkey", F.col("prediction").alias("again"))
    both = found.labels().join(again, "c_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("prediction") == F.col("again"), 1)).alias("same")
    )
    card = store.model_card(spark, path).select("algorithm", "n_clusters", "silhouette", "verdict").first()
    return both.select("*", *[F.lit(card[c]).alias(c) for c in ("algorithm", "n_clusters", "silhouette", "verdict")])
