"""Exact single linkage against brute force over all pairs."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablelab.operators import cluster
from tablelab.operators.hierarchy import merge_centres, pair_distances
from tablelab.operators.linkage import spanning_tree


def frame(spark, x, parts=3):
    rows = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, point array<double>")
    return rows.repartition(parts).withColumn("features", array_to_vector("point"))


def groups_of(labelled):
    out = {}
    for r in labelled.select("id", "prediction").collect():
        out.setdefault(r["prediction"], set()).add(r["id"])
    return sorted(map(sorted, out.values()))


def brute_tree(x, distance):
    gap = pair_distances(x, distance)
    rest, total, nearest = set(range(1, len(x))), [], gap[0].copy()
    while rest:
        at = min(rest, key=lambda i: nearest[i])
        total.append(nearest[at])
        rest.discard(at)
        nearest = np.minimum(nearest, gap[at])
    return sorted(total)


@pytest.mark.parametrize("distance", ["euclidean", "manhattan", "cosine"])
def test_equals_brute_force_over_many_blocks(spark, distance):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, s, (90, 3)) for m, s in ((0.5, 1), (6, 0.5), (12, 2))])
    model = cluster.fit_single_linkage(frame(spark, x), 6, distance=distance, block=40)
    brute = merge_centres(x, np.ones(len(x)), 6, "single", distance)
    assert groups_of(model.transform(frame(spark, x))) == sorted(np.flatnonzero(brute == g).tolist() for g in range(6))
    assert sum(model.relabel) == 15
    if distance != "cosine":
        lengths = sorted(r["d"] for r in model.model.tree.collect())
        assert np.allclose(lengths, brute_tree(x, distance))


def test_tree_of_ties_does_not_depend_on_blocks(spark):
    grid = spark.range(144).select(F.col("id").alias("pid"), F.array((F.col("id") % 12).cast("double"), F.floor(F.col("id") / 12).cast("double")).alias("x"))
    trees = [{tuple(r) for r in spanning_tree(grid.repartition(p), block=b).select("lo", "hi", "d").collect()} for b, p in ((16, 2), (200, 5))]
    assert trees[0] == trees[1] and len(trees[0]) == 143 and {e[2] for e in trees[0]} == {1.0}


def test_copies_small_tables_and_bad_rows(spark):
    x = [[0.0, 0.0]] * 400 + [[-0.0, 0.0], [9.0, 9.0], [9.0, 9.5]]
    model = cluster.fit_single_linkage(frame(spark, x), 2)
    rows = model.transform(frame(spark, [*x, [1.0, 1.0]])).groupBy("prediction").count().collect()
    assert {r["prediction"]: r["count"] for r in rows} == {0: 401, 1: 2, None: 1}
    assert len(set(model.relabel)) == 2
    few = cluster.fit_single_linkage(frame(spark, x), 10)
    assert len(few.relabel) == 3
    one = cluster.fit_single_linkage(frame(spark, [[1.0], [1.0]]), 1)
    assert one.transform(frame(spark, [[1.0]])).first()["prediction"] == 0
    for bad, distance in (([[1.0], [float("nan")]], "euclidean"), ([[0.0]], "cosine"), ([], "euclidean")):
        with pytest.raises(ValueError):
            cluster.fit_single_linkage(frame(spark, bad), 2, distance=distance)
