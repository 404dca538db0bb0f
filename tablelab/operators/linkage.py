"""Exact single linkage: the minimum spanning tree of all distinct points, cut at its longest edges.

Single linkage to ``k`` groups is the minimum spanning tree without its
``k - 1`` longest edges. The tree grows in rounds: each component takes its
shortest edge to another one, and components tied by edges merge, so that
their number at least halves. Points lie in blocks of bounded size that are
close together; a pair of blocks is compared only where the space between
them leaves room for an edge shorter than those known already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.functions.columns import ref
from tablelab.session import scratch_path

#: Points of a block on average, blocks of a table. The work is quadratic where blocks are close together; the
#: driver holds one centre per block.
BLOCK = 1024
MOST_BLOCKS = 16_384
DISTANCES = ("euclidean", "l2", "l1", "manhattan", "cosine")

# An edge is ordered by length, then by its points: a total order, in which shortest edges never close a circle.
EDGE = "comp long, d double, lo long, hi long, other long"


def _stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: rounds start from files, with a plan that does not grow."""
    path = scratch_path(df.sparkSession, "linkage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _gaps(x: np.ndarray, y: np.ndarray, city: bool) -> np.ndarray:
    """All distances of two blocks, added up column by column, so that both directions agree in every bit."""
    out = np.zeros((len(x), len(y)))
    for i in range(x.shape[1]):
        step = x[:, i, None] - y[None, :, i]
        out += np.abs(step) if city else step * step
    return out if city else np.sqrt(out)


def _nearest(one: pd.DataFrame, two: pd.DataFrame, city: bool) -> pd.DataFrame:
    """Per component of ``one``: its first edge to a point of another component in ``two``."""
    one, two = one.sort_values("pid"), two.sort_values("pid")
    gap = _gaps(np.stack(one["x"]), np.stack(two["x"]), city)
    here, there = one["comp"].to_numpy(), two["comp"].to_numpy()
    gap[here[:, None] == there[None]] = np.inf
    # Of equally near points the first one gives the first edge, whichever end it is.
    place = gap.argmin(axis=1)
    a, b = one["pid"].to_numpy(), two["pid"].to_numpy()[place]
    found = pd.DataFrame({"comp": here, "d": gap[np.arange(len(a)), place], "lo": np.minimum(a, b), "hi": np.maximum(a, b), "other": there[place]})
    return found[np.isfinite(found["d"])].sort_values(["d", "lo", "hi"]).drop_duplicates("comp")


def _first_edges(edges: DataFrame) -> DataFrame:
    first = edges.groupBy("comp").agg(F.min(F.struct("d", "lo", "hi", "other")).alias("e"))
    return first.select("comp", "e.d", "e.lo", "e.hi", "e.other")


def _roots(first: DataFrame) -> DataFrame:
    """comp, root: components tied by their first edges, pointers doubled until all show to the end.

    Two components that chose each other are the only circle; the lesser one is the root.
    """
    back = first.select(F.col("comp").alias("other"), F.col("other").alias("back"))
    chosen = first.select("comp", "other").join(back, "other", "left")
    mutual = (F.col("back") == F.col("comp")) & (F.col("comp") < F.col("other"))
    roots = _stored(chosen.select("comp", F.when(mutual, F.col("comp")).otherwise(F.col("other")).alias("root")))
    while True:
        up = roots.select(F.col("comp").alias("root"), F.col("root").alias("above"))
        roots = _stored(roots.join(up, "root", "left").select("comp", F.coalesce("above", "root").alias("root"), (F.col("above") != F.col("root")).alias("moved")))
        if roots.where("moved").isEmpty():
            return roots.select("comp", "root")
        roots = roots.select("comp", "root")


def _relabel(rows: DataFrame, roots: DataFrame, column: str = "comp") -> DataFrame:
    to = roots.select(F.col("comp").alias(column), F.col("root").alias("__root"))
    kept = [c for c in rows.columns if c != column]
    return rows.join(to, column, "left").select(*kept, F.coalesce("__root", column).alias(column))


def forest_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """pid, comp: components of ``nodes`` (pid) tied by the edges (lo, hi, d) of a forest, in a logarithmic number of rounds."""
    labels = nodes.select("pid", F.col("pid").alias("comp"))
    left = edges.select("lo", "hi", "d", F.col("lo").alias("a"), F.col("hi").alias("b"))
    while not left.isEmpty():
        ends = left.select(F.col("a").alias("comp"), "d", "lo", "hi", F.col("b").alias("other"))
        ends = ends.unionByName(left.select(F.col("b").alias("comp"), "d", "lo", "hi", F.col("a").alias("other")))
        roots = _roots(_first_edges(ends))
        labels = _stored(_relabel(labels, roots))
        left = _stored(_relabel(_relabel(left, roots, "a"), roots, "b").where("a <> b"))
    return labels


def _blocks(points: DataFrame, n: int, size: int, seed: int) -> DataFrame:
    """points (pid, x) with the number of a block: clusters of near points, crowded ones cut by hash."""
    wanted = -(-n // size)
    if wanted == 1:
        return points.withColumn("block", F.lit(0))
    model = KMeans(k=wanted, maxIter=5, seed=seed, featuresCol="__v", predictionCol="cell").fit(points.select(array_to_vector("x").alias("__v")))
    celled = _stored(model.transform(points.withColumn("__v", array_to_vector("x"))).drop("__v"))
    cells = {r["cell"]: -(-r["count"] // size) for r in celled.groupBy("cell").count().collect()}
    first = dict(zip(sorted(cells), np.cumsum([0, *[cells[c] for c in sorted(cells)]]).tolist()))
    at = F.element_at(F.create_map(*[F.lit(v) for c in first for v in (c, first[c])]), F.col("cell"))
    many = F.element_at(F.create_map(*[F.lit(v) for c in cells for v in (c, cells[c])]), F.col("cell"))
    return celled.withColumn("block", (at + F.pmod(F.xxhash64("pid"), many)).cast("int")).drop("cell")


def _numbered(points: DataFrame) -> DataFrame:
    """Each point's number is a hash of its value, the same in any attempt; where two points agree in it, another hash is taken."""
    seed = 0
    while True:
        numbered = points.withColumn("pid", F.xxhash64(F.lit(seed), "x").bitwiseAND(F.lit((1 << 63) - 1)))
        if numbered.groupBy("pid").agg(F.count(F.lit(1)).alias("same")).where("same > 1").isEmpty():
            return numbered
        seed += 1


def spanning_tree(points: DataFrame, *, distance: str = "euclidean", block: int = BLOCK, seed: int = 42) -> DataFrame:
    """lo, hi, d: the edges of the minimum spanning tree of ``points`` (pid long of 0 or more, x array of doubles), each point once.

    Equal lengths go to the lesser points, so the tree is the same for any
    blocks and partitions. No edge for one point or none. More than
    ``MOST_BLOCKS * block`` points are an error.
    """
    n = points.count()
    if n > MOST_BLOCKS * block:
        raise ValueError(f"{n} distinct points are more than {MOST_BLOCKS} blocks of {block}; use larger blocks or micro-clusters")
    city = distance in ("l1", "manhattan")
    spark = points.sparkSession
    state = _stored(_blocks(points, n, block, seed).withColumn("comp", F.col("pid")))

    def shape(part: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(part["x"])
        middle = x.mean(axis=0)
        return pd.DataFrame({"block": [int(part["block"].iloc[0])], "middle": [middle.tolist()], "radius": [float(_gaps(x, middle[None], city).max())]})

    shapes = {r["block"]: r for r in state.groupBy("block").applyInPandas(shape, "block int, middle array<double>, radius double").collect()}
    numbers = sorted(shapes)
    middles, radii = np.array([shapes[b]["middle"] for b in numbers]), np.array([shapes[b]["radius"] for b in numbers])

    def inside(part: pd.DataFrame) -> pd.DataFrame:
        return _nearest(part, part, city)

    def across(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([_nearest(one, two, city), _nearest(two, one, city)])

    tree = spark.createDataFrame([], "lo long, hi long, d double")
    groups = n
    while groups > 1:
        near = _stored(state.groupBy("block").applyInPandas(inside, EDGE))
        # Blocks within one component know no edge of their own; the next block with another component bounds it.
        sole = {r["block"]: r["lo"] if r["lo"] == r["hi"] else None for r in state.groupBy("block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).collect()}
        owner = np.array([-1 if sole[b] is None else sole[b] for b in numbers])
        bounds = []
        for i in np.flatnonzero(owner >= 0):
            foreign = owner != owner[i]
            if foreign.any():
                far = _gaps(middles[i][None], middles[foreign], city)[0] + radii[i] + radii[foreign]
                bounds.append((int(owner[i]), float(far.min())))
        known = near.select("comp", "d").unionByName(spark.createDataFrame(bounds, "comp long, d double"))
        known = known.groupBy("comp").agg(F.min("d").alias("d"))
        held = state.select("block", "comp").distinct().join(known, "comp", "left")
        reach_of = {r["block"]: r["d"] for r in held.groupBy("block").agg(F.max(F.coalesce("d", F.lit(float("inf")))).alias("d")).collect()}
        reach = np.array([reach_of[b] for b in numbers])

        def meeting(batches: Iterator[pd.DataFrame], owner=owner, reach=reach) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for i in batch["id"]:
                    room = _gaps(middles[i][None], middles, city)[0] - radii[i] - radii
                    # A hair of slack for the rounding of centres and radii.
                    slack = 1e-9 * (radii[i] + radii + np.abs(middles[i]).sum() + np.abs(middles).sum(axis=1))
                    meet = (room <= np.maximum(reach[i], reach) + slack) & ((owner < 0) | (owner != owner[i]))
                    for j in np.flatnonzero(meet):
                        if j > i:
                            yield pd.DataFrame({"one": [numbers[i]], "two": [numbers[j]]})

        edges = near
        if len(numbers) > 1:
            pairs = _stored(spark.range(len(numbers)).repartition("id").mapInPandas(meeting, "one int, two int"))
            sides = []
            for side in ("one", "two"):
                members = state.select(F.col("block").alias(side), "pid", "comp", "x")
                # Columns under new identities: the two sides stem from one table.
                sides.append(pairs.join(members, side).select(*[F.col(c).alias(c) for c in ("one", "two", "pid", "comp", "x")]).groupBy("one", "two"))
            met = sides[0].cogroup(sides[1]).applyInPandas(across, EDGE)
            edges = near.unionByName(met)
        first = _stored(_first_edges(edges))
        tree = _stored(tree.unionByName(first.select("lo", "hi", "d").distinct()))
        state = _stored(_relabel(state, _roots(first)))
        groups = state.select("comp").distinct().count()
    return tree


@dataclass
class SingleLinkage:
    """Group number of each distinct fitted point; ``transform`` joins rows by point."""

    points: DataFrame
    tree: DataFrame
    vector: str
    distance: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``__raw``; a point that was not fitted gets null, as single linkage has no rule for it."""
        keyed = df.withColumn("__point", _direction(vector_to_array(ref(self.vector)), self.distance))
        return keyed.join(self.points.select(F.col("x").alias("__point"), F.col("raw").alias("__raw")), "__point", "left").drop("__point")


def _direction(x, distance: str):
    """For cosine the unit vector: its Euclidean distance orders pairs as the cosine does."""
    if distance != "cosine":
        return F.transform(x, lambda v: v + 0.0)
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v))
    return F.transform(x, lambda v: v / norm + 0.0)


def link_points(
    df: DataFrame, k: int, *, distance: str = "euclidean", block: int = BLOCK, seed: int = 42, vector: str = "features"
) -> tuple[SingleLinkage, list[int], np.ndarray]:
    """The fitted groups, their sizes in rows and their mean points.

    Copies of a point are one node and never part. A null vector, a missing
    component or (cosine) a row of zeros is an error. With at most ``k``
    distinct points each is its own group. Equally long edges are cut in the
    order of their points' numbers, which depend on the values alone.
    """
    if distance not in DISTANCES:
        raise ValueError(f"unknown distance {distance!r}, expected one of {DISTANCES}")
    if k < 1:
        raise ValueError("the number of groups must be 1 or more")
    x = vector_to_array(ref(vector))
    bad = ref(vector).isNull() | F.exists(x, lambda v: F.isnan(v) | v.isNull())
    if distance == "cosine":
        bad = bad | ~F.exists(x, lambda v: v != 0)
    if not df.where(bad).isEmpty():
        raise ValueError("single linkage needs whole vectors" + (" that are not all zero" if distance == "cosine" else ""))
    counted = df.select(_direction(x, distance).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    points = _numbered(_stored(counted))
    if points.isEmpty():
        raise ValueError("single linkage needs at least one row")
    tree = spanning_tree(points.select("pid", "x"), distance=distance, block=block, seed=seed)
    cut = tree.orderBy(F.desc("d"), F.desc("lo"), F.desc("hi")).limit(k - 1)
    labels = forest_components(points, tree.join(cut.select("lo", "hi"), ["lo", "hi"], "left_anti"))
    named = _stored(points.join(labels, "pid"))
    width = len(points.first()["x"])
    sums = [F.sum(F.get("x", F.lit(i)) * F.col("n")).alias(f"s{i}") for i in range(width)]
    found = named.groupBy("comp").agg(F.sum("n").alias("size"), *sums).orderBy("comp").collect()
    number = {r["comp"]: i for i, r in enumerate(found)}
    raw = F.element_at(F.create_map(*[F.lit(v) for c, i in number.items() for v in (c, i)]), F.col("comp"))
    middles = np.array([[r[f"s{i}"] / r["size"] for i in range(width)] for r in found])
    return SingleLinkage(named.select("x", "n", raw.alias("raw")), tree, vector, distance), [r["size"] for r in found], middles
