"""K-means from many starts at once: every round is one Spark job for all starts.

Equal points are merged into one with a weight first (:func:`merge_points`), which
changes no sum. A task turns its points into sums per centre; only these reach
the driver. Draws hash the coordinates, so they don't depend on the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import ref
from tablelab.session import materialise

#: Column of a merged frame: the number of rows that are this point.
WEIGHT = "__weight"
#: Points that are compared with all centres together, and doubles in a packed row.
ROWS, BLOCK_DOUBLES = 4096, 1024
#: Of these, points whose distances to all centres are held at once, small enough for a processor's cache.
TILE = 1024
#: Points of a task that are merged before they are dealt out, and partitions they are dealt to at first; adaptive execution joins small ones.
HELD, DEALT = 1 << 18, 2048
#: Rows up to which shuffle partitions hold the distinct points, whatever their number.
FEW_ROWS = 4_000_000
#: Rounds of k-means||, and points each adds per cluster.
STEPS, OVERSAMPLING = 2, 2
#: Rounds on the few candidates of a start, as in Spark's estimator.
LOCAL_ROUNDS = 30


def merge_points(df: DataFrame, vector: str) -> DataFrame:
    """One row per distinct vector and :data:`WEIGHT`, the number of its rows; written once. A merged frame stays as it is.

    In larger frames tasks merge what they hold before it is dealt out, so
    that many copies of a point don't meet in one task; distinct points go to
    many small partitions, whatever the number of shuffle partitions.
    """
    if WEIGHT in df.columns:
        return df
    points = df.select(vector_to_array(ref(vector)).alias("point"))
    few = df.count() <= FEW_ROWS
    counted = points.groupBy("point").agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)) if few else _dealt(points)
    return materialise(counted.select(array_to_vector("point").alias(vector), WEIGHT), [vector])


def merge_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct set of values of these double columns and :data:`WEIGHT`, the number of its rows; for many rows, scanned and written once."""
    counted = materialise(_dealt(df.select(F.array(*[ref(c) for c in columns]).alias("point"))), ["point"])
    return counted.select(*[F.get("point", F.lit(i)).alias(c) for i, c in enumerate(columns)], WEIGHT)


def merge_again(weighted: DataFrame, vector: str) -> DataFrame:
    """A merged frame as :func:`merge_points` makes it, of one that may hold a vector several times."""
    counted = _dealt(weighted.select(vector_to_array(ref(vector)).alias("point"), F.col(WEIGHT).alias("weight")))
    return materialise(counted.select(array_to_vector("point").alias(vector), WEIGHT), [vector])


def _dealt(points: DataFrame) -> DataFrame:
    """Each distinct ``point`` and the number of its rows, or the sum of ``weight`` where there is one; not written yet."""
    weighted = "weight" in points.columns

    def held(batches):
        x, w = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) + 0.0
            more_w = batch.column("weight").to_numpy(zero_copy_only=False) if weighted else np.ones(len(more))
            x = more if x is None else np.vstack([x, more])
            w = more_w if w is None else np.append(w, more_w)
            if len(x) >= HELD:
                x, w = _merged(x, w)
                if len(x) >= HELD // 2:
                    yield _weighted(x, w)
                    x, w = None, None
        if x is not None:
            yield _weighted(*_merged(x, w))

    return points.mapInArrow(held, "point array<double>, weight double").hint("rebalance", DEALT, F.col("point")).groupBy("point").agg(F.sum("weight").alias(WEIGHT))


def _merged(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal points as one, with the sum of their weights; points whose hashes agree by chance stay apart."""
    _, first, own = np.unique(_hashes(x), return_index=True, return_inverse=True)
    apart = (x[first[own]].view(np.uint64) != np.ascontiguousarray(x).view(np.uint64)).any(axis=1)
    sums = np.bincount(own, np.where(apart, 0.0, w), len(first))
    return np.vstack([x[first], x[apart]]), np.append(sums, w[apart])


def _weighted(x: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
    cells = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
    return pa.RecordBatch.from_arrays([cells, pa.array(w)], names=["point", "weight"])


def as_blocks(merged: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Merged points as rows of packed doubles, weight first, which loops read without conversion; and their dimensions."""
    some = merged.select(vector_to_array(ref(vector)).alias("point")).first()
    if some is None:
        raise ValueError("no rows to cluster")
    dims = len(some["point"])
    rows = max(1, BLOCK_DOUBLES // (dims + 1))

    def pack(batches):
        for batch in batches:
            x = batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            flat = np.column_stack([batch.column(WEIGHT).to_numpy(zero_copy_only=False), x])
            yield pa.RecordBatch.from_pydict({"block": [flat[i : i + rows].tobytes() for i in range(0, len(flat), rows)]})

    arrays = merged.select(vector_to_array(ref(vector)).alias("point"), WEIGHT)
    return materialise(arrays.mapInArrow(pack, "block binary")), dims


def blocks(batches, dims: int):
    """Points and weights of packed rows, a bounded number at a time."""
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column("block").to_pylist())).reshape(-1, dims + 1)
        for start in range(0, len(flat), ROWS):
            part = flat[start : start + ROWS]
            yield np.ascontiguousarray(part[:, 1:]), np.ascontiguousarray(part[:, 0])


def task_sums(blocks_: DataFrame, partial, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of the arrays that ``partial`` makes of each task's blocks: one row per task, added in their order."""

    def one(batches):
        yield pa.RecordBatch.from_pydict({"sums": [partial(batches).tobytes()]})

    total = np.zeros(shape)
    for r in blocks_.mapInArrow(one, "sums binary").collect():
        total += np.frombuffer(r["sums"]).reshape(shape)
    return total


@dataclass
class Sums:
    """Of one start: weight and mean offset sums by centre, and the squared distances to the nearest one (0 if left out)."""

    n: np.ndarray
    x: np.ndarray
    cost: float


def centre_sums(points: DataFrame, sets: Sequence[np.ndarray]) -> list[Sums]:
    """For each set of centres what its nearest points add up to, without their cost: one job for all sets."""
    return _nearest_sums(points, sets, False)


def costed_sums(points: DataFrame, sets: Sequence[np.ndarray]) -> list[Sums]:
    return _nearest_sums(points, sets, True)


def _nearest_sums(points: DataFrame, sets: Sequence[np.ndarray], cost: bool) -> list[Sums]:
    dims = sets[0].shape[1]
    bounds = np.cumsum([0, *[len(c) for c in sets]])
    every = np.vstack(sets)
    origin = every.mean(axis=0)
    moved = every - origin
    minus, squares = -2 * moved, (moved**2).sum(axis=1)[:, None]

    def partial(batches):
        total = np.zeros((len(every), dims + 2))
        for all_x, all_w in blocks(batches, dims):
            for at in range(0, len(all_x), TILE):
                x, w = np.ascontiguousarray((all_x[at : at + TILE] - origin).T), all_w[at : at + TILE]
                gaps = minus @ x
                gaps += squares
                nearest = np.empty_like(gaps)
                for low, high in zip(bounds, bounds[1:]):
                    own = gaps[low:high] == gaps[low:high].min(axis=0)
                    if np.count_nonzero(own) > len(w):  # equally near centres: the first one
                        own &= own.cumsum(axis=0) == 1
                    nearest[low:high] = own
                    if cost:
                        apart = ((x - moved[low + own.argmax(axis=0)].T) ** 2).sum(axis=0)
                        total[low:high, 1] += own @ (w * apart)
                total[:, [0, *range(2, dims + 2)]] += nearest @ np.vstack([w, w * x]).T
        return total

    table = task_sums(points, partial, (len(every), dims + 2))
    out = []
    for low, high in zip(bounds, bounds[1:]):
        n = table[low:high, 0]
        out.append(Sums(n, table[low:high, 2:] + n[:, None] * origin, float(table[low:high, 1].sum())))
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers (splitmix64)."""
    h = h + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(x: np.ndarray) -> np.ndarray:
    h = np.zeros(len(x), np.uint64)
    for column in x.T:
        h = _mix(h ^ np.ascontiguousarray(column).view(np.uint64))
    return h


def draw_points(points: DataFrame, dims: int, need: int, seeds: Sequence[int], sets: Sequence[np.ndarray] | None = None) -> list[np.ndarray]:
    """For each seed ``need`` distinct points, with a probability by weight, or by weight times squared distance to the seed's set.

    Drawn without replacement: the points of least -log(u) / weight, where u
    comes from a hash of seed and coordinates.
    """

    def partial(batches):
        best = [(np.zeros(0), np.zeros((0, dims))) for _ in seeds]
        for x, w in blocks(batches, dims):
            h = _hashes(x)
            for i, seed in enumerate(seeds):
                u = ((_mix(h ^ _mix(np.array([seed], np.uint64))) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
                share = w if sets is None else w * ((x[:, None] - sets[i][None]) ** 2).sum(axis=2).min(axis=1)
                found = share > 0
                keys = np.append(best[i][0], -np.log(u[found]) / share[found])
                kept = np.vstack([best[i][1], x[found]])
                least = np.argsort(keys, kind="stable")[:need]
                best[i] = keys[least], kept[least]
        start = np.repeat(np.arange(len(seeds)), [len(k) for k, _ in best])
        keys, kept = np.concatenate([k for k, _ in best]), np.vstack([p for _, p in best])
        yield pa.RecordBatch.from_arrays([pa.array(start, pa.int32()), pa.array(keys), pa.array(list(kept), pa.list_(pa.float64()))], names=["start", "key", "point"])

    drawn = points.mapInArrow(partial, "start int, key double, point array<double>")
    first = F.slice(F.sort_array(F.collect_list(F.struct("key", "point"))), 1, need)
    out = [np.zeros((0, dims)) for _ in seeds]
    for r in drawn.groupBy("start").agg(first.alias("first")).collect():
        out[r["start"]] = np.array([p["point"] for p in r["first"]])
    return out


def _among_candidates(found: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ and a few rounds over the weighted candidates of a start."""
    if len(found) <= k:
        return found
    rng = np.random.default_rng(seed)
    weight = np.maximum(weight, 1e-12)
    centres = found[[rng.choice(len(found), p=weight / weight.sum())]]
    while len(centres) < k:
        share = weight * ((found[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        if not share.sum() > 0:
            break
        centres = np.vstack([centres, found[rng.choice(len(found), p=share / share.sum())]])
    for _ in range(LOCAL_ROUNDS):
        own = ((found[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        n = np.bincount(own, weight, len(centres))
        sums = np.column_stack([np.bincount(own, weight * c, len(centres)) for c in found.T])
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1e-300)[:, None], centres)
    return centres


def start_centres(points: DataFrame, dims: int, k: int, seeds: Sequence[int], init: str) -> list[np.ndarray]:
    """First centres of each seed: ``random`` points, or by ``k-means||``, in one job per round for all seeds."""
    if init == "random":
        return draw_points(points, dims, k, seeds)
    sets = draw_points(points, dims, 1, seeds)
    for step in range(1, STEPS + 1):
        more = draw_points(points, dims, OVERSAMPLING * k, [s + 1_000_003 * step for s in seeds], sets)
        sets = [np.vstack(pair) for pair in zip(sets, more)]
    return [_among_candidates(c, s.n, k, seed) for c, s, seed in zip(sets, centre_sums(points, sets), seeds)]


def best_centres(merged: DataFrame, vector: str, k: int, seeds: Sequence[int], init: str, max_iter: int, tol: float) -> tuple[np.ndarray, Sums]:
    """Centres and sums of the start of least cost, the first one on ties.

    A start ends when no centre moves by more than ``tol``; a centre without
    points stays where it is.
    """
    points, dims = as_blocks(merged, vector)
    sets = start_centres(points, dims, k, seeds, init)
    moving = list(range(len(sets)))
    for _ in range(max_iter):
        sums = centre_sums(points, [sets[i] for i in moving])
        still = []
        for i, s in zip(moving, sums):
            new = np.where(s.n[:, None] > 0, s.x / np.maximum(s.n, 1)[:, None], sets[i])
            if (((new - sets[i]) ** 2).sum(axis=1) > tol * tol).any():
                still.append(i)
            sets[i] = new
        moving = still
        if not moving:
            break
    last = costed_sums(points, sets)
    best = min(range(len(sets)), key=lambda i: last[i].cost)
    return sets[best], last[best]
