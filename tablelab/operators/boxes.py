"""Sums of Euclidean distances from every point to every cluster, without looking at every pair.

Points are cut into a tree of boxes. Two boxes far enough apart meet through
Chebyshev nodes: the distance is a smooth function there, and as many nodes are
taken per feature as its expansion needs for ``TOLERANCE`` of the distance. Near
boxes are split, and in the end pairs of points are taken one by one. All points
count, and the order of an expansion follows from its two boxes alone. Sums come
out as from all pairs but for rounding: they differ by some 1e-13 of themselves.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.session import materialise

#: Share of a distance that an expansion may miss, and the most nodes per feature that it may take.
TOLERANCE, ORDER = 1e-10, 14
TOO_MANY = 1_000_000
#: Points of the smallest boxes, by the number of features.
LEAF = {1: 64, 2: 256, 3: 1024}
MOST_FEATURES = max(LEAF)
#: Rows and columns of pairs held at once, small enough for a processor's cache.
TILE = (64, 512)
#: Share of the squares below which a difference of them has too few digits.
DIGITS = 1e-4
#: Boxes are far if between them lies such a share of the squared distance of their middles.
CLEAR = 0.01
#: A block of points is one row of the exchange: so many points, fewer with many clusters.
BLOCK_ROWS, BLOCK_DOUBLES, FEW_ROWS = 1 << 18, 1 << 21, 2048
BLOCKS, MOST_BLOCKS, PIECE_DOUBLES, SAMPLE = 32, 1024, 1 << 17, 1 << 16
CELL_TASKS = 400
MOST_LABELS = 64


def sorted_ranges(rows: int, leaf: int) -> np.ndarray:
    """Boxes as ranges of points in tree order: ``low, high, first child`` (-1 for none); the second child follows the first."""
    boxes, i = [[0, rows, -1]], 0
    while i < len(boxes):
        low, high, _ = boxes[i]
        if high - low > leaf:
            boxes[i][2] = len(boxes)
            middle = (low + high) // 2
            boxes += [[low, middle, -1], [middle, high, -1]]
        i += 1
    return np.array(boxes)


def tree_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the points in which :func:`sorted_ranges` cuts every box across its widest feature."""
    order = np.arange(len(x))
    for low, high, child in sorted_ranges(len(x), leaf):
        if child >= 0:
            part = x[order[low:high]]
            widest = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            order[low:high] = order[low:high][np.argpartition(part[:, widest], (low + high) // 2 - low)]
    return order


def pair_sums(a: np.ndarray, qa: np.ndarray, b: np.ndarray, qb: np.ndarray, far: bool, both: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Weighted sums of the distances of all pairs, per row of ``a`` and, if asked, per row of ``b``.

    The squares come from a matrix product about the middle. Where nearly all
    cancels out, too few digits are left: such pairs, which ``far`` points
    don't have, are taken by differences.
    """
    middle = (a.mean(axis=0) + b.mean(axis=0)) / 2
    a, b = a - middle, b - middle
    own, other = (a * a).sum(axis=1), (b * b).sum(axis=1)
    left = np.column_stack([-2 * a, own, np.ones(len(a))])
    right = np.ascontiguousarray(np.column_stack([b, np.ones(len(b)), other]).T)
    from_a = np.ascontiguousarray(qa.T) if both else None
    sums_a, sums_b = np.zeros((len(a), qb.shape[1])), np.zeros((qa.shape[1], len(b))) if both else None
    for i in range(0, len(a), TILE[0]):
        high = slice(i, i + TILE[0])
        for j in range(0, len(b), TILE[1]):
            wide = slice(j, j + TILE[1])
            gap = left[high] @ right[:, wide]
            if not far and not gap.min() >= DIGITS * (own[high].max() + other[wide].max()):
                close = gap < DIGITS * (own[high, None] + other[wide])
                if np.count_nonzero(close) > gap.size // 16:
                    gap = _squares(a[high], b[wide])
                else:
                    m, n = np.nonzero(close)
                    gap[m, n] = ((a[high][m] - b[wide][n]) ** 2).sum(axis=1)
            np.sqrt(gap, out=gap)
            sums_a[high] += gap @ qb[wide]
            if both:
                sums_b[:, wide] += from_a[:, high] @ gap
    return sums_a, sums_b.T if both else None


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T):
        part = np.subtract(x[:, None], y)
        part *= part
        total += part
    return total


@lru_cache(maxsize=None)
def unit_nodes(order: int) -> np.ndarray:
    return np.cos(np.pi * (np.arange(order) + 0.5) / order) if order > 1 else np.zeros(1)


@lru_cache(maxsize=None)
def _coefficients(order: int) -> np.ndarray:
    factors = np.full(order, 2.0 / order)
    factors[0] = 1.0 / order
    return factors[:, None] * _chebyshev(unit_nodes(order), order).T


def _chebyshev(u: np.ndarray, order: int) -> np.ndarray:
    out = np.ones((len(u), order))
    if order > 1:
        out[:, 1] = u
    for m in range(2, order):
        out[:, m] = 2 * u * out[:, m - 1] - out[:, m - 2]
    return out


def shares(u: np.ndarray, order: int) -> np.ndarray:
    """What each node of -1..1 gives to the interpolation at the places ``u``: ``(places, nodes)``."""
    return _chebyshev(np.clip(u, -1.0, 1.0), order) @ _coefficients(order)


@lru_cache(maxsize=None)
def _between(order: int, other: int) -> np.ndarray:
    return shares(unit_nodes(other), order)


def _apply(matrices: list, values: np.ndarray) -> np.ndarray:
    """Each matrix on its own axis; the last axis, clusters, stays."""
    for axis, matrix in enumerate(matrices):
        values = np.moveaxis(np.tensordot(matrix, values, axes=(1, axis)), 0, axis)
    return values


def needed_orders(gap: np.ndarray, half: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Nodes per feature that boxes of half widths ``half`` need towards boxes ``other`` at ``gap`` between the middles.

    As a function of one feature the distance is smooth up to the places where
    it would be zero. They span an ellipse around the box's interval, and the
    terms of the expansion fall by its size.
    """
    apart = np.maximum(np.abs(gap) - half - other, 0.0)
    along = np.maximum(np.abs(gap) - other, 0.0)
    aside = np.sqrt(np.maximum((apart * apart).sum(axis=-1, keepdims=True) - apart * apart, 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        long = (np.hypot(along + half, aside) + np.hypot(along - half, aside)) / (2 * half)
        orders = np.ceil(-np.log(TOLERANCE) / np.arccosh(np.maximum(long, 1.0)) / 2) * 2
    return np.where(half == 0, 1, np.where(orders <= ORDER, np.maximum(orders, 2), TOO_MANY)).astype(int)


class Box:
    """What far boxes see of one: nodes per feature, and weights and sums at the nodes, also for fewer nodes."""

    def __init__(self, centre: np.ndarray, half: np.ndarray, weights: np.ndarray):
        self.centre, self.half, self.weights = centre, half, weights
        self.sums = None
        self.fewer = {}

    def nodes(self, orders: tuple) -> np.ndarray:
        grids = np.meshgrid(*[c + h * unit_nodes(p) for c, h, p in zip(self.centre, self.half, orders)], indexing="ij")
        return np.column_stack([g.ravel() for g in grids])

    def view(self, orders: tuple) -> list:
        """``nodes, weights, sums`` of so many nodes; the sums are added to by the caller."""
        if orders not in self.fewer:
            weights = _apply([_between(p, full).T for p, full in zip(orders, self.weights.shape)], self.weights).reshape(-1, self.weights.shape[-1])
            self.fewer[orders] = [self.nodes(orders), np.ascontiguousarray(weights), np.zeros_like(weights)]
        return self.fewer[orders]

    def gather(self) -> np.ndarray | None:
        """Sums at all nodes."""
        for orders, (_, _, sums) in self.fewer.items():
            fine = _apply([_between(p, full) for p, full in zip(orders, self.weights.shape)], sums.reshape(*orders, -1))
            self.sums = fine if self.sums is None else self.sums + fine
        return self.sums


class Tree:
    """Points in tree order with their weights per cluster, their boxes, and the sums found so far."""

    def __init__(self, x: np.ndarray, weights: np.ndarray):
        self.x, self.weights, self.sums = x, weights, np.zeros_like(weights)
        self.dims = x.shape[1]
        self.low, self.high, self.child = sorted_ranges(len(x), LEAF[self.dims]).T
        least, most = np.empty((len(self.low), self.dims)), np.empty((len(self.low), self.dims))
        for i in range(len(self.low) - 1, -1, -1):
            c = self.child[i]
            part = x[self.low[i] : self.high[i]]
            least[i] = part.min(axis=0) if c < 0 else np.minimum(least[c], least[c + 1])
            most[i] = part.max(axis=0) if c < 0 else np.maximum(most[c], most[c + 1])
        self.centre, self.half = (least + most) / 2, (most - least) / 2
        self.size = self.high - self.low
        self.boxes = {}

    def _leaf_shares(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the nodes in each point of a box: all features but the last together, and the last."""
        part = self.x[self.low[i] : self.high[i]]
        half = np.where(self.half[i] == 0, 1.0, self.half[i])
        each = [shares((part[:, f] - self.centre[i, f]) / half[f], self._orders(i)[f]) for f in range(self.dims)]
        first = np.ones((len(part), 1))
        for one in each[:-1]:
            first = (first[:, :, None] * one[:, None, :]).reshape(len(part), -1)
        return first, each[-1]

    def _orders(self, i: int) -> tuple:
        return tuple(1 if h == 0 else ORDER for h in self.half[i])

    def _child_shares(self, i: int, c: int) -> list:
        """Shares of a box's nodes in the nodes of its child."""
        half = np.where(self.half[i] == 0, 1.0, self.half[i])
        orders, own = self._orders(i), self._orders(c)
        return [shares((self.centre[c, f] + self.half[c, f] * unit_nodes(own[f]) - self.centre[i, f]) / half[f], orders[f]) for f in range(self.dims)]

    def box(self, i: int) -> Box:
        if i not in self.boxes:
            k = self.weights.shape[1]
            if self.child[i] < 0:
                first, last = self._leaf_shares(i)
                q = self.weights[self.low[i] : self.high[i]]
                weights = first.T @ (last[:, :, None] * q[:, None, :]).reshape(len(q), -1)
            else:
                weights = sum(_apply([s.T for s in self._child_shares(i, c)], self.box(c).weights) for c in (self.child[i], self.child[i] + 1))
            self.boxes[i] = Box(self.centre[i], self.half[i], np.ascontiguousarray(weights).reshape(*self._orders(i), k))
        return self.boxes[i]

    def side(self, i: int, orders: np.ndarray) -> list:
        """``points, weights, sums`` that stand for a box: its nodes, or its points where they are fewer."""
        if np.prod(orders) < self.size[i]:
            return self.box(i).view(tuple(int(p) for p in orders))
        part = slice(self.low[i], self.high[i])
        return [self.x[part], self.weights[part], self.sums[part]]

    def finish(self) -> np.ndarray:
        """Sums of every point, with those of all boxes that it lies in."""
        for i in range(len(self.low)):
            box = self.boxes.get(i)
            sums = box.gather() if box else None
            if sums is None:
                continue
            if self.child[i] < 0:
                first, last = self._leaf_shares(i)
                k = self.weights.shape[1]
                found = (first @ sums.reshape(first.shape[1], -1)).reshape(len(first), -1, k)
                self.sums[self.low[i] : self.high[i]] += (found * last[:, :, None]).sum(axis=1)
            else:
                for c in (self.child[i], self.child[i] + 1):
                    below = self.box(c)
                    found = _apply(self._child_shares(i, c), sums)
                    below.sums = found if below.sums is None else below.sums + found
            self.boxes[i].fewer, self.boxes[i].sums = {}, None
        return self.sums


def meet(a: Tree, b: Tree) -> None:
    """Add what two trees, or one tree with itself, give to each other's sums."""
    same = a is b
    i, j = np.zeros(1, dtype=int), np.zeros(1, dtype=int)
    while len(i):
        gap = a.centre[i] - b.centre[j]
        to_a, to_b = needed_orders(gap, a.half[i], b.half[j]), needed_orders(gap, b.half[j], a.half[i])
        # Points need no smoothness: the smallest boxes can always be taken by their points.
        end_a, end_b = a.child[i] < 0, b.child[j] < 0
        fits_a, fits_b = (to_a <= ORDER).all(axis=1), (to_b <= ORDER).all(axis=1)
        between = np.maximum(np.abs(gap) - a.half[i] - b.half[j], 0.0)
        clear = fits_a & fits_b & (np.einsum("ij,ij->i", between, between) > CLEAR * np.einsum("ij,ij->i", gap, gap))
        itself = (i == j) if same else np.zeros(len(i), dtype=bool)
        done = (fits_a | end_a) & (fits_b | end_b) & ~(itself & ~end_a)
        for n in np.nonzero(done)[0]:
            if itself[n]:
                part = slice(a.low[i[n]], a.high[i[n]])
                a.sums[part] += pair_sums(a.x[part], a.weights[part], a.x[part], a.weights[part], False, both=False)[0]
                continue
            xa, qa, sums_a = a.side(i[n], to_a[n])
            xb, qb, sums_b = b.side(j[n], to_b[n])
            found_a, found_b = pair_sums(xa, qa, xb, qb, bool(clear[n]))
            sums_a += found_a
            sums_b += found_b
        rest = ~done
        size_a, size_b = (a.half[i] ** 2).sum(axis=1), (b.half[j] ** 2).sum(axis=1)
        cut_a = rest & ~itself & ~end_a & (end_b | fits_b & ~fits_a | (fits_a == fits_b) & (size_a >= size_b))
        cut_b = rest & ~itself & ~cut_a
        cut_both = rest & itself
        ca, cb, cc = a.child[i[cut_a]], b.child[j[cut_b]], a.child[i[cut_both]]
        i, j = (
            np.concatenate([ca, ca + 1, i[cut_b], i[cut_b], cc, cc, cc + 1]),
            np.concatenate([j[cut_a], j[cut_a], cb, cb + 1, cc, cc + 1, cc + 1]),
        )


def meet_far(a: Tree, box: Box) -> None:
    """Add to a tree's sums what a box far from all of it gives."""
    gap = a.centre[0] - box.centre
    to_a, to_b = needed_orders(gap, a.half[0], box.half), needed_orders(gap, box.half, a.half[0])
    xa, qa, sums = a.side(0, to_a)
    xb, qb, _ = box.view(tuple(int(p) for p in to_b))
    sums += pair_sums(xa, qa, xb, qb, False, both=False)[0]


class Cuts:
    """Where space is cut into blocks: a tree of thresholds, each at about the middle of the sample there."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        #: Points are stored from here on, so that numbers far from zero keep their digits.
        self.origin = np.median(sample, axis=0) if len(sample) else np.zeros(sample.shape[1])
        self.feature, self.value = np.zeros(2**depth, dtype=int), np.full(2**depth, np.inf)
        parts = [sample]
        for i in range(2**depth - 1):
            part = parts[i]
            if len(part):
                f = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                found = np.unique(part[:, f])
                if len(found) > 1:
                    self.feature[i], self.value[i] = f, min(np.sort(part[:, f])[(len(part) - 1) // 2], found[-2])
            right = part[:, self.feature[i]] > self.value[i]
            parts += [part[~right], part[right]]

    def block(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=int)
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[np.arange(len(x)), self.feature[at]] > self.value[at])
        return at - (2**self.depth - 1)


def _cuts(merged: DataFrame, cells: Sequence[str], rows: int, labels: int) -> Cuts:
    """Blocks of about equal numbers of distinct points. The sample only says where to cut; no sum depends on it."""
    share = max(1, rows // SAMPLE)
    drawn = merged.where(F.pmod(F.xxhash64(*cells), F.lit(share)) == 0).select(*cells).distinct().collect()
    sample = np.array([tuple(r) for r in drawn], dtype=float).reshape(-1, len(cells))
    points = len(sample) * share
    wanted = max(points / min(BLOCK_ROWS, max(1, BLOCK_DOUBLES // labels)), min(BLOCKS, points / FEW_ROWS), 1)
    return Cuts(sample, math.ceil(math.log2(min(wanted, MOST_BLOCKS))))


def _spread(c: np.ndarray, w: np.ndarray, labels: int) -> np.ndarray:
    out = np.zeros((len(c), labels))
    out[np.arange(len(c)), c] = w
    return out


def mean_silhouette(merged: DataFrame, cells: Sequence[str], sizes: np.ndarray, rows: int) -> float:
    """Mean Euclidean silhouette over all rows, from distinct points ``cells..., c, w`` and the sizes of the clusters.

    ``rows`` is about their number, for the size of the sample that says where to cut.

    Space is cut into blocks of near points. Each block is packed into one row
    with what far blocks see of it; every block meets itself and each block
    near to it in a cell of its own, and the far ones by their nodes. Sums per
    point leave a cell, never pairs.
    """
    k, dims, leaf = len(sizes), len(cells), LEAF[len(cells)]
    cuts = _cuts(merged, cells, rows, k)
    names = list(cells)

    def place(batches):
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in names]) if batch.num_rows else np.zeros((0, dims))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cuts.block(x).astype(np.int32))], names=[*batch.schema.names, "block"])

    def pack(found: pd.DataFrame) -> pd.DataFrame:
        x = found[names].to_numpy(dtype=float) - cuts.origin
        order = tree_order(x, leaf)
        c, w = found["c"].to_numpy(dtype=np.int32)[order], found["w"].to_numpy(dtype=float)[order]
        box = Tree(x[order], _spread(c, w, k)).box(0)
        packed = [a.tobytes() for a in (x[order], c, w, box.centre, box.half, box.weights)]
        return pd.DataFrame([[int(found["block"].iloc[0]), *packed]], columns=["block", "x", "c", "w", "centre", "half", "weights"])

    blocks = 2**cuts.depth
    kinds = ", ".join(f"{f} double" for f in names)
    placed = merged.select(*names, "c", "w").mapInArrow(place, f"{kinds}, c int, w bigint, block int")
    packed = materialise(
        placed.repartition(blocks, "block")
        .groupBy("block")
        .applyInPandas(pack, "block int, x binary, c binary, w binary, centre binary, half binary, weights binary")
    )
    seen = {}
    for r in packed.select("block", "centre", "half", "weights").collect():
        half = np.frombuffer(r["half"])
        orders = [1 if h == 0 else ORDER for h in half]
        seen[r["block"]] = (np.frombuffer(r["centre"]), half, np.frombuffer(r["weights"]).reshape(*orders, k))
    if not seen:
        return math.nan
    near, far = _neighbours(seen)
    edges = [(a, a * blocks + a) for a in seen] + [(b, p[0] * blocks + p[1]) for p in near for b in p]

    def cell_sums(found: pd.DataFrame) -> pd.DataFrame:
        trees = []
        for r in found.itertuples():
            c, w = np.frombuffer(r.c, dtype=np.int32), np.frombuffer(r.w)
            trees.append((r.block, Tree(np.frombuffer(r.x).reshape(-1, dims), _spread(c, w, k)), r))
        meet(trees[0][1], trees[-1][1])
        if len(trees) == 1:
            for b in far[trees[0][0]]:
                meet_far(trees[0][1], Box(*seen[b]))
        out, step = [], max(1, PIECE_DOUBLES // k)
        for block, tree, r in trees:
            sums = tree.finish()
            for i in range(0, len(sums), step):
                # The block's own cell carries clusters and weights along.
                own = [r.c[4 * i : 4 * (i + step)], r.w[8 * i : 8 * (i + step)]] if len(trees) == 1 else [None, None]
                out.append([block, i // step, sums[i : i + step].tobytes(), *own])
        return pd.DataFrame(out, columns=["block", "piece", "sums", "c", "w"])

    def widths(found: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(s).reshape(-1, k) for s in found["sums"])
        own = found[found["c"].notna()].iloc[0]
        c, w = np.frombuffer(own["c"], dtype=np.int32), np.frombuffer(own["w"])
        at, size = np.arange(len(c)), sizes[c]
        near_by = sums[at, c] / np.maximum(size - 1, 1)
        others = sums / sizes
        others[at, c] = np.inf
        away = others.min(axis=1)
        widest = np.maximum(near_by, away)
        flat = (size == 1) | (widest == 0)
        return pd.DataFrame({"total": [float((w * np.where(flat, 0.0, (away - near_by) / np.where(flat, 1.0, widest))).sum())], "rows": [float(w.sum())]})

    table = merged.sparkSession.createDataFrame(edges, "block int, cell bigint")
    parts = (
        packed.select("block", "x", "c", "w")
        .join(F.broadcast(table), "block")
        .repartition(min(CELL_TASKS, len(seen) + len(near)), "cell")
        .groupBy("cell")
        .applyInPandas(cell_sums, "block int, piece int, sums binary, c binary, w binary")
    )
    totals = parts.repartition(blocks, "block", "piece").groupBy("block", "piece").applyInPandas(widths, "total double, rows double")
    return float(totals.agg(F.sum("total") / F.sum("rows")).first()[0])


def _neighbours(seen: dict) -> tuple[list[tuple[int, int]], dict[int, list[int]]]:
    """Pairs of blocks that must meet point by point, and the far blocks of each."""
    names = sorted(seen)
    centre, half = np.stack([seen[b][0] for b in names]), np.stack([seen[b][1] for b in names])
    near, far = [], {}
    for i, a in enumerate(names):
        gap = centre[i] - centre
        fits = (needed_orders(gap, half[i], half) <= ORDER).all(axis=1) & (needed_orders(gap, half, half[i]) <= ORDER).all(axis=1)
        far[a] = [b for j, b in enumerate(names) if j != i and fits[j]]
        near += [(a, b) for j, b in enumerate(names) if j > i and not fits[j]]
    return near, far
