"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors of whole numbers are laid out in cells (ranges of documents), each cut
into blocks with the largest and least value per term: the forward index. A
query's bound for a block is the sum over terms of the largest product the
block allows. First each query meets its own cell, its blocks in order of
bound, until bounds fall below its k-th score. With that k-th score as floor
it then meets every other cell; blocks whose bound is below the floor, or
below the k-th score reached so far, are not scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelab.llm.common import pick, stored

K = 5
#: Vectors of a cell at most (one row of the index) and of a block.
CELL, BLOCK = 16_384, 256
#: Leading terms whose signs order the vectors, so that a block's values are alike.
SIGN_TERMS = 12
EXACT = float(1 << 53)

INDEX = "cell long, dim int, ids binary, kind string, data binary"
PACKS = "cell long, home long, dim int, at binary, ids binary, kind string, data binary, floor binary"
FOUND = "home long, at int, query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and whole-number vectors of the rows that take part."""
    rows = pick(vectors, vec_id=vec_id, embedding=embedding).where("vec_id IS NOT NULL AND size(embedding) > 0")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return rows.where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _sign_code() -> Column:
    bits = F.transform(F.slice("v", 1, SIGN_TERMS), lambda x: F.when(x >= 0, 1).otherwise(0))
    return F.aggregate(bits, F.lit(0), lambda a, b: a * 2 + b)


def _packed(values: np.ndarray) -> tuple[str, bytes]:
    for kind in ("<i2", "<i4", "<i8"):
        if not values.size or np.abs(values.astype(np.float64)).max() < float(1 << (8 * int(kind[2]) - 1)):
            return kind, values.astype(kind).tobytes()
    return "<i8", values.tobytes()


def _cells(batches):
    """Index rows from a sorted stream of vectors of one partition."""
    held: dict[int, list] = {}
    made = 0
    part = TaskContext.get().partitionId()

    def row(dim: int, rows: list) -> pa.RecordBatch:
        nonlocal made
        kind, data = _packed(np.array([v for _, v in rows], np.int64).reshape(-1, dim))
        made += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + made], pa.int64()), pa.array([dim], pa.int32()), pa.array([np.array([i for i, _ in rows], "<i8").tobytes()]), pa.array([kind]), pa.array([data])],
            names=["cell", "dim", "ids", "kind", "data"],
        )

    for batch in batches:
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
            own = held.setdefault(len(v), [])
            own.append((i, v))
            if len(own) == CELL:
                yield row(len(v), held.pop(len(v)))
    for dim, rows in held.items():
        yield row(dim, rows)


def index(rows: DataFrame) -> DataFrame:
    """One stored row per cell, vectors with like signs of their first terms side by side."""
    ordered = rows.withColumn("code", _sign_code()).repartitionByRange(F.size("v"), "code", "vec_id").sortWithinPartitions(F.size("v"), "code", "vec_id")
    return stored(ordered.select("vec_id", "v").mapInArrow(_cells, INDEX), "index")


class Cell:
    """The blocks of one index row."""

    def __init__(self, cell: int, dim: int, ids: bytes, kind: str, data: bytes):
        self.cell, self.dim = cell, dim
        self.ids = np.frombuffer(ids, "<i8")
        self.v = np.frombuffer(data, kind).reshape(-1, dim).astype(np.int64)
        self.starts = list(range(0, len(self.ids), BLOCK))
        self.high = np.maximum.reduceat(self.v, self.starts, axis=0)
        self.low = np.minimum.reduceat(self.v, self.starts, axis=0)

    def block(self, b: int) -> slice:
        return slice(self.starts[b], min(self.starts[b] + BLOCK, len(self.ids)))


def product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers: by floating point where that is exact, else by Python's integers, cut to 64 bits."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(v.astype(np.float64)).max(initial=0)) * q.shape[1]
    if most < EXACT:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    full = q.astype(object) @ v.astype(object).T
    return np.clip(full, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def bounds(q: np.ndarray, cell: Cell) -> np.ndarray:
    """Largest score (queries x blocks) that the blocks' term maxima allow; infinite where it can't be told exactly."""
    reach = max(float(np.abs(cell.high.astype(np.float64)).max(initial=0)), float(np.abs(cell.low.astype(np.float64)).max(initial=0)))
    if float(np.abs(q.astype(np.float64)).max(initial=0)) * reach * q.shape[1] >= EXACT:
        return np.full((len(q), len(cell.starts)), np.inf)
    x = q.astype(np.float64)
    return np.maximum(x, 0) @ cell.high.astype(np.float64).T + np.minimum(x, 0) @ cell.low.astype(np.float64).T


class Best:
    """The k best (score, smaller id first) of each query so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.score = np.full((queries, 0), 0, np.int64)
        self.rows: list[list[tuple[int, int]]] = [[] for _ in range(queries)]

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, skip: np.ndarray) -> None:
        """``skip``: position in ``ids`` that a query must not take, or -1."""
        for row, q in enumerate(at):
            good = scores[row] >= self.floor[q]
            if skip[row] >= 0:
                good[skip[row]] = False
            found = np.flatnonzero(good)
            if not len(found):
                continue
            if len(found) > self.k:  # the best k of the block, ties to smaller ids
                found = found[np.lexsort((ids[found], -scores[row][found]))[: self.k]]
            own = self.rows[q] + list(zip((-scores[row][found]).tolist(), ids[found].tolist()))
            own.sort()
            self.rows[q] = own[: self.k]
            if len(own) >= self.k:
                self.floor[q] = max(self.floor[q], -own[self.k - 1][0])


def _search(cell: Cell, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> Best:
    """``own``: each query's position in the cell, or -1. Blocks by summed bound, each scored for the queries it can still serve."""
    best = Best(len(q), k, floor.copy())
    bound = bounds(q, cell)
    order = np.argsort(-np.where(np.isfinite(bound), bound, 0).sum(0), kind="stable")
    if (own >= 0).any():  # at home the floor is still open: each query's best block first
        first = np.where(own >= 0, bound.argmax(1), -1)
        for b in np.unique(first[first >= 0]):
            _score(cell, q, own, best, b, np.flatnonzero(first == b))
            bound[first == b, b] = -np.inf
    for b in order.tolist():
        open_ = np.flatnonzero(bound[:, b] >= best.floor)
        if len(open_):
            _score(cell, q, own, best, b, open_)
    return best


def _score(cell: Cell, q: np.ndarray, own: np.ndarray, best: Best, b: int, at: np.ndarray) -> None:
    part = cell.block(b)
    skip = np.where((own[at] >= part.start) & (own[at] < part.stop), own[at] - part.start, -1)
    scores = product(q[at], cell.v[part])
    hit = (scores >= best.floor[at][:, None]).any(1)
    best.add(at[hit], scores[hit], cell.ids[part], skip[hit])


def _home(every: int, k: int):
    """One pack per cell: its queries with their k-th score inside the cell."""

    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                cell = Cell(**x)
                at = np.flatnonzero(cell.ids % every == 0)
                if not len(at):
                    continue
                best = _search(cell, cell.v[at], at, np.full(len(at), -np.inf), k)
                kind, data = _packed(cell.v[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell.cell], pa.int64()), pa.array([cell.dim], pa.int32()), pa.array([at.astype("<i4").tobytes()]), pa.array([cell.ids[at].tobytes()]), pa.array([kind]), pa.array([data]), pa.array([best.floor.astype("<f8").tobytes()])],
                    names=["home", "dim", "at", "ids", "kind", "data", "floor"],
                )

    return run


def _away(k: int):
    """Scores of the packs that follow their cell in a stream sorted by cell, the cell's own row first."""

    def run(batches):
        cell = None
        for batch in batches:
            for x in batch.to_pylist():
                if x["at"] is None:
                    cell = Cell(x["cell"], x["dim"], x["ids"], x["kind"], x["data"])
                    continue
                q = np.frombuffer(x["data"], x["kind"]).reshape(-1, x["dim"]).astype(np.int64)
                at, ids = np.frombuffer(x["at"], "<i4"), np.frombuffer(x["ids"], "<i8")
                own = at.astype(np.int64) if x["home"] == cell.cell else np.full(len(at), -1)
                best = _search(cell, q, own, np.frombuffer(x["floor"], "<f8"), k)
                out = [(x["home"], int(a), int(i), v, -s) for a, i, rows in zip(at, ids, best.rows) for s, v in rows]
                if out:
                    home, a, i, v, s = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(home, pa.int64()), pa.array(a, pa.int32()), pa.array(i, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())], names=["home", "at", "query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = K, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per query and rank: query_id, rank (from 1), vec_id, score.

    Queries are rows whose vec_id is divisible by ``every``; candidates all
    rows but the query's own. Components become floor(scale * x); the score is
    their inner product, ties go to the smaller vec_id. Rows with a null id or
    a null, empty or non-finite vector take no part; vectors of different
    lengths don't meet. Rows that repeat an id are queries and candidates each.
    Fewer than k candidates: all of them.

    Query packs meet cells in a grid: each pack is sent to each cell of its
    dimension, a stated query set against all rows in blocks.
    """
    cells = index(quantised(vectors, scale, vec_id, embedding))
    packs = stored(cells.mapInArrow(_home(every, k), PACKS.replace("cell long, ", "")), "packs")
    names = [c.split()[0] for c in PACKS.split(", ")]
    sent = packs.join(cells.select("cell", "dim"), "dim").select(*names)
    own = cells.select("cell", F.lit(0).cast("long").alias("home"), "dim", F.lit(None).cast("binary").alias("at"), "ids", "kind", "data", F.lit(None).cast("binary").alias("floor"))
    grid = own.unionByName(sent).withColumn("later", F.col("at").isNotNull()).repartition("cell").sortWithinPartitions("cell", "later").drop("later")
    found = grid.mapInArrow(_away(k), FOUND)
    order = Window.partitionBy("home", "at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
