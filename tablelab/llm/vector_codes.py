"""Product codes of vectors: a codebook for each of sixteen parts, found by exact integer rounds.

Nearest entries are found with fixed pivots (LAESA). A part's distances to a
few pivots are computed once and stored with it. In a round, the distances of
the pivots to all entries give, by the triangle inequality, a lower bound of
the distance of a part to each entry: the largest difference of two distances
to one pivot. Entries are tried in order of their bounds, and a part is done
when the next bound lies above its best exact distance. Distances are exact
integers; the bounds are lowered by more than their rounding.

A round is one pass over stored rows. A task returns a sum and a count for
each entry, so that the driver sees the codebooks alone: 64 times the length
of a vector.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.llm.common import pick, stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
PIVOTS = 4
#: Largest integer component; squares of differences over a part stay exact.
LARGEST = 1 << 29
#: Rows that a step works on at a time.
ROWS = 2048
#: Share of a distance that a bound in single precision may be off by, with room.
SLACK = 2.0**-20


def is_whole(vector: Column) -> Column:
    """The vector is there, and so are all its components, all finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The integer vectors of a batch, all of one length."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) and int(np.abs(flat).max()) > LARGEST:
        raise ValueError(f"components beyond {LARGEST // 256} in size can't be coded exactly")
    return flat.reshape(batch.num_rows, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows that stand opposite each other."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def choose_pivots(codebooks: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """By part: ``n`` entries far from each other, the first one and then always the farthest of the rest."""
    parts, entries, _ = codebooks.shape
    chosen = np.zeros((parts, min(n, entries)), np.int64)
    for j, book in enumerate(codebooks):
        near = squared(book, book[0])
        for k in range(1, chosen.shape[1]):
            chosen[j, k] = int(near.argmax())
            near = np.minimum(near, squared(book, book[chosen[j, k]]))
    return codebooks[np.arange(parts)[:, None], chosen]


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """rows x parts x pivots, single precision."""
    cut = vectors.reshape(len(vectors), len(pivots), 1, -1)
    return np.sqrt(squared(cut, pivots[None]).astype(np.float64)).astype(np.float32)


def nearest(parts: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and exact squared distance of the nearest entry of one codebook, ties to the lower index.

    Also the number of exact distances that were computed.
    """
    between = np.sqrt(squared(book[:, None], pivots[None]).astype(np.float64))
    apart = np.abs(to_pivots[:, None, :].astype(np.float64) - between[None])
    bounds = (apart - SLACK * (to_pivots[:, None, :] + between[None] + 1)).max(axis=2)
    order = np.argsort(bounds, axis=1, kind="stable")
    bounds = np.take_along_axis(bounds, order, axis=1)
    best = order[:, 0].copy()
    least = squared(parts, book[best])
    tried, open_rows = len(parts), np.arange(len(parts))
    for k in range(1, len(book)):
        bound = bounds[open_rows, k]
        # In doubles: the bound has room for the rounding of the root.
        open_rows = open_rows[(bound <= 0) | (bound <= np.sqrt(least[open_rows].astype(np.float64)))]
        if not len(open_rows):
            break
        entry = order[open_rows, k]
        found = squared(parts[open_rows], book[entry])
        tried += len(open_rows)
        better = (found < least[open_rows]) | ((found == least[open_rows]) & (entry < best[open_rows]))
        at = open_rows[better]
        best[at], least[at] = entry[better], found[better]
    return best, least, tried


def assign(vectors: np.ndarray, to_pivots: np.ndarray, codebooks: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """rows x parts: indexes of the nearest entries, exact squared distances."""
    cut = vectors.reshape(len(vectors), len(codebooks), -1)
    found = [nearest(cut[:, j], to_pivots[:, j], codebooks[j], pivots[j]) for j in range(len(codebooks))]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _slices(batches, width: int, pivots: np.ndarray):
    """(batch, vectors, distances to the pivots) in bounded slices."""
    shape = (-1, *pivots.shape[:2])
    rows = max(1, min(ROWS, (1 << 20) // width))
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            yield part, _rows(part, width), np.frombuffer(b"".join(part.column("d").to_pylist()), "<f4").reshape(shape)


def _sums(kept: DataFrame, codebooks: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """part, entry, at (component), n, total: what a round's replacement needs; one row per entry and component."""
    width = codebooks.shape[0] * codebooks.shape[2]

    def add(batches):
        totals, counts = np.zeros(codebooks.shape, np.int64), np.zeros(codebooks.shape[:2], np.int64)
        for _, vectors, to_pivots in _slices(batches, width, pivots):
            found, _ = assign(vectors, to_pivots, codebooks, pivots)
            for j in range(len(codebooks)):
                np.add.at(totals[j], found[:, j], vectors.reshape(len(vectors), len(codebooks), -1)[:, j])
                counts[j] += np.bincount(found[:, j], minlength=codebooks.shape[1])
        part, entry, at = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, codebooks.shape))
        columns = [part.astype(np.int32), entry.astype(np.int32), at.astype(np.int32), counts[part, entry], totals[part, entry, at]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "at", "n", "total"])

    sums = kept.select("v", "d").mapInArrow(add, "part int, entry int, at int, n long, total long")
    return sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def replaced(codebooks: np.ndarray, sums: list) -> np.ndarray:
    """Codebooks whose used entries are the floors of their parts' means."""
    out = codebooks.copy()
    for part, entry, at, n, total in sums:
        out[part, entry, at] = int(total) // int(n)
    return out


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def fit(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, np.ndarray | None, np.ndarray | None, int]:
    """Stored rows (vec_id, label, v, d), codebooks, pivots and the vectors' length.

    The length is the most frequent one among whole vectors (ties: the larger
    one) and must be a multiple of ``parts``. Codebooks are None without rows.
    """
    whole = pick(rows, vec_id=vec_id, vector=vector, label=label).where(is_whole(F.col("vector")))
    usual = whole.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    width = usual["size"] if usual else 0
    whole = whole.select("vec_id", "label", integers(F.col("vector")).alias("v"))
    if not width:
        return whole, None, None, 0
    if width % parts:
        raise ValueError(f"vectors of {width} components don't fall into {parts} equal parts")
    fits = whole.where(F.size("v") == width)
    first = fits.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    codebooks = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    if int(np.abs(codebooks).max()) > LARGEST:
        raise ValueError(f"components beyond {LARGEST // 256} in size can't be coded exactly")
    pivots = choose_pivots(codebooks)
    schema = T.StructType([*whole.schema.fields, T.StructField("d", T.BinaryType())])

    def measure(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                same = np.array([n == width for n in part.column("v").value_lengths().to_pylist()], bool)
                out: list[bytes | None] = [None] * part.num_rows
                fitting = part.filter(pa.array(same))
                for i, d in zip(np.flatnonzero(same).tolist(), pivot_distances(_rows(fitting, width), pivots)):
                    out[i] = d.tobytes()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=schema.names)

    kept = stored(whole.mapInArrow(measure, schema), "vectors")
    for _ in range(rounds):
        # One row per entry and component: 64 times the length of a vector.
        codebooks = replaced(codebooks, _sums(kept.where("d IS NOT NULL"), codebooks, pivots).collect())
    return kept, codebooks, pivots, width


def encode(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per kept row: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds a null or non-finite component are
    dropped. Rows that repeat an id are rows of their own; a null id stands
    behind all others when the first codebooks are taken, ties go by the
    vector. With fewer rows than entries the codebooks have fewer. A vector of
    another length than the usual one keeps its row, with null code and error.
    An empty table gives no rows.
    """
    kept, codebooks, pivots, width = fit(rows, parts, entries, rounds, vec_id, vector, label)
    schema = T.StructType([*[f for f in kept.schema.fields if f.name in ("vec_id", "label")], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if codebooks is None:
        coded = kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        sha = F.lit(digest(np.zeros(0, np.int64)))
    else:
        sha = F.lit(digest(codebooks))

        def write(batches):
            for batch, vectors, to_pivots in _slices(batches, width, pivots):
                found, error = assign(vectors, to_pivots, codebooks, pivots)
                codes = [r.tobytes().hex() for r in found.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error.sum(axis=1))], names=schema.names)

        coded = kept.where("d IS NOT NULL").mapInArrow(write, schema)
        coded = stored(coded.unionByName(kept.where("d IS NULL").select("vec_id", "label"), allowMissingColumns=True), "codes")
    # One row per label, stored so that Spark knows its size: broadcast when small, else a join that splits large labels.
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    by_label = by_label if codebooks is None else stored(by_label, "label-errors")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", sha.alias("codebooks_sha256"))
