"""What the corpus operators share: column picking, Arrow batches, stored tables, word rules."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import ref
from tablelab.session import scratch_path

#: Rows that a Python step holds at a time, and the bytes of text beyond which it takes fewer.
CHUNK_ROWS = 512
CHUNK_CHARS = 4_000_000

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names: ``pick(df, id="doc_id")``.

    Columns are found by position, first by exact name and then without case,
    so further columns with clashing names do no harm. The first match counts.
    """
    names = df.columns
    lowered = [n.lower() for n in names]
    at = {}
    for new, old in columns.items():
        if old not in names and old.lower() not in lowered:
            raise ValueError(f"no column {old!r} among {names}")
        at[new] = names.index(old) if old in names else lowered.index(old.lower())
    placed = df.toDF(*[f"_{i}" for i in range(len(names))])
    return placed.select(*[F.col(f"_{i}").alias(new) for new, i in at.items()])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the frame as Parquet into the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read. The files lie under
    ``spark.checkpoint.dir`` and stay until the owner of that folder clears it,
    as lazy results read them.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches, bounded in rows and characters."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist() if text in batch.schema.names else [0] * batch.num_rows
        low = total = 0
        for i, size in enumerate(sizes):
            if i > low and (i - low >= CHUNK_ROWS or total + size > CHUNK_CHARS):
                yield batch.slice(low, i - low)
                low, total = i, 0
            total += size
        if low < batch.num_rows:
            yield batch.slice(low)


def mapped(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text") -> DataFrame:
    """``step`` over bounded slices of Arrow batches."""

    def run(batches):
        for part in chunks(batches, text):
            yield step(part)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts as Python strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def lowered_words(text: str) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space: the words ``[^\\x20\\x09-\\x0D]+`` as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split()


class HashCache(dict):
    """64-bit hash by word; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def starts_of(lengths: Iterable[int]) -> np.ndarray:
    return np.array([0, *accumulate(lengths)], np.int64)


def grouped(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal keys in a sorted stream; a run may span batches.

    The caller bounds the size of a run by its choice of keys.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            if held and keys[low] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = keys[low]
    if held:
        yield pa.Table.from_batches(held)


def row_uid(*columns: Column) -> Column:
    return F.xxhash64(*columns)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = ["HashCache", "chunks", "grouped", "lowered_words", "mapped", "pick", "ref", "row_uid", "starts_of", "stored", "table", "texts_of"]
