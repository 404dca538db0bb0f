"""Packing of token streams: concatenate all documents, cut into windows of fixed size.

Two passes. The first tokenises and stores, per task, each document's ids and
the number of ids before it in that task; stored files freeze this order. The
second adds up the tasks' totals into offsets over the whole stream and cuts
every document where a window of ``size`` ids ends. Only one number per task
is summed across tasks; ids never cross the network.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tablelab.llm.common import LOWER, chunks, pick, stored, texts_of

# Spark's tasks are the threads; this is read when a worker first encodes.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SIZE = 2048
END_ID = 1
#: Tasks whose totals one window sums; two levels of sums serve BLOCK * BLOCK tasks.
BLOCK = 1024

# Small Latin letters that normalisation keeps, and ASCII signs but the apostrophe, which starts words such as 's.
_SMALL = "a-z\u00df-\u00f6\u00f8-\u024f"
_PLAIN = re.compile(f"[{_SMALL}!-&(-@\\[-`{{-~]+")
_RUN = re.compile(f"[{_SMALL}]+|[^{_SMALL}]+")
_ASCII_SIGNS = frozenset(chr(c) for c in range(128) if not chr(c).isalpha())


def _byte_signs() -> list[str]:
    """The sign that stands for each byte: itself if it can be seen, else one from U+0100 on, in order."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(hidden)) for b in range(256)]


_BYTE_SIGNS = _byte_signs()
_loaded: dict[str, ChunkIds] = {}


class ChunkIds:
    """Ids of texts as bytes, by way of their pieces without space or line feed.

    The tokenizer lower-cases, drops white space and merges only within words,
    so the ids of a text are those of its pieces in order, and most pieces
    occur again and again. Pieces not seen yet are cut into runs of letters and
    of other signs, which are words of their own, and runs of small Latin
    letters go straight to the tokenizer's model. Pieces and runs are held
    in two generations of ``limit``: when the young one is full it becomes the
    old one, so what occurs often stays. A text that may name a special token
    is encoded as it is.
    """

    def __init__(self, path: str, limit: int = 500_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.limit = limit
        self.held: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _recall(self, wanted: set[str]) -> set[str]:
        """Those of the pieces that are not known; older ones become young again."""
        new = wanted.difference(self.held)
        again = new.intersection(self.old)
        self.held.update(zip(again, map(self.old.__getitem__, again)))
        return new.difference(again)

    def _learn(self, pieces: set[str]) -> None:
        letters: set[str] = set()
        rest: set[str] = set()
        cut: list[tuple[str, list[str]]] = []
        for piece in self._recall(pieces):
            if piece.isascii() and piece.isalpha():
                letters.add(piece)
            elif _PLAIN.fullmatch(piece) and piece.lower() == piece:
                runs = _RUN.findall(piece)
                cut.append((piece, runs))
                for run in runs:
                    (letters if run[0] not in _ASCII_SIGNS else rest).add(run)
            else:  # a word may reach over the border of letters
                rest.add(piece)
        if cut:
            letters, rest = self._recall(letters), self._recall(rest)
        held, tokenize, kind = self.held, self.model.tokenize, self.kind.char
        for run in letters:
            # What the normaliser leaves as it is goes to the model as signs for bytes.
            word = run if run.isascii() else "".join([_BYTE_SIGNS[b] for b in run.encode()])
            held[run] = array(kind, [t.id for t in tokenize(word)]).tobytes()
        whole = list(rest)
        for run, found in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
            held[run] = array(kind, found.ids).tobytes()
        for piece, runs in cut:
            held[piece] = b"".join([held[r] for r in runs])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.held) > self.limit:
            self.old, self.held = self.held, {}
        gc.disable()  # lists of pieces come and go, none refers to itself
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [None if "<|" in t else t.encode("utf-8").translate(LOWER).decode("utf-8").replace("\n", " ").split(" ") for t in texts]
        self._learn(set().union(*[x for x in split if x]))
        held = self.held.__getitem__
        return [self._bytes(self.tokenizer.encode(t, add_special_tokens=False).ids) if x is None else b"".join(map(held, x)) for t, x in zip(texts, split)]


def _tokenizer(path: str) -> ChunkIds:
    if path not in _loaded:
        _loaded[path] = ChunkIds(path)
    return _loaded[path]


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each document with ``end_id`` at the end: doc_id, part, before, n, ids, width (bytes an id)."""
    rows = pick(docs, doc_id=doc_id, text=text)
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("part", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def encode(batches):
        ids_of = _tokenizer(tokenizer_path)
        kind, part, before = ids_of.kind, TaskContext.get().partitionId(), 0
        end = np.array([end_id], kind).tobytes()
        for batch in chunks(batches):
            ids = [x + end for x in ids_of.encode(texts_of(batch))]
            counts = np.array([len(x) // kind.itemsize for x in ids], np.int64)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            same = len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(same, part, np.int32)), pa.array(starts), pa.array(counts),
                 pa.array(np.full(same, kind.itemsize, np.int32)), pa.array(ids, pa.binary())],
                names=schema.names,
            )

    return rows.mapInArrow(encode, schema)


def part_offsets(tokens: DataFrame) -> DataFrame:
    """part, base: ids in all earlier parts. Sums in blocks of parts, then over the blocks."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total")).withColumn("block", F.floor(F.col("part") / BLOCK))
    blocks = totals.groupBy("block").agg(F.sum("total").alias("block_total"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("block_total").over(earlier), F.lit(0)).alias("block_base"))
    within = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.select("block", "part", F.coalesce(F.sum("total").over(within), F.lit(0)).alias("inside"))
    return placed.join(blocks, "block").select("part", (F.col("inside") + F.col("block_base")).alias("base"))


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` on request.

    A null or empty text is a document of the end id alone. Rows that share a
    doc_id, also with one text, are packed each for itself. An empty table
    gives no pieces. All sequences but the last are full. The order of the
    documents follows the order in which the table is read.
    """
    tokens = stored(tokenised(docs, tokenizer_path, end_id, doc_id, text), "tokens")
    # One row of two numbers per task of the first pass, stored so that Spark knows its size: broadcast when small, else shuffled.
    placed = tokens.join(stored(part_offsets(tokens), "offsets"), "part")
    schema = T.StructType(
        [
            T.StructField("doc_id", tokens.schema["doc_id"].dataType),
            *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")],
            *([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []),
        ]
    )

    def cut(batches):
        for batch in chunks(batches, "ids"):
            at, columns = [], [[] for _ in schema.names[1:]]
            for i, (before, base, n, width, raw) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("before", "base", "n", "width", "ids")])):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                place, start = base + before, 0
                while start < n:
                    offset = (place + start) % size
                    length = min(size - offset, n - start)
                    piece = ids[start : start + length]
                    row = (start, length, zlib.crc32(piece.tobytes()), n, (place + start) // size, offset)
                    for column, value in zip(columns, row if not with_ids else (*row, piece.tolist())):
                        column.append(value)
                    at.append(i)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64()))]
                + [pa.array(x, pa.list_(pa.int64()) if name == "ids" else pa.int64()) for name, x in zip(schema.names[1:], columns)],
                names=schema.names,
            )

    return placed.select("doc_id", "before", "base", "n", "width", "ids").mapInArrow(cut, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and its ids in order, from pieces with ids; a sequence has ``size`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
