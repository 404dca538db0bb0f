"""Benchmark decontamination with one Aho-Corasick automaton over the words of test items.

Test questions and answers are lower-cased and cut into words; every window of
``width`` consecutive words is a pattern over word numbers. Each document is
scanned once; hits are word positions, mapped back to code points of the
original text where asked for.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.llm.common import mapped, pick, row_uid, stored, texts_of

WIDTH = 10
#: Bytes of benchmark text in one automaton. More text is cut into shards, each scanned for itself.
SHARD_BYTES = 4_000_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_KEPT = {*range(48, 58), *range(97, 123), *range(128, 256)}
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256))

_built: dict[str, tuple] = {}


def words_of(text: str) -> list[bytes]:
    """A-Z in lower case; words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Start and end in code points of each of the words of :func:`words_of`."""
    low = text.translate({c: c + 32 for c in range(65, 91)})
    return [m.span() for m in WORD.finditer(low)]


def build(items: list[tuple], width: int = WIDTH) -> tuple:
    """(automaton or None, numbers of words) from (item_id, text) pairs."""
    numbers: dict[bytes, int] = {}
    owners: dict[tuple, set] = defaultdict(set)
    for item, text in items:
        found = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text or "")]
        for i in range(max(1, len(found) - width + 1) if found else 0):
            owners[tuple(found[i : i + width])].add(item)
    if not owners:
        return None, numbers
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, own in owners.items():
        automaton.add_word(window, (len(window), tuple(str(x) for x in own if x is not None)))
    automaton.make_automaton()
    return automaton, numbers


def scan(text: str, automaton, numbers: dict) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of the text, hit runs of word positions (end exclusive, disjoint, in order) and items found."""
    words = words_of(text)
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    if words and automaton is not None:
        found = [(end + 1 - value[0], end + 1, value[1]) for end, value in automaton.iter(tuple(map(numbers.get, words, repeat(0))))]
        for _, _, own in found:
            items.update(own)
        runs = merged([x[:2] for x in found])
    return len(words), runs, items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(runs):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _scanner(shared, key: str, width: int, only_hits: bool, spans: bool):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = _automaton(key, shared, width)
        rows = []
        for i, text in enumerate(texts_of(batch)):
            n, runs, items = scan(text, *own)
            if only_hits and not runs:
                continue
            places = word_offsets(text) if spans and runs else None
            marked = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in runs] if places else []
            rows.append((i, n, [{"start": a, "end": b} for a, b in runs], marked, sorted(items)))
        run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        at, n, runs, marked, items = zip(*rows) if rows else [()] * 5
        return pa.RecordBatch.from_arrays(
            [batch.column(c).take(pa.array(at, pa.int64())) for c in ("doc_id", "uid")]
            + [pa.array(n, pa.int64()), pa.array(runs, run), pa.array(marked, run), pa.array(items, pa.list_(pa.string()))],
            names=["doc_id", "uid", "n_words", "runs", "spans", "items"],
        )

    return step


def _finish(rows: DataFrame) -> DataFrame:
    total = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return rows.select(
        "doc_id",
        "n_words",
        total.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.col("items").alias("item_ids"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        "spans",
    )


def _merge_arrow(batch: pa.RecordBatch) -> pa.RecordBatch:
    data = {c: batch.column(c).to_pylist() for c in batch.schema.names}
    for c in ("runs", "spans"):
        data[c] = [[{"start": a, "end": b} for a, b in merged([(r["start"], r["end"]) for r in x or []])] for x in data[c]]
    data["items"] = [sorted(set(x or [])) for x in data["items"]]
    return pa.RecordBatch.from_pydict(data, schema=batch.schema)


def _pairs(items: DataFrame, shard: int, shards: int) -> list[tuple]:
    """(item, text) of one shard: SHARD_BYTES of text on average."""
    own = items if shards == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard)
    return [(r["item"], r["text"]) for r in own.distinct().collect()]


def _key(pairs: list[tuple], width: int) -> str:
    return hashlib.sha256(repr((width, sorted(map(repr, pairs)))).encode()).hexdigest()


def _shards(items: DataFrame, shard_bytes: int) -> int:
    held = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    return max(1, -(-held // shard_bytes))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of a test item; all columns stay as they are.

    One pass without a shuffle; a benchmark of several shards takes one stored pass for each.
    """
    names = docs.columns
    at = names.index(text)
    rows = docs.toDF(*[f"_{i}" for i in range(len(names))])
    items = pick(benchmark, item=item_id, text=item_text)
    shards = _shards(items, shard_bytes)
    for shard in range(shards):
        pairs = _pairs(items, shard, shards)
        key, shared = _key(pairs, width), docs.sparkSession.sparkContext.broadcast(pairs)

        def step(batch: pa.RecordBatch, key=key, shared=shared) -> pa.RecordBatch:
            own = _automaton(key, shared, width)
            return batch.filter(pa.array([not scan(t, *own)[1] for t in texts_of(batch, f"_{at}")], pa.bool_()))

        rows = mapped(rows, step, rows.schema, f"_{at}")
        if shard + 1 < shards:
            rows = stored(rows, "clean")
    return rows.toDF(*names)


def _automaton(key: str, shared, width: int) -> tuple:
    if key not in _built:
        _built.clear()
        _built[key] = build(shared.value, width)
    return _built[key]


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD_BYTES, spans: bool = True) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, item_ids, items_sha256, contaminated, spans.

    ``spans`` are hit passages in code points of the original text. Null and
    empty texts have no words and are clean; items without words match nothing;
    an item of fewer than ``width`` words is one window. Items with a null id
    mark words but are not counted. Repeated items count once. Repeated rows
    each get a row. ``item_ids`` are sorted as strings.

    The benchmark's size is measured first. Up to ``shard_bytes`` it goes into
    one broadcast automaton; beyond, shards of that size are scanned in turn
    and their hits joined by row hash, so memory stays bounded.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("uid", row_uid("doc_id", "text"))
    items = pick(benchmark, item=item_id, text=item_text)
    shards = _shards(items, shard_bytes)
    kind = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["uid"], T.StructField("n_words", T.LongType()), T.StructField("runs", kind),
                           T.StructField("spans", kind), T.StructField("items", T.ArrayType(T.StringType()))])

    def scanned(shard: int, only_hits: bool) -> DataFrame:
        pairs = _pairs(items, shard, shards)
        return mapped(rows, _scanner(spark.sparkContext.broadcast(pairs), _key(pairs, width), width, only_hits, spans), schema)

    base = scanned(0, False)
    if shards == 1:
        return _finish(base)
    more = None
    for shard in range(1, shards):
        part = stored(scanned(shard, True), f"hits-{shard}")
        more = part if more is None else more.unionByName(part)
    more = more.dropDuplicates(["uid", "runs", "items"]).groupBy("uid").agg(
        F.flatten(F.collect_list("runs")).alias("r"), F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i")
    )
    both = base.join(more, "uid", "left")
    both = both.select("doc_id", "uid", "n_words", *[F.concat(c, F.coalesce(F.col(d), F.array().cast(schema[c].dataType))).alias(c) for c, d in (("runs", "r"), ("spans", "s"), ("items", "i"))])
    return _finish(mapped(both, _merge_arrow, schema))
