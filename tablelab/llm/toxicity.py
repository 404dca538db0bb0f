"""Toxicity: two class-conditional Kneser-Ney models over sequences of symbols.

Texts become sequences of 64 symbols: a-z in either case, one space for every
run of other ASCII signs, and the bytes of further letters. For each class the
labelled rows give counts of runs of four symbols. A class's probability of a
symbol behind three others discounts its counts and leaves the rest to the
probability behind two, which comes from counts of both classes together
(continuation counts, as in Kneser-Ney smoothing). A rare expression is thus
smoothed alike in both classes, and only what one class holds often speaks for
it. The score is a logistic function of the difference of both log-likelihoods
over the length of the text, less what ordinary text has in the same contexts:
the class with fewer labelled texts predicts any text a little worse, and in
languages with few texts most.

A code of four symbols has 24 bits, so counts and model are bounded by
``2**24`` rows whatever the number of texts; natural text has some ten
thousand. The counts cover the labelled rows outside the held-out fold, of
which at most about ``SAMPLE`` are taken; scoring covers all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.llm.common import chunks, pick, stored

THRESHOLD = 0.7
#: Discount of a count, and counts that the shared model has in every context of a class.
DISCOUNT, SHARED = 1.0, 2.0
#: Discount of the shared continuation counts.
SHARED_DISCOUNT = 0.75
#: Symbols that a text counts as having besides its own, so that a few symbols decide nothing.
PRIOR_LENGTH = 200.0
#: Penalty of the two weights of the logistic function.
PENALTY = 1e-5
#: Labelled rows that the fit uses, about; those with the least hash of their id, all if there are fewer.
SAMPLE = 200_000
#: Distinct codes that a counting task holds before it hands them on.
HELD = 2_000_000

_SYMBOL = np.ones(256, np.uint8)
_SYMBOL[0] = 0
_SYMBOL[65:91] = _SYMBOL[97:123] = np.arange(2, 28)
_SYMBOL[128:192] = 28 + np.arange(64) % 32
_SYMBOL[192:] = 60 + np.arange(64) % 4


def symbol_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs of four symbols, text after text, and the number in each text.

    Three marks stand before a text, so that its first symbol has a context too.
    """
    raw = [b"\0\0\0" + (t or "").encode("utf-8", "surrogatepass").replace(b"\0", b" ") for t in texts]
    x = _SYMBOL[np.frombuffer(b"".join(raw), np.uint8)]
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 1) | (x[:-1] != 1)
    ends = np.cumsum(keep, dtype=np.int64)[np.cumsum([len(r) for r in raw], dtype=np.int64) - 1] if raw else np.zeros(0, np.int64)
    x = x[keep].astype(np.uint32)
    codes = x.copy()
    for back in (1, 2, 3):
        codes[back:] |= x[:-back] << np.uint32(6 * back)
    return codes[x != 0], np.diff(ends, prepend=0) - 3


def _totals(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of the rows of ``weights`` at each."""
    distinct, at = np.unique(codes, return_inverse=True)
    return distinct, np.stack([np.bincount(at, w, len(distinct)) for w in weights]).astype(np.int64)


def _parts(label: Column, half: Column) -> Column:
    """0 to 3: the label, and which half of the training rows a row is in."""
    return (label + 2 * half).cast("int")


def count_codes(rows: DataFrame) -> DataFrame:
    """code, n0..n3: how often each code occurs in the rows (part, text) of each part."""

    def count(batches):
        held = (np.zeros(0, np.uint32), np.zeros((4, 0), np.int64))
        for batch in chunks(batches):
            codes, lengths = symbol_codes(batch.column("text").to_pylist())
            part = np.repeat(batch.column("part").to_numpy(zero_copy_only=False), lengths)
            both, n = np.unique(codes * np.uint32(4) + part.astype(np.uint32), return_counts=True)
            own = np.zeros((4, len(both)), np.int64)
            own[both % 4, np.arange(len(both))] = n
            held = _totals(np.concatenate([held[0], both // 4]), np.concatenate([held[1], own], axis=1))
            if len(held[0]) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int64()), *map(pa.array, held[1])], names=names)
                held = (np.zeros(0, np.uint32), np.zeros((4, 0), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int64()), *map(pa.array, held[1])], names=names)

    names = ["code", "n0", "n1", "n2", "n3"]
    counted = rows.mapInArrow(count, ", ".join(f"{c} long" for c in names))
    return counted.groupBy("code").agg(*[F.sum(c).alias(c) for c in names[1:]])


def _shared(codes: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability of each code's last symbol behind the two before it, from distinct codes."""
    grams = {3: np.unique(codes & 0x3FFFF, return_counts=True)}
    for k in (2, 1):
        grams[k] = np.unique(grams[k + 1][0] & (1 << 6 * k) - 1, return_counts=True)
    kept, counts = grams[1]
    probability = counts / counts.sum()
    for k in (2, 3):
        gram, counts = grams[k]
        _, context = np.unique(gram >> 6, return_inverse=True)
        total, kinds = np.bincount(context, counts), np.bincount(context)
        lower = probability[np.searchsorted(kept, gram & (1 << 6 * (k - 1)) - 1)]
        probability = np.maximum(counts - SHARED_DISCOUNT, 0) / total[context] + SHARED_DISCOUNT * (kinds / total)[context] * lower
        kept = gram
    return probability[np.searchsorted(kept, codes & 0x3FFFF)]


@dataclass(frozen=True)
class Evidence:
    """Difference of both classes' log-probabilities: by code, and by context for codes not seen behind it."""

    codes: np.ndarray
    by_code: np.ndarray
    contexts: np.ndarray
    by_context: np.ndarray

    def table(self) -> np.ndarray:
        """One number for every possible code; 0 behind contexts not seen."""
        out = np.zeros(1 << 24, np.float32)
        out.reshape(-1, 64)[self.contexts] = self.by_context[:, None]
        out[self.codes] = self.by_code
        return out


def evidence(codes: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray) -> Evidence:
    """From counts of both classes by distinct code, in order."""
    seen = ordinary + toxic > 0
    codes, counts = codes[seen].astype(np.int64), [ordinary[seen], toxic[seen]]
    if not len(codes):
        return Evidence(codes, np.zeros(0, np.float32), codes, np.zeros(0, np.float32))
    shared = _shared(codes)
    contexts, at = np.unique(codes >> 6, return_inverse=True)
    logs, lefts = [], []
    for n in counts:
        total = np.bincount(at, n) + SHARED
        left = (np.bincount(at, np.minimum(n, DISCOUNT)) + SHARED) / total
        logs.append(np.log(np.maximum(n - DISCOUNT, 0) / total[at] + left[at] * shared))
        lefts.append(np.log(left))
    # What ordinary text is expected to lose in a context, where the class of fewer texts is known less well, counts for neither class.
    ordinary_p = np.exp(logs[0])
    difference, unseen = logs[1] - logs[0], lefts[1] - lefts[0]
    expected = np.bincount(at, ordinary_p * difference) + np.maximum(0, 1 - np.bincount(at, ordinary_p)) * unseen
    return Evidence(codes, (difference - expected[at]).astype(np.float32), contexts, (unseen - expected).astype(np.float32))


def differences(tables: list[np.ndarray], texts: list[str | None]) -> list[np.ndarray]:
    """By table and text: the difference of the log-likelihoods over the length."""
    codes, lengths = symbol_codes(texts)
    text = np.repeat(np.arange(len(texts)), lengths)
    return [np.bincount(text, t[codes], len(texts)) / (lengths + PRIOR_LENGTH) for t in tables]


def with_difference(rows: DataFrame, models: list[Evidence]) -> DataFrame:
    """The columns but ``text``, and ``difference_0``, ``difference_1``, ... by model."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, *[T.StructField(f"difference_{i}", T.DoubleType()) for i in range(len(models))]])

    def score(batches):
        tables = [m.table() for m in models]
        for batch in chunks(batches):
            found = differences(tables, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *[pa.array(x, pa.float64()) for x in found]], names=schema.names)

    return rows.mapInArrow(score, schema)


@dataclass(frozen=True)
class ToxicityModel:
    """Evidence by code, and the weights of the logistic function."""

    evidence: Evidence
    base: float
    weight: float

    def score(self, difference: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-(F.lit(self.base) + F.lit(self.weight) * difference)))


def _held_out(fold: int, rest: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold == rest, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: int = 3, rest: int = 1, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Models of both classes from about ``sample`` labelled ids, or all if there are fewer, whose crc32(doc_id as text) mod ``fold`` is not ``rest``.

    An id with several labels takes the larger one; each row that carries the
    id counts. The logistic function is fitted to rows scored by models of the
    other half of the rows, so that no row is judged by its own counts.
    Without rows of both labels the score is a constant: the share of label 1,
    or 0.5.
    """
    marks = pick(labels, doc_id=doc_id, label=label).where("doc_id IS NOT NULL AND label IN (0, 1)").where(~_held_out(fold, rest))
    marks = stored(marks.groupBy("doc_id").agg(F.max("label").cast("int").alias("label")), "labels")
    share = sample / max(marks.count(), 1)
    if share < 1:
        marks = marks.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    # ``sample`` rows of two numbers go to every task, so that no text is shuffled.
    rows = pick(docs, doc_id=doc_id, text=text).join(F.broadcast(marks), "doc_id").select(_parts(F.col("label"), half).alias("part"), "text")
    # At most 2**24 codes of 24 bits, in practice some ten thousand.
    counted = stored(count_codes(rows), "codes").orderBy("code").toArrow()
    codes = counted.column("code").to_numpy()
    n = [counted.column(f"n{i}").to_numpy() for i in range(4)]
    whole = evidence(codes, n[0] + n[2], n[1] + n[3])
    halves = [evidence(codes, n[0], n[1]), evidence(codes, n[2], n[3])]
    scored = with_difference(rows, halves)
    scored = scored.select((F.col("part") % 2).cast("double").alias("label"), F.when(F.col("part") < 2, F.col("difference_1")).otherwise(F.col("difference_0")).alias("difference"))
    scored = stored(scored, "differences")
    held = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    total, ones = held["n"], held["ones"] or 0.0
    if not 0 < ones < total:
        share = 0.5 if not total else min(0.99, max(0.01, ones / total))
        return ToxicityModel(whole, float(np.log(share / (1 - share))), 0.0)
    found = LogisticRegression(labelCol="label", regParam=PENALTY, maxIter=100).fit(scored.select("label", array_to_vector(F.array("difference")).alias("features")))
    return ToxicityModel(whole, float(found.intercept), float(found.coefficients[0]))


def classify(docs: DataFrame, model: ToxicityModel, fold: int = 3, rest: int = 1, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted, difference.

    Null and empty texts have no symbols and a difference of 0. A null doc_id
    is not held out. Repeated rows each get a row; an empty table gives none.
    """
    scored = with_difference(pick(docs, doc_id=doc_id, text=text), [model.evidence]).withColumnRenamed("difference_0", "difference")
    scored = scored.select("doc_id", _held_out(fold, rest).alias("held_out"), model.score(F.col("difference")).alias("score"), "difference")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "difference")
