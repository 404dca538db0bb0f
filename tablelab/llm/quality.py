"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Shallow trees are fitted to labelled rows; every path from a root becomes a
rule, a conjunction of thresholds. A logistic regression with a lasso penalty
weighs the rules, most to zero. The rules that stay are compiled into one
Spark column, which scores every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.llm.common import mapped, pick, stored, texts_of

#: Labelled rows that the fit uses at most; those with the least hash of their id.
SAMPLE = 20_000
TREES, DEPTH, SEED = 24, 3, 17
PENALTY = 0.0005
THRESHOLD = 0.3

STATISTICS = (
    "n_words", "mean_word", "long_words", "upper", "digits", "punctuation", "symbols", "exclaims", "pipes", "other_bytes",
    "distinct_words", "repeated_next", "top_word", "marked_words", "n_lines", "words_per_line", "repeated_lines", "spaces",
)

_UPPER, _LOWER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in "!\"'(),-.:;?"]] = True
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[b for b in range(33, 127) if not (_UPPER | _LOWER | _DIGIT | _MARKS)[b]]] = True


def statistics(text: str) -> list[float]:
    """The numbers of :data:`STATISTICS` over the whole text; all 0 for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, n = len(raw), len(words)
    letters = max(1, int(count[_UPPER | _LOWER].sum()))
    held: dict[bytes, int] = {}
    for w in words:
        held[w] = held.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = b"".join([w[-1:] for w in words])
    ends_marked = int((_SYMBOLS | (np.arange(256) == 33))[np.frombuffer(ends, np.uint8)].sum())
    letters_wide = len(raw.decode("utf-8", "surrogatepass"))
    return [
        float(n), letters_wide / n, sum(len(w) > 12 for w in words) / n, float(count[_UPPER].sum()) / letters, float(count[_DIGIT].sum()) / size,
        float(count[_MARKS].sum()) / size, float(count[_SYMBOLS].sum()) / size, float(count[33]) / n, float(count[124]) / n, float(count[128:].sum()) / size,
        len(held) / n, sum(map(eq, words, words[1:])) / n, max(held.values()) / n, ends_marked / n, float(len(lines)), n / len(lines),
        1.0 - len(set(lines)) / len(lines), float(count[32]) / size,
    ]


def with_statistics(rows: DataFrame) -> DataFrame:
    """The columns but ``text``, and one double per statistic."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, *[T.StructField(s, T.DoubleType()) for s in STATISTICS]])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = np.array([statistics(t) for t in texts_of(batch)], np.float64).reshape(-1, len(STATISTICS))
        return pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *[pa.array(table[:, i]) for i in range(len(STATISTICS))]], names=schema.names)

    return mapped(rows, step, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction: statistic, whether above, threshold."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        tests = [F.col(s) > t if above else F.col(s) <= t for s, above, t in self.parts]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out.cast("double")

    def __str__(self) -> str:
        return " AND ".join(f"{s} {'>' if above else '<='} {t:.6g}" for s, above, t in self.parts)


@dataclass(frozen=True)
class RuleModel:
    """Rules with weights; the score is the logistic of their sum."""

    base: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total = total + rule.column() * F.lit(weight)
        return 1.0 / (1.0 + F.exp(-total))


def _simple(parts: list[tuple[str, bool, float]]) -> tuple:
    """At most one lower and one upper threshold per statistic, in a fixed order."""
    tight: dict[tuple[str, bool], float] = {}
    for s, above, t in parts:
        old = tight.get((s, above))
        tight[s, above] = t if old is None else max(old, t) if above else min(old, t)
    return tuple(sorted((s, above, t) for (s, above), t in tight.items()))


def tree_rules(model) -> list[Rule]:
    """Every path of every tree, inner ones too; equal rules once."""
    found: dict[tuple, None] = {}

    def walk(node, parts: list) -> None:
        if parts:
            found.setdefault(_simple(parts))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, cut = STATISTICS[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), [*parts, (name, False, cut)])
        walk(node.rightChild(), [*parts, (name, True, cut)])

    for tree in model.trees:
        walk(tree._java_obj.rootNode() if hasattr(tree, "_java_obj") else tree._call_java("rootNode"), [])
    return [Rule(p) for p in found]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int, fold: int, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text and label of at most ``sample`` labelled rows outside the held-out fold.

    An id with several labels takes the larger one.
    """
    rows = pick(labels, doc_id=doc_id, label=label).where("doc_id IS NOT NULL AND label IN (0, 1)")
    rows = rows.where(F.crc32(F.col("doc_id").cast("string")) % fold != 0).groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers.
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, fold: int = 5, doc_id: str = "doc_id", text: str = "text") -> RuleModel:
    """Rules from labelled rows whose crc32(doc_id as text) is not divisible by ``fold``.

    Without rows of both labels the model is a constant: the share of label 1, or 0.5.
    """
    rows = training_rows(pick(docs, doc_id=doc_id, text=text), labels, label, sample, fold)
    train = stored(with_statistics(rows), "train")
    held = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    n, ones = held["n"], held["ones"] or 0.0
    if not 0 < ones < n:
        share = 0.5 if not n else min(0.99, max(0.01, ones / n))
        return RuleModel(float(np.log(share / (1 - share))), ())
    # A fixed order makes the fit repeatable.
    train = train.coalesce(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    vectors = train.select("label", *STATISTICS, array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED, subsamplingRate=0.7, featureSubsetStrategy="onethird")
    rules = tree_rules(forest.fit(vectors))
    if not rules:
        share = ones / n
        return RuleModel(float(np.log(share / (1 - share))), ())
    hits = vectors.select("label", array_to_vector(F.array(*[r.column() for r in rules])).alias("features"))
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=100).fit(stored(hits, "hits"))
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(float(lasso.intercept), tuple(kept))


def classify(docs: DataFrame, model: RuleModel, fold: int = 5, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted. Null and empty texts are scored as texts without words.

    A null doc_id is not held out. Repeated rows each get a row.
    """
    rows = with_statistics(pick(docs, doc_id=doc_id, text=text))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold == 0, F.lit(False))
    scored = rows.select("doc_id", held_out.alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


