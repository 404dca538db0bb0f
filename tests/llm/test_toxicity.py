"""Toxicity: counts and probabilities against plain recomputation, held-out accuracy, edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tablelab.llm import toxicity
from tablelab.llm.queries import QUERIES
from tests.oracle import DATA

SF = f"{DATA}/sf0.001"
WORDS = ["the", "house", "garden", "tower", "river", "été", "straße", "walks", "small", "under", "water", "stone"]


def symbols(text):
    """Plain form of the symbols of a text."""
    out = [0, 0, 0]
    for b in (text or "").encode().replace(b"\0", b" "):
        x = int(toxicity._SYMBOL[b])
        if x != 1 or out[-1] != 1:
            out.append(x)
    return out


def plain_codes(text):
    s = symbols(text)
    return [s[i - 3] << 18 | s[i - 2] << 12 | s[i - 1] << 6 | s[i] for i in range(3, len(s))]


def test_codes_follow_the_plain_form():
    texts = ["The  house.\n\nÉté 12 straße", "", None, "a", " \0 x", "ab" * 5000]
    codes, lengths = toxicity.symbol_codes(texts)
    assert lengths.tolist() == [len(plain_codes(t)) for t in texts]
    assert codes.tolist() == [c for t in texts for c in plain_codes(t)]
    assert toxicity.symbol_codes(["THE HOUSE"])[0].tolist() == toxicity.symbol_codes(["the\n house"])[0].tolist()


def test_probabilities_follow_the_plain_form():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(WORDS) for _ in range(30)) for _ in range(20)]
    counts = [Counter(c for t in texts[k::2] for c in plain_codes(t)) for k in (0, 1)]
    codes = np.array(sorted(set(counts[0]) | set(counts[1])))
    found = toxicity.evidence(codes, *[np.array([c[x] for x in codes.tolist()]) for c in counts])
    # Continuation counts, from the distinct codes of both classes together.
    grams = {3: Counter(c & 0x3FFFF for c in codes.tolist())}
    grams[2] = Counter(g & 0xFFF for g in grams[3])
    grams[1] = Counter(g & 0x3F for g in grams[2])

    def shared(gram, k):
        if k == 1:
            return grams[1][gram] / sum(grams[1].values())
        behind = [n for g, n in grams[k].items() if g >> 6 == gram >> 6]
        d = toxicity.SHARED_DISCOUNT
        return max(grams[k][gram] - d, 0) / sum(behind) + d * len(behind) / sum(behind) * shared(gram & (1 << 6 * (k - 1)) - 1, k - 1)

    def probability(k, code):
        behind = [n for c, n in counts[k].items() if c >> 6 == code >> 6]
        total = sum(behind) + toxicity.SHARED
        left = (sum(min(n, toxicity.DISCOUNT) for n in behind) + toxicity.SHARED) / total
        return max(counts[k][code] - toxicity.DISCOUNT, 0) / total + left * shared(code & 0x3FFFF, 3), left

    for code in rng.sample(codes.tolist(), 40):
        near = [c for c in codes.tolist() if c >> 6 == code >> 6]
        unseen = math.log(probability(1, code)[1] / probability(0, code)[1])
        expected = sum(probability(0, c)[0] * math.log(probability(1, c)[0] / probability(0, c)[0]) for c in near)
        expected += max(0, 1 - sum(probability(0, c)[0] for c in near)) * unseen
        want = math.log(probability(1, code)[0] / probability(0, code)[0]) - expected
        table = found.table()
        assert table[code] == pytest.approx(want, abs=1e-5)
        free = next(x for x in range(64) if (code >> 6) * 64 + x not in set(near))
        assert table[(code >> 6) * 64 + free] == pytest.approx(unseen - expected, abs=1e-5)


def planted(spark, n=900):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(20, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words[rng.randrange(len(words))] = "gr" + rng.choice(["umbel", "ompf", "akz", "imsel"]) + rng.choice(["", "en", "er!"])
        rows.append((i, " ".join(words), "x", 1))
        labels.append((i, 0, int(toxic), "z"))
    return spark.createDataFrame(rows, "doc_id long, text string, Label string, score int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_held_out_accuracy(spark):
    docs, labels = planted(spark)
    model = toxicity.fit(docs, labels)
    got = toxicity.classify(docs, model).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    # Labels of the held-out fold don't matter.
    other = labels.withColumn("toxic", (1 - labels.toxic).cast("int")).where("false").unionByName(labels.where("pmod(crc32(cast(doc_id as string)), 3) <> 1"))
    again = toxicity.fit(docs, other)
    assert again.weight == pytest.approx(model.weight, rel=1e-6) and np.array_equal(again.evidence.by_code, model.evidence.by_code)
    small = toxicity.fit(docs, labels, sample=300)
    assert 0 < len(small.evidence.codes) < len(model.evidence.codes)


def test_edge_cases(spark):
    docs, labels = planted(spark, 120)
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(None, "the house", 1), (1, None, 1), (1, None, 1), (2, "", 1), (3, "\0\0", 1), (4, "grumbel " * 200_000, 1), (5, "日本語 \U0001f600", 1)], "DOC_ID long, Text string, held_out int")
    got = toxicity.classify(odd, model, doc_id="doc_id", text="text").collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False] and [r.difference for r in got if r.doc_id in (1, 2)] == [0, 0, 0]
    assert [r.predicted for r in got if r.doc_id == 4] == [1]
    assert toxicity.classify(docs.limit(0), model).count() == 0
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.selectExpr("doc_id", "cast(null as int) AS toxic")):
        flat = toxicity.fit(docs, some)
        assert flat.weight == 0 and 0 < toxicity.classify(docs, flat).first().score < 1
    assert toxicity.classify(docs, toxicity.fit(docs.limit(0), labels)).first().score == 0.5
    # Repeated rows and repeated labels: the larger label counts.
    twice = toxicity.fit(docs, labels.unionByName(labels.selectExpr("doc_id", "quality", "0 AS toxic", "text")))
    assert np.array_equal(twice.evidence.by_code, model.evidence.by_code)


def test_query(spark):
    got = QUERIES["op11_toxicity"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and dict(got.dtypes)["predicted"] == "int"
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
