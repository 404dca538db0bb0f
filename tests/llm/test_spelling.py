"""Spelling variants: the index and whole runs against brute force, shards, odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablelab.llm import spelling
from tablelab.llm.queries import QUERIES
from tests.oracle import DATA

SF = f"{DATA}/sf0.001"


def one_apart(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_pairs(words):
    """Words that share one of their forms with a code point left out or masked."""
    held = defaultdict(set)
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w))), *(w[:i] + "\0" + w[i + 1 :] for i in range(len(w)))}:
            held[key].add(w)
    return {(a, b) for group in held.values() for a in group for b in group if one_apart(a, b)}


def plain_counts(docs):
    held = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            held[run] += 1
    return {w: n for w, n in held.items() if len(w) >= 7 and n >= 2}


def plain(docs):
    n = plain_counts(docs)
    near = defaultdict(list)
    for a, b in near_pairs(n):
        near[a].append(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def vocabulary(rng, n, letters="abé", low=7, high=12):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)})


def test_index_against_brute_force():
    rng = random.Random(2)
    for words in (vocabulary(rng, 300), vocabulary(rng, 300, "ab", 2, 9), ["a" * k for k in range(7, 40)], ["aaaaaaab", "aaaaaaa"], ["xyzxyzx"]):
        pairs = near_pairs(words)
        for turned in (False, True):
            known = [w[::-1] if turned else w for w in words]
            index = spelling.RankIndex(known)
            sought = [*known, "q" * 8, known[0][:-1] + "q"]
            exact = np.array([len(w) // 2 for w in sought])
            a, b = index.near(sought, exact)
            got = [(sought[i], known[j]) for i, j in zip(a.tolist(), b.tolist())]
            assert len(set(got)) == len(got)
            want = {(v, u) for v in sought for u in known if one_apart(v, u) and u.startswith(v[: len(v) // 2])}
            assert set(got) == want and (turned or {p for p in want if p[0] in words} <= pairs)


def texts(rng, n_docs=60):
    base = ["beautiful", "résumées", "international", "straßenbahn", "aaaaaaaa", "mississippi", "gardener"]
    docs = []
    for i in range(n_docs):
        out = []
        for _ in range(60):
            w = rng.choice(base)
            if rng.random() < 0.15:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aeàs") + w[k:], w[:k] + rng.choice("xzé") + w[k + 1 :]])
            out.append(w.capitalize() if rng.random() < 0.1 else w)
        docs.append((i, rng.choice([" ", ", ", "1", "\n"]).join(out)))
    return docs


@pytest.mark.parametrize("shard_words", [5, 40, 50_000])
def test_whole_run(spark, shard_words):
    docs = texts(random.Random(shard_words))
    docs += [(900, None), (901, ""), (None, "Beautiful beautifulx beautifulx"), (902, "short words ×÷×÷×÷× 日本語日本語日"), (902, "gardener gardenery"), (902, "gardener gardenery"), (903, "aaaaaaaaz" * 3000), (904, "aaaaaaaaz" * 3000)]
    frame = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, N int")
    got = sorted(map(tuple, spelling.group_variants(frame, shard_words=shard_words).collect()))
    assert got == plain(docs)


def test_crowded_halves_over_shards(spark):
    # All words share a half, which reaches over all shards, and every shard has many visitors.
    rng = random.Random(7)
    words = [f"same{w}" for w in vocabulary(rng, 150, "ab", 3, 6)] + [f"{w}tail" for w in vocabulary(rng, 150, "ab", 3, 6)]
    docs = [(i, " ".join(w for w in words for _ in range(1 + 30 * (zlib.crc32(w.encode()) % 5 == 0)))) for i in range(3)]
    got = sorted(map(tuple, spelling.group_variants(spark.createDataFrame(docs, "doc_id long, text string"), shard_words=20).collect()))
    assert got == plain(docs)


def test_empty(spark):
    for docs in ([], [(1, None)], [(1, "few")], [(1, "once upon singular")]):
        assert spelling.group_variants(spark.createDataFrame(docs, "doc_id long, text string")).count() == 0


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == plain(docs)
