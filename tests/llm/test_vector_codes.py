"""Vector codes: whole runs against brute force, pruning, ties, odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from tablelab.llm import vector_codes


def plain(rows, parts=16, entries=64, rounds=2):
    """The definition, entry by entry with Python integers."""
    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][2]) // parts
    cut = lambda v, j: v[j * w : (j + 1) * w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(r[2], j) for r in first] for j in range(parts)]

    def best(j, p):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), k) for k, e in enumerate(books[j]))

    for _ in range(rounds):
        new = []
        for j in range(parts):
            held = {}
            for r in kept:
                held.setdefault(best(j, cut(r[2], j))[1], []).append(cut(r[2], j))
            new.append([[sum(c) // len(held[k]) for c in zip(*held[k])] if k in held else e for k, e in enumerate(books[j])])
        books = new
    found = [[best(j, cut(r[2], j)) for j in range(parts)] for r in kept]
    sums = {}
    for r, f in zip(kept, found):
        sums[r[1]] = sums.get(r[1], 0) + sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), sums[r[1]], sha) for r, f in zip(kept, found)]


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "x") for r in rows], f"vec_id long, embedding array<{kind}>, LABEL int, code string").withColumnRenamed("LABEL", "label")


def compare(spark, rows, kind="float", **options):
    got = sorted(map(tuple, vector_codes.encode(frame(spark, rows, kind), **options).collect()), key=str)
    assert got == sorted(plain(rows, **options), key=str)


def vectors(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return rng.normal(0, spread, (n, width)).astype(np.float32).astype(float).tolist()


def test_brute_force_with_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, v, rng.choice([0, 1, 1, 1, None])) for i, v in enumerate(vectors(150, 32, 2))]
    nan, inf = float("nan"), float("inf")
    rows += [(3, None, 1), (4, [None] + [0.5] * 31, 1), (5, [nan] * 32, 2), (6, [inf] + [0.0] * 31, None), (7, [0.0] * 31 + [-inf], 0)]
    rows += [(8, rows[8][1], 5)] * 3 + [(None, rows[9][1], None), (10, [0.25] * 32, 7), (10, [-0.25] * 32, 7)]
    rng.shuffle(rows)
    compare(spark, rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_ties_and_equal_vectors(spark, kind):
    # Few different values: many equal distances and entries that are never used.
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.5]) for _ in range(16)], i % 3) for i in range(120)] + [(1000 + i, [0.5] * 16, 0) for i in range(60)]
    compare(spark, rows, kind)


def test_other_sizes(spark):
    rows = [(i, v, None) for i, v in enumerate(vectors(40, 12, 6, 300.0))]
    compare(spark, rows, parts=4, entries=8, rounds=3)
    compare(spark, rows[:5], parts=4)
    compare(spark, rows[:1], parts=2, rounds=0)


def test_lengths_and_empty(spark):
    rows = [(i, v, 1) for i, v in enumerate(vectors(70, 16, 8))]
    got = {r.vec_id: r for r in vector_codes.encode(frame(spark, [*rows, (900, [0.1] * 8, 1), (901, [], 2)])).collect()}
    assert got[900].code is None and got[900].error is None and got[900].label_error == got[0].label_error
    assert got[901].label_error is None and len(got) == 72
    assert [got[i].code for i in range(70)] == [r[1] for r in plain(rows)]
    for few in ([], [(1, None, 1)], [(1, [float("nan")] * 16, 1)]):
        empty = vector_codes.encode(frame(spark, few))
        assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(Exception, match="equal parts"):
        vector_codes.encode(frame(spark, [(1, [0.5] * 17, 1)]))


def test_pruning_is_exact_and_saves_work():
    rng = np.random.default_rng(9)
    book = rng.integers(-300, 300, (64, 4))
    parts = np.concatenate([book[rng.integers(0, 64, 900)] + rng.integers(-20, 20, (900, 4)), book[:50], rng.integers(-(1 << 28), 1 << 28, (50, 4))])
    pivots = vector_codes.choose_pivots(book[None])[0]
    best, least, tried = vector_codes.nearest(parts, vector_codes.pivot_distances(parts, pivots[None])[:, 0], book, pivots)
    all_of = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (best == all_of.argmin(axis=1)).all() and (least == all_of.min(axis=1)).all()
    assert tried < 0.5 * 64 * len(parts)
