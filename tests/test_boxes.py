"""Distance sums by boxes of near points against all pairs."""

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from tablelab.operators import boxes, quality, segments
from tests.oracle import DATA, connect, differences


def clouds(n):
    rng = np.random.default_rng(3)
    key = np.arange(n) / 100
    return {
        "line": rng.normal(size=(n, 1)),
        "plane": rng.normal(size=(n, 2)),
        "rows of a grid": np.column_stack([rng.uniform(-1, 10, n).round(3), rng.integers(0, 25, n)]),
        "string": np.column_stack([rng.uniform(-1, 10, n), rng.integers(0, 25, n), key]),
        "cloud far from zero": rng.normal(size=(n, 3)) + 1e6,
        "clumps": rng.normal(size=(n, 3)) * 1e-3 + rng.integers(0, 6, (n, 1)) * [3.0, 1e3, 0.1],
        "heavy tails": rng.standard_cauchy(size=(n, 2)),
        "one feature constant": np.column_stack([rng.normal(size=n), np.full(n, 0.1), rng.exponential(size=n)]),
        "one point": np.full((n, 2), 0.1),
    }


def with_weights(x, k=4):
    rng = np.random.default_rng(4)
    weights = np.zeros((len(x), k))
    weights[np.arange(len(x)), rng.integers(0, k, len(x))] = rng.integers(1, 5, len(x))
    return x[boxes.tree_order(x, boxes.LEAF[x.shape[1]])], weights


@pytest.mark.parametrize("name", sorted(clouds(10)))
def test_sums_are_those_of_all_pairs(name):
    x, weights = with_weights(clouds(6000)[name])
    tree = boxes.Tree(x, weights)
    boxes.meet(tree, tree)
    found = tree.finish()
    some = np.arange(0, len(x), 40)
    want = np.stack([np.sqrt(((x - x[i]) ** 2).sum(axis=1)) @ weights for i in some])
    assert np.allclose(found[some], want, rtol=1e-11, atol=1e-12)


def test_two_trees_and_a_far_box_give_the_same_sums():
    x, weights = with_weights(clouds(6000)["plane"])
    near, far = x + [0.5, 0.0], x + [90.0, 40.0]
    want = [np.stack([np.sqrt(((b - p) ** 2).sum(axis=1)) @ weights for p in x[::200]]) for b in (near, far)]
    a, b = boxes.Tree(x, weights), boxes.Tree(near, weights)
    boxes.meet(a, b)
    back = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) @ weights for p in near[::200]])
    assert np.allclose(b.finish()[::200], back, rtol=1e-11)
    boxes.meet_far(a, boxes.Tree(far, weights).box(0))
    assert np.allclose(a.finish()[::200], want[0] + want[1], rtol=1e-11)


def test_pairs_looked_at_grow_less_than_with_the_square(monkeypatch):
    looked = []
    plain = boxes.pair_sums
    monkeypatch.setattr(boxes, "pair_sums", lambda a, qa, b, qb, *rest, **named: looked.append(len(a) * len(b)) or plain(a, qa, b, qb, *rest, **named))
    pairs = []
    for n in (8000, 32_000):
        looked.clear()
        x, weights = with_weights(clouds(n)["rows of a grid"])
        tree = boxes.Tree(x, weights)
        boxes.meet(tree, tree)
        pairs.append(sum(looked))
    assert pairs[1] < 6 * pairs[0] and pairs[1] < 32_000**2 / 8


def frame(spark, n, gaps=False):
    rng = np.random.default_rng(6)
    label = np.minimum(rng.integers(0, 9, n), 3)
    x = rng.normal(size=(n, 3)).round(2) * [1.0, 5.0, 0.2] + label[:, None] * [0.4, 0.0, 0.3]
    x[: n // 10] = x[n // 10 : 2 * (n // 10)]
    label[0] = 7  # alone in its cluster
    rows = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=np.arange(n), cluster=label)
    if gaps:
        rows.loc[5, "b"] = None
    return spark.createDataFrame(rows)


def test_importance_of_many_rows_does_not_look_at_all_pairs(spark, monkeypatch):
    """All pairs of 5.4 million rows did not end."""
    df = frame(spark, 2500)
    pts = quality.points(df, ["a", "b", "c"], "cluster", ["id"])
    m = quality.cluster_moments(pts, 3)
    base, without = quality.silhouette_without(pts, m)
    monkeypatch.setattr(quality, "BOX_ROWS", 1000)
    monkeypatch.setattr(quality, "_pair_sums", None)
    for few in (boxes.FEW_ROWS, 700):  # one block, several blocks
        monkeypatch.setattr(boxes, "FEW_ROWS", few)
        found, each = quality.silhouette_without(pts, m)
        assert [found, *each] == pytest.approx([base, *without], abs=1e-12)


def test_importance_by_boxes_with_missing_values(spark, monkeypatch):
    """As in SQL: sums pass over missing values, and their rows have no width."""
    monkeypatch.setattr(quality, "BOX_ROWS", 100)
    df = frame(spark, 300, gaps=True).where("cluster < 7")
    found = {r["feature"]: r for r in segments.silhouette_drop(df, "cluster", ["a", "b", "c"], ["id"], mode="euclidean").collect()}
    rows = df.collect()
    sizes = {c: sum(r["cluster"] == c for r in rows) for c in range(4)}
    for used, value in ((["a", "b", "c"], found["a"]["base"]), (["a", "c"], found["b"]["without"]), (["b", "c"], found["a"]["without"])):
        whole = [r for r in rows if all(r[f] is not None and r[f] == r[f] for f in used)]
        assert len(whole) == len(rows) - ("b" in used)
        x, own = np.array([[r[f] for f in used] for r in whole]), np.array([r["cluster"] for r in whole])
        gaps = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
        sums = np.stack([gaps[:, own == c].sum(axis=1) for c in range(4)], axis=1)
        widths = []
        for i, c in enumerate(own):
            near, far = sums[i, c] / (sizes[c] - 1), min(sums[i, j] / sizes[j] for j in range(4) if j != c)
            widths.append((far - near) / max(far, near))
        assert value == pytest.approx(np.mean(widths), abs=1e-12)


@pytest.mark.parametrize("name", ["g06_silhouette_drop", "g07_combined_importance"])
def test_queries_by_boxes_match_sql(spark, monkeypatch, name):
    monkeypatch.setattr(quality, "BOX_ROWS", 0)
    sf = f"{DATA}/sf0.01"
    assert differences(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name]) == []
