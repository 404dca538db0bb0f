"""Exact quantiles by narrowing, in a fixed small number of scans.

The built-in exact ``percentile`` keeps every distinct value of a column in one
aggregation buffer. Here a first scan sketches each column
(``percentile_approx``) to guess edges close around the wanted ranks. A second
scan counts rows per interval between edges, with one row per value only for
the short intervals around the guesses. The counts prove where each rank lies.
A value that fills a large share of the rows ends up as an edge and is only
counted. Where a rank falls in a long interval, that interval is sketched and
counted again; each round cuts it by a factor of thousands, so what reaches the
driver is bounded for any row count and the answer stays exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

ACCURACY = 10_000
LIST_LIMIT = 5_000
SMALL = 30_000
LOOSE = 0.02


@dataclass
class Central:
    """Count, mean and sums of powers of the deviation from the mean."""

    n: int = 0
    mean: float | None = None
    powers: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0, 0.0])


@dataclass
class _Search:
    """Edges of one column for the next count, and the ranks still wanted."""

    wanted: set[int]
    edges: list[float]
    listed: set[tuple[float, float]]
    known: dict[int, float] = field(default_factory=dict)
    brackets: list[tuple[float, float, int, int]] = field(default_factory=list)


def _ranks(n: int, p: float) -> tuple[int, int]:
    low = math.floor((n - 1) * p)
    return low, min(low + 1, n - 1)


def quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probs: Sequence[float],
    *,
    exact: bool = True,
    extra: Sequence[Column] = (),
    central: dict[str, Central] | None = None,
    accuracy: int = ACCURACY,
    list_limit: int = LIST_LIMIT,
) -> tuple[dict[str, list[float | None]], Row]:
    """Linear-interpolation quantiles of double columns, NULLs skipped.

    Returns ``{name: [value per prob]}`` and the row of ``extra`` aggregates
    computed in the first scan. If ``central`` is given it is filled with the
    central power sums of each column, taken in the second scan.
    """
    names = list(columns)
    slack = 3.0 / accuracy
    shares = sorted({min(1.0, max(0.0, p + s)) for p in probs for s in (-LOOSE, -slack, 0.0, slack, LOOSE)})
    aggregates = [*extra]
    for i, name in enumerate(names):
        c = columns[name]
        aggregates += [F.count(c).alias(f"__n{i}"), F.min(c).alias(f"__min{i}"), F.max(c).alias(f"__max{i}")]
        aggregates.append(F.percentile_approx(c, shares, accuracy).alias(f"__q{i}"))
        if central is not None:
            aggregates.append(F.avg(c).alias(f"__avg{i}"))
    if not aggregates:
        return {}, Row()
    first = df.agg(*aggregates).first()
    result: dict[str, list[float | None]] = {name: [None] * len(probs) for name in names}
    searches: dict[str, _Search] = {}
    for i, name in enumerate(names):
        n = first[f"__n{i}"]
        if central is not None:
            central[name] = Central(n, first[f"__avg{i}"])
        if n == 0:
            continue
        sketch = dict(zip(shares, first[f"__q{i}"]))
        if not exact:
            result[name] = [sketch[p] for p in probs]
        searches[name] = _first_search(n, first[f"__min{i}"], first[f"__max{i}"], probs if exact else (), sketch, slack, accuracy, list_limit)

    active = searches if exact or central is not None else {}
    while active:
        _count_and_pick(df, columns, active, central)
        central = None
        active = {name: s for name, s in active.items() if s.wanted}
        if active:
            _resketch(df, columns, active, accuracy, list_limit)

    if exact:
        for name, s in searches.items():
            n = first[f"__n{names.index(name)}"]
            for k, p in enumerate(probs):
                low, high = _ranks(n, p)
                weight = (n - 1) * p - low
                a, b = s.known[low], s.known[high]
                result[name][k] = a if weight == 0 or a == b else a * (1 - weight) + b * weight
    return result, first


def _first_search(n, lo, hi, probs, sketch, slack, accuracy, list_limit) -> _Search:
    wanted = {r for p in probs for r in _ranks(n, p)}
    edges, listed = {lo, hi}, set()
    for p in probs:
        reach = slack if n > SMALL else LOOSE
        if n <= 10 / LOOSE:
            pair = (lo, hi)
        else:
            pair = (sketch[max(0.0, p - reach)], sketch[min(1.0, p + reach)])
        edges.update(pair)
        if n * (2 * reach + 4.0 / accuracy) <= list_limit:
            listed.add(pair)
    return _Search(wanted, sorted(edges), listed)


def _count_and_pick(df: DataFrame, columns: dict[str, Column], searches: dict[str, _Search], central) -> None:
    """One scan: rows per edge and interval, and per value in listed intervals.

    Each task sorts its Arrow batches into the intervals and returns counts
    only. Done in NumPy because the same comparisons over many columns make a
    generated JVM method too large to be compiled.
    """
    names = list(searches)
    edges = {c: np.array(searches[c].edges) for c in names}
    listed = {c: sorted(searches[c].listed) for c in names}
    means = {c: central[c].mean for c in names} if central is not None else None

    def partial(batches):
        counts = {c: np.zeros(2 * len(edges[c]) + 1, dtype="int64") for c in names}
        powers = {c: np.zeros(4) for c in names}
        values: dict[str, dict] = {c: {} for c in names}
        for batch in batches:
            for c in names:
                v = batch[c].to_numpy(dtype=float)
                v = v[~np.isnan(v)]
                place = np.searchsorted(edges[c], v, side="left")
                kind = 2 * place + (edges[c][np.minimum(place, len(edges[c]) - 1)] == v)
                if means is not None:
                    d = v - means[c]
                    squares = d * d
                    powers[c] += [d.sum(), squares.sum(), (squares * d).sum(), (squares * squares).sum()]
                inside = np.zeros(len(v), dtype=bool)
                for lo, hi in listed[c]:
                    inside |= (v > lo) & (v < hi)
                counts[c] += np.bincount(kind[~inside], minlength=len(counts[c]))
                for k, x in zip(kind[inside].tolist(), v[inside].tolist()):
                    values[c][(k, x)] = values[c].get((k, x), 0) + 1
        out = []
        for c in names:
            out += [(c, k, None, int(n), 0.0, 0.0, 0.0, 0.0) for k, n in enumerate(counts[c]) if n]
            out += [(c, k, x, n, 0.0, 0.0, 0.0, 0.0) for (k, x), n in values[c].items()]
            if means is not None:
                out.append((c, -1, None, 0, *powers[c].tolist()))
        yield pd.DataFrame(out, columns=["column", "kind", "x", "n", "p1", "p2", "p3", "p4"]).astype({"x": float})

    schema = "column string, kind int, x double, n bigint, p1 double, p2 double, p3 double, p4 double"
    parts = df.select(*[columns[c].alias(c) for c in names]).mapInPandas(partial, schema)
    totals = parts.groupBy("column", "kind", F.nanvl("x", F.lit(None)).alias("x")).agg(
        *[F.sum(c).alias(c) for c in ("n", "p1", "p2", "p3", "p4")]
    )
    counted: dict[str, list] = {c: [] for c in names}
    for r in totals.collect():
        if r["kind"] >= 0:
            counted[r["column"]].append(r)
        else:
            central[r["column"]].powers = [r["p1"], r["p2"], r["p3"], r["p4"]]
    for c in names:
        _pick(searches[c], counted[c])


def _pick(s: _Search, rows: list) -> None:
    """Walk the counts in order and settle every wanted rank that is certain."""
    steps = sorted(
        ((r["kind"], r["x"], r["n"]) for r in rows), key=lambda r: (r[0], r[1] is not None, r[1] if r[1] is not None else 0.0)
    )
    below, s.brackets = 0, []
    for kind, x, n in steps:
        hit = {r for r in s.wanted if below <= r < below + n}
        if hit and kind % 2 == 1:
            s.known.update(dict.fromkeys(hit, s.edges[kind // 2]))
        elif hit and x is not None:
            s.known.update(dict.fromkeys(hit, x))
        elif hit:
            i = kind // 2
            s.brackets.append((s.edges[i - 1], s.edges[i], below, n))
        below += n
    s.wanted -= set(s.known)


def _resketch(df: DataFrame, columns: dict[str, Column], searches: dict[str, _Search], accuracy: int, list_limit: int) -> None:
    """Guess edges inside the open intervals that hold a wanted rank."""
    slack = 3.0 / accuracy
    asked, aggregates = [], []
    for name, s in searches.items():
        v = columns[name]
        for lo, hi, below, inside in s.brackets:
            ranks = [r for r in s.wanted if below <= r < below + inside]
            if inside <= list_limit:
                asked.append((name, lo, hi, inside, None))
                continue
            pair = (max(0.0, (min(ranks) - below) / inside - slack), min(1.0, (max(ranks) + 1 - below) / inside + slack))
            asked.append((name, lo, hi, inside, pair))
            aggregates.append(F.percentile_approx(F.when((v > lo) & (v < hi), v), list(pair), accuracy).alias(f"q{len(asked)}"))
    row = df.agg(*aggregates).first() if aggregates else None
    for s in searches.values():
        s.edges, s.listed = [], set()
    for i, (name, lo, hi, inside, pair) in enumerate(asked, start=1):
        s = searches[name]
        guess = (lo, hi) if pair is None else tuple(row[f"q{i}"])
        s.edges = sorted({*s.edges, lo, hi, *guess})
        if pair is None or inside * (pair[1] - pair[0] + 4.0 / accuracy) <= list_limit:
            s.listed.add(guess)
