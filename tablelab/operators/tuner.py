"""A tuner that learns from its trials: tree-structured Parzen estimation.

Trials are split into the few best and the rest. For each parameter, the values
of either side give a density: a mixture of kernels around the values seen and
an even one. New values are drawn from the density of the best, and of several
draws the one is taken whose density among the best is highest against the
rest. Parameters that have nothing to do with the result stay spread out.

A batch of proposals runs side by side as Spark jobs. Proposals whose result is
not known yet count among the rest, so that a batch doesn't try one spot.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame

from tablelab.operators.centres import merge_points
from tablelab.operators.search import HIGHER_IS_BETTER, PARALLELISM, SPACES, Search, draw_params, run_trials
from tablelab.session import materialise

#: Random trials before anything is learned, draws per proposal.
STARTUP, DRAWS = 10, 24
#: Share of the trials that count as the best, and their most.
BEST_SHARE, MOST_BEST = 0.25, 25
#: New tries after a proposal that was made before.
TRIES = 5
_NORMAL = NormalDist()


def _cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf)(np.asarray(x, float) / math.sqrt(2)))


class _Number:
    """An int or float parameter, laid out on 0..1; an int takes the stretch around it."""

    def __init__(self, spec: dict):
        self.whole, self.log = spec["type"] == "int", bool(spec.get("log")) and spec["type"] != "int"
        low, high = spec["low"], spec["high"]
        self.low, self.high = (math.log(low), math.log(high)) if self.log else (low - 0.5, high + 0.5) if self.whole else (low, high)
        self.first, self.last = low, high

    def place(self, value) -> float:
        x = math.log(value) if self.log else float(value)
        return (x - self.low) / (self.high - self.low) if self.high > self.low else 0.5

    def value(self, place: float):
        x = self.low + place * (self.high - self.low)
        if self.whole:
            return int(min(self.last, max(self.first, round(x))))
        return float(min(self.last, max(self.first, math.exp(x) if self.log else x)))

    def kernels(self, values: Sequence) -> tuple[np.ndarray, np.ndarray]:
        """Middles and widths: a wide kernel over all, and one per value that reaches to its farther neighbour."""
        at = np.sort([self.place(v) for v in values])
        wide = np.full(len(at), 0.5)
        if len(at) > 1:
            gap = np.diff(at)
            wide = np.maximum(np.append(gap[0], gap), np.append(gap, gap[-1]))
        return np.append(at, 0.5), np.append(np.clip(wide, 1.0 / min(100, len(at) + 2), 1.0), 1.0)

    def draw(self, values: Sequence, rng: np.random.Generator):
        middle, width = self.kernels(values)
        k = int(rng.integers(len(middle)))
        low, high = _cdf(np.array([-middle[k] / width[k], (1 - middle[k]) / width[k]]))
        u = min(1 - 1e-12, max(1e-12, low + rng.random() * (high - low)))
        return self.value(min(1.0, max(0.0, middle[k] + width[k] * _NORMAL.inv_cdf(u))))

    def log_density(self, values: Sequence, at: Sequence) -> np.ndarray:
        """At each of the values ``at``, with kernels around ``values``."""
        middle, width = self.kernels(values)
        inside = _cdf((1 - middle) / width) - _cdf(-middle / width)
        x = np.array([self.place(v) for v in at])[:, None]
        if self.whole:
            half = 0.5 / max(self.high - self.low, 1)
            mass = _cdf((x + half - middle) / width) - _cdf((x - half - middle) / width)
        else:
            mass = np.exp(-0.5 * ((x - middle) / width) ** 2) / width / math.sqrt(2 * math.pi)
        return np.log((mass / inside).mean(axis=1) + 1e-300)


class _Choice:
    """A categorical parameter: counts with one more spread over all choices."""

    def __init__(self, spec: dict):
        self.choices = list(spec["choices"])

    def weights(self, values: Sequence) -> np.ndarray:
        n = np.array([sum(v == c for v in values) for c in self.choices], float) + 1 / len(self.choices)
        return n / n.sum()



class Sampler:
    """Proposes parameters and learns from their scores (higher is better; None for a failed trial)."""

    def __init__(self, space: dict, seed: int = 42, startup: int = STARTUP, draws: int = DRAWS):
        self.space, self.startup, self.draws = space, startup, draws
        self.rng = np.random.default_rng(seed)
        self.dims = {name: _Choice(spec) if spec["type"] == "categorical" else _Number(spec) for name, spec in space.items()}
        self.tried: list[tuple[dict, float]] = []
        self.waiting: list[dict] = []

    def _split(self) -> tuple[list[dict], list[dict]]:
        order = sorted(range(len(self.tried)), key=lambda i: (-self.tried[i][1], i))
        n = min(MOST_BEST, max(2, math.ceil(BEST_SHARE * len(order))))
        # A failed trial is never one of the best.
        best = [i for i in order[:n] if self.tried[i][1] > -math.inf]
        rest = [i for i in order if i not in set(best)]
        return [self.tried[i][0] for i in best], [self.tried[i][0] for i in rest] + self.waiting

    def _value(self, dim: _Number | _Choice, best: Sequence, rest: Sequence):
        """Of several draws from the best, the one that is most likely there against the rest.

        A choice is drawn by such a weight and not the largest one taken: with
        few trials the best choice may not be among the best yet.
        """
        if isinstance(dim, _Choice):
            weights = dim.weights(best) / np.sqrt(dim.weights(rest))
            return dim.choices[int(self.rng.choice(len(weights), p=weights / weights.sum()))]
        drawn = [dim.draw(best, self.rng) for _ in range(self.draws)]
        gain = dim.log_density(best, drawn) - dim.log_density(rest, drawn)
        return drawn[int(gain.argmax())]

    def _unseen(self, seen: list[dict]) -> dict | None:
        """A random set of parameters not tried before, if a few draws find one."""
        return next((p for p in (draw_params(self.space, self.rng) for _ in range(100)) if p not in seen), None)

    def propose(self) -> dict:
        if len(self.tried) + len(self.waiting) < self.startup or not any(s > -math.inf for _, s in self.tried):
            found = draw_params(self.space, self.rng)
        else:
            best, rest = self._split()
            seen = [p for p, _ in self.tried] + self.waiting
            for _ in range(TRIES):
                found = {name: self._value(dim, [p[name] for p in best], [p[name] for p in rest]) for name, dim in self.dims.items()}
                # What was tried before would give the same result again.
                if found not in seen:
                    break
            else:
                found = self._unseen(seen) or found
        self.waiting.append(found)
        return found

    def learn(self, params: dict, score: float | None) -> None:
        if params in self.waiting:
            self.waiting.remove(params)
        self.tried.append((params, -math.inf if score is None or math.isnan(score) else float(score)))


def tune_learning(
    df: DataFrame,
    algorithm: str,
    *,
    key: Sequence[str],
    n_trials: int = 50,
    space: dict | None = None,
    metric: str = "silhouette",
    seed: int = 42,
    startup: int = STARTUP,
    ready: bool = False,
    first_number: int = 0,
    parallelism: int = PARALLELISM,
    merged: DataFrame | None = None,
    **options,
) -> Search:
    """Trials from a typed space, each batch of ``parallelism`` proposals chosen by what the earlier ones gave.

    One-cluster results and failed trials count as the worst.
    """
    sampler = Sampler(space or SPACES[algorithm], seed, startup)
    frame = df if ready else materialise(df, key)
    merged = merge_points(frame, options.get("vector", "features")) if merged is None else merged
    sign = 1 if HIGHER_IS_BETTER[metric] else -1
    trials = []
    while len(trials) < n_trials:
        todo = [(algorithm, sampler.propose()) for _ in range(min(max(parallelism, 1), n_trials - len(trials)))]
        done = run_trials(
            frame, todo, key=key, metric=metric, seed=seed, first_number=first_number + len(trials),
            require_two=True, parallelism=parallelism, merged=merged, **options,
        )
        for trial in done.trials:
            value = trial.metrics.get(metric) if trial.clustering is not None else None
            sampler.learn(trial.params, None if value is None else sign * value)
        trials += done.trials
    return Search(trials, metric)
