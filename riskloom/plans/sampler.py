"""Trials drawn from what earlier trials showed: a tree-structured Parzen estimator.

The first STARTUP trials are drawn at random. From then on every parameter is drawn by itself: the best
trials and the others give a density each, both mixtures of normal kernels cut to the range, and
of CANDIDATES drawn from the first the one with the largest ratio of the two is taken.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass
from statistics import NormalDist

# Fixed values, those that Optuna's TPESampler has by default.
STARTUP = 10
CANDIDATES = 24
#: Share of the trials that count as best, and how many at most.
BEST_SHARE, MOST_BEST = 0.1, 25
#: Trials that weigh in full; of more, the earlier ones weigh less.
RECENT = 25

NORMAL = NormalDist()


@dataclass(frozen=True)
class Kernels:
    """Normal kernels cut to ``low`` to ``high``; with a ``step``, mass is that of a step around a value."""

    mus: list[float]
    sigmas: list[float]
    weights: list[float]
    low: float
    high: float
    step: float | None

    def _bounds(self, k: int) -> tuple[float, float]:
        return tuple(NORMAL.cdf((x - self.mus[k]) / self.sigmas[k]) for x in (self.low, self.high))

    def draw(self, rng: random.Random) -> float:
        k = rng.choices(range(len(self.mus)), self.weights)[0]
        below, above = self._bounds(k)
        p = min(max(rng.uniform(below, above), 1e-12), 1 - 1e-12)
        x = min(max(self.mus[k] + self.sigmas[k] * NORMAL.inv_cdf(p), self.low), self.high)
        if self.step is None:
            return x
        first, last = self.low + self.step / 2, self.high - self.step / 2
        return min(max(first + self.step * round((x - first) / self.step), first), last)

    def density(self, x: float) -> float:
        total = 0.0
        for k, weight in enumerate(self.weights):
            below, above = self._bounds(k)
            mu, sigma = self.mus[k], self.sigmas[k]
            if self.step is None:
                here = NORMAL.pdf((x - mu) / sigma) / sigma
            else:
                here = NORMAL.cdf((x + self.step / 2 - mu) / sigma) - NORMAL.cdf((x - self.step / 2 - mu) / sigma)
            total += weight * here / (above - below)
        return total


def kernels(seen: list[float], low: float, high: float, step: float | None = None) -> Kernels:
    """A kernel at each value seen, in order of the trials, as wide as it is far to its neighbours, and
    one over the whole range."""
    if step is not None:
        low, high = low - step / 2, high + step / 2
    n, prior = len(seen), (low + high) / 2
    order = sorted(range(n + 1), key=lambda k: [*seen, prior][k])
    ends = [low, *sorted([*seen, prior]), high]
    wide = [max(b - a, c - b) for a, b, c in zip(ends, ends[1:], ends[2:])]
    if n:  # the ends of the range are no neighbours
        wide[0], wide[-1] = ends[2] - ends[1], ends[-2] - ends[-3]
    least = (high - low) / min(100, n + 2)
    width = {k: min(max(w, least), high - low) for k, w in zip(order, wide)}
    ramp = n - RECENT
    # evenly from 1 / n up to 1
    older = [1 / n + (1 - 1 / n) * k / max(1, ramp - 1) for k in range(ramp)]
    weights = [*older, *[1.0] * min(n, RECENT), 1.0]
    return Kernels(
        [*seen, prior],
        [*(width[k] for k in range(n)), high - low],
        [w / sum(weights) for w in weights],
        low,
        high,
        step,
    )


def split(scores: list[float | None]) -> tuple[list[int], list[int]]:
    """Numbers of the best trials and of the others, both in order; higher is better, none is worst."""
    n = min(math.ceil(BEST_SHARE * len(scores)), MOST_BEST)
    ranked = sorted(range(len(scores)), key=lambda k: -math.inf if scores[k] is None else scores[k], reverse=True)
    return sorted(ranked[:n]), sorted(ranked[n:])


def suggest(
    rng: random.Random, seen: list[float], scores: list[float | None], low: float, high: float, step: float | None = None
) -> float:
    """The next value of a parameter that had the values ``seen`` in trials with these scores."""
    best, others = ([seen[k] for k in part] for part in split(scores))
    good, bad = kernels(best, low, high, step), kernels(others, low, high, step)
    ratio: Callable[[float], float] = lambda x: math.log(good.density(x)) - math.log(bad.density(x))
    return max((good.draw(rng) for _ in range(CANDIDATES)), key=ratio)
