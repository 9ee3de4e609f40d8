"""Search for the settings of the highest objective, each trial chosen by those before it.

Sampling follows the tree-structured Parzen estimator of Bergstra et al., "Algorithms for
Hyper-Parameter Optimization" (NeurIPS 2011): the best trials and the others each give a
density over every setting, and of some draws from the density of the best the one with the
largest ratio of both is tried next. The first ``STARTUP`` trials are drawn evenly. A trial
is whatever the caller's objective does, usually a Spark job; here is only the choice."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

STARTUP, CANDIDATES, GOOD_SHARE, MOST_GOOD = 10, 24, 0.1, 25
REDRAWS = 100


@dataclass(frozen=True)
class Number:
    """A number between ``low`` and ``high``, both included; whole if ``whole``."""

    low: float
    high: float
    whole: bool = False

    def _shown(self, x: float):
        return int(min(max(round(x), self.low), self.high)) if self.whole else float(min(max(x, self.low), self.high))

    def draw(self, rng: np.random.Generator):
        pad = 0.5 if self.whole else 0.0
        return self._shown(rng.uniform(self.low - pad, self.high + pad))

    def _kernels(self, seen: list) -> tuple[np.ndarray, np.ndarray]:
        """One bell per trial and a wide one for the whole range; a bell is as wide as
        the way to its farther neighbour."""
        span = float(self.high - self.low) or 1.0
        centers = np.array([(self.low + self.high) / 2, *sorted(map(float, seen))])
        line = np.concatenate([[self.low], centers[1:], [self.high]])
        near = np.maximum(np.diff(line)[:-1], np.diff(line)[1:]) if len(seen) else np.empty(0)
        widths = np.concatenate([[span], np.clip(near, span / min(100, 1 + len(centers)), span)])
        return centers, widths

    def draw_from(self, seen: list, rng: np.random.Generator):
        centers, widths = self._kernels(seen)
        i = rng.integers(len(centers))
        for _ in range(REDRAWS):
            x = rng.normal(centers[i], widths[i])
            if self.low <= x <= self.high:
                break
        return self._shown(x)

    def log_density(self, x, seen: list) -> float:
        centers, widths = self._kernels(seen)
        cdf = lambda z: 0.5 * (1 + np.vectorize(math.erf)(z / math.sqrt(2)))
        inside = cdf((self.high - centers) / widths) - cdf((self.low - centers) / widths)
        bells = np.exp(-0.5 * ((x - centers) / widths) ** 2) / (widths * np.maximum(inside, 1e-12))
        return float(np.log(bells.mean() + 1e-300))

    @property
    def options(self) -> tuple | None:
        return tuple(range(int(self.low), int(self.high) + 1)) if self.whole else None


@dataclass(frozen=True)
class Choice:
    """One of ``options``."""

    options: tuple

    def _shares(self, seen: list) -> np.ndarray:
        counts = np.array([1.0 + sum(s == o for s in seen) for o in self.options])
        return counts / counts.sum()

    def draw(self, rng: np.random.Generator):
        return self.options[int(rng.integers(len(self.options)))]

    def draw_from(self, seen: list, rng: np.random.Generator):
        return self.options[int(rng.choice(len(self.options), p=self._shares(seen)))]

    def log_density(self, x, seen: list) -> float:
        return float(np.log(self._shares(seen)[self.options.index(x)]))


Space = dict[str, "Number | Choice"]


def suggest(space: Space, trials: list[tuple[dict, float]], rng: np.random.Generator, startup: int = STARTUP) -> dict:
    """Settings to try next, given the trials so far (settings and objective; a missing
    objective counts as the worst). In a finite space no setting is tried twice while
    another is left."""
    tried = [t[0] for t in trials]
    untried = _untried(space, tried)
    if len(trials) < startup:
        found = [{name: p.draw(rng) for name, p in space.items()}]
    else:
        order = sorted(range(len(trials)), key=lambda i: (-(trials[i][1] if trials[i][1] == trials[i][1] else -math.inf), i))
        good = set(order[: min(MOST_GOOD, math.ceil(GOOD_SHARE * len(trials)))])
        found = []
        densities = {name: ([t[name] for i, t in enumerate(tried) if i in good], [t[name] for i, t in enumerate(tried) if i not in good]) for name in space}
        for _ in range(CANDIDATES):
            one = {name: p.draw_from(densities[name][0], rng) for name, p in space.items()}
            ratio = sum(p.log_density(one[name], densities[name][0]) - p.log_density(one[name], densities[name][1]) for name, p in space.items())
            found.append((ratio, one))
        found = [one for _, one in sorted(found, key=lambda x: -x[0])]
    if untried is None:
        return found[0]
    fresh = [one for one in found if one in untried]
    return fresh[0] if fresh else untried[int(rng.integers(len(untried)))] if untried else found[0]


def _untried(space: Space, tried: list[dict]) -> list[dict] | None:
    """Settings that are left in a small finite space; None if it is none."""
    sizes = [len(p.options) if p.options is not None else None for p in space.values()]
    if None in sizes or math.prod(sizes) > 10_000:
        return None
    return [one for values in itertools.product(*(p.options for p in space.values())) if (one := dict(zip(space, values))) not in tried]


def study(objective: Callable[[dict], float], space: Space, n_trials: int, seed: int = 0, startup: int = STARTUP) -> list[tuple[dict, float]]:
    """Settings and objectives of ``n_trials`` trials, one after the other."""
    rng = np.random.default_rng(seed)
    trials: list[tuple[dict, float]] = []
    for _ in range(n_trials):
        settings = suggest(space, trials, rng, startup)
        value = objective(settings)
        trials.append((settings, math.nan if value is None else float(value)))
    return trials


def trial_table(spark: SparkSession, trials: list[tuple[dict, float]], schema: str) -> DataFrame:
    """``run_no, <settings of schema>, score``."""
    names = [c.split()[0] for c in schema.split(", ")]
    rows = [(i, *(t[n] for n in names), None if v != v else v) for i, (t, v) in enumerate(trials)]
    return spark.createDataFrame(rows, f"run_no int, {schema}, score double")
