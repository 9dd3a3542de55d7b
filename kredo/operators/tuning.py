"""Model-based search of hyperparameters (M4): tree-structured Parzen proposals, poor trials ended early.

The first trials are drawn at random.  After them the finished trials are split into the best quarter and the
rest; each part gives the parameters a joint density (a normal kernel at each trial, and the uniform one as
prior).  Of some candidates drawn from the density of the good trials the one is tried where it most exceeds that of
the rest.

Trials run in rounds of ``width``.  All of a round run at a share of the full effort; the better half of the
round (ties, too) goes on to full effort.  Proposals depend on the seed and on finished rounds
only, so a search gives the same trials however long each takes.  The driver sees parameters and scores, never rows.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass


@dataclass(frozen=True)
class Range:
    """A parameter's bounds.  ``log``: equal ratios are equal steps.  ``digits``: 0 for whole numbers."""
    low: float
    high: float
    log: bool = False
    digits: int = 4

    def inner(self, x: float) -> float:
        """Place in 0..1."""
        if self.log:
            return math.log(x / self.low) / math.log(self.high / self.low)
        return (x - self.low) / (self.high - self.low)

    def outer(self, u: float) -> float | int:
        x = self.low * (self.high / self.low) ** u if self.log else self.low + u * (self.high - self.low)
        return min(int(self.high), max(int(self.low), round(x))) if self.digits == 0 else min(self.high, max(self.low, round(x, self.digits)))


@dataclass(frozen=True)
class Trial:
    number: int
    values: dict
    share: float
    score: float | None

    def rank(self) -> tuple:
        """Full trials before ended ones, then by score, then the earlier."""
        return self.share, -math.inf if self.score is None else self.score, -self.number


class Parzen:
    """Mixture over points of the unit cube: at each a product of normals cut to 0..1, and the uniform density."""

    def __init__(self, points: list[list[float]]):
        self.points = points
        self.width = max(0.08, 0.25 * len(points) ** (-1 / (4 + len(points[0])))) if points else 1.0

    def normal(self, x: float, centre: float) -> float:
        upto = lambda y: 0.5 * (1 + math.erf((y - centre) / (self.width * math.sqrt(2))))      # noqa: E731
        return math.exp(-0.5 * ((x - centre) / self.width) ** 2) / (self.width * math.sqrt(2 * math.pi) * (upto(1.0) - upto(0.0)))

    def density(self, x: list[float]) -> float:
        return (1.0 + sum(math.prod(map(self.normal, x, c)) for c in self.points)) / (len(self.points) + 1)

    def draw(self, rng: random.Random, n: int) -> list[float]:
        k = rng.randrange(len(self.points) + 1)
        return [rng.random() for _ in range(n)] if k == len(self.points) else [self.near(rng, c) for c in self.points[k]]

    def near(self, rng: random.Random, centre: float) -> float:
        while True:                              # the centre lies inside, so almost half of the draws at least do
            x = rng.gauss(centre, self.width)
            if 0.0 <= x <= 1.0:
                return x


def propose(done: list[Trial], space: dict[str, Range], number: int, seed: int, start: int, candidates: int = 24) -> dict:
    rng = random.Random(f"{seed}/{number}")
    drawn = [[rng.random() for _ in space]]
    if number >= start and done:
        ranked = sorted(done, key=Trial.rank, reverse=True)
        n_good = max(1, math.ceil(len(ranked) / 4))
        good, rest = (Parzen([[r.inner(t.values[p]) for p, r in space.items()] for t in part])
                      for part in (ranked[:n_good], ranked[n_good:]))
        drawn = [good.draw(rng, len(space)) for _ in range(candidates)]
        drawn.sort(key=lambda x: -good.density(x) / rest.density(x))
    return {p: r.outer(u) for (p, r), u in zip(space.items(), drawn[0])}


def search(objective: Callable[[dict, float], float | None], space: dict[str, Range], trials: int, seed: int = 42, start: int = 6,
           width: int = 4, share: float = 0.25) -> list[Trial]:
    """All trials by number.  ``objective(values, share)`` is a score to be made large; None ranks last.  With
    ``share`` 1 no trial is ended early."""
    done: list[Trial] = []
    with ThreadPoolExecutor(max_workers=max(1, width)) as pool:
        while len(done) < trials:
            numbers = range(len(done), min(trials, len(done) + width))
            tried = [propose(done, space, n, seed, start) for n in numbers]
            scores = list(pool.map(lambda v: objective(v, share), tried))
            if share < 1:
                known = sorted((s for s in scores if s is not None), reverse=True)
                least = known[(len(known) - 1) // 2] if known else math.inf
                goes_on = [s is not None and s >= least for s in scores]
                full = iter(list(pool.map(lambda v: objective(v, 1.0), [v for v, on in zip(tried, goes_on) if on])))
                done += [Trial(n, v, 1.0, next(full)) if on else Trial(n, v, share, s)
                         for n, v, s, on in zip(numbers, tried, scores, goes_on)]
            else:
                done += [Trial(n, v, 1.0, s) for n, v, s in zip(numbers, tried, scores)]
    return done


def best(done: list[Trial]) -> Trial:
    return max(done, key=Trial.rank)
