"""Guided search of parameters: a tree-structured Parzen sampler with early halving.

Trials are told apart by their score into a good share and the rest. Per parameter, each
side is a mixture of normals around its values (on the parameter's own scale) and a wide
one over its bounds; candidates are drawn from the good side's mixture, and the one that is
likeliest under good relative to the rest is tried next. The first trials are drawn evenly.

A trial is scored fold by fold. After a fold, a trial whose mean so far lies below the
median of the finished trials' means after as many folds is given up: its other folds are
never fitted. Trials and draws are seeded; without a time limit the same data give the same
trials.
"""

from __future__ import annotations

import math
import random
import statistics
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

START_TRIALS = 10
CANDIDATES = 24
GOOD_SHARE, MOST_GOOD = 0.25, 25


@dataclass(frozen=True)
class Bounds:
    """A parameter's range and scale: ``int``, ``float`` or ``log`` (log-uniform)."""

    low: float
    high: float
    kind: str = "float"

    def encode(self, value: float) -> float:
        return math.log(value) if self.kind == "log" else float(value)

    def decode(self, place: float) -> float | int:
        low, high = self.range
        place = min(max(place, low), high)
        if self.kind == "int":
            return min(max(round(place), round(self.low)), round(self.high))
        return min(max(math.exp(place), self.low), self.high) if self.kind == "log" else place

    @property
    def range(self) -> tuple[float, float]:
        if self.kind == "int":  # each number owns an interval of width 1
            return self.low - 0.5, self.high + 0.5
        return self.encode(self.low), self.encode(self.high)


@dataclass
class Trial:
    number: int
    params: dict[str, Any]
    scores: list[float] = field(default_factory=list)
    given_up: bool = False

    @property
    def mean(self) -> float:
        return sum(self.scores) / len(self.scores) if self.scores else float("-inf")


@dataclass
class SearchResult:
    """Best finished trial and what was done: trials asked for, run, given up, and whether
    the clock ended the search."""

    best: dict[str, Any]
    score: float
    trials: list[Trial]
    asked: int
    timed_out: bool

    def card(self) -> dict[str, Any]:
        return {
            "trials_asked": self.asked, "trials_run": len(self.trials),
            "trials_given_up": sum(t.given_up for t in self.trials), "timed_out": self.timed_out,
            "best_score": self.score if self.best else None, "best": self.best,
        }


class _Mixture:
    """Normals around points, cut at the bounds, and one over the whole range."""

    def __init__(self, points: Sequence[float], low: float, high: float):
        self.low, self.high = low, high
        width = max(high - low, 1e-12)
        points = sorted(points)
        self.parts = [((low + high) / 2, width)]
        floor = width / min(100.0, 1.0 + len(points))
        for k, x in enumerate(points):
            gaps = [x - points[k - 1] if k else x - low, points[k + 1] - x if k + 1 < len(points) else high - x]
            self.parts.append((x, min(max(*gaps, floor), width)))

    @staticmethod
    def _below(x: float, mean: float, spread: float) -> float:
        return 0.5 * (1 + math.erf((x - mean) / spread / math.sqrt(2)))

    def density(self, x: float) -> float:
        total = 0.0
        for mean, spread in self.parts:
            inside = self._below(self.high, mean, spread) - self._below(self.low, mean, spread)
            total += math.exp(-0.5 * ((x - mean) / spread) ** 2) / spread / max(inside, 1e-12)
        return total / len(self.parts) / math.sqrt(2 * math.pi)

    def draw(self, rng: random.Random) -> float:
        mean, spread = rng.choice(self.parts)
        for _ in range(100):
            x = rng.gauss(mean, spread)
            if self.low <= x <= self.high:
                return x
        return rng.uniform(self.low, self.high)


def suggest(space: Mapping[str, Bounds], trials: Sequence[Trial], rng: random.Random, start: int = START_TRIALS) -> dict[str, Any]:
    """Parameters of the next trial."""
    done = [t for t in trials if t.scores]
    if len(done) < start:
        return {n: b.decode(rng.uniform(*b.range)) for n, b in space.items()}
    # Trials that got further rank above those given up early at the same mean.
    ranked = sorted(done, key=lambda t: (t.given_up, -t.mean, t.number))
    count = min(max(1, math.ceil(GOOD_SHARE * len(ranked))), MOST_GOOD)
    good, rest = ranked[:count], ranked[count:]
    out = {}
    for name, bounds in space.items():
        sides = [_Mixture([bounds.encode(t.params[name]) for t in side], *bounds.range) for side in (good, rest)]
        drawn = [sides[0].draw(rng) for _ in range(CANDIDATES)]
        out[name] = bounds.decode(max(drawn, key=lambda x: sides[0].density(x) / sides[1].density(x)))
    return out


def search(
    space: Mapping[str, Bounds],
    evaluate: Callable[[dict[str, Any], int], float],
    trials: int,
    folds: int,
    seed: int = 42,
    timeout_seconds: float = float("inf"),
    start: int = START_TRIALS,
) -> SearchResult:
    """Maximise the mean of ``evaluate(params, fold)`` over the folds.

    No fold is begun after the timeout, but the first trial is always finished.
    """
    rng, begun, done = random.Random(seed), time.monotonic(), []
    timed_out = False

    def late() -> bool:
        return time.monotonic() - begun > timeout_seconds

    for number in range(trials):
        if done and late():
            timed_out = True
            break
        trial = Trial(number, suggest(space, done, rng, start))
        finished = [t for t in done if not t.given_up]
        for fold in range(folds):
            if done and fold and late():
                timed_out = trial.given_up = True
                break
            trial.scores.append(evaluate(trial.params, fold))
            before = [sum(t.scores[: fold + 1]) / (fold + 1) for t in finished]
            if fold + 1 < folds and len(before) >= start // 2 and trial.mean < statistics.median(before):
                trial.given_up = True
                break
        done.append(trial)
    finished = [t for t in done if not t.given_up]
    best = max(finished, key=lambda t: (t.mean, -t.number), default=None)
    return SearchResult(dict(best.params) if best else {}, best.mean if best else float("-inf"), done, trials, timed_out)
