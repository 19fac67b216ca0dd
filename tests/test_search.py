"""The guided search on planted surfaces."""

import math
import random
import statistics

import pytest

from wardline.operators.search import Bounds, Trial, search, suggest

SPACE = {"depth": Bounds(3, 8, "int"), "rate": Bounds(0.01, 0.3, "log"), "trees": Bounds(100, 1000, "int"), "share": Bounds(0.6, 1.0)}


def surface(params, fold=0):
    """Best at depth 5, rate 0.05, 700 trees, share 0.8; folds differ a little."""
    off = ((params["depth"] - 5) / 5) ** 2 + (math.log(params["rate"] / 0.05) / 3.4) ** 2
    off += ((params["trees"] - 700) / 900) ** 2 + ((params["share"] - 0.8) / 0.4) ** 2
    return 0.9 - off + 0.01 * math.sin(fold)


def test_better_than_random_at_thirty_trials():
    guided, drawn = [], []
    for seed in range(25):
        guided.append(search(SPACE, surface, 30, 1, seed).score)
        rng = random.Random(seed)
        drawn.append(max(surface({n: b.decode(rng.uniform(*b.range)) for n, b in SPACE.items()}) for _ in range(30)))
    assert statistics.mean(guided) > statistics.mean(drawn) + 0.01
    assert sum(g > d for g, d in zip(guided, drawn)) >= 18


def test_bounds_and_kinds_hold():
    found = search(SPACE, surface, 40, 2, 1)
    for trial in found.trials:
        assert 3 <= trial.params["depth"] <= 8 and isinstance(trial.params["depth"], int)
        assert 0.01 <= trial.params["rate"] <= 0.3 and 100 <= trial.params["trees"] <= 1000 and 0.6 <= trial.params["share"] <= 1
    assert {t.params["depth"] for t in found.trials} >= {4, 5, 6}


def test_log_scale_is_drawn_evenly_by_magnitude():
    rng = random.Random(0)
    drawn = [suggest({"r": Bounds(0.001, 1.0, "log")}, [], rng)["r"] for _ in range(900)]
    parts = [sum(a <= x < 10 * a for x in drawn) for a in (0.001, 0.01, 0.1)]
    assert all(250 < p < 350 for p in parts)


def test_poor_trials_stop_after_their_first_folds():
    calls = []

    def evaluate(params, fold):
        calls.append((tuple(params.items()), fold))
        return surface(params, fold)

    found = search(SPACE, evaluate, 30, 5, 3)
    card = found.card()
    assert card["trials_given_up"] > 5 and card["trials_run"] == card["trials_asked"] == 30
    assert len(calls) == sum(len(t.scores) for t in found.trials) < 30 * 5
    best = max((t for t in found.trials if len(t.scores) == 5), key=lambda t: t.mean)
    assert found.best == best.params and not best.given_up


def test_repeats_with_its_seed():
    one, two = (search(SPACE, surface, 15, 2, 9) for _ in range(2))
    assert [t.params for t in one.trials] == [t.params for t in two.trials]
    assert [t.params for t in search(SPACE, surface, 15, 2, 8).trials] != [t.params for t in one.trials]


def test_the_clock_is_reported():
    found = search(SPACE, surface, 50, 3, 1, timeout_seconds=-1)
    assert found.card()["trials_run"] == 1 and found.timed_out and found.best


@pytest.mark.parametrize("bounds", [Bounds(5, 5, "int"), Bounds(0.5, 0.5), Bounds(0.1, 0.1, "log")])
def test_a_single_value(bounds):
    done = [Trial(k, {"x": bounds.low}, [0.5]) for k in range(20)]
    assert suggest({"x": bounds}, done, random.Random(1))["x"] == pytest.approx(bounds.low)


def test_no_trials():
    assert search(SPACE, surface, 0, 3).best == {}
