"""Adaptive search of booster parameters on the time hold-out: a tree-structured
Parzen estimator with several trials in flight."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.models.boosted import Binned, Case, TreeSpec, fit_cases

WARM_TRIALS = 10
TRIALS_AT_ONCE = 4
CANDIDATES = 24
GOOD_SHARE = 0.1
MOST_GOOD = 25

# Searched ranges per booster as (kind, low, high).
SPACES = {
    "squared": {
        "step": ("log", 0.01, 0.1), "depth": ("int", 3, 7), "min_leaf": ("int", 5, 100),
        "feature_share": ("real", 0.5, 1.0), "row_share": ("real", 0.5, 1.0),
    },
    "absolute": {
        "step": ("log", 0.01, 0.1), "depth": ("int", 3, 7), "min_leaf": ("int", 1, 50),
        "row_share": ("real", 0.5, 1.0), "feature_share": ("real", 0.5, 1.0),
    },
    "median": {
        "step": ("log", 0.01, 0.1), "depth": ("int", 3, 7), "min_leaf": ("int", 5, 100),
        "row_share": ("real", 0.5, 1.0), "feature_share": ("real", 0.5, 1.0),
    },
    "deep": {"step": ("log", 0.01, 0.15), "depth": ("int", 4, 7)},
    "histogram": {
        "step": ("log", 0.01, 0.1), "rounds": ("int", 300, 1500), "depth": ("int", 4, 7),
        "min_leaf": ("int", 10, 80),
    },
}


def draw(space: Mapping[str, tuple], random: np.random.Generator) -> dict[str, float]:
    """One parameter set, each value on its own."""
    return {name: _value(one, random.uniform(*_bounds(one))) for name, one in space.items()}


def _bounds(one: tuple) -> tuple[float, float]:
    """Ends of the scale on which a parameter is searched; whole numbers own half a
    step to either side."""
    kind, low, high = one
    if kind == "log":
        return math.log(low), math.log(high)
    return (low - 0.5, high + 0.5) if kind == "int" else (float(low), float(high))


def _value(one: tuple, at: float) -> float:
    kind, low, high = one
    value = math.exp(at) if kind == "log" else at
    return float(min(max(round(value) if kind == "int" else value, low), high))


def _place(one: tuple, value: float) -> float:
    return math.log(value) if one[0] == "log" else float(value)


class Parzen:
    """Density of the places tried: a bell over each, as wide as the distance to the
    neighbours, and one wide bell over the whole scale, cut off at its ends."""

    def __init__(self, places: Sequence[float], low: float, high: float) -> None:
        span = max(high - low, 1e-12)
        order = np.sort(np.append(np.array(places, float), (low + high) / 2))
        gaps = np.diff(np.concatenate([[low], order, [high]]))
        width = np.clip(np.maximum(gaps[:-1], gaps[1:]), span / min(100.0, len(order) + 1.0), span)
        width[np.searchsorted(order, (low + high) / 2)] = span
        self.low, self.high, self.middle, self.width = low, high, order, width

    def _below(self, at: float) -> np.ndarray:
        return np.array([0.5 * (1 + math.erf((at - m) / (w * math.sqrt(2)))) for m, w in zip(self.middle, self.width)])

    def draw(self, count: int, random: np.random.Generator) -> np.ndarray:
        chosen = random.integers(0, len(self.middle), count)
        out = random.normal(self.middle[chosen], self.width[chosen])
        for _ in range(100):
            outside = (out < self.low) | (out > self.high)
            if not outside.any():
                break
            out[outside] = random.normal(self.middle[chosen], self.width[chosen])[outside]
        return np.clip(out, self.low, self.high)

    def log_density(self, at: np.ndarray) -> np.ndarray:
        inside = self._below(self.high) - self._below(self.low)
        z = (at[:, None] - self.middle) / self.width
        bells = np.exp(-0.5 * z * z) / (self.width * math.sqrt(2 * math.pi) * np.maximum(inside, 1e-12))
        return np.log(np.maximum(bells.mean(axis=1), 1e-300))


def propose(
    space: Mapping[str, tuple], done: Sequence[tuple[Mapping[str, float], float]],
    running: Sequence[Mapping[str, float]], random: np.random.Generator, *, warm: int = WARM_TRIALS,
) -> dict[str, float]:
    """The next parameter set: drawn freely for the first trials, then near good ones
    and away from the others.

    For every parameter the best trials and the rest make a density each; of
    ``CANDIDATES`` draws from the first the one with the largest quotient of both is
    taken.  Trials still running count among the rest, so that they are not repeated.
    """
    if len(done) < warm:
        return draw(space, random)
    ordered = sorted(range(len(done)), key=lambda k: done[k][1])
    count = min(math.ceil(GOOD_SHARE * len(done)), MOST_GOOD)
    good = [done[k][0] for k in ordered[:count]]
    rest = [done[k][0] for k in ordered[count:]] + list(running)
    out = {}
    for name, one in space.items():
        low, high = _bounds(one)
        near = Parzen([_place(one, trial[name]) for trial in good], low, high)
        far = Parzen([_place(one, trial[name]) for trial in rest], low, high)
        places = near.draw(CANDIDATES, random)
        out[name] = _value(one, float(places[np.argmax(near.log_density(places) - far.log_density(places))]))
    return out


def study(
    space: Mapping[str, tuple], score: Callable[[list[dict[str, float]]], list[float]], *, trials: int,
    seed: int = constants.SEED, at_once: int = TRIALS_AT_ONCE, warm: int = WARM_TRIALS,
) -> list[tuple[dict[str, float], float]]:
    """Parameter sets with their scores in the order of their trials; ``score`` gets the
    sets of a wave together.  Reruns give the same trials."""
    random, done = np.random.default_rng(seed), []
    while len(done) < trials:
        wave: list[dict[str, float]] = []
        for _ in range(min(at_once, trials - len(done))):
            wave.append(propose(space, done, wave, random, warm=warm))
        done += list(zip(wave, score(wave)))
    return done


def search(
    table: Binned, specs: Sequence[TreeSpec], *, target: str, after: dt.date, trials: int,
    spaces: Mapping[str, Mapping[str, tuple]] = SPACES, seed: int = constants.SEED, label: str = "label",
    at_once: int = TRIALS_AT_ONCE,
) -> DataFrame:
    """Trials as rows: target, model, trial, params, score (MAE of the log target).

    All trials share one binned table and those of a wave grow side by side; only
    parameters and scores pass the driver.
    """
    results = []
    for spec in specs:
        def scored(wave: list[dict[str, float]], spec: TreeSpec = spec) -> list[float]:
            cases = [Case(spec.tuned(one), label, after=after, refit=False) for one in wave]
            return [min(fitted.absolute) for fitted in fit_cases(table, cases)]

        found = study(spaces[spec.name], scored, trials=trials, seed=seed, at_once=at_once)
        results += [(target, spec.name, trial, params, score) for trial, (params, score) in enumerate(found)]
    return table.blocks.sparkSession.createDataFrame(
        results, "target string, model string, trial int, params map<string, double>, score double")


def best_trials(trials: DataFrame) -> DataFrame:
    """The best parameter set per target and model, the earlier trial on ties."""
    return trials.groupBy("target", "model").agg(
        F.min_by("params", F.struct("score", "trial")).alias("params"),
        F.min("score").alias("score"))
