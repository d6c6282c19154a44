"""Forecast with boosted trees, quarterly specialists, ridge and calibration."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import from_log, to_log
from tallycast.models.boosted import (
    DEFAULT_SPECS, Binned, Case, Fitted, TreeSpec, fit_cases, predict, predict_specialists, training_rows,
)
from tallycast.models.ridge import as_vectors, fit_ridge
from tallycast.operators import blend, metrics
from tallycast.operators.weights import split_holdout, stable_year_weight
from tallycast.plans import variants
from tallycast.session import cut_lineage


@dataclass(frozen=True)
class Training:
    """Long tables of a run: raw hold-out and future forecasts and what follows from them."""

    holdout: DataFrame
    future: DataFrame
    multipliers: variants.Multipliers
    holdout_variants: DataFrame
    future_variants: DataFrame
    scores: DataFrame
    best: DataFrame
    models: dict[tuple[str, str, int], Fitted]


def fitted_models(
    table: Binned, members: Mapping[str, Sequence[TreeSpec]], *, after: dt.date,
) -> dict[tuple[str, str, int], Fitted]:
    """All models of a run by target, booster and quarter (0 is the base model).

    Every target has its label in a column of its name.  All fits grow side by side
    on one binned table.
    """
    names = [(target, spec, quarter) for target, specs in members.items() for spec in specs for quarter in range(5)]
    cases = [Case(spec.specialist() if quarter else spec, f"label_{target}", quarter or None, after=after)
             for target, spec, quarter in names]
    return {(target, spec.name, quarter): one for (target, spec, quarter), one in zip(names, fit_cases(table, cases))}


def raw_forecasts(
    history: DataFrame,
    future: DataFrame,
    features: Sequence[str],
    *,
    keys: Sequence[str],
    after: dt.date,
    weights: Mapping[str, Mapping[str, float]],
    specs: Sequence[TreeSpec] = DEFAULT_SPECS,
    tuned: Mapping[tuple[str, str], Mapping[str, float]] | None = None,
    stable_years: tuple[int, int] = constants.STABLE_YEARS,
) -> tuple[DataFrame, DataFrame, dict[tuple[str, str, int], Fitted]]:
    """Blended hold-out and future forecasts of all targets (keys, Date, target, yhat), and the models.

    ``history`` and ``future`` carry the feature columns; members without
    weight are not trained.
    """
    by_day = [*keys, "Date"]
    usable = {target: blend.usable_weights(members, [spec.name for spec in specs]) for target, members in weights.items()}
    labels = {f"label_{target}": to_log(F.col(target)) for target in weights}
    labelled = history.withColumns(labels | {"weight": stable_year_weight(F.col("Date"), stable_years)})
    vectors = cut_lineage(as_vectors(labelled, features, [*by_day, *labels, "weight"]))
    ahead = cut_lineage(as_vectors(future, features, by_day))
    held = split_holdout(vectors, after)[1]
    chosen = {target: [spec.tuned((tuned or {}).get((target, spec.name), {})) for spec in specs if spec.name in usable[target]]
              for target in weights}
    models = fitted_models(training_rows(vectors, labels=list(labels)), chosen, after=after)

    results = []
    for part, where, early in (("holdout", held, True), ("future", ahead, False)):
        whole = None
        for target in weights:
            stacked = None
            for spec in chosen[target]:
                base, *quarters = (models[target, spec.name, quarter] for quarter in range(5))
                model = base.early if early and base.early is not None else base.full
                plain = predict(model, where, by_day).withColumnRenamed("yhat", "plain")
                expert = predict_specialists(dict(enumerate(quarters, 1)), where, by_day, early=early)
                mixed = expert.join(plain, by_day).select(
                    *by_day, F.lit(target).alias("target"), F.lit(spec.name).alias("model"),
                    blend.specialist_mix(F.col("yhat"), F.col("plain")).alias("yhat"))
                stacked = mixed if stacked is None else stacked.unionByName(mixed)
            linear_rows = split_holdout(labelled, after)[0] if early else labelled
            ridge = fit_ridge(linear_rows, features, f"label_{target}")
            trees = blend.weighted_blend(stacked, {target: usable[target]}, keys=by_day)
            days = split_holdout(labelled, after)[1] if early else future
            linear = days.select(*by_day, from_log(ridge.predict()).alias("linear"))
            mixed = trees.join(linear, by_day).select(
                *by_day, "target", blend.ridge_mix(F.col("linear"), F.col("yhat")).alias("yhat"))
            whole = mixed if whole is None else whole.unionByName(mixed)
        results.append(whole)
    return results[0], results[1], models


def train(
    history: DataFrame,
    future: DataFrame,
    features: Sequence[str],
    *,
    keys: Sequence[str],
    after: dt.date = constants.HOLDOUT_AFTER,
    weights: Mapping[str, Mapping[str, float]] = constants.BOOSTER_WEIGHTS,
    fixed: Mapping[str, float] = constants.FIXED_CALIBRATION,
    grid: tuple[float, float, float] = constants.CALIBRATION_GRID,
    **options,
) -> Training:
    """The whole pipeline for every target of ``weights``.

    One hold-out serves both the number of trees and the calibration, so its
    scores are slightly optimistic.
    """
    by_day = [*keys, "Date"]
    held_parts, future_parts, models = raw_forecasts(
        history, future, features, keys=keys, after=after, weights=weights, **options)
    truth = variants.targets_long(history, keys=by_day, value="y", targets=list(weights))
    scored = cut_lineage(held_parts.join(truth, [*by_day, "target"]))
    ahead = cut_lineage(future_parts)
    factors = variants.multipliers(scored, grid=grid)
    held_variants = variants.calibrated(scored, factors, fixed=fixed)
    scores = metrics.regression_metrics(held_variants, keys=["variant", "target"])
    return Training(
        holdout=scored, future=ahead, multipliers=factors, holdout_variants=held_variants,
        future_variants=variants.calibrated(ahead, factors, fixed=fixed),
        scores=scores, best=metrics.best_variant(scores), models=models)
