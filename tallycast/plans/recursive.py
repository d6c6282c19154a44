"""Recursive pipeline: lag features, time-decayed history, level anchors."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import at_least, from_log, to_log
from tallycast.models.boosted import TreeSpec, fit_with_holdout, training_rows
from tallycast.models.forest import NamedForest
from tallycast.models.recursive import recursive_forecast
from tallycast.models.ridge import RidgeModel, as_vectors, fit_ridge
from tallycast.operators import blend, metrics
from tallycast.operators.dynamic import dynamic_names, with_dynamic_features
from tallycast.operators.features import attach_days
from tallycast.operators.weights import decay_weight, split_holdout
from tallycast.session import cut_lineage


def training_frame(
    panel: DataFrame, calendar: DataFrame, target: str, *, keys: Sequence[str], warmup_end: dt.date
) -> DataFrame:
    """Dense panel with past-value features of its own target, calendar features and
    weights that fade with age, without the first rows whose lags reach before the history."""
    weighted = panel.select(*keys, "Date", target, decay_weight("Date", keys).alias("weight"))
    moving = with_dynamic_features(weighted, target, keys=keys)
    warm = moving.where(F.col("Date") >= F.lit(warmup_end))
    return attach_days(warm, calendar).withColumn("label", to_log(F.col(target)))


def fit_trees(
    frame: DataFrame, features: Sequence[str], spec: TreeSpec, *, keys: Sequence[str], after: dt.date,
) -> NamedForest:
    """A forest on calendar and past values; the hold-out decides its size."""
    vectors = as_vectors(frame, features, [*keys, "Date", "label", "weight"])
    return NamedForest(tuple(features), fit_with_holdout(spec, training_rows(vectors), after=after).full)


def holdout_scores(
    frame: DataFrame, features: Sequence[str], target: str, *, after: dt.date
) -> DataFrame:
    """One-step scores of a model fitted on the rows before the hold-out only."""
    train, held = split_holdout(frame, after)
    model = fit_ridge(train, features, "label", weight="weight")
    scored = held.select(
        F.lit(target).alias("target"), F.col(target).alias("y"),
        at_least(from_log(model.predict()), 0.0).alias("yhat"))
    return metrics.regression_metrics(scored, keys=["target"])


def recursive_plan(
    panel: DataFrame,
    calendar: DataFrame,
    future_calendar: DataFrame,
    calendar_features: Sequence[str],
    *,
    keys: Sequence[str],
    warmup_end: dt.date,
    anchors: Mapping[str, float] = constants.RECURSIVE_ANCHOR,
    trees: TreeSpec | None = None,
    after: dt.date = constants.HOLDOUT_AFTER,
) -> tuple[DataFrame, dict[str, RidgeModel | NamedForest]]:
    """Anchored and capped Revenue and COGS forecasts, and the fitted models: ridge, or
    forests whose size the rows after ``after`` decide."""
    by_day = [*keys, "Date"]
    result, models = None, {}
    for target in anchors:
        features = [*calendar_features, *dynamic_names(target)]
        frame = cut_lineage(training_frame(
            panel, calendar, target, keys=keys, warmup_end=warmup_end))
        models[target] = fit_ridge(frame, features, "label", weight="weight") if trees is None else fit_trees(
            frame, features, trees, keys=keys, after=after)
        part = recursive_forecast(panel, future_calendar, models[target], target, keys=keys)
        result = part if result is None else result.join(part, by_day)
    anchored = blend.anchor_to_mean(cut_lineage(result), anchors, keys=keys)
    capped = blend.cap_cogs(anchored)
    return capped.withColumns({name: at_least(F.col(name), 0.0) for name in anchors}), models
