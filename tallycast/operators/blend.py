"""Blends, anchors and caps of forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import at_least, at_most, ratio


def mix(first: Column, second: Column, share: float) -> Column:
    """``share`` of the first and the rest of the second forecast."""
    return first * share + second * (1.0 - share)


def specialist_mix(specialist: Column, base: Column) -> Column:
    return mix(specialist, base, constants.SPECIALIST_SHARE)


def ridge_mix(ridge: Column, trees: Column) -> Column:
    return mix(ridge, trees, constants.RIDGE_SHARE)


def usable_weights(weights: Mapping[str, float], present: Sequence[str]) -> dict[str, float]:
    """Weights of the members that exist; a missing last member's weight goes to the first."""
    names = list(weights)
    kept = {name: weights[name] for name in names if name in present and weights[name] != 0}
    if names[-1] not in present and len(names) > 3:
        kept[names[0]] = kept.get(names[0], 0.0) + weights[names[-1]]
    return kept


def weighted_blend(
    predictions: DataFrame,
    weights: Mapping[str, Mapping[str, float]],
    *,
    keys: Sequence[str],
) -> DataFrame:
    """Blend long predictions (…, target, model, yhat) by weights per target and model."""
    factor = F.coalesce(*[
        F.when((F.col("target") == target) & (F.col("model") == model), F.lit(weight))
        for target, members in weights.items() for model, weight in members.items()
    ], F.lit(0.0))
    return predictions.groupBy(*keys, "target").agg(F.sum(factor * F.col("yhat")).alias("yhat"))


def mean_over_runs(predictions: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Average over seeds or models, not below zero."""
    return predictions.groupBy(*keys).agg(at_least(F.avg("yhat"), 0.0).alias("yhat"))


def anchor_to_mean(
    forecast: DataFrame, anchors: Mapping[str, float], *, keys: Sequence[str]
) -> DataFrame:
    """Scale each column so that its mean over the series' forecast days is the anchor."""
    days = Window.partitionBy(*keys)
    return forecast.withColumns({
        name: F.col(name) * ratio(F.lit(level), F.avg(name).over(days))
        for name, level in anchors.items()
    })


def cap_cogs(forecast: DataFrame, share: float = constants.COGS_CAP) -> DataFrame:
    return forecast.withColumn("COGS", at_most(F.col("COGS"), F.col("Revenue") * share))


def cogs_from_ratio(
    forecast: DataFrame, ratios: DataFrame, *, keys: Sequence[str], share: float = constants.COGS_CAP
) -> DataFrame:
    """COGS as the series' usual part of Revenue, capped."""
    priced = forecast.join(ratios, list(keys)).withColumn(
        "COGS", F.col("Revenue") * F.col("cogs_ratio")).drop("cogs_ratio")
    return cap_cogs(priced, share)


def blend_tables(
    left: DataFrame, right: DataFrame, *, share: float, keys: Sequence[str],
    targets: Sequence[str] = constants.TARGETS,
) -> DataFrame:
    """Blend two finished forecast tables by key."""
    other = right.select(*keys, *[F.col(name).alias(f"__{name}") for name in targets])
    return left.join(other, list(keys)).select(
        *keys, *[mix(F.col(name), F.col(f"__{name}"), share).alias(name) for name in targets])


def rescale(forecast: DataFrame, factors: Mapping[str, float]) -> DataFrame:
    return forecast.withColumns({name: F.col(name) * f for name, f in factors.items()})
