"""Calibrated variants of a raw forecast, their scores and published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.operators.calibration import best_multiplier, factor_of


def with_quarter(df: DataFrame) -> DataFrame:
    return df.withColumn("quarter", F.quarter("Date"))


@dataclass(frozen=True)
class Multipliers:
    """Fitted factors: one per target, and one per target and quarter."""

    overall: dict[str, float]
    quarterly: dict[tuple[str, int], float]


def multipliers(scored: DataFrame, *, grid=constants.CALIBRATION_GRID) -> Multipliers:
    """Fit the factors on long scored rows (target, Date, y, yhat).

    At most five numbers per target come back to the driver; they enter later
    plans as constants, so applying them needs no join.
    """
    overall = best_multiplier(scored, keys=["target"], grid=grid)
    quarterly = best_multiplier(with_quarter(scored), keys=["target", "quarter"], grid=grid)
    return Multipliers(
        overall={row.target: row.multiplier for row in overall.collect()},
        quarterly={(row.target, row.quarter): row.multiplier for row in quarterly.collect()},
    )


def calibrated(
    raw: DataFrame,
    factors: Multipliers,
    *,
    fixed: Mapping[str, float] = constants.FIXED_CALIBRATION,
) -> DataFrame:
    """Long forecast rows (target, Date, yhat, …) under every calibration variant.

    A quarter that the hold-out does not contain keeps its raw forecast.
    """
    target, quarter = F.col("target"), F.quarter("Date")
    by_quarter = [
        F.when((target == name) & (quarter == q), F.lit(factor))
        for (name, q), factor in factors.quarterly.items()
    ]
    choices = F.array(
        F.struct(F.lit("global").alias("variant"), factor_of(target, factors.overall).alias("factor")),
        F.struct(F.lit("per_q").alias("variant"), F.coalesce(*by_quarter, F.lit(1.0)).alias("factor")),
        F.struct(F.lit("default").alias("variant"), factor_of(target, fixed).alias("factor")),
    )
    kept = [name for name in raw.columns if name != "yhat"]
    return raw.select(*kept, "yhat", F.inline(choices)).select(
        *kept, (F.col("yhat") * F.col("factor")).alias("yhat"), "variant")


def targets_wide(
    long: DataFrame, *, keys: Sequence[str], targets: Sequence[str] = constants.TARGETS
) -> DataFrame:
    """One column per target."""
    return long.groupBy(*keys).pivot("target", list(targets)).agg(F.first("yhat"))


def targets_long(
    wide: DataFrame, *, keys: Sequence[str], value: str = "yhat",
    targets: Sequence[str] = constants.TARGETS,
) -> DataFrame:
    return wide.select(*keys, *targets).unpivot(list(keys), list(targets), "target", value)


def score_against(
    forecast: DataFrame, actual: DataFrame, *, keys: Sequence[str],
    targets: Sequence[str] = constants.TARGETS,
) -> DataFrame:
    """Long rows (keys, target, yhat, y) of the days both tables have."""
    truth = targets_long(actual, keys=keys, value="y", targets=targets)
    return targets_long(forecast, keys=keys, targets=targets).join(truth, [*keys, "target"])
