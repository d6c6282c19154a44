"""Training weights and the time-based hold-out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.operators.windows import days_to_latest


def stable_year_weight(
    date: Column,
    years: tuple[int, int] = constants.STABLE_YEARS,
    other: float = constants.OTHER_YEAR_WEIGHT,
) -> Column:
    return F.when(F.year(date).between(*years), F.lit(1.0)).otherwise(F.lit(other))


def decay_weight(
    date: str, keys: Sequence[str], half_life: float = constants.DECAY_HALF_LIFE_DAYS
) -> Column:
    return F.pow(F.lit(0.5), days_to_latest(date, keys) / F.lit(float(half_life)))


def quarter_weight(
    weight: Column, date: Column, quarter: int, boost: float = constants.QUARTER_BOOST
) -> Column:
    return F.when(F.quarter(date) == quarter, weight * boost).otherwise(weight)


def in_holdout(date: Column, after: dt.date, until: dt.date | None = None) -> Column:
    """True for rows that are scored and not trained on: strictly after ``after``."""
    late = date > F.lit(after)
    return late if until is None else late & (date <= F.lit(until))


def split_holdout(df: DataFrame, after: dt.date, until: dt.date | None = None):
    """(training rows, hold-out rows)."""
    return df.where(F.col("Date") <= F.lit(after)), df.where(in_holdout(F.col("Date"), after, until))


def stable_weight_share(
    years: tuple[int, int] = constants.STABLE_YEARS,
    other: float = constants.OTHER_YEAR_WEIGHT,
) -> Column:
    """Aggregate: part of the total weight that the stable years carry."""
    weight = stable_year_weight(F.col("Date"), years, other)
    stable = F.year("Date").between(*years)
    return F.sum(F.when(stable, weight).otherwise(0.0)) / F.sum(weight)
