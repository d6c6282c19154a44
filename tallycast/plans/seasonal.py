"""Seasonal baseline: level of the last full year, yearly growth, day-of-year profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import ratio, round_half_even


def yearly_totals(
    sales: DataFrame, *, keys: Sequence[str], targets: Sequence[str] = constants.TARGETS
) -> DataFrame:
    return sales.groupBy(*keys, F.year("Date").alias("year")).agg(
        *[F.sum(name).alias(name) for name in targets])


def growth_and_level(
    sales: DataFrame, *, keys: Sequence[str], full_years: tuple[int, int], base_year: int,
    targets: Sequence[str] = constants.TARGETS,
) -> DataFrame:
    """Yearly growth factor and daily level of each series.

    The geometric mean of consecutive growth factors is the root of the last
    total over the first.  The level is the base year's total over 365 days.
    """
    full = F.col("year").between(*full_years)
    steps = F.count_if(full) - 1
    columns = []
    for name in targets:
        known = F.when(full, F.col(name))
        first = F.min_by(known, F.when(full, F.col("year")))
        last = F.max_by(known, F.when(full, F.col("year")))
        columns.append(F.pow(ratio(last, first), ratio(F.lit(1.0), steps)).alias(f"growth_{name}"))
        base = F.sum(F.when(F.col("year") == base_year, F.col(name)))
        columns.append((base / 365).alias(f"level_{name}"))
    return yearly_totals(sales, keys=keys, targets=targets).groupBy(*keys).agg(*columns)


def profile(
    sales: DataFrame, *, keys: Sequence[str], targets: Sequence[str] = constants.TARGETS
) -> DataFrame:
    """Mean of the values, each relative to its year's mean, per month and day."""
    year = Window.partitionBy(*keys, F.year("Date"))
    scaled = sales.select(*keys, "Date", *[
        ratio(F.col(name), F.avg(name).over(year)).alias(name) for name in targets])
    return scaled.groupBy(
        *keys, F.month("Date").alias("month"), F.dayofmonth("Date").alias("day"),
    ).agg(*[F.avg(name).alias(f"norm_{name}") for name in targets])


def seasonal_forecast(
    sales: DataFrame,
    days: DataFrame,
    *,
    keys: Sequence[str],
    full_years: tuple[int, int],
    base_year: int,
    targets: Sequence[str] = constants.TARGETS,
    digits: int | None = 2,
) -> DataFrame:
    """Forecast of ``days`` (keys and Date): level × growth ^ years ahead × profile.

    Days without a profile entry (29 February) use factor 1.
    """
    keys = list(keys)
    base = growth_and_level(
        sales, keys=keys, full_years=full_years, base_year=base_year, targets=targets)
    shape = profile(sales, keys=keys, targets=targets)
    asked = days.select(
        *keys, "Date", F.month("Date").alias("month"), F.dayofmonth("Date").alias("day"))
    joined = asked.join(base, keys).join(
        shape, [*keys, "month", "day"], "left")
    ahead = F.year("Date") - base_year
    values = []
    for name in targets:
        value = (F.col(f"level_{name}") * F.pow(F.col(f"growth_{name}"), ahead)
                 * F.coalesce(F.col(f"norm_{name}"), F.lit(1.0)))
        values.append((value if digits is None else round_half_even(value, digits)).alias(name))
    return joined.select(*keys, "Date", *values)
