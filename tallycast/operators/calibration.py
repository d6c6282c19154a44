"""Scalar calibration of forecasts.

The error of a multiplier is a sum of kinked lines, one per row with the kink
at actual / predicted.  Rows are bucketed by the grid cell of their kink and
summed; running sums over the cells then give the error at every grid point.
One pass over the rows replaces one pass per grid point.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast import constants


def grid_size(grid: tuple[float, float, float]) -> int:
    start, end, step = grid
    return len(np.arange(start, end + step, step))


def calibration_errors(
    scored: DataFrame,
    *,
    keys: Sequence[str],
    grid: tuple[float, float, float] = constants.CALIBRATION_GRID,
    actual: str = "y",
    predicted: str = "yhat",
) -> DataFrame:
    """MAE of every grid multiplier per group: keys, multiplier, mae."""
    start, _, step = grid
    points = grid_size(grid)
    # |y - m*p| does not change when both signs flip, so p can be taken as >= 0.
    sign = F.when(F.col(predicted) < 0, -1.0).otherwise(1.0)
    rows = scored.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).select(
        *keys, (F.col(actual) * sign).alias("y"), (F.col(predicted) * sign).alias("p"))
    kink = F.try_divide(F.col("y"), F.col("p"))
    # Cell c holds kinks in (grid[c-1], grid[c]]; rows without a kink never change.
    cell = F.ceil((kink - start) / step)
    cell = F.when(kink.isNull(), F.lit(-1)).otherwise(
        F.least(F.greatest(cell, F.lit(0)), F.lit(points))).cast("int")
    cells = rows.withColumn("cell", cell).groupBy(*keys, "cell").agg(
        F.sum(F.when(F.col("cell") >= 0, F.col("y")).otherwise(0.0)).alias("sy"),
        F.sum(F.when(F.col("cell") >= 0, F.col("p")).otherwise(0.0)).alias("sp"),
        F.sum(F.when(F.col("cell") < 0, F.abs("y")).otherwise(0.0)).alias("fixed"),
        F.count(F.lit(1)).alias("n"),
    )
    # One array of cells per group: its length is bounded by the grid.
    packed = cells.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("fixed").alias("fixed"),
        F.sum("sy").alias("ty"),
        F.sum("sp").alias("tp"),
    )
    every = packed.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    partial = cells.where(F.col("cell") >= 0).select(*keys, "cell", "sy", "sp")
    filled = every.join(partial, [*keys, "cell"], "left") if keys else every.join(
        partial, "cell", "left")
    # A group has one row per grid point, so without keys the window holds the grid.
    up_to = Window.partitionBy(*keys).orderBy("cell").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    multiplier = F.lit(start) + F.col("cell") * F.lit(step)
    below_y, below_p = F.sum(F.coalesce("sy", F.lit(0.0))).over(up_to), F.sum(
        F.coalesce("sp", F.lit(0.0))).over(up_to)
    summed = filled.select(
        *keys, "n", "fixed", "ty", "tp",
        multiplier.alias("multiplier"), below_y.alias("by"), below_p.alias("bp"))
    low = F.col("multiplier") * F.col("bp") - F.col("by")
    high = (F.col("ty") - F.col("by")) - F.col("multiplier") * (F.col("tp") - F.col("bp"))
    return summed.select(
        *keys, "multiplier", F.try_divide(low + high + F.col("fixed"), F.col("n")).alias("mae"))


def best_multiplier(scored: DataFrame, *, keys: Sequence[str], **options) -> DataFrame:
    """The multiplier with the smallest MAE per group, the smaller one on ties."""
    errors = calibration_errors(scored, keys=keys, **options)
    return errors.groupBy(*keys).agg(
        F.min_by("multiplier", F.struct("mae", "multiplier")).alias("multiplier"),
        F.min("mae").alias("mae"),
    )


def apply_multiplier(
    forecast: DataFrame,
    multipliers: DataFrame,
    *,
    keys: Sequence[str],
    value: str = "yhat",
    default: float = 1.0,
) -> DataFrame:
    """Scale a forecast by its group's multiplier; groups without one use the default."""
    table = multipliers.select(*keys, F.col("multiplier").alias("__factor"))
    return forecast.join(table, list(keys), "left").withColumn(
        value, F.col(value) * F.coalesce("__factor", F.lit(default))).drop("__factor")


def factor_of(target: Column, factors: Mapping[str, float]) -> Column:
    """The given factor of a target, 1 for other targets."""
    return F.coalesce(
        *[F.when(target == name, F.lit(float(f))) for name, f in factors.items()], F.lit(1.0))
