"""Rolling mean and deviation of the previous rows of a series.

Sliding frames cost Spark one update per row and frame position, and differences
of running sums lose the digits of small deviations behind a large level.  Rows of
a series are cut into blocks as long as the frame instead.  Every frame is the end
of one block and the beginning of the next, both of which grow row by row, so a
row costs the same whatever the width; the two are merged by counts, means and sums
of squares around the mean, and nothing is ever subtracted from a sum.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallycast import constants


def rolling_names(value: str, windows: Sequence[int] = constants.ROLLING_WINDOWS) -> list[str]:
    return [f"{value}_roll_{kind}_{n}" for n in windows for kind in ("mean", "std")]


def fewest_values(width: int) -> int:
    """Values a window needs before it gives a result."""
    return max(2, width // 3)


def mean_and_deviation(frames: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
    """Row means and sample deviations of the known values, NaN with too few."""
    known = ~np.isnan(frames)
    count = known.sum(axis=1)
    mean = np.where(known, frames, 0.0).sum(axis=1) / np.maximum(count, 1)
    spread = np.where(known, frames - mean[:, None], 0.0)
    deviation = np.sqrt(np.einsum("ij,ij->i", spread, spread) / np.maximum(count - 1, 1))
    usable = count >= enough
    return np.where(usable, mean, np.nan), np.where(usable, deviation, np.nan)


def _moments(value: Column, over: WindowSpec) -> Column:
    """Count, mean and squares around it, from the start of a block to the row."""
    count = F.count(value).over(over)
    return F.struct(
        count.cast("double").alias("n"), F.coalesce(F.avg(value).over(over), F.lit(0.0)).alias("mean"),
        (F.coalesce(F.var_pop(value).over(over), F.lit(0.0)) * count).alias("squares"))


def with_rolling(
    df: DataFrame, value: str, keys: Sequence[str],
    windows: Sequence[int] = constants.ROLLING_WINDOWS, date: str = "Date",
) -> DataFrame:
    """Mean and deviation of the previous ``n`` rows; null with too few values.

    Unknown values and NaN do not count.  Input that is already partitioned by the
    keys is not shuffled again.
    """
    series = Window.partitionBy(*keys).orderBy(date)
    known = F.col(value).cast("double")
    rows = df.withColumns({
        "__y": F.when(~F.isnan(known), known), "__row": F.row_number().over(series) - 1})
    rows = rows.withColumns({f"__block_{n}": F.floor(F.col("__row") / n) for n in windows})
    for n in windows:
        block = Window.partitionBy(*keys, f"__block_{n}").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn(f"__upto_{n}", _moments(F.col("__y"), block.orderBy(date)))
        rows = rows.withColumn(f"__from_{n}", _moments(F.col("__y"), block.orderBy(F.desc(date))))
    rows = rows.withColumns({
        name: column for n in windows for name, column in (
            (f"__new_{n}", F.lag(f"__upto_{n}", 1).over(series)),
            # At the start of a block the block before is the whole frame.
            (f"__old_{n}", F.when(F.col("__row") % n != 0, F.lag(f"__from_{n}", n).over(series))))})
    out = {}
    for n in windows:
        new, old = F.col(f"__new_{n}"), F.col(f"__old_{n}")
        zero = F.lit(0.0)
        a, b = F.coalesce(new["n"], zero), F.coalesce(old["n"], zero)
        count, gap = a + b, F.coalesce(new["mean"], zero) - F.coalesce(old["mean"], zero)
        mean = (a * F.coalesce(new["mean"], zero) + b * F.coalesce(old["mean"], zero)) / count
        squares = F.coalesce(new["squares"], zero) + F.coalesce(old["squares"], zero) + F.when(
            (a > 0) & (b > 0), gap * gap * a * b / count).otherwise(zero)
        usable = count >= fewest_values(n)
        out[f"{value}_roll_mean_{n}"] = F.when(usable, mean)
        out[f"{value}_roll_std_{n}"] = F.when(usable, F.sqrt(squares / (count - 1)))
    return rows.select(*[F.col(f"`{name}`") for name in df.columns], *[column.alias(name) for name, column in out.items()])
