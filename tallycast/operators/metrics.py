"""Forecast accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.scalars import ratio


def regression_metrics(
    scored: DataFrame, *, keys: Sequence[str], actual: str = "y", predicted: str = "yhat"
) -> DataFrame:
    """MAE, RMSE and R² per group in one pass, over the rows with both values."""
    y = F.when(F.col(predicted).isNotNull(), F.col(actual))
    error = y - F.col(predicted)
    return scored.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - ratio(F.avg(error * error), F.var_pop(y))).alias("r2"),
    )


def mape(scored: DataFrame, *, keys: Sequence[str], actual: str = "y", predicted: str = "yhat") -> DataFrame:
    """Mean absolute percentage error; days without actual sales are skipped."""
    y = F.col(actual)
    return scored.groupBy(*keys).agg(
        (F.avg(ratio(F.abs(y - F.col(predicted)), y)) * 100).alias("mape"))


def best_variant(metrics: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """The variant with the smallest sum of MAE over targets, ties by name.

    Sums that differ only in summation order count as equal.
    """
    totals = metrics.groupBy(*keys, "variant").agg(F.sum("mae").alias("sum_mae"))
    return totals.groupBy(*keys).agg(
        F.min_by("variant", F.struct(F.round("sum_mae", 4), F.col("variant"))).alias("variant"),
        F.min("sum_mae").alias("sum_mae"),
    )


def forecast_correlation(
    left: DataFrame, right: DataFrame, *, keys: Sequence[str], value: str
) -> DataFrame:
    """Correlation of two forecasts of the same days, per key."""
    other = right.select(*keys, "Date", F.col(value).alias("__other"))
    return left.join(other, [*keys, "Date"]).groupBy(*keys).agg(
        F.corr(value, "__other").alias("correlation"))
