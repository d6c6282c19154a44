"""Forecast files, run metadata and importance tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import at_least, date_text, round_half_even


def as_forecast_file(
    forecast: DataFrame,
    *,
    keys: Sequence[str] = (),
    targets: Sequence[str] = constants.TARGETS,
) -> DataFrame:
    """The published layout: text date, targets not below zero, two decimals."""
    money = [round_half_even(at_least(F.col(name), 0.0), 2).alias(name)
             for name in targets if name in forecast.columns]
    return forecast.select(*keys, date_text(F.col("Date")).alias("Date"), *money)


def write_forecasts(forecast: DataFrame, path: str, *, by: Sequence[str] = ("variant",)) -> None:
    """Write one CSV folder per value of ``by``, rows in date order.

    Rows are range-partitioned by (``by``, Date), so a large variant is spread
    over several ordered files instead of one task.
    """
    ordered = as_forecast_file(forecast, keys=by).repartitionByRange(*by, "Date")
    ordered.sortWithinPartitions(*by, "Date").write.mode("overwrite").option(
        "header", True).partitionBy(*by).csv(path)


def publish_variant(
    variants: DataFrame, chosen: str = "default", *, keys: Sequence[str] = ()
) -> DataFrame:
    """The rows of one variant in the published layout, with the keys of a panel."""
    return as_forecast_file(variants.where(F.col("variant") == chosen), keys=keys)


def run_metadata(
    spark: SparkSession,
    *,
    numbers: Mapping[str, float],
    labels: Mapping[str, str],
    scores: Mapping[str, Mapping[str, float]],
) -> DataFrame:
    """One row that describes a run."""
    return spark.createDataFrame(
        [(dict(numbers), dict(labels), {name: dict(values) for name, values in scores.items()})],
        "numbers map<string, double>, labels map<string, string>, "
        "scores map<string, map<string, double>>",
    )


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").json(path)


def write_importance(importance: DataFrame, path: str) -> None:
    importance.write.mode("overwrite").option("header", True).csv(path)


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    """An importance table, long or with one column per model; shares become numbers."""
    table = spark.read.option("header", True).csv(path)
    return table.select(*[
        F.col(name) if name in ("feature", "model") else F.col(name).cast("double").alias(name)
        for name in table.columns])
