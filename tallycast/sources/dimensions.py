"""Small dimension tables and the date spine."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast import constants


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A table of constants inside the plan: no Python worker has to deliver it."""
    fields = T.StructType.fromDDL(schema)
    records = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name)
                   for value, field in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*records)))


def date_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Every day from first to last, both included."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("Date"))


def spine_of(df: DataFrame, date: str = "Date") -> DataFrame:
    """Every day between the first and last date in ``df``."""
    bounds = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("Date")
    )


def fixed_holidays(spark: SparkSession, rows=constants.FIXED_HOLIDAYS) -> DataFrame:
    return literal_table(spark, rows, "month int, day int, name string")


def lunar_new_year(
    spark: SparkSession, dates: Mapping[int, dt.date] = constants.LUNAR_NEW_YEAR
) -> DataFrame:
    return literal_table(spark, sorted(dates.items()), "year int, event_date date")


def promo_schedule(spark: SparkSession, rows: Iterable = constants.PROMO_SCHEDULE) -> DataFrame:
    return literal_table(
        spark, rows,
        "name string, start_month int, start_day int, duration_days int, "
        "discount double, recur string",
    )


def feature_meanings(
    spark: SparkSession, meanings: Mapping[str, str] = constants.FEATURE_MEANINGS
) -> DataFrame:
    return literal_table(spark, meanings.items(), "feature string, meaning string")
