"""Daily panels: one row per series and day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.functions.scalars import (
    at_least, differs, line_revenue_filled, ratio,
)


def order_totals(items: DataFrame, measures: Mapping[str, F.Column]) -> DataFrame:
    """Line measures summed per order before orders are joined."""
    return items.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        *[F.sum(value).alias(name) for name, value in measures.items()]
    )


def daily_components(
    orders: DataFrame,
    items: DataFrame,
    *,
    keys: Sequence[str] = (),
    cancelled: str = "cancelled",
    date: str = "order_date",
    dimension: DataFrame | None = None,
    on: str | None = None,
) -> DataFrame:
    """Orders, revenue and average order value per series and day.

    Orders with an unknown status count; days without any order line are left
    out.  Lines are summed per order before the join.  With a ``dimension``
    (one row per ``on``) that holds the series keys, orders are summed per
    ``on`` and day first, so a frequent value reaches that join as at most one
    row per day.
    """
    first_keys = [on] if dimension is not None else list(keys)
    completed = orders.where(differs(F.col("order_status"), cancelled)).where(
        F.col(date).isNotNull()).select(*first_keys, "order_id", F.col(date).alias("Date"))
    totals = order_totals(items, {"rev_recon": line_revenue_filled(
        F.col("quantity"), F.col("unit_price"), F.col("discount_amount"))})
    joined = completed.join(totals.withColumn("has_lines", F.lit(1)), "order_id", "left")
    daily = joined.groupBy(*first_keys, "Date").agg(
        F.count_distinct("order_id").alias("n_orders"),
        F.sum("rev_recon").alias("rev_recon"),
        F.max("has_lines").alias("has_lines"),
    )
    if dimension is not None:
        daily = daily.join(dimension.select(on, *keys), on).groupBy(*keys, "Date").agg(
            F.sum("n_orders").alias("n_orders"),
            F.sum("rev_recon").alias("rev_recon"),
            F.max("has_lines").alias("has_lines"),
        )
    revenue = F.coalesce("rev_recon", F.lit(0.0))
    return daily.where(F.col("has_lines") == 1).select(
        *keys, "Date", "n_orders", revenue.alias("rev_recon"),
        (revenue / at_least(F.col("n_orders"), 1)).alias("aov"))


def densify(
    daily: DataFrame, *, keys: Sequence[str], fill: Mapping[str, float | None],
    date: str = "Date", until: dt.date | None = None,
) -> DataFrame:
    """Add the missing days of each series between its first and last day, or
    up to ``until`` if that is later.

    Row windows then agree with the calendar.  ``daily`` has one row per series
    and day, so each series' days fit one array and no join is needed to find
    the gaps: every row opens the days up to the next one.
    """
    rows = Window.partitionBy(*keys).orderBy(date)
    following = F.lead(date).over(rows)
    end = F.col(date) if until is None else F.greatest(F.col(date), F.lit(until))
    opened = daily.withColumn("__until", F.coalesce(F.date_sub(following, 1), end)).withColumn(
        "__day", F.explode(F.sequence(F.col(date), F.col("__until"), F.expr("interval 1 day"))))
    real = F.col("__day") == F.col(date)
    values = [F.when(real, F.col(name)).otherwise(F.lit(value)).alias(name)
              for name, value in fill.items()]
    return opened.select(*keys, F.col("__day").alias(date), *values)


def fill_with_median(
    df: DataFrame, column: str, *, keys: Sequence[str]
) -> DataFrame:
    """Missing values get the exact median of their own series (daily rows)."""
    middle = F.median(column).over(Window.partitionBy(*keys))
    return df.withColumn(column, F.coalesce(F.col(column), middle))


def cogs_ratio(df: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Median daily COGS per Revenue of each series (Revenue at least 1)."""
    daily = F.col("COGS") / at_least(F.col("Revenue"), 1.0)
    return df.groupBy(*keys).agg(F.median(daily).alias("cogs_ratio"))


def align(left: DataFrame, right: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Bring two per-day tables together by key, never by row position."""
    return left.join(right, [*keys, "Date"])


def safe_quotient(left: DataFrame, right: DataFrame, *, key: str, name: str,
                  numerator: str, denominator: str) -> DataFrame:
    """Divide two grouped results by key; a key missing on one side gives null."""
    return left.join(right, key, "full").select(
        key, ratio(F.col(numerator), F.col(denominator)).alias(name))
