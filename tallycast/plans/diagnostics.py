"""Checks of a daily sales series (columns Date, Revenue, COGS, optional keys)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import at_least, ratio, round_half_even, weekday_name
from tallycast.operators.aggregates import condition_share, describe
from tallycast.operators.ranking import top_rows
from tallycast.operators.weights import stable_weight_share
from tallycast.operators.windows import change_from_previous


def summary(sales: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    return sales.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"),
        F.avg("Revenue").alias("mean_revenue"),
        F.min("Revenue").alias("min_revenue"),
        F.max("Revenue").alias("max_revenue"),
        F.avg("COGS").alias("mean_cogs"),
        (1 - F.avg(F.col("COGS") / at_least(F.col("Revenue"), 1.0))).alias("mean_margin"),
    )


def yearly(sales: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Rounded yearly figures; margin and growth are taken from the rounded ones."""
    per_year = sales.groupBy(*keys, F.year("Date").alias("year")).agg(
        F.count("Revenue").alias("days"),
        round_half_even(F.avg("Revenue")).alias("rev_mean"),
        round_half_even(F.sum("Revenue")).alias("rev_total"),
        round_half_even(F.avg("COGS")).alias("cogs_mean"),
    )
    margin = ratio(F.col("rev_mean") - F.col("cogs_mean"), F.col("rev_mean")) * 100
    growth = change_from_previous(
        F.col("rev_total"), Window.partitionBy(*keys).orderBy("year")) * 100
    return per_year.withColumns({
        "margin_pct": round_half_even(margin, 2),
        "yoy_growth_pct": round_half_even(growth, 1),
    })


def by_weekday(sales: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    return sales.groupBy(*keys, F.weekday("Date").alias("dow")).agg(
        F.first(weekday_name(F.col("Date"))).alias("weekday"),
        round_half_even(F.avg("Revenue")).alias("rev_mean"))


def by_month(sales: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    return sales.groupBy(*keys, F.month("Date").alias("month")).agg(
        round_half_even(F.avg("Revenue")).alias("rev_mean"))


def cost_ratio(sales: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Distribution of daily COGS per Revenue and the days above 1."""
    daily = F.col("COGS") / at_least(F.col("Revenue"), 1.0)
    with_ratio = sales.withColumn("cost_ratio", daily)
    above = F.col("cost_ratio") > 1
    return describe(with_ratio, F.col("cost_ratio"), keys=keys, extra=[
        F.count_if(above).alias("days_above"),
        (condition_share(above) * 100).alias("pct_above"),
    ])


def top_days(sales: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(sales.select("Date", "Revenue", "COGS"), "Revenue", n, "Date")


def promo_months(promotions: DataFrame) -> DataFrame:
    """Promotions by starting month, in month order."""
    month = F.month("start_date").alias("month")
    return promotions.where(F.col("start_date").isNotNull()).groupBy(month).agg(
        F.count(F.lit(1)).alias("n")).orderBy("month")


def weight_share(
    sales: DataFrame, *, years: tuple[int, int] = constants.STABLE_YEARS,
    other: float = constants.OTHER_YEAR_WEIGHT, keys: Sequence[str] = (),
) -> DataFrame:
    """Stable days and their part of the training weight."""
    stable = F.year("Date").between(*years)
    return sales.groupBy(*keys).agg(
        F.count_if(stable).alias("stable_days"),
        F.count_if(~stable).alias("other_days"),
        stable_weight_share(years, other).alias("stable_share"),
    )


def events_seen(events: DataFrame, sales: DataFrame, event_date: str = "event_date") -> DataFrame:
    """Whether each event lies in the history or after it."""
    last = sales.agg(F.max("Date")).scalar()
    return events.withColumn(
        "period", F.when(F.col(event_date) <= last, F.lit("TRAIN")).otherwise(F.lit("TEST")))
