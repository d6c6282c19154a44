"""Dashboard measures over orders, lines, products, sessions and stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.scalars import flag, ratio
from tallycast.operators.aggregates import (
    descending, known, share_of_total, sums_by_dimension, value_counts,
)
from tallycast.operators.panel import order_totals


def totals(sales: DataFrame) -> DataFrame:
    """Revenue, COGS and gross margin of everything."""
    summed = sales.agg(F.sum("Revenue").alias("revenue"), F.sum("COGS").alias("cogs"))
    return summed.withColumn("gross_margin", ratio(F.col("revenue") - F.col("cogs"), F.col("revenue")))


def by_year(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.year("Date").alias("year")).agg(
        F.sum("Revenue").alias("revenue"), F.sum("COGS").alias("cogs")).orderBy("year")


def by_month(sales: DataFrame) -> DataFrame:
    """Season: revenue per calendar month over all years."""
    return sales.groupBy(F.month("Date").alias("month")).agg(
        F.sum("Revenue").alias("revenue"), F.avg("Revenue").alias("mean_revenue")).orderBy("month")


def amount_by_category(lines: DataFrame, products: DataFrame, amount: str) -> DataFrame:
    """A line amount per product category with its share of the total."""
    sums = sums_by_dimension(
        lines, products, on="product_id", by="category", measures={amount: F.col(amount)})
    return descending(share_of_total(sums, amount, "share"), amount, "category")


def margin_by_segment(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Margin of the summed revenue per product segment."""
    sums = sums_by_dimension(
        lines, products, on="product_id", by="segment",
        measures={"revenue": F.col("revenue"), "cogs": F.col("cogs")})
    return sums.select(
        "segment", "revenue",
        ratio(F.col("revenue") - F.col("cogs"), F.col("revenue")).alias("margin"))


def returns_by_reason(returns: DataFrame) -> DataFrame:
    return value_counts(returns, "return_reason")


def channels(sessions: DataFrame) -> DataFrame:
    """Sessions, revenue and conversion per channel (columns channel, revenue, converted)."""
    return known(sessions, "channel").groupBy("channel").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("revenue").alias("revenue"),
        F.avg(flag(F.col("converted")).cast("double")).alias("conversion"),
    )


def promo_usage(lines: DataFrame) -> DataFrame:
    """Revenue with and without a promotion."""
    used = F.col("promo_id").isNotNull()
    sums = lines.agg(
        F.sum(F.when(used, F.col("revenue"))).alias("promo_revenue"),
        F.sum(F.when(~used, F.col("revenue"))).alias("other_revenue"),
    )
    both = F.coalesce("promo_revenue", F.lit(0.0)) + F.coalesce("other_revenue", F.lit(0.0))
    return sums.withColumn("promo_share", ratio(F.col("promo_revenue"), both))


def delivery(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Return rate and mean days from order to shipment.

    ``lines`` has order_id, returned and ship_date.  Days are summed per order
    before the join, so an order with very many lines joins as one row.
    """
    shipped = F.unix_date("ship_date")
    per_order = order_totals(lines, {
        "n": F.lit(1),
        "back": flag(F.col("returned")),
        "shipped": shipped,
        "n_shipped": flag(F.col("ship_date").isNotNull()),
    })
    ordered = orders.select("order_id", F.unix_date("order_date").alias("ordered"))
    days = F.col("shipped") - F.col("n_shipped") * F.col("ordered")
    return per_order.join(ordered, "order_id").agg(
        ratio(F.sum("back"), F.sum("n")).alias("return_rate"),
        ratio(F.sum(days), F.sum(F.when(F.col("ordered").isNotNull(), F.col("n_shipped")))).alias(
            "delivery_days"),
    )


def stock_rates(inventory: DataFrame) -> DataFrame:
    """Fill rate and stock-out rate (columns demanded, filled, on_hand)."""
    return inventory.agg(
        ratio(F.sum("filled"), F.sum("demanded")).alias("fill_rate"),
        F.avg(flag(F.col("on_hand") <= 0).cast("double")).alias("stockout_rate"),
    )
