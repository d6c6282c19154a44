"""Ten business questions over the retail tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions.scalars import line_revenue, margin_share, ratio
from tallycast.operators.aggregates import (
    descending, known, known_share, mean_by, sums_by_dimension, value_counts,
)
from tallycast.operators.panel import order_totals, safe_quotient
from tallycast.operators.windows import order_gap_counts


def median_order_gap(orders: DataFrame) -> DataFrame:
    """Median days between consecutive orders of a customer."""
    gaps = order_gap_counts(orders, customer="customer_id", date="order_date")
    return gaps.agg(F.percentile("gap", F.lit(0.5), F.col("n")).alias("median_gap"))


def margin_by_segment(products: DataFrame) -> DataFrame:
    """Mean margin per product segment, best first."""
    margin = margin_share(F.col("price"), F.col("cogs"))
    return descending(mean_by(products, "segment", margin, "margin"), "margin", "segment")


def line_margin_by_segment(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Mean margin per segment over order lines (price and cogs per line)."""
    margin = margin_share(F.col("price"), F.col("cogs"))
    sums = sums_by_dimension(
        lines, products, on="product_id", by="segment",
        measures={"total": margin, "n": margin.isNotNull().cast("bigint")})
    means = sums.select("segment", ratio(F.col("total"), F.col("n")).alias("margin"))
    return descending(means, "margin", "segment")


def return_reasons(returns: DataFrame, products: DataFrame, category: str) -> DataFrame:
    """Returns of one product category by reason, most frequent first."""
    wanted = products.where(F.col("category") == category)
    counts = sums_by_dimension(
        returns, wanted, on="product_id", by="category",
        measures={"n": F.lit(1)}, extra_keys=("return_reason",))
    return descending(counts.select("return_reason", "n"), "n", "return_reason")


def bounce_by_source(web_traffic: DataFrame) -> DataFrame:
    """Mean bounce rate per traffic source, lowest first."""
    means = mean_by(web_traffic, "traffic_source", F.col("bounce_rate"), "bounce_rate")
    return means.orderBy(F.col("bounce_rate").asc_nulls_last(), "traffic_source")


def promo_share(order_items: DataFrame) -> DataFrame:
    """Share of order lines bought with a promotion."""
    return order_items.agg(known_share(F.col("promo_id")).alias("promo_share"))


def orders_per_customer(orders: DataFrame, customers: DataFrame, group: str = "age_group") -> DataFrame:
    """Orders per distinct customer of each customer group, highest first."""
    per_customer = known(orders, "customer_id").groupBy("customer_id").agg(
        F.count("order_id").alias("n"))
    joined = per_customer.join(known(customers, group).select("customer_id", group), "customer_id")
    rates = joined.groupBy(group).agg(
        ratio(F.sum("n"), F.count_distinct("customer_id")).alias("orders_per_customer"))
    return descending(rates, "orders_per_customer", group)


def revenue_by_region(
    orders: DataFrame, order_items: DataFrame, geography: DataFrame, *,
    status: str = "delivered", revenue: Column | None = None,
) -> DataFrame:
    """Revenue of orders in one status per region, highest first.

    Lines are summed per order and orders per zip before the next join; a line
    without a discount value has no revenue and is skipped.
    """
    value = revenue if revenue is not None else line_revenue(
        F.col("quantity"), F.col("unit_price"), F.col("discount_amount"))
    totals = order_totals(order_items, {"revenue": value})
    wanted = orders.where(F.col("order_status") == status).select("order_id", "zip")
    by_region = sums_by_dimension(
        wanted.join(totals, "order_id"), geography, on="zip", by="region",
        measures={"revenue": F.col("revenue")})
    filled = by_region.withColumn("revenue", F.coalesce("revenue", F.lit(0.0)))
    return descending(filled, "revenue", "region")


def payment_counts(orders: DataFrame, status: str = "cancelled") -> DataFrame:
    """Payment methods of orders in one status, most frequent first."""
    return value_counts(orders.where(F.col("order_status") == status), "payment_method")


def return_rate_by_size(order_items: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """Returns per order line for each product size, highest first."""
    one = {"n": F.lit(1)}
    sold = sums_by_dimension(order_items, products, on="product_id", by="size", measures=one)
    back = sums_by_dimension(returns, products, on="product_id", by="size", measures=one)
    rates = safe_quotient(
        back.withColumnRenamed("n", "back"), sold.withColumnRenamed("n", "sold"),
        key="size", name="return_rate", numerator="back", denominator="sold")
    return descending(rates, "return_rate", "size")


def payment_by_installments(payments: DataFrame) -> DataFrame:
    """Mean payment value per number of installments, highest first."""
    means = mean_by(payments, "installments", F.col("payment_value"), "payment_value")
    return descending(means, "payment_value", "installments")
