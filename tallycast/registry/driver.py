"""The given test tables in the shape of the retail tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.operators.panel import daily_components, densify, order_totals
from tallycast.session import cut_lineage
from tallycast.sources.dimensions import lunar_new_year, spine_of

KEYS = ["series"]

# Calendar of the order dates in the given tables (1995 to 2001).
FULL_YEARS = (1995, 2000)
BASE_YEAR = 2000
STABLE_YEARS = (1996, 1999)
HOLDOUT_AFTER = dt.date(2001, 1, 31)
HISTORY_END = dt.date(2001, 8, 1)
FORECAST_FIRST = dt.date(2001, 8, 2)
FORECAST_LAST = dt.date(2002, 1, 31)
WARMUP_END = dt.date(1997, 1, 1)
TREND_ORIGIN = dt.date(1998, 1, 1)
REGIME_YEAR = 1998
LUNAR_NEW_YEAR = {
    1995: dt.date(1995, 1, 31),
    1996: dt.date(1996, 2, 19),
    1997: dt.date(1997, 2, 7),
    1998: dt.date(1998, 1, 28),
    1999: dt.date(1999, 2, 16),
    2000: dt.date(2000, 2, 5),
    2001: dt.date(2001, 1, 24),
    2002: dt.date(2002, 2, 12),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").alias("payment_value"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Lines; a zero discount stands for a line without a promotion."""
    gross, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.lit(1).alias("quantity"),
        gross.alias("unit_price"),
        (gross * discount).alias("discount_amount"),
        F.when(discount > 0, (discount * 100).cast("int")).alias("promo_id"),
        (gross * (1 - discount)).alias("revenue"),
        (gross * 0.95).alias("cogs"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("return_reason"),
        F.to_date("l_shipdate").alias("ship_date"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("segment"),
        F.col("p_brand").alias("category"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("series"),
        F.col("c_nationkey").alias("nation"),
    )


def returns(spark: SparkSession, folder: str) -> DataFrame:
    return order_items(spark, folder).where(F.col("return_flag") == "R").select(
        "product_id", "return_reason")


def geography(spark: SparkSession, folder: str) -> DataFrame:
    """Region of each customer; the customer number stands for the zip code."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("nation"), F.col("r_name").alias("region"))
    return customers(spark, folder).join(places, "nation").select(
        F.col("customer_id").alias("zip"), "region")


def components(spark: SparkSession, folder: str) -> DataFrame:
    """Daily orders, revenue and order value per customer segment."""
    return daily_components(
        orders(spark, folder), order_items(spark, folder), keys=KEYS, cancelled="P",
        dimension=customers(spark, folder), on="customer_id")


def promotions(spark: SparkSession, folder: str) -> DataFrame:
    """Discounted lines as promotions that run from shipment for ``l_quantity`` days."""
    start = F.to_date("l_shipdate")
    return table(spark, folder, "lineitem").where(F.col("l_discount") > 0).select(
        start.alias("start_date"),
        F.date_add(start, F.col("l_quantity").cast("int")).alias("end_date"),
        (F.col("l_discount") * 100).alias("discount_value"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("applicable_category"),
    )


PROMO_FLAGS = {"R": "has_r_promo", "A": "has_a_promo"}


def daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue and COGS per customer segment and day."""
    totals = order_totals(
        order_items(spark, folder), {"Revenue": F.col("revenue"), "COGS": F.col("cogs")})
    per_customer = orders(spark, folder).join(totals, "order_id").groupBy(
        "customer_id", F.col("order_date").alias("Date")).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("COGS").alias("COGS"))
    joined = per_customer.join(customers(spark, folder).select("customer_id", "series"), "customer_id")
    return joined.groupBy("series", "Date").agg(
        F.sum("Revenue").alias("Revenue"), F.sum("COGS").alias("COGS"))


def daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue and COGS per day, without the segments."""
    totals = order_totals(
        order_items(spark, folder), {"Revenue": F.col("revenue"), "COGS": F.col("cogs")})
    return orders(spark, folder).join(totals, "order_id").groupBy(F.col("order_date").alias("Date")).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("COGS").alias("COGS"))


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """The daily sales with every day of each segment."""
    return densify(daily_sales(spark, folder), keys=KEYS, fill={"Revenue": 0.0, "COGS": 0.0})


def panel_once(spark: SparkSession, folder: str) -> DataFrame:
    """The panel written once, for plans that read it several times.

    It has one row per segment and day, while the facts behind it are scanned
    and joined a single time.
    """
    return cut_lineage(panel(spark, folder))


def sales_once(spark: SparkSession, folder: str) -> DataFrame:
    """The daily sales written once, for plans that read them several times."""
    return cut_lineage(daily_sales(spark, folder))


def order_days(spark: SparkSession, folder: str) -> DataFrame:
    """Every day of the order calendar with its number of orders."""
    counts = orders(spark, folder).where("order_date is not null").groupBy(
        F.col("order_date").alias("Date")).agg(F.count(F.lit(1)).alias("n_orders"))
    return spine_of(counts).join(counts, "Date", "left").select(
        "Date", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


def order_days_once(spark: SparkSession, folder: str) -> DataFrame:
    return cut_lineage(order_days(spark, folder))


def lunar_events(spark: SparkSession) -> DataFrame:
    return lunar_new_year(spark, LUNAR_NEW_YEAR)
