"""Registered questions and dashboard measures with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallycast.plans import dashboard, questions
from tallycast.registry import driver
from tallycast.registry.common import DAILY_SQL, rounded


def q1_median_gap(spark, sf):
    return questions.median_order_gap(driver.orders(spark, sf))


def q2_margin_by_segment(spark, sf):
    lines = driver.order_items(spark, sf).select(
        "product_id", F.col("revenue").alias("price"), "cogs")
    return rounded(questions.line_margin_by_segment(lines, driver.products(spark, sf)), 8, "margin")


def q2_mean_price_by_segment(spark, sf):
    """The product-level form: margin over a cost of 60 % plus 1 % per size step."""
    items = driver.products(spark, sf).withColumn(
        "cogs", F.col("price") * (F.lit(0.6) - F.col("size") / 200))
    return rounded(questions.margin_by_segment(items), 8, "margin")


def q3_return_reasons(spark, sf):
    by_type = driver.products(spark, sf).select("product_id", F.col("segment").alias("category"))
    return questions.return_reasons(driver.returns(spark, sf), by_type, "STANDARD")


def q4_mean_by_source(spark, sf):
    web = driver.table(spark, sf, "events").select(
        F.col("event_type").alias("traffic_source"), F.col("value").alias("bounce_rate"))
    return rounded(questions.bounce_by_source(web), 6, "bounce_rate")


def q5_promo_share(spark, sf):
    return rounded(questions.promo_share(driver.order_items(spark, sf)), 9, "promo_share")


def q6_orders_per_customer(spark, sf):
    rates = questions.orders_per_customer(
        driver.orders(spark, sf), driver.customers(spark, sf), "series")
    return rounded(rates, 9, "orders_per_customer")


def q7_revenue_by_region(spark, sf):
    orders = driver.orders(spark, sf).withColumnRenamed("customer_id", "zip")
    result = questions.revenue_by_region(
        orders, driver.order_items(spark, sf), driver.geography(spark, sf), status="F")
    return rounded(result, 1, "revenue")


def q8_payment_counts(spark, sf):
    return questions.payment_counts(driver.orders(spark, sf), "F")


def q9_return_rate_by_size(spark, sf):
    rates = questions.return_rate_by_size(
        driver.order_items(spark, sf), driver.returns(spark, sf), driver.products(spark, sf))
    return rounded(rates, 9, "return_rate")


def q10_mean_payment(spark, sf):
    payments = driver.orders(spark, sf).withColumnRenamed("payment_method", "installments")
    return rounded(questions.payment_by_installments(payments), 4, "payment_value")


def dash_totals(spark, sf):
    lines = driver.order_items(spark, sf).select(
        F.col("revenue").alias("Revenue"), F.col("cogs").alias("COGS"))
    return rounded(rounded(dashboard.totals(lines), 0, "revenue", "cogs"), 9, "gross_margin")


def dash_by_year(spark, sf):
    return rounded(dashboard.by_year(driver.daily_totals(spark, sf)), 0, "revenue", "cogs")


def dash_by_month(spark, sf):
    season = dashboard.by_month(driver.daily_sales(spark, sf))
    return rounded(rounded(season, 0, "revenue"), 2, "mean_revenue")


def dash_revenue_by_category(spark, sf):
    result = dashboard.amount_by_category(
        driver.order_items(spark, sf), driver.products(spark, sf), "revenue")
    return rounded(rounded(result, 0, "revenue"), 9, "share")


def dash_discount_by_category(spark, sf):
    result = dashboard.amount_by_category(
        driver.order_items(spark, sf), driver.products(spark, sf), "discount_amount")
    return rounded(rounded(result, 1, "discount_amount"), 9, "share")


def dash_margin_by_segment(spark, sf):
    result = dashboard.margin_by_segment(
        driver.order_items(spark, sf), driver.products(spark, sf))
    return rounded(rounded(result, 0, "revenue"), 9, "margin")


def dash_returns_by_reason(spark, sf):
    return dashboard.returns_by_reason(driver.returns(spark, sf))


def dash_channels(spark, sf):
    sessions = driver.table(spark, sf, "events").select(
        F.col("event_type").alias("channel"), F.col("value").alias("revenue"),
        (F.col("value") > 50).alias("converted"))
    return rounded(rounded(dashboard.channels(sessions), 2, "revenue"), 9, "conversion")


def dash_promo_usage(spark, sf):
    usage = dashboard.promo_usage(driver.order_items(spark, sf))
    return rounded(rounded(usage, 0, "promo_revenue", "other_revenue"), 9, "promo_share")


def dash_delivery(spark, sf):
    lines = driver.order_items(spark, sf).withColumn("returned", F.col("return_flag") == "R")
    return rounded(
        dashboard.delivery(lines, driver.orders(spark, sf)), 9, "return_rate", "delivery_days")


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith(("q", "dash_"))
           and callable(fn)}

_CATEGORY = """
WITH s AS (SELECT p_brand AS category, sum({amount}) AS v
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT category, round(v, {digits}) AS {name}, round(v / (SELECT sum(v) FROM s), 9) AS share FROM s"""

ORACLE = {
    "q1_median_gap": """
WITH g AS (SELECT date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER (
             PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
             CAST(o_orderdate AS DATE)) AS gap FROM orders)
SELECT CAST(median(gap) AS DOUBLE) AS median_gap FROM g WHERE gap IS NOT NULL""",
    "q2_margin_by_segment": """
WITH x AS (SELECT p_type, l_extendedprice * (1 - l_discount) AS price,
                  l_extendedprice * CAST(0.95 AS DOUBLE) AS cogs
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT p_type AS segment, round(avg((price - cogs) / price), 8) AS margin FROM x GROUP BY 1""",
    "q2_mean_price_by_segment": """
SELECT p_type AS segment,
       round(avg((p_retailprice - p_retailprice * (CAST(0.6 AS DOUBLE) - p_size / 200.0::DOUBLE))
                 / p_retailprice), 8) AS margin
FROM part GROUP BY 1""",
    "q3_return_reasons": """
SELECT l_linestatus AS return_reason, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_returnflag = 'R' AND p_type = 'STANDARD' GROUP BY 1""",
    "q4_mean_by_source": """
SELECT event_type AS traffic_source, round(avg(value), 6) AS bounce_rate FROM events GROUP BY 1""",
    "q5_promo_share": """
SELECT round(avg(CASE WHEN nullif(l_discount, 0) IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END), 9)
       AS promo_share FROM lineitem""",
    "q6_orders_per_customer": """
SELECT c_mktsegment AS series,
       round(count(o_orderkey)::DOUBLE / count(DISTINCT c_custkey), 9) AS orders_per_customer
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "q7_revenue_by_region": """
SELECT r_name AS region, round(sum(l_extendedprice - l_extendedprice * l_discount), 1) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE o_orderstatus = 'F' GROUP BY 1""",
    "q8_payment_counts": """
SELECT o_orderpriority AS payment_method, count(*) AS n FROM orders
WHERE o_orderstatus = 'F' GROUP BY 1""",
    "q9_return_rate_by_size": """
WITH t AS (SELECT p_size AS size, count(*) AS n FROM lineitem
           JOIN part ON l_partkey = p_partkey GROUP BY 1),
r AS (SELECT p_size AS size, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE l_returnflag = 'R' GROUP BY 1)
SELECT size, round(r.n::DOUBLE / t.n, 9) AS return_rate FROM t FULL JOIN r USING (size)""",
    "q10_mean_payment": """
SELECT o_orderpriority AS installments, round(avg(o_totalprice), 4) AS payment_value
FROM orders GROUP BY 1""",
    "dash_totals": """
WITH s AS (SELECT sum(l_extendedprice * (1 - l_discount)) AS r,
                  sum(l_extendedprice * CAST(0.95 AS DOUBLE)) AS c FROM lineitem)
SELECT round(r, 0) AS revenue, round(c, 0) AS cogs, round((r - c) / r, 9) AS gross_margin FROM s""",
    "dash_by_year": f"""
WITH {DAILY_SQL}
SELECT CAST(year("Date") AS INTEGER) AS year, round(sum("Revenue"), 0) AS revenue,
       round(sum("COGS"), 0) AS cogs FROM daily GROUP BY 1""",
    "dash_by_month": f"""
WITH {DAILY_SQL}
SELECT CAST(month("Date") AS INTEGER) AS month, round(sum("Revenue"), 0) AS revenue,
       round(avg("Revenue"), 2) AS mean_revenue FROM daily GROUP BY 1""",
    "dash_revenue_by_category": _CATEGORY.format(
        amount="l_extendedprice * (1 - l_discount)", digits=0, name="revenue"),
    "dash_discount_by_category": _CATEGORY.format(
        amount="l_extendedprice * l_discount", digits=1, name="discount_amount"),
    "dash_margin_by_segment": """
WITH s AS (SELECT p_type AS segment, sum(l_extendedprice * (1 - l_discount)) AS r,
                  sum(l_extendedprice * CAST(0.95 AS DOUBLE)) AS c
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT segment, round(r, 0) AS revenue, round((r - c) / r, 9) AS margin FROM s""",
    "dash_returns_by_reason": """
SELECT l_linestatus AS return_reason, count(*) AS n FROM lineitem
WHERE l_returnflag = 'R' GROUP BY 1""",
    "dash_channels": """
SELECT event_type AS channel, count(*) AS sessions, round(sum(value), 2) AS revenue,
       round(avg(CASE WHEN value > 50 THEN 1.0::DOUBLE ELSE 0 END), 9) AS conversion
FROM events GROUP BY 1""",
    "dash_promo_usage": """
WITH s AS (SELECT sum(l_extendedprice * (1 - l_discount)) FILTER (l_discount > 0) AS p,
                  sum(l_extendedprice * (1 - l_discount)) FILTER (l_discount = 0) AS o FROM lineitem)
SELECT round(p, 0) AS promo_revenue, round(o, 0) AS other_revenue,
       round(p / (p + o), 9) AS promo_share FROM s""",
    "dash_delivery": """
SELECT round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END), 9) AS return_rate,
       round(avg(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))), 9)
       AS delivery_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}
