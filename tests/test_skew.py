"""Results when one key holds a third of all rows, against plain joins."""

import pytest
from pyspark.sql import functions as F

from tallycast.operators import panel
from tallycast.plans import dashboard, questions


@pytest.fixture(scope="module")
def tables(spark):
    """3,000 orders, a third by customer 0; 9,000 lines, a third in order 0 and of product 0."""
    hot = F.pmod(F.col("id"), F.lit(3)) == 0
    day = F.expr("date_add(date'2020-01-01', cast(pmod(id, 50) as int))")
    orders = spark.range(3000).select(
        F.col("id").alias("order_id"), F.when(hot, 0).otherwise(F.pmod("id", F.lit(200))).alias("customer_id"),
        day.alias("order_date"), F.when(F.pmod("id", F.lit(7)) == 0, "P").otherwise("F").alias("order_status"),
        F.when(hot, "z0").otherwise(F.concat(F.lit("z"), F.pmod("id", F.lit(9)))).alias("zip"))
    items = spark.range(9000).select(
        F.when(hot, 0).otherwise(F.pmod("id", F.lit(3000))).alias("order_id"),
        F.when(hot, 0).otherwise(F.pmod("id", F.lit(40))).alias("product_id"),
        F.lit(2).alias("quantity"), (F.col("id") % 90).cast("double").alias("unit_price"),
        F.when(F.col("id") % 5 > 0, F.lit(0.5)).alias("discount_amount"),
        (F.col("id") % 5 == 1).alias("returned"),
        F.expr("date_add(date'2020-02-01', cast(pmod(id, 30) as int))").alias("ship_date"))
    products = spark.range(40).select(
        F.col("id").alias("product_id"), F.pmod("id", F.lit(4)).cast("string").alias("size"))
    people = spark.range(200).select(
        F.col("id").alias("customer_id"), F.pmod("id", F.lit(3)).cast("string").alias("series"))
    places = spark.range(9).select(
        F.concat(F.lit("z"), "id").alias("zip"), F.pmod("id", F.lit(2)).cast("string").alias("region"))
    return {"orders": orders, "items": items, "products": products, "people": people, "places": places}


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_gaps(tables):
    orders = tables["orders"].toPandas().sort_values(["customer_id", "order_date"])
    gaps = orders.groupby("customer_id")["order_date"].apply(
        lambda s: s.astype("datetime64[ns]").diff().dt.days).dropna()
    assert questions.median_order_gap(tables["orders"]).first()[0] == gaps.median()


def test_revenue_by_region(tables):
    plain = tables["items"].join(tables["orders"].where("order_status = 'F'"), "order_id").join(
        tables["places"], "zip").groupBy("region").agg(
        F.sum(F.col("quantity") * F.col("unit_price") - F.col("discount_amount")).alias("revenue"))
    got = questions.revenue_by_region(tables["orders"], tables["items"], tables["places"], status="F")
    assert rows(got, "region") == rows(plain, "region")


def test_return_rates(tables):
    returns = tables["items"].where("returned").select("product_id")
    plain = tables["items"].join(tables["products"], "product_id").groupBy("size").agg(
        F.avg(F.col("returned").cast("double")).alias("return_rate"))
    got = questions.return_rate_by_size(tables["items"], returns, tables["products"])
    assert dict(rows(got, "size")) == pytest.approx(dict(rows(plain, "size")))


def test_delivery(tables):
    plain = tables["items"].join(tables["orders"], "order_id").agg(
        F.avg(F.col("returned").cast("double")), F.avg(F.datediff("ship_date", "order_date"))).first()
    got = dashboard.delivery(tables["items"], tables["orders"]).first()
    assert tuple(got) == pytest.approx(tuple(plain))


def test_daily_components(tables):
    joined = tables["orders"].join(tables["people"], "customer_id")
    plain = panel.daily_components(joined, tables["items"], keys=["series"], cancelled="P")
    got = panel.daily_components(
        tables["orders"], tables["items"], keys=["series"], cancelled="P",
        dimension=tables["people"], on="customer_id")
    assert rows(got, "series", "Date") == rows(plain, "series", "Date")
