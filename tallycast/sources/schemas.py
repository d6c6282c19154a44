"""Explicit schemas of the retail tables."""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "sales": "Date date, Revenue double, COGS double",
    "sample_submission": "Date date, Revenue double, COGS double",
    "promotions": (
        "promo_id string, promo_name string, promo_type string, discount_value double, "
        "start_date date, end_date date, applicable_category string, promo_channel string, "
        "stackable_flag int, min_order_value int"
    ),
    "orders": (
        "order_id bigint, order_date date, customer_id bigint, zip string, "
        "order_status string, payment_method string"
    ),
    "order_items": (
        "order_id bigint, product_id bigint, quantity int, unit_price double, "
        "discount_amount double, promo_id string"
    ),
    "products": (
        "product_id bigint, category string, segment string, size string, "
        "price double, cogs double"
    ),
    "customers": "customer_id bigint, age_group string",
    "returns": "product_id bigint, return_reason string",
    "web_traffic": "traffic_source string, bounce_rate double",
    "payments": "installments int, payment_value double",
    "geography": "zip string, region string",
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[table])


def table_names() -> list[str]:
    return list(_DDL)
