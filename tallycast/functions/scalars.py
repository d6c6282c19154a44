"""Column helpers whose null, tie and rounding rules differ from Spark's own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def at_least(value: Column, low: float) -> Column:
    """Lower clip that leaves null as null (``greatest`` alone would return ``low``)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low)))


def at_most(value: Column, limit: Column) -> Column:
    """Upper cap; null when either side is null."""
    return F.when(value.isNotNull() & limit.isNotNull(), F.least(value, limit))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null for a zero or missing denominator."""
    return F.try_divide(numerator, denominator)


def margin_share(price: Column, cost: Column) -> Column:
    """Share of the price left after cost."""
    return ratio(price - cost, price)


def round_half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def differs(value: Column, other: object) -> Column:
    """``!=`` that keeps rows whose value is null."""
    return ~value.eqNullSafe(F.lit(other))


def line_revenue(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Revenue of an order line; a missing discount leaves it unknown."""
    return quantity * unit_price - discount


def line_revenue_filled(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Revenue of an order line; a missing discount counts as none."""
    return quantity * unit_price - F.coalesce(discount, F.lit(0.0))


def to_log(value: Column) -> Column:
    return F.log1p(value)


def from_log(value: Column) -> Column:
    return F.expm1(value)


def label_for(value: Column, names: Mapping[str, str], default: str) -> Column:
    """Look a code up in a small fixed table."""
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def weekday_name(date: Column) -> Column:
    """Mon … Sun."""
    return F.date_format(date, "E")


def date_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def parse_date(text: Column) -> Column:
    """ISO text to date; text that is no valid date gives null."""
    return F.try_to_date(text, "yyyy-MM-dd")
