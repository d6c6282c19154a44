"""Approximate distinct counts from stored daily sketches.

A sketch has a fixed size whatever it has seen, and sketches of days add up to
those of any period, so periods are counted without another look at the rows.  The
exact count stays the default (``operators.aggregates``); this is the opt-in for
keys with very many different values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registers as a power of two; the relative standard error is about 1.04 / 2^(bits / 2).
BITS = 14


def standard_error(bits: int = BITS) -> float:
    return 1.04 / 2 ** (bits / 2)


def daily_sketches(
    df: DataFrame, value: str, *, date: str, keys: Sequence[str] = (), bits: int = BITS,
) -> DataFrame:
    """``keys``, ``Date`` and ``sketch`` of the known values of each day; rows without a
    date are left out."""
    return df.where(F.col(date).isNotNull()).groupBy(*keys, F.col(date).alias("Date")).agg(
        F.hll_sketch_agg(value, F.lit(bits)).alias("sketch"))


def distinct_in(sketches: DataFrame, period: Column, *, keys: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """``keys``, ``period`` and about how many different values its days hold."""
    return sketches.groupBy(*keys, period.alias("period")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
