"""Grouped summaries that pre-aggregate facts before any join or wide shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.functions.scalars import flag, ratio


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present (groups of a missing key are not reported)."""
    return df.dropna(subset=list(keys))


def sums_by_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    *,
    on: str,
    by: str | Sequence[str],
    measures: Mapping[str, Column],
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Sum fact measures by dimension attributes.

    The fact is summed per join key first (combined on the map side), so a key
    that holds a large part of the fact reaches the join as one row.  The sums
    stay right when the dimension repeats a key.  ``extra_keys`` are fact
    columns that are kept as grouping columns.
    """
    groups = [by] if isinstance(by, str) else list(by)
    per_key = known(fact, on).groupBy(on, *extra_keys).agg(
        *[F.sum(value).alias(name) for name, value in measures.items()]
    )
    joined = per_key.join(dimension.select(on, *groups), on)
    keys = [*groups, *extra_keys]
    return known(joined, *keys).groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in measures]
    )


def mean_by(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    return known(df, key).groupBy(key).agg(F.avg(value).alias(name))


def value_counts(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Frequencies, most frequent first, ties by value."""
    counts = known(df, key).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), F.asc(key))


def descending(df: DataFrame, value: str, *ties: str) -> DataFrame:
    """Sorted by value, missing values last, ties in key order."""
    return df.orderBy(F.col(value).desc_nulls_last(), *[F.asc(tie) for tie in ties])


def known_share(column: Column) -> Column:
    """Aggregate: share of rows with a value."""
    return F.avg(column.isNotNull().cast("double"))


def condition_share(condition: Column) -> Column:
    """Aggregate: share of rows that satisfy the condition."""
    return F.avg(flag(condition).cast("double"))


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Each row's part of the overall sum.

    ``df`` is an aggregated result; its total is a scalar subquery that reuses
    the same shuffle, so no window gathers the rows in one task.
    """
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, ratio(F.col(value), total))


def describe(
    df: DataFrame, value: Column, *, keys: Sequence[str] = (), extra: Sequence[Column] = ()
) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles.

    The quartiles gather a value histogram per group: meant for series that
    are already daily, where a group has at most one row per day.
    """
    quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    summary = df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        quartiles.alias("q"),
        F.max(value).alias("max"),
        *extra,
    )
    names = {"p25": 0, "p50": 1, "p75": 2}
    return summary.withColumns({n: F.col("q")[i] for n, i in names.items()}).drop("q")
