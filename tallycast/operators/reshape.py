"""Long and wide forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_future(history: DataFrame, future: DataFrame) -> DataFrame:
    """History followed by future rows whose unknown columns are null."""
    return history.unionByName(future, allowMissingColumns=True)


def to_long(
    df: DataFrame, *, keys: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)


def to_wide(df: DataFrame, *, key: str, column: str, values: Sequence[str], value: str) -> DataFrame:
    """One column per value of ``column`` and their total; missing cells are 0."""
    wide = df.groupBy(key).pivot(column, list(values)).agg(F.first(value)).na.fill(0.0, list(values))
    return wide.withColumn("total", sum((F.col(v) for v in values[1:]), F.col(values[0])))


def stack(tables: Mapping[str, DataFrame], column: str = "variant") -> DataFrame:
    """Union of named tables with the name as a column."""
    named = [df.withColumn(column, F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, named)


def names_not_in(all_names: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Names of the first table that the second one lacks."""
    return all_names.select(key).join(kept.select(key), key, "left_anti")
