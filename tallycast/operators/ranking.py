"""Top rows, fixed-size samples, ranked tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast import constants


def top_rows(df: DataFrame, value: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` largest rows, ties in key order."""
    return df.orderBy(F.col(value).desc_nulls_last(), *[F.asc(tie) for tie in ties]).limit(n)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.desc(name) for name in order]).limit(n)


def fixed_sample(
    df: DataFrame, n: int, *, keys: Sequence[str], seed: int = constants.SEED
) -> DataFrame:
    """``n`` rows without replacement, the same rows for any partitioning."""
    mixed = F.md5(F.concat_ws("|", *[F.col(key).cast("string") for key in keys], F.lit(str(seed))))
    return df.orderBy(mixed, *keys).limit(n)


def ranked(df: DataFrame, value: str, n: int, *, within: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """The ``n`` largest rows per group with their rank number from 1."""
    order = Window.partitionBy(*within).orderBy(
        F.col(value).desc_nulls_last(), *[F.asc(tie) for tie in ties])
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
