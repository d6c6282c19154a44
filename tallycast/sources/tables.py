"""Reading retail tables from CSV or Parquet folders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.sources.schemas import schema_of


def read_csv_table(
    spark: SparkSession, folder: str, table: str, *, further: Mapping[str, str] | None = None,
) -> DataFrame:
    """A CSV table with its fixed schema, and those of the ``further`` columns (name to
    type) that the file has.

    Columns are matched by header name, so files may hold other columns or
    another order; empty cells and NaN become null.
    """
    path = f"{folder}/{table}.csv"
    wanted = schema_of(table)
    raw = spark.read.option("header", True).csv(path)
    more = {name: kind for name, kind in (further or {}).items() if name in raw.columns}
    return raw.select(
        *[_typed(F.col(field.name), field.dataType.simpleString()).alias(field.name) for field in wanted],
        *[_typed(F.col(name), kind).alias(name) for name, kind in more.items()])


def unreadable_cells(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Per column of a CSV table: cells with text that its type cannot hold (``unreadable``)
    and all cells (``cells``).  Empty cells and NaN are missing, not unreadable."""
    wanted = schema_of(table)
    raw = spark.read.option("header", True).csv(f"{folder}/{table}.csv")
    counts = []
    for field in wanted:
        value = F.trim(F.col(field.name))
        typed = _typed(F.col(field.name), field.dataType.simpleString())
        lost = typed.isNull() & (value != "") & (F.lower(value) != "nan")
        counts.append(F.struct(F.lit(field.name).alias("column"), F.count_if(lost).alias("unreadable"),
                               F.count(F.lit(1)).alias("cells")))
    return raw.agg(F.array(*counts).alias("found")).select(F.inline("found"))


def _typed(column, type_name: str):
    value = F.trim(column)
    if type_name == "date":
        return F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd")
    typed = value.try_cast(type_name)
    if type_name == "double":
        return F.when(~F.isnan(typed), typed)
    return F.when(value != "", typed) if type_name == "string" else typed


def read_parquet_table(
    spark: SparkSession, folder: str, table: str, *, dates: Iterable[str] = ()
) -> DataFrame:
    """A Parquet table; midnight timestamps named in ``dates`` become dates."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.withColumns({name: F.to_date(F.col(name)) for name in dates}) if dates else df
