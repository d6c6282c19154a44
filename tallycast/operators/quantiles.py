"""Exact quantiles of groups of any size.

Spark's exact percentile keeps every different value of a group in one buffer.
Here a group is narrowed down instead: its range is cut into ``CELLS`` cells, one
pass sums the rows per cell, and the cell in which the wanted rank lies becomes
the next range.  Only a range of at most ``limit`` rows is sorted, after equal
values have been added up.  Ranges meet the rows by broadcast while there are at
most ``BROADCAST_GROUPS`` groups, so that a large group stays spread over all tasks.
The driver sees two numbers a pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallycast.session import cut_lineage

CELLS = 1024
LIMIT = 1 << 20
BROADCAST_GROUPS = 1 << 16


def group_quantiles(
    df: DataFrame, value: str, share: float, *, keys: Sequence[str] = (), weight: str | None = None,
    name: str = "quantile", limit: int = LIMIT,
) -> DataFrame:
    """``keys`` and the quantile of the known values of each group.

    Without weights it lies between the two middle values in proportion, as SQL's
    ``median`` does; with weights it is the smallest value up to which ``share`` of
    the weight lies, and rows without a positive weight do not count.  NaN counts
    as unknown.  Null keys are groups of their own.  A group without a known value
    has no row; an empty table gives no rows.
    """
    own = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    known = df.select(*[F.col(f"`{key}`") for key in keys], F.col(value).cast("double").alias("__v"), own.alias("__w")).where(
        "__v is not null and not isnan(__v) and __w > 0")
    # The last field is 0 in every row; as a constant it would make the joins cross joins.
    rows = known.select(
        F.struct(*[F.col(f"`{key}`") for key in keys], F.least(F.abs("__v"), F.lit(0.0)).alias("__all")).alias("g"),
        F.col("__v").alias("v"), F.col("__w").alias("w"))
    found = rows.groupBy("g").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"), F.sum("w").alias("total"))
    place = F.lit(share) * (F.col("total") - 1)
    target = F.floor(place) + 1 if weight is None else F.lit(share) * F.col("total")
    state = cut_lineage(found.select(
        "g", "lo", "hi", "n", F.lit(0.0).alias("below"), F.lit(None).cast("double").alias("after"),
        target.cast("double").alias("target"),
        (place - F.floor(place) if weight is None else F.lit(0.0)).alias("onwards")))
    while (state.where("lo < hi").agg(F.max("n")).first()[0] or 0) > limit:
        state = cut_lineage(_narrowed(rows, state))
    return _finished(rows, state).select(*[F.col("g").getField(key).alias(key) for key in keys], F.col("q").alias(name))


def _within(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows inside the range of their group."""
    ranges = F.broadcast(state) if state.count() <= BROADCAST_GROUPS else state
    return rows.join(ranges, rows["g"].eqNullSafe(state["g"])).drop(rows["g"]).where("v between lo and hi")


def _so_far(order: str) -> WindowSpec:
    return Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _narrowed(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Each group's range cut down to the cell in which its rank lies."""
    kept = ("g", "target", "onwards")
    cell = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * CELLS), F.lit(CELLS - 1))
    cells = _within(rows, state).withColumn("cell", F.when(F.col("lo") < F.col("hi"), cell).otherwise(0)).groupBy(
        *kept, "below", "after", "cell").agg(
            F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"), F.sum("w").alias("w"))
    # At most CELLS rows a group.
    placed = cells.withColumns({
        "upto": F.col("below") + F.sum("w").over(_so_far("cell")),
        "next": F.coalesce(F.lead("low").over(Window.partitionBy("g").orderBy("cell")), "after"),
        "last": F.row_number().over(Window.partitionBy("g").orderBy(F.desc("cell"))) == 1})
    hit = placed.where((F.col("upto") >= F.col("target")) | F.col("last")).withColumn(
        "turn", F.row_number().over(Window.partitionBy("g").orderBy("cell"))).where("turn = 1")
    return hit.select(
        "g", F.col("low").alias("lo"), F.col("high").alias("hi"), "n", (F.col("upto") - F.col("w")).alias("below"),
        F.col("next").alias("after"), "target", "onwards")


def _finished(rows: DataFrame, state: DataFrame) -> DataFrame:
    values = _within(rows, state).groupBy("g", "below", "after", "target", "onwards", "v").agg(F.sum("w").alias("w"))
    upto = values.withColumn("upto", F.col("below") + F.sum("w").over(_so_far("v")))
    middle = upto.groupBy("g", "after", "onwards").agg(
        F.coalesce(F.min(F.when(F.col("upto") >= F.col("target"), F.col("v"))), F.max("v")).alias("one"),
        F.min(F.when(F.col("upto") >= F.col("target") + 1, F.col("v"))).alias("two"))
    two = F.coalesce("two", "after", "one")
    return middle.select("g", (F.col("one") + F.col("onwards") * (two - F.col("one"))).alias("q"))
