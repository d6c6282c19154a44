"""Joins between days and intervals or nearby events, as equi joins on the day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import flag

BLOCK_DAYS = 256
VALUE_DIGITS = 8


def active_by_day(
    days: DataFrame,
    intervals: DataFrame,
    *,
    start: str = "start_date",
    end: str = "end_date",
    value: str = "discount_value",
    category: str = "applicable_category",
    category_flags: Mapping[str, str] = constants.PROMO_CATEGORY_FLAGS,
) -> DataFrame:
    """Number of active intervals, their value sum and category flags per day.

    Both ends are inclusive.  An interval, clipped to the days asked for, adds one
    at its first day and takes it back on the day after its last; these changes are
    summed per day, which leaves at most two rows for every calendar day however many and
    however long the intervals are, and run up over the calendar.  Values are summed
    as decimals with ``VALUE_DIGITS`` digits, so that what was added is taken back
    exactly.
    """
    asked = days.agg(F.struct(F.min("Date").alias("first"), F.max("Date").alias("last"))).scalar()
    changes = {"n_active_promos": F.lit(1), "sum_discount_active": F.col(value).cast(f"decimal(28,{VALUE_DIGITS})"),
               **{out: flag(F.col(category) == name) for name, out in category_flags.items()}}
    clipped = intervals.where(F.col(start) <= F.col(end)).select(
        F.greatest(F.col(start), asked["first"]).alias("lo"), F.least(F.col(end), asked["last"]).alias("hi"),
        *[F.coalesce(change, F.lit(0)).alias(name) for name, change in changes.items()]).where("lo <= hi")
    # Intervals of the same days are one before they become two changes.
    packed = clipped.groupBy("lo", "hi").agg(*[F.sum(name).alias(name) for name in changes])
    opened = packed.select(F.inline(F.array(
        F.struct(F.col("lo").alias("Date"), *changes),
        F.struct(F.date_add("hi", 1).alias("Date"), *[(-F.col(name)).alias(name) for name in changes]))))
    per_day = running_totals(opened.groupBy("Date").agg(*[F.sum(name).alias(name) for name in changes]), list(changes), days)
    found = days.join(per_day, "Date", "left")
    return found.withColumns({
        "n_active_promos": F.coalesce("n_active_promos", F.lit(0)).cast("int"),
        "sum_discount_active": F.coalesce(F.col("sum_discount_active").cast("double"), F.lit(0.0)),
        **{out: flag(F.col(out) > 0) for out in category_flags.values()}})


def running_totals(changes: DataFrame, names: Sequence[str], days: DataFrame) -> DataFrame:
    """Sums of all changes up to each of the asked days (columns ``Date`` and names).

    The calendar is cut into blocks of ``BLOCK_DAYS``; days run up within a block, and
    the sum of a block is handed to every later one (one row per pair of blocks).
    """
    block = F.floor(F.datediff("Date", F.lit("1970-01-01")) / BLOCK_DAYS)
    rows = days.select("Date").distinct().withColumns({name: F.lit(0) for name in names}).unionByName(
        changes).groupBy("Date").agg(*[F.sum(name).alias(name) for name in names]).withColumn("block", block)
    within = Window.partitionBy("block").orderBy("Date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.select("Date", "block", *[F.sum(name).over(within).alias(name) for name in names])
    sums = rows.groupBy("block").agg(*[F.sum(name).alias(name) for name in names])
    last = sums.agg(F.max("block")).scalar()
    later = sums.where(F.col("block") < last).withColumn(
        "block", F.explode(F.sequence(F.col("block") + 1, last))).groupBy("block").agg(
            *[F.sum(name).alias(f"before_{name}") for name in names])
    return run.join(later, "block", "left").select(
        "Date", *[(F.col(name) + F.coalesce(f"before_{name}", F.lit(0))).alias(name) for name in names])


def nearest_event_offset(
    days: DataFrame,
    events: DataFrame,
    *,
    event_date: str = "event_date",
    reach: int = constants.EVENT_REACH_DAYS,
    far: int = constants.EVENT_FAR,
    name: str = "tet_days_diff",
) -> DataFrame:
    """Signed days since the nearest event, ``far`` when none lies within reach.

    Each event is opened into the days around it and the nearest event per day
    is kept (the earlier one on equal distance), so days join by equality.
    """
    around = events.select(
        F.col(event_date).alias("event"),
        F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("offset"),
    ).select(F.date_add("event", F.col("offset")).alias("Date"), "event", "offset")
    nearest = around.groupBy("Date").agg(
        F.min_by("offset", F.struct(F.abs("offset"), F.col("event"))).alias(name))
    return days.join(nearest, "Date", "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(far)))
