"""Window features over daily rows.

Every window is partitioned by the series key.  Facts are reduced to at most
one row per series and day before, so the calendar bounds a partition however
many facts a series has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import ratio

NEGLIGIBLE_WEIGHT = 1e-16


def by_date(keys: Sequence[str], date: str = "Date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date)


def lag_columns(value: str, rows: WindowSpec, lags: Sequence[int] = constants.LAGS) -> dict[str, Column]:
    return {f"{value}_lag_{k}": F.lag(value, k).over(rows) for k in lags}


def with_ewm(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    spans: Sequence[int] = constants.EWM_SPANS,
    min_rows: int = 3,
) -> DataFrame:
    """Exponentially weighted mean of the previous rows, one column per span.

    The recursion ``e = a*y + (1-a)*e_prev`` unrolls into a weighted sum.  Rows
    are cut into blocks long enough for weights beyond one whole block to
    vanish in double precision, so running sums over a row's own block plus the
    closing value of the block before give the mean in constant work per row.
    A missing value makes all later means of its series null.
    """
    block_rows = max(_memory_rows(span) for span in spans)
    if len(spans) > 1 and any(_grows_too_large(span, block_rows) for span in spans):
        for span in spans:
            df = with_ewm(df, value, keys, (span,), min_rows)
        return df
    rows = by_date(keys)
    position, block, offset = "__pos", "__block", "__off"
    out = df.withColumn(position, F.row_number().over(rows) - 1).withColumns({
        block: F.floor(F.col(position) / block_rows),
        offset: F.col(position) % block_rows,
    })
    in_block = Window.partitionBy(*keys, block).orderBy("Date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    age = F.col(offset).cast("double")

    own = {}
    for span in spans:
        decay = _decay(span)
        if decay == 0.0:
            own[f"__own_{span}"] = F.col(value)
            continue
        share = F.when(F.col(position) == 0, F.lit(1.0)).otherwise(F.lit(1.0 - decay))
        grown = F.sum(F.col(value) * share * F.pow(F.lit(decay), -age)).over(in_block)
        own[f"__own_{span}"] = grown * F.pow(F.lit(decay), age)
    out = out.withColumns(own)

    closes_block = F.col(offset) == block_rows - 1
    full = {}
    for span in spans:
        closing = F.last(F.when(closes_block, F.col(f"__own_{span}")), ignorenulls=True).over(before)
        carried = closing * F.pow(F.lit(_decay(span)), age + 1)
        full[f"__ewm_{span}"] = F.col(f"__own_{span}") + F.coalesce(carried, F.lit(0.0))
    out = out.withColumns(full)

    usable = (F.count(value).over(before) == F.col(position)) & (F.col(position) >= min_rows)
    result = {
        f"{value}_ewm_{span}": F.when(usable, F.lag(f"__ewm_{span}").over(rows)) for span in spans
    }
    return out.withColumns(result).drop(position, block, offset, *own, *full)


def _decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1)


def _memory_rows(span: int) -> int:
    """Rows after which a value's weight is negligible."""
    decay = _decay(span)
    return math.ceil(math.log(NEGLIGIBLE_WEIGHT) / math.log(decay)) if decay > 0.0 else 1


def _grows_too_large(span: int, block_rows: int) -> bool:
    decay = _decay(span)
    return decay > 0.0 and -block_rows * math.log(decay) > 600.0


def change_from_previous(value: Column, rows: WindowSpec) -> Column:
    """Relative change to the previous row; null on the first."""
    return ratio(value, F.lag(value).over(rows)) - 1


def days_to_latest(date: str, keys: Sequence[str]) -> Column:
    """Age in days relative to the newest row of the series."""
    newest = F.max(date).over(Window.partitionBy(*keys))
    return F.greatest(F.datediff(newest, F.col(date)), F.lit(0))


def order_gap_counts(orders: DataFrame, *, customer: str, date: str) -> DataFrame:
    """Days between consecutive orders of a customer, as a histogram.

    Orders are counted per customer and day first, so a window holds at most
    one row per day even for a customer with a large part of all orders.
    Further orders of one day are gaps of zero.
    """
    days = orders.dropna(subset=[customer, date]).groupBy(customer, date).agg(
        F.count(F.lit(1)).alias("n"))
    previous = F.lag(date).over(Window.partitionBy(customer).orderBy(date))
    gaps = days.select(F.datediff(F.col(date), previous).alias("gap"), "n")
    moves = F.array(
        F.struct(F.col("gap").alias("gap"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.lit(0).alias("gap"), (F.col("n") - 1).alias("n")),
    )
    return (
        gaps.select(F.inline(moves))
        .where(F.col("gap").isNotNull() & (F.col("n") > 0))
        .groupBy("gap")
        .agg(F.sum("n").alias("n"))
    )
