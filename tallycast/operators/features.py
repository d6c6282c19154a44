"""Calendar, event and promotion features of a day.

The features depend on the day only.  They are built once per day on a
calendar table and joined to the panel by ``Date``, never computed per row.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import flag
from tallycast.operators.intervals import active_by_day, nearest_event_offset

NOT_FEATURES = ("Date", "Revenue", "COGS")


def calendar_columns(
    date: Column,
    *,
    origin: dt.date = constants.TREND_ORIGIN,
    regime_year: int = constants.REGIME_YEAR,
    paydays: Sequence[int] = constants.PAYDAYS,
) -> dict[str, Column]:
    """Date parts, month edges, pay days, trend and regime flags."""
    year, day, weekday = F.year(date), F.dayofmonth(date), F.weekday(date)
    month_length = F.dayofmonth(F.last_day(date))
    left, passed = month_length - day, day - 1
    trend = F.datediff(date, F.lit(origin))
    columns = {
        "year": year,
        "month": F.month(date),
        "day": day,
        "dow": weekday,
        "doy": F.dayofyear(date),
        "quarter": F.quarter(date),
        "dim": month_length,
        "is_weekend": flag(weekday > 4),
        "days_to_eom": left,
        "days_from_som": passed,
    }
    for edge in range(1, 4):
        columns[f"is_last{edge}"] = flag(left < edge)
        columns[f"is_first{edge}"] = flag(passed < edge)
    columns |= {
        "is_payday": flag(day.isin(*paydays)),
        "is_month_end_zone": flag(day >= constants.MONTH_END_ZONE_FROM),
        "t_days": trend,
        "t_years": trend / constants.YEAR_LENGTH,
        "regime_pre2019": flag(year < regime_year),
        "regime_2019": flag(year == regime_year),
        "regime_post2019": flag(year > regime_year),
        "is_odd_year": year % 2,
    }
    return columns


def fourier_columns(
    date: Column, harmonics: Mapping[str, int] = constants.FOURIER_HARMONICS
) -> dict[str, Column]:
    """Sine and cosine terms of the yearly, weekly and monthly cycle."""
    position = {
        "y": F.dayofyear(date) / constants.YEAR_LENGTH,
        "w": F.weekday(date) / 7.0,
        "m": (F.dayofmonth(date) - 1) / F.dayofmonth(F.last_day(date)),
    }
    columns = {}
    for cycle, count in harmonics.items():
        for k in range(1, count + 1):
            angle = position[cycle] * (2.0 * math.pi * k)
            columns[f"sin_{cycle}{k}"] = F.sin(angle)
            columns[f"cos_{cycle}{k}"] = F.cos(angle)
    return columns


def holiday_columns(
    date: Column, holidays: Sequence[tuple[int, int, str]] = constants.FIXED_HOLIDAYS
) -> dict[str, Column]:
    """One flag per fixed holiday and one for the last Friday of November."""
    columns = {
        f"hol_{name}": flag((F.month(date) == month) & (F.dayofmonth(date) == day))
        for month, day, name in holidays
    }
    week_before_end = F.make_date(F.year(date), F.lit(11), F.lit(23))
    columns["hol_black_friday"] = flag(date == F.next_day(week_before_end, "FRI"))
    return columns


def lunar_window_columns(offset: Column) -> dict[str, Column]:
    """Windows around the lunar new year from the signed day offset."""
    columns = {f"tet_in_{reach}": flag(F.abs(offset) <= reach) for reach in (7, 14, 21)}
    columns["tet_before_7"] = flag(offset.between(-7, -1))
    columns["tet_after_7"] = flag(offset.between(1, 7))
    columns["tet_on"] = flag(offset == 0)
    return columns


def with_promo_windows(
    df: DataFrame, schedule: Sequence[tuple] = constants.PROMO_SCHEDULE, date: str = "Date"
) -> DataFrame:
    """Flag, days since start, days to end and discount of each recurring promotion.

    The latest start that still covers the day decides.  The starts are columns
    of their own first, so that the four features share one computation.
    """
    day = F.col(date)
    begun = {
        name: _covering_start(day, month, start_day, length, recur).alias(f"__{name}")
        for name, month, start_day, length, _, recur in schedule
    }
    started = df.select("*", *begun.values())
    columns = []
    for name, _, _, length, discount, _ in schedule:
        start = F.col(f"__{name}")
        since = F.datediff(day, start)
        columns += [
            flag(start.isNotNull()).alias(f"promo_{name}"),
            F.coalesce(since, F.lit(-1)).cast("double").alias(f"promo_{name}_since"),
            F.coalesce(length - since, F.lit(-1)).cast("double").alias(f"promo_{name}_until"),
            F.when(start.isNotNull(), float(discount or 0)).otherwise(0.0).alias(f"promo_{name}_disc"),
        ]
    return started.select(*df.columns, *columns)


def _covering_start(day: Column, month: int, start_day: int, length: int, recur: str) -> Column:
    """Start of the window that covers the day, null outside of all windows."""
    starts = []
    for years_back in range(length // 365 + 2):
        year = F.year(day) - years_back
        start = _day_of_year(year, month, start_day)
        covers = (start <= day) & (day <= F.date_add(start, length))
        if recur == "odd":
            covers = covers & (year % 2 == 1)
        starts.append(F.when(covers, start))
    return F.coalesce(*starts)


def _day_of_year(year: Column, month: int, day: int) -> Column:
    """A date in each year; null in years without that day (29 February)."""
    if (month, day) == (2, 29):
        last = F.last_day(F.make_date(year, F.lit(2), F.lit(1)))
        return F.when(F.dayofmonth(last) == 29, last)
    return F.make_date(year, F.lit(month), F.lit(day))


def lunar_aligned_lag(
    df: DataFrame,
    history: DataFrame,
    *,
    keys: Sequence[str] = (),
    lunar: Mapping[int, dt.date] = constants.LUNAR_NEW_YEAR,
    last_known_year: int = constants.TRAIN_END.year,
    values: Mapping[str, str] | None = None,
    fallback_year: int | None = None,
) -> DataFrame:
    """Values at the same offset from the lunar new year in the latest earlier year.

    Without an earlier year the result is null, unless ``fallback_year`` names
    the year to use (which looks ahead for the oldest rows).
    """
    values = values or {"Revenue": "rev_tet_aligned_lag", "COGS": "cogs_tet_aligned_lag"}
    date, year = F.col("Date"), F.year("Date")
    known = sorted(y for y in lunar if y <= last_known_year)
    own = F.coalesce(*[F.when(year == y, F.lit(lunar[y])) for y in sorted(lunar)])
    earlier = [F.when(year > y, F.lit(lunar[y])) for y in reversed(known)]
    if fallback_year is not None:
        earlier.append(F.lit(lunar[fallback_year]))
    shift = F.coalesce(F.datediff(date, own), F.lit(0))
    asked = df.withColumn("__reference", F.date_add(F.coalesce(*earlier), shift))
    past = history.select(
        *keys, F.col("Date").alias("__reference"),
        *[F.col(name).alias(out) for name, out in values.items()])
    return asked.join(past, [*keys, "__reference"], "left").drop("__reference")


def with_lunar(days: DataFrame, events: DataFrame) -> DataFrame:
    offsets = nearest_event_offset(days, events)
    return offsets.withColumns(lunar_window_columns(F.col("tet_days_diff")))


def build_features(
    days: DataFrame,
    *,
    promotions: DataFrame,
    lunar_events: DataFrame,
    origin: dt.date = constants.TREND_ORIGIN,
    regime_year: int = constants.REGIME_YEAR,
    holidays: Sequence[tuple[int, int, str]] = constants.FIXED_HOLIDAYS,
    schedule: Sequence[tuple] = constants.PROMO_SCHEDULE,
) -> DataFrame:
    """The calendar feature table: one row per day of ``days`` (column ``Date``)."""
    date = F.col("Date")
    plain = days.withColumns(
        calendar_columns(date, origin=origin, regime_year=regime_year)
        | fourier_columns(date)
        | holiday_columns(date, holidays)
    )
    lunar = with_lunar(plain, lunar_events)
    return active_by_day(with_promo_windows(lunar, schedule), promotions)


def attach_days(panel: DataFrame, days: DataFrame) -> DataFrame:
    """Join calendar features, one row per day, to a panel by day."""
    return panel.join(days, "Date")


def feature_names(df: DataFrame, *, exclude: Sequence[str] = ()) -> list[str]:
    """Feature columns in table order."""
    left_out = {*NOT_FEATURES, *exclude}
    return [name for name in df.columns if name not in left_out]
