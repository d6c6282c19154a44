"""Quantiles of large groups, interval sums, rolling moments and distinct sketches."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallycast.operators import intervals, sketches
from tallycast.operators.quantiles import group_quantiles
from tallycast.operators.rolling import fewest_values, with_rolling

D = dt.date


@pytest.fixture(scope="module")
def values(spark):
    random = np.random.default_rng(1)
    rows = [(int(k) if k < 3 else None, float(v), float(w)) for k, v, w in zip(
        random.integers(0, 4, 1500), np.round(random.lognormal(0, 2, 1500), 2), random.choice([0.2, 1, 2], 1500))]
    rows += [(0, 1.5, 1.0)] * 400 + [(1, None, 1.0), (1, float("nan"), 1.0), (9, None, 1.0), (2, 5.0, 0.0), (2, 7.0, -1.0)]
    return rows, spark.createDataFrame(rows, "k int, v double, w double").cache()


def of_group(rows, key):
    return np.array([(v, w) for k, v, w in rows if k == key and v is not None and not math.isnan(v)])


@pytest.mark.parametrize("limit", [50, 1 << 20])
def test_quantiles_equal_sorted_groups(values, limit):
    rows, df = values
    for share in (0.0, 0.5, 0.9):
        got = {r.k: r.quantile for r in group_quantiles(df, "v", share, keys=["k"], limit=limit).collect()}
        assert set(got) == {0, 1, 2, None}
        for key, value in got.items():
            assert value == pytest.approx(np.quantile(of_group(rows, key)[:, 0], share), abs=1e-12)
    got = {r.k: r.m for r in group_quantiles(df, "v", 0.3, keys=["k"], weight="w", name="m", limit=limit).collect()}
    for key, value in got.items():
        own = of_group(rows, key)
        own = own[(own[:, 1] > 0)]
        own = own[np.argsort(own[:, 0], kind="stable")]
        upto = np.cumsum(own[:, 1])
        assert value == own[np.searchsorted(upto, 0.3 * upto[-1] - 1e-9), 0]


def test_quantiles_of_one_value_and_of_nothing(spark, values):
    same = spark.range(5000).select(F.lit(2.5).alias("v"))
    assert group_quantiles(same, "v", 0.5, limit=10).first()["quantile"] == 2.5
    assert group_quantiles(values[1].where("false"), "v", 0.5).count() == 0
    assert group_quantiles(values[1].where("k = 9"), "v", 0.5, keys=["k"]).count() == 0


def test_intervals_sum_exactly_whatever_their_length(spark):
    random = np.random.default_rng(2)
    first = D(2019, 12, 20)
    days = [first + dt.timedelta(days=int(k)) for k in range(700) if k % 50 != 7]
    rows = []
    for _ in range(300):
        lo = first + dt.timedelta(days=int(random.integers(-400, 800)))
        rows.append((lo, lo + dt.timedelta(days=int(random.integers(-3, 1500))), float(random.integers(1, 400)) / 10,
                     [None, "Streetwear", "Outdoor", "Other"][int(random.integers(0, 4))]))
    rows += [(None, first, 1.0, None), (first, None, 1.0, None), (days[5], days[5], None, "Outdoor")]
    table = spark.createDataFrame(rows, "start_date date, end_date date, discount_value double, applicable_category string")
    asked = spark.createDataFrame([(day, k) for k, day in enumerate(days)] + [(days[0], -1)], "Date date, n int")
    got = intervals.active_by_day(asked, table).collect()
    assert len(got) == len(days) + 1
    for row in got:
        on = [r for r in rows if r[0] and r[1] and r[0] <= row.Date <= r[1]]
        assert row.n_active_promos == len(on)
        assert row.sum_discount_active == pytest.approx(sum(r[2] or 0.0 for r in on), abs=1e-9)
        assert row.has_outdoor_promo == int(any(r[3] == "Outdoor" for r in on))
        assert row.has_streetwear_promo == int(any(r[3] == "Streetwear" for r in on))
    none = intervals.active_by_day(asked, table.where("false")).collect()
    assert {(r.n_active_promos, r.sum_discount_active, r.has_outdoor_promo) for r in none} == {(0, 0.0, 0)}


def test_rolling_moments_keep_small_deviations_behind_a_large_level(spark):
    random = np.random.default_rng(3)
    y = np.concatenate([1e9 + random.normal(0, 1, 120), np.full(60, 1e9), 1e9 + random.normal(0, 1e-2, 120)])
    y[[5, 40, 41, 200]] = np.nan
    rows = [(s, D(2020, 1, 1) + dt.timedelta(days=k), None if np.isnan(v) and k != 40 else float(v) + s)
            for s in (0, 1) for k, v in enumerate(y)]
    df = spark.createDataFrame(rows, "s int, Date date, y double").repartition(3)
    widths = (2, 7, 30, 365)
    got = with_rolling(df, "y", ["s"], widths).orderBy("s", "Date").toPandas()
    for s in (0, 1):
        own = got[got.s == s].reset_index(drop=True)
        past = (pd.Series(y) - 1e9).shift(1)
        for width in widths:
            roll = past.rolling(width, min_periods=fewest_values(width))
            np.testing.assert_allclose(own[f"y_roll_mean_{width}"] - 1e9 - s, roll.mean(), atol=1e-6)
            # Doubles near 1e9 are 1e-7 apart; nothing beyond that is lost.
            want = np.array([np.nan if np.isnan(m) else np.nanstd(past[max(0, k - width + 1):k + 1], ddof=1)
                             for k, m in enumerate(roll.mean())])
            np.testing.assert_allclose(own[f"y_roll_std_{width}"], want, atol=2e-6)
        flat = own.loc[120 + 31:179, "y_roll_std_30"]
        assert (flat == 0.0).all()


def test_sketches_of_days_add_up(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 9000).alias("customer"), F.date_add(F.lit("2021-01-01"), (F.col("id") % 90).cast("int")).alias("day"))
    rows = rows.unionByName(spark.createDataFrame([(1, None), (None, D(2021, 1, 1))], "customer long, day date"))
    daily = sketches.daily_sketches(rows, "customer", date="day").cache()
    assert daily.count() == 90
    month = F.date_trunc("month", "Date").cast("date")
    got = {r.period: r.n_distinct for r in sketches.distinct_in(daily, month).collect()}
    exact = {r.m: r.n for r in rows.where("day is not null").groupBy(F.trunc("day", "month").alias("m")).agg(
        F.count_distinct("customer").alias("n")).collect()}
    assert set(got) == set(exact)
    for key, n in exact.items():
        assert abs(got[key] - n) <= 4 * sketches.standard_error() * n
