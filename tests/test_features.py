"""Day features with the published constants, against plain date arithmetic."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tallycast import constants as C
from tallycast.operators import features, weights
from tallycast.operators.dynamic import dynamic_names
from tallycast.sources import dimensions

D = dt.date


@pytest.fixture(scope="module")
def spine(spark):
    return dimensions.date_spine(spark, C.TRAIN_START, C.FORECAST_END).cache()


@pytest.fixture(scope="module")
def promotions(spark):
    rows = []
    for name, month, day, length, value, recur in C.PROMO_SCHEDULE:
        for year in range(2013, 2023):
            if recur == "yearly" or year % 2:
                start = D(year, month, day)
                rows.append((name, start, start + dt.timedelta(days=length), value,
                             {"urban_blowout": "Streetwear", "rural_special": "Outdoor"}.get(name)))
    return spark.createDataFrame(
        rows, "promo_id string, start_date date, end_date date, discount_value double, applicable_category string").cache()


@pytest.fixture(scope="module")
def table(spark, spine, promotions):
    return features.build_features(
        spine, promotions=promotions, lunar_events=dimensions.lunar_new_year(spark)).cache()


@pytest.fixture(scope="module")
def rows(table):
    return {r.Date: r for r in table.collect()}


def test_row_and_feature_counts(spine, table):
    train = spine.where(F.col("Date") <= F.lit(C.TRAIN_END))
    assert train.count() == 3833
    assert spine.where(F.col("Date") >= F.lit(C.FORECAST_START)).count() == 548
    assert train.where(weights.in_holdout(F.col("Date"), C.HOLDOUT_AFTER)).count() == 180
    assert train.where(weights.stable_year_weight(F.col("Date")) == 1.0).count() == 1826
    assert train.where(F.col("Date") >= F.lit(C.WARMUP_END)).count() == 3103
    names = features.feature_names(table)
    assert len(names) == len(set(names)) == 88
    assert len(names) + sum(len(dynamic_names(t)) for t in C.TARGETS) == 142
    assert table.count() == 4381


def test_calendar_values(rows):
    for date, r in rows.items():
        month_end = (date.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        assert (r.year, r.month, r.day, r.dow) == (date.year, date.month, date.day, date.weekday())
        assert (r.doy, r.dim) == (date.timetuple().tm_yday, month_end.day)
        assert r.quarter == (date.month + 2) // 3 and r.is_weekend == (date.weekday() in (5, 6))
        left = (month_end - date).days
        assert (r.days_to_eom, r.is_last1, r.is_last3) == (left, left == 0, left <= 2)
        assert (r.days_from_som, r.is_first2) == (date.day - 1, date.day <= 2)
        assert r.t_days == (date - D(2020, 1, 1)).days and r.t_years == pytest.approx(r.t_days / 365.25)
        assert (r.regime_pre2019, r.regime_2019, r.regime_post2019) == (
            date.year < 2019, date.year == 2019, date.year > 2019)
        assert r.sin_y3 == pytest.approx(math.sin(2 * math.pi * 3 * r.doy / 365.25), abs=1e-12)
        assert r.cos_w2 == pytest.approx(math.cos(2 * math.pi * 2 * r.dow / 7), abs=1e-12)
        assert r.sin_m2 == pytest.approx(math.sin(4 * math.pi * (r.day - 1) / r.dim), abs=1e-12)


def test_holidays_and_black_friday(rows):
    friday = {2012: 30, 2013: 29, 2014: 28, 2015: 27, 2016: 25, 2017: 24, 2018: 30, 2019: 29,
              2020: 27, 2021: 26, 2022: 25, 2023: 24}
    assert {d.year: d.day for d, r in rows.items() if r.hol_black_friday} == friday
    assert all(r.hol_christmas == (d.month == 12 and d.day == 25) for d, r in rows.items())


def test_lunar_offsets(rows):
    far = 0
    for date, r in rows.items():
        offsets = [(date - event).days for event in C.LUNAR_NEW_YEAR.values()]
        near = sorted((o for o in offsets if abs(o) <= 60), key=lambda o: (abs(o), -o))
        expected = near[0] if near else 999
        far += expected == 999
        assert r.tet_days_diff == expected
        assert r.tet_before_7 == (-7 <= expected <= -1) and r.tet_after_7 == (1 <= expected <= 7)
        assert (r.tet_in_14, r.tet_on) == (abs(expected) <= 14, expected == 0)
    assert far == 2929


def test_recurring_windows(rows):
    for date, r in rows.items():
        for name, month, day, length, value, recur in C.PROMO_SCHEDULE:
            inside = [
                (date - start).days
                for start in (D(date.year, month, day), D(date.year - 1, month, day))
                if 0 <= (date - start).days <= length and (recur == "yearly" or start.year % 2)]
            expected = (1, inside[0], length - inside[0], value) if inside else (0, -1, -1, 0.0)
            assert (r[f"promo_{name}"], r[f"promo_{name}_since"], r[f"promo_{name}_until"],
                    r[f"promo_{name}_disc"]) == expected


def test_window_from_29_february_exists_in_leap_years_only(spark):
    days = spark.createDataFrame([(D(2023, 3, 1),), (D(2024, 3, 1),), (D(2025, 2, 20),)], "Date date")
    got = features.with_promo_windows(days, [("leap", 2, 29, 400, 5, "yearly")]).collect()
    assert {r.Date: r.promo_leap_since for r in got} == {
        D(2023, 3, 1): -1.0, D(2024, 3, 1): 1.0, D(2025, 2, 20): 357.0}


def test_active_promotions(rows, promotions):
    spans = [tuple(r) for r in promotions.collect()]
    for date, r in rows.items():
        active = [p for p in spans if p[1] <= date <= p[2]]
        assert r.n_active_promos == len(active)
        assert r.sum_discount_active == sum(p[3] for p in active)
        assert r.has_streetwear_promo == any(p[4] == "Streetwear" for p in active)


def test_lunar_aligned_lag(spark, spine):
    history = spine.where(F.col("Date") <= F.lit(C.TRAIN_END)).select(
        "Date", F.datediff(F.col("Date"), F.lit(D(2000, 1, 1))).cast("double").alias("Revenue"), F.lit(1.0).alias("COGS"))
    got = {r.Date: r.rev_tet_aligned_lag for r in features.lunar_aligned_lag(spine, history).collect()}
    number = lambda d: float((d - D(2000, 1, 1)).days)
    assert got[D(2024, 2, 10)] == number(D(2022, 2, 1))
    assert got[D(2023, 1, 25)] == number(D(2022, 2, 4))
    assert got[D(2012, 8, 1)] is None
    assert got[D(2014, 1, 31)] == number(D(2013, 2, 10))
    ahead = features.lunar_aligned_lag(
        spine.where("Date = date'2012-07-10'"), history, fallback_year=2022).first()
    assert ahead.rev_tet_aligned_lag == number(D(2022, 2, 1) + (D(2012, 7, 10) - D(2012, 1, 23)))


def test_dimension_tables(spark):
    assert dimensions.fixed_holidays(spark).count() == 10
    assert dimensions.lunar_new_year(spark).agg(F.max("event_date")).first()[0] == D(2024, 2, 10)
    assert dimensions.promo_schedule(spark).where("recur = 'odd'").count() == 2
    days = spark.createDataFrame([(D(2020, 1, 1),), (D(2020, 1, 5),)], "Date date")
    assert dimensions.spine_of(days).count() == 5


def test_calendar_joins_without_a_hint(table, spine):
    joined = features.attach_days(spine.withColumn("series", F.lit("a")), table)
    assert joined.count() == 4381
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
