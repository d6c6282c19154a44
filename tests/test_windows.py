"""Past-value features against pandas, weights, calibration against brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallycast import constants as C
from tallycast.operators import weights
from tallycast.operators.calibration import best_multiplier, calibration_errors, grid_size
from tallycast.operators.dynamic import dynamic_names, with_dynamic_features
from tallycast.operators.windows import by_date, change_from_previous, with_ewm
from tallycast.plans import variants

D = dt.date


@pytest.fixture(scope="module")
def frame():
    random = np.random.default_rng(7)
    parts = []
    for series, days in (("a", 1300), ("b", 400), ("c", 5)):
        level = random.gamma(2.0, 500.0, days) * (random.random(days) > 0.1)
        parts.append(pd.DataFrame({
            "series": series, "Date": pd.date_range("2015-01-01", periods=days).date, "y": level}))
    return pd.concat(parts, ignore_index=True)


def expected_features(frame):
    out = []
    for _, part in frame.groupby("series"):
        part, past = part.copy(), part["y"].shift(1)
        for lag in C.LAGS:
            part[f"y_lag_{lag}"] = part["y"].shift(lag)
        for width in C.ROLLING_WINDOWS:
            roll = past.rolling(width, min_periods=max(2, width // 3))
            part[f"y_roll_mean_{width}"], part[f"y_roll_std_{width}"] = roll.mean(), roll.std()
        for span in C.EWM_SPANS:
            part[f"y_ewm_{span}"] = past.ewm(span=span, adjust=False, min_periods=3).mean()
        out.append(part)
    return pd.concat(out).sort_values(["series", "Date"]).reset_index(drop=True)


@pytest.mark.parametrize("partitions", [1, 8])
def test_dynamic_features_equal_pandas(spark, frame, partitions):
    df = spark.createDataFrame(frame, "series string, Date date, y double").repartition(partitions)
    got = with_dynamic_features(df, "y", keys=["series"])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
    pdf = got.toPandas().sort_values(["series", "Date"]).reset_index(drop=True)
    want = expected_features(frame)
    for name in dynamic_names("y"):
        np.testing.assert_allclose(
            pdf[name].astype(float), want[name], rtol=1e-9, atol=1e-6, err_msg=name)


def test_ewm_of_mixed_spans_and_missing_values(spark, frame):
    one = frame[frame.series == "a"]
    df = spark.createDataFrame(one, "series string, Date date, y double")
    got = with_ewm(df, "y", ["series"], spans=(1, 2, 400)).toPandas().sort_values("Date")
    past = one["y"].shift(1)
    for span in (1, 2, 400):
        want = past.ewm(span=span, adjust=False, min_periods=3).mean()
        np.testing.assert_allclose(got[f"y_ewm_{span}"].astype(float), want, rtol=1e-9, atol=1e-9)
    holed = df.withColumn("y", F.when(F.col("Date") != F.lit(D(2015, 1, 11)), F.col("y")))
    after = with_ewm(holed, "y", ["series"]).where(F.col("y_ewm_7").isNotNull())
    assert after.agg(F.max("Date")).first()[0] == D(2015, 1, 11)


def test_change_and_weights(spark):
    df = spark.createDataFrame(
        [("a", D(2020, 1, 1), 0.0), ("a", D(2020, 4, 1), 2.0), ("a", D(2022, 1, 1), 3.0)],
        "series string, Date date, y double")
    change = change_from_previous(F.col("y"), by_date(["series"]))
    assert [r[0] for r in df.select("Date", change.alias("c")).orderBy("Date").select("c").collect()] == [
        None, None, 0.5]
    decay = df.select(weights.decay_weight("Date", ["series"]).alias("w")).agg(F.min("w"), F.max("w")).first()
    assert decay[0] == pytest.approx(0.5 ** (731 / 730)) and decay[1] == 1.0
    boosted = df.orderBy("Date").select(weights.quarter_weight(F.lit(0.01), F.col("Date"), 2)).collect()
    assert [r[0] for r in boosted] == [0.01, 0.02, 0.01]
    before, after = weights.split_holdout(df, D(2020, 4, 1))
    assert (before.count(), after.count()) == (2, 1)


@pytest.mark.parametrize("grid", [C.CALIBRATION_GRID, C.COARSE_CALIBRATION_GRID])
def test_calibration_equals_trying_every_multiplier(spark, grid):
    random = np.random.default_rng(3)
    rows = []
    for group in ("p", "q", "zero"):
        actual = random.normal(100, 60, 300)
        predicted = actual / random.uniform(0.5, 2.0, 300) + random.normal(0, 5, 300)
        predicted[:20] = 0.0
        if group == "zero":
            predicted[:] = 0.0
        rows += [(group, float(y), float(p)) for y, p in zip(actual, predicted)]
    df = spark.createDataFrame(rows, "target string, y double, yhat double").repartition(5)
    errors = calibration_errors(df, keys=["target"], grid=grid).toPandas()
    best = {r.target: r for r in best_multiplier(df, keys=["target"], grid=grid).collect()}
    steps = grid[0] + np.arange(grid_size(grid)) * grid[2]
    assert len(steps) == (161 if grid == C.CALIBRATION_GRID else 71)
    for group in ("p", "q", "zero"):
        y, p = np.array([r[1] for r in rows if r[0] == group]), np.array([r[2] for r in rows if r[0] == group])
        want = np.array([np.abs(y - m * p).mean() for m in steps])
        got = errors[errors.target == group].sort_values("multiplier")
        np.testing.assert_allclose(got.mae, want, rtol=1e-10)
        assert best[group].multiplier == pytest.approx(steps[want.argmin()])
    everything = best_multiplier(df, keys=[], grid=grid).first()
    y, p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    assert everything.mae == pytest.approx(min(np.abs(y - m * p).mean() for m in steps))


def test_quarters_without_holdout_rows_keep_the_raw_forecast(spark):
    scored = spark.createDataFrame(
        [("Revenue", D(2022, 8, 1), 120.0, 100.0), ("Revenue", D(2022, 11, 1), 90.0, 100.0)],
        "target string, Date date, y double, yhat double")
    factors = variants.multipliers(scored)
    assert {k: round(v, 3) for k, v in factors.quarterly.items()} == {("Revenue", 3): 1.2, ("Revenue", 4): 0.9}
    raw = spark.createDataFrame([("Revenue", D(2023, 2, 1), 10.0), ("Revenue", D(2023, 8, 1), 10.0)],
                                "target string, Date date, yhat double")
    got = {(r.variant, r.Date.month): r.yhat for r in variants.calibrated(raw, factors).collect()}
    assert got["per_q", 2] == 10.0 and got["per_q", 8] == pytest.approx(12.0)
    assert got["default", 2] == pytest.approx(12.6) and len(got) == 6
