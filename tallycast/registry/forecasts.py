"""Registered baseline, calibration, blending and publishing queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallycast import constants
from tallycast.operators import blend, metrics, weights
from tallycast.operators.calibration import (
    apply_multiplier, best_multiplier, calibration_errors,
)
from tallycast.operators.panel import cogs_ratio
from tallycast.operators.reshape import stack
from tallycast.plans import seasonal, variants
from tallycast.registry import driver
from tallycast.session import cut_lineage
from tallycast.registry.common import PANEL_SQL, rounded
from tallycast.sources.sinks import as_forecast_file, publish_variant

KEYS = driver.KEYS
BY_DAY = [*KEYS, "Date"]
SETTINGS = {"keys": KEYS, "full_years": driver.FULL_YEARS, "base_year": driver.BASE_YEAR}


def _history(panel):
    return panel.where(F.col("Date") <= F.lit(driver.HOLDOUT_AFTER))


def _holdout(panel):
    return panel.where(weights.in_holdout(F.col("Date"), driver.HOLDOUT_AFTER))


def _future(panel):
    """The forecast days of every segment."""
    days = F.sequence(F.lit(driver.FORECAST_FIRST), F.lit(driver.FORECAST_LAST),
                      F.expr("interval 1 day"))
    return panel.select(*KEYS).distinct().withColumn("Date", F.explode(days))


def _scored(panel):
    """Hold-out rows with the baseline fitted on the rows before them."""
    held = _holdout(panel)
    raw = seasonal.seasonal_forecast(_history(panel), held, digits=None, **SETTINGS)
    return cut_lineage(variants.score_against(raw, held, keys=BY_DAY))


def growth(spark, sf):
    result = seasonal.growth_and_level(driver.panel(spark, sf), **SETTINGS)
    return rounded(result.select("series", "growth_Revenue", "growth_COGS"), 9, "growth_Revenue", "growth_COGS")


def seasonal_profile(spark, sf):
    result = seasonal.profile(driver.panel(spark, sf), keys=KEYS)
    return rounded(result, 9, "norm_Revenue", "norm_COGS")


def seasonal_forecast(spark, sf):
    panel = driver.panel_once(spark, sf)
    return seasonal.seasonal_forecast(panel, _future(panel), **SETTINGS)


def backtest_mape(spark, sf):
    panel = driver.panel_once(spark, sf)
    tail = panel.where(F.year("Date").isin(1999, 2000))
    predicted = seasonal.seasonal_forecast(panel, tail, digits=None, **SETTINGS)
    scored = variants.score_against(predicted, tail, keys=BY_DAY)
    return rounded(metrics.mape(scored, keys=[*KEYS, "target"]), 5, "mape")


def weights_stable(spark, sf):
    date = F.col("Date")
    weight = weights.stable_year_weight(date, driver.STABLE_YEARS)
    return driver.panel(spark, sf).select(*BY_DAY, weight.alias("weight"))


def weights_decay(spark, sf):
    weight = weights.decay_weight("Date", KEYS)
    return rounded(driver.panel(spark, sf).select(*BY_DAY, weight.alias("weight")), 9, "weight")


def weights_quarter(spark, sf):
    date = F.col("Date")
    weight = weights.stable_year_weight(date, driver.STABLE_YEARS)
    return driver.panel(spark, sf).select(
        *BY_DAY, *[weights.quarter_weight(weight, date, q).alias(f"weight_q{q}") for q in (1, 2, 3, 4)])


def holdout_split(spark, sf):
    part = weights.in_holdout(F.col("Date"), driver.HOLDOUT_AFTER).alias("is_holdout")
    return driver.panel(spark, sf).groupBy(*KEYS, part).agg(
        F.count(F.lit(1)).alias("days"), F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"))


def calib_errors(spark, sf):
    errors = calibration_errors(_scored(driver.panel_once(spark, sf)), keys=["target"])
    return rounded(rounded(errors, 6, "multiplier"), 3, "mae")


def calib_global(spark, sf):
    best = best_multiplier(_scored(driver.panel_once(spark, sf)), keys=["target"])
    return rounded(rounded(best, 6, "multiplier"), 3, "mae")


def calib_quarter(spark, sf):
    scored = variants.with_quarter(_scored(driver.panel_once(spark, sf)))
    best = best_multiplier(scored, keys=["target", "quarter"])
    return rounded(rounded(best, 6, "multiplier"), 3, "mae")


def calib_applied(spark, sf):
    """A factor per segment and target, joined to the future forecast."""
    panel = driver.panel_once(spark, sf)
    raw = seasonal.seasonal_forecast(panel, _future(panel), digits=None, **SETTINGS)
    factors = best_multiplier(_scored(panel), keys=[*KEYS, "target"])
    long = apply_multiplier(
        variants.targets_long(raw, keys=BY_DAY), factors, keys=[*KEYS, "target"])
    return rounded(long, 4, "yhat")


def _variants_of_holdout(spark, sf):
    scored = _scored(driver.panel_once(spark, sf))
    return variants.calibrated(scored, variants.multipliers(scored))


def variant_metrics(spark, sf):
    result = metrics.regression_metrics(_variants_of_holdout(spark, sf), keys=["variant", "target"])
    return rounded(rounded(result, 3, "mae", "rmse"), 8, "r2")


def best_variant(spark, sf):
    scores = metrics.regression_metrics(_variants_of_holdout(spark, sf), keys=["variant", "target"])
    return rounded(metrics.best_variant(scores), 3, "sum_mae")


def _variants_of_future(spark, sf):
    panel = driver.panel_once(spark, sf)
    raw = seasonal.seasonal_forecast(panel, _future(panel), digits=None, **SETTINGS)
    long = variants.targets_long(raw, keys=BY_DAY)
    table = variants.calibrated(long, variants.multipliers(_scored(panel)))
    return variants.targets_wide(table, keys=["variant", *BY_DAY])


def forecast_file(spark, sf):
    return as_forecast_file(_variants_of_future(spark, sf), keys=["variant", *KEYS])


def published_variant(spark, sf):
    return publish_variant(_variants_of_future(spark, sf), "default", keys=driver.KEYS)


def _members(spark, sf):
    """Three baselines that differ in their growth years."""
    panel = driver.panel_once(spark, sf)
    days = _future(panel)
    members = {}
    for model, first in (("squared", 1995), ("absolute", 1997), ("deep", 1999)):
        settings = SETTINGS | {"full_years": (first, driver.FULL_YEARS[1])}
        members[model] = seasonal.seasonal_forecast(panel, days, digits=None, **settings)
    return members


def blend_weighted(spark, sf):
    """Booster weights over three members; the absent fourth's weight goes to the first."""
    members = _members(spark, sf)
    long = stack({name: variants.targets_long(wide, keys=BY_DAY) for name, wide in members.items()},
                 "model")
    table = {target: blend.usable_weights(constants.BOOSTER_WEIGHTS[target], list(members))
             for target in constants.TARGETS}
    return rounded(blend.weighted_blend(long, table, keys=BY_DAY), 4, "yhat")


def blend_layers(spark, sf):
    """Specialist share and ridge share applied to three members."""
    members = _members(spark, sf)
    joined = None
    for model, wide in members.items():
        part = wide.select(*BY_DAY, F.col("Revenue").alias(model))
        joined = part if joined is None else joined.join(part, BY_DAY)
    trees = blend.specialist_mix(F.col("absolute"), F.col("squared"))
    mixed = blend.ridge_mix(F.col("deep"), trees)
    return rounded(joined.select(*BY_DAY, mixed.alias("yhat")), 4, "yhat")


def blend_finished(spark, sf):
    """Two finished tables blended, then rescaled."""
    members = _members(spark, sf)
    mixed = blend.blend_tables(members["squared"], members["deep"], share=0.7, keys=BY_DAY)
    return rounded(blend.rescale(mixed, {"Revenue": 1.15, "COGS": 1.2}), 4, "Revenue", "COGS")


def run_average(spark, sf):
    """Members averaged like runs with different seeds."""
    runs = stack({name: variants.targets_long(wide, keys=BY_DAY)
                  for name, wide in _members(spark, sf).items()}, "run")
    return rounded(blend.mean_over_runs(runs, keys=[*BY_DAY, "target"]), 4, "yhat")


def anchor_mean(spark, sf):
    panel = driver.panel_once(spark, sf)
    raw = seasonal.seasonal_forecast(panel, _future(panel), digits=None, **SETTINGS)
    anchored = blend.anchor_to_mean(raw, constants.RECURSIVE_ANCHOR, keys=KEYS)
    return rounded(blend.cap_cogs(anchored), 2, "Revenue", "COGS")


def ratio_cap(spark, sf):
    """COGS from each segment's median cost ratio, capped."""
    panel = driver.panel_once(spark, sf)
    raw = seasonal.seasonal_forecast(panel, _future(panel), digits=None, **SETTINGS)
    ratios = cogs_ratio(panel.where(F.col("Revenue") > 0), keys=KEYS)
    return rounded(blend.cogs_from_ratio(raw.drop("COGS"), ratios, keys=KEYS), 4, "Revenue", "COGS")


def forecast_correlation(spark, sf):
    members = _members(spark, sf)
    result = metrics.forecast_correlation(
        members["squared"], _shifted(members["deep"]), keys=KEYS, value="Revenue")
    return rounded(result, 7, "correlation")


def _shifted(forecast):
    """The forecast moved by one day, so that the correlation is not 1."""
    return forecast.withColumn("Date", F.date_add("Date", 1))


QUERIES = {fn.__name__: fn for fn in (
    growth, seasonal_profile, seasonal_forecast, backtest_mape, weights_stable, weights_decay,
    weights_quarter, holdout_split, calib_errors, calib_global, calib_quarter, calib_applied,
    variant_metrics,
    best_variant, forecast_file, published_variant, blend_weighted, blend_layers, blend_finished,
    run_average, anchor_mean, ratio_cap, forecast_correlation,
)}


def _baseline(tag: str, source: str, days: str, first_year: int = 1995) -> str:
    """CTEs that end in raw_<tag>(series, Date, frev, fcogs)."""
    return f"""
tot_{tag} AS (SELECT series, year("Date") AS y, sum("Revenue") AS r, sum("COGS") AS c
  FROM {source} GROUP BY ALL),
rate_{tag} AS (SELECT b.series, b.r / 365 AS lr, b.c / 365 AS lc,
    pow(b.r / a.r, 1.0::DOUBLE / (2000 - {first_year})) AS gr, pow(b.c / a.c, 1.0::DOUBLE / (2000 - {first_year})) AS gc
  FROM tot_{tag} a JOIN tot_{tag} b ON a.series = b.series AND a.y = {first_year} AND b.y = 2000),
mean_{tag} AS (SELECT series, year("Date") AS y, avg("Revenue") AS mr, avg("COGS") AS mc
  FROM {source} GROUP BY ALL),
prof_{tag} AS (SELECT s.series, month("Date") AS m, day("Date") AS d,
    avg("Revenue" / mr) AS nr, avg("COGS" / mc) AS nc
  FROM {source} s JOIN mean_{tag} t ON s.series = t.series AND year("Date") = t.y GROUP BY ALL),
raw_{tag} AS (SELECT f.series, f."Date",
    lr * pow(gr, year(f."Date") - 2000) * coalesce(nr, 1) AS frev,
    lc * pow(gc, year(f."Date") - 2000) * coalesce(nc, 1) AS fcogs
  FROM {days} f JOIN rate_{tag} r ON r.series = f.series
  LEFT JOIN prof_{tag} p ON p.series = f.series AND p.m = month(f."Date") AND p.d = day(f."Date"))"""


_FUTURE = """
future AS (SELECT DISTINCT series, CAST(g AS DATE) AS "Date" FROM panel,
  generate_series(TIMESTAMP '2001-08-02', TIMESTAMP '2002-01-31', INTERVAL 1 DAY) t(g))"""
_HELD = """
hist AS (SELECT * FROM panel WHERE "Date" <= DATE '2001-01-31'),
held AS (SELECT * FROM panel WHERE "Date" > DATE '2001-01-31')"""
_SCORED = f"""{PANEL_SQL}, {_HELD}, {_baseline('h', 'hist', 'held')},
scored AS (
  SELECT r.series, r."Date", 'Revenue' AS target, frev AS yhat, "Revenue" AS y
  FROM raw_h r JOIN held h ON h.series = r.series AND h."Date" = r."Date"
  UNION ALL
  SELECT r.series, r."Date", 'COGS', fcogs, "COGS"
  FROM raw_h r JOIN held h ON h.series = r.series AND h."Date" = r."Date"),
grid AS (SELECT 0.8::DOUBLE + i * 0.005::DOUBLE AS m FROM range(161) t(i)),
err AS (SELECT target, m, avg(abs(y - m * yhat)) AS mae FROM scored, grid GROUP BY ALL),
err_q AS (SELECT target, CAST(quarter("Date") AS INTEGER) AS quarter, m, avg(abs(y - m * yhat)) AS mae
          FROM scored, grid GROUP BY ALL),
best AS (SELECT target, arg_min(m, mae) AS m, min(mae) AS mae FROM err GROUP BY 1),
best_q AS (SELECT target, quarter, arg_min(m, mae) AS m, min(mae) AS mae FROM err_q GROUP BY 1, 2)"""
_FUTURE_RAW = f"{_FUTURE}, {_baseline('f', 'panel', 'future')}"
_FIXED = "CASE target WHEN 'Revenue' THEN 1.26::DOUBLE ELSE 1.32::DOUBLE END"


def _calibrated(rows: str) -> str:
    return f"""
calibrated AS (
  SELECT s.* EXCLUDE (yhat), yhat * m AS yhat, 'global' AS variant FROM {rows} s JOIN best USING (target)
  UNION ALL BY NAME
  SELECT s.* EXCLUDE (yhat), yhat * coalesce(m, 1) AS yhat, 'per_q' AS variant FROM {rows} s
  LEFT JOIN best_q b ON b.target = s.target AND b.quarter = quarter(s."Date")
  UNION ALL BY NAME
  SELECT s.* EXCLUDE (yhat), yhat * {_FIXED} AS yhat, 'default' AS variant FROM {rows} s)"""


_METRICS = f"""WITH {_SCORED}, {_calibrated('scored')},
scores AS (SELECT variant, target, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
  1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2 FROM calibrated GROUP BY ALL)"""
_PUBLISHED = f"""WITH {_SCORED}, {_FUTURE_RAW},
long AS (SELECT series, "Date", 'Revenue' AS target, frev AS yhat FROM raw_f
         UNION ALL SELECT series, "Date", 'COGS', fcogs FROM raw_f), {_calibrated('long')}"""
_MEMBERS = f"""{PANEL_SQL}, {_FUTURE}, {_baseline('s', 'panel', 'future')},
{_baseline('a', 'panel', 'future', 1997)}, {_baseline('d', 'panel', 'future', 1999)},
members AS (SELECT s.series, s."Date", s.frev AS sr, s.fcogs AS sc, a.frev AS ar, a.fcogs AS ac,
    d.frev AS dr, d.fcogs AS dc
  FROM raw_s s JOIN raw_a a ON a.series = s.series AND a."Date" = s."Date"
  JOIN raw_d d ON d.series = s.series AND d."Date" = s."Date")"""

ORACLE = {
    "growth": f"""WITH {PANEL_SQL}, {_FUTURE}, {_baseline('f', 'panel', 'future')}
SELECT series, round(gr, 9) AS "growth_Revenue", round(gc, 9) AS "growth_COGS" FROM rate_f""",
    "seasonal_profile": f"""WITH {PANEL_SQL}, {_FUTURE_RAW}
SELECT series, CAST(m AS INTEGER) AS month, CAST(d AS INTEGER) AS day, round(nr, 9) AS "norm_Revenue",
       round(nc, 9) AS "norm_COGS" FROM prof_f""",
    "seasonal_forecast": f"""WITH {PANEL_SQL}, {_FUTURE_RAW}
SELECT series, "Date", round_even(frev, 2) AS "Revenue", round_even(fcogs, 2) AS "COGS" FROM raw_f""",
    "backtest_mape": f"""WITH {PANEL_SQL},
tail AS (SELECT * FROM panel WHERE year("Date") IN (1999, 2000)), {_baseline('b', 'panel', 'tail')},
j AS (SELECT t.series, "Revenue" AS yr, frev, "COGS" AS yc, fcogs FROM raw_b r
      JOIN tail t ON t.series = r.series AND t."Date" = r."Date")
SELECT series, 'Revenue' AS target, round(avg(abs(yr - frev) / nullif(yr, 0)) * 100, 5) AS mape FROM j GROUP BY 1
UNION ALL SELECT series, 'COGS', round(avg(abs(yc - fcogs) / nullif(yc, 0)) * 100, 5) FROM j GROUP BY 1""",
    "weights_stable": f"""WITH {PANEL_SQL}
SELECT series, "Date", CASE WHEN year("Date") >= 1996 AND year("Date") <= 1999 THEN 1.0::DOUBLE
       ELSE 0.01::DOUBLE END AS weight FROM panel""",
    "weights_decay": f"""WITH {PANEL_SQL}
SELECT series, "Date", round(exp(ln(0.5::DOUBLE) * (max("Date") OVER (PARTITION BY series) - "Date") / 730), 9)
       AS weight FROM panel""",
    "weights_quarter": f"""WITH {PANEL_SQL},
w AS (SELECT *, CASE WHEN year("Date") BETWEEN 1996 AND 1999 THEN 1.0::DOUBLE ELSE 0.01::DOUBLE END AS w FROM panel)
SELECT series, "Date", {", ".join(
        f'CASE WHEN quarter("Date") = {q} THEN w * 2 ELSE w END AS weight_q{q}' for q in (1, 2, 3, 4))}
FROM w""",
    "holdout_split": f"""WITH {PANEL_SQL}
SELECT series, "Date" > DATE '2001-01-31' AS is_holdout, count(*) AS days, min("Date") AS first_date,
       max("Date") AS last_date FROM panel GROUP BY 1, 2""",
    "calib_errors": f"""WITH {_SCORED}
SELECT target, round(m, 6) AS multiplier, round(mae, 3) AS mae FROM err""",
    "calib_global": f"""WITH {_SCORED}
SELECT target, round(m, 6) AS multiplier, round(mae, 3) AS mae FROM best""",
    "calib_quarter": f"""WITH {_SCORED}
SELECT target, quarter, round(m, 6) AS multiplier, round(mae, 3) AS mae FROM best_q""",
    "calib_applied": f"""{_PUBLISHED},
err_s AS (SELECT series, target, m, avg(abs(y - m * yhat)) AS mae FROM scored, grid GROUP BY ALL),
best_s AS (SELECT series, target, arg_min(m, mae) AS m FROM err_s GROUP BY ALL)
SELECT series, "Date", target, round(yhat * b.m, 4) AS yhat FROM long JOIN best_s b USING (series, target)""",
    "variant_metrics": f"""{_METRICS}
SELECT variant, target, round(mae, 3) AS mae, round(rmse, 3) AS rmse, round(r2, 8) AS r2 FROM scores""",
    "best_variant": f"""{_METRICS}, t AS (SELECT variant, sum(mae) AS s FROM scores GROUP BY 1)
SELECT variant, round(s, 3) AS sum_mae FROM t ORDER BY round(s, 4), variant LIMIT 1""",
    "forecast_file": f"""{_PUBLISHED}
SELECT variant, series, strftime("Date", '%Y-%m-%d') AS "Date",
       round_even(greatest(max(yhat) FILTER (target = 'Revenue'), 0), 2) AS "Revenue",
       round_even(greatest(max(yhat) FILTER (target = 'COGS'), 0), 2) AS "COGS"
FROM calibrated GROUP BY variant, series, "Date" """,
    "published_variant": f"""{_PUBLISHED}
SELECT series, strftime("Date", '%Y-%m-%d') AS "Date",
       round_even(greatest(max(yhat) FILTER (target = 'Revenue'), 0), 2) AS "Revenue",
       round_even(greatest(max(yhat) FILTER (target = 'COGS'), 0), 2) AS "COGS"
FROM calibrated WHERE variant = 'default' GROUP BY series, calibrated."Date" """,
    "blend_weighted": f"""WITH {_MEMBERS}
SELECT series, "Date", 'Revenue' AS target,
       round(0.55::DOUBLE * sr + 0.30::DOUBLE * ar + 0.15::DOUBLE * dr, 4) AS yhat FROM members
UNION ALL SELECT series, "Date", 'COGS',
       round(0.65::DOUBLE * sc + 0.20::DOUBLE * ac + 0.15::DOUBLE * dc, 4) FROM members""",
    "blend_layers": f"""WITH {_MEMBERS}
SELECT series, "Date", round(0.2::DOUBLE * dr + 0.8::DOUBLE * (0.6::DOUBLE * ar + 0.4::DOUBLE * sr), 4) AS yhat
FROM members""",
    "blend_finished": f"""WITH {_MEMBERS}
SELECT series, "Date", round(1.15::DOUBLE * (0.7::DOUBLE * sr + 0.3::DOUBLE * dr), 4) AS "Revenue",
       round(1.2::DOUBLE * (0.7::DOUBLE * sc + 0.3::DOUBLE * dc), 4) AS "COGS" FROM members""",
    "run_average": f"""WITH {_MEMBERS}
SELECT series, "Date", 'Revenue' AS target, round(greatest((sr + ar + dr) / 3, 0), 4) AS yhat FROM members
UNION ALL SELECT series, "Date", 'COGS', round(greatest((sc + ac + dc) / 3, 0), 4) FROM members""",
    "anchor_mean": f"""WITH {PANEL_SQL}, {_FUTURE_RAW},
a AS (SELECT series, "Date", frev * (4250000.0::DOUBLE / avg(frev) OVER (PARTITION BY series)) AS r,
             fcogs * (3750000.0::DOUBLE / avg(fcogs) OVER (PARTITION BY series)) AS c FROM raw_f)
SELECT series, "Date", round(r, 2) AS "Revenue", round(least(c, r * 0.98::DOUBLE), 2) AS "COGS" FROM a""",
    "ratio_cap": f"""WITH {PANEL_SQL}, {_FUTURE_RAW},
k AS (SELECT series, median("COGS" / greatest("Revenue", 1)) AS k FROM daily GROUP BY 1)
SELECT r.series, "Date", round(frev, 4) AS "Revenue", round(least(frev * k, frev * 0.98::DOUBLE), 4) AS "COGS"
FROM raw_f r JOIN k ON k.series = r.series""",
    "forecast_correlation": f"""WITH {_MEMBERS}
SELECT x.series, round(corr(x.sr, y.dr), 7) AS correlation FROM members x
JOIN members y ON y.series = x.series AND x."Date" = y."Date" + 1 GROUP BY 1""",
}
