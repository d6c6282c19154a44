"""Registered model and explanation queries.  Fitted models have no SQL; the
importance tables of a given linear model do."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import from_log, to_log
from tallycast.models import boosted, forest, importance, recursive, ridge, search
from tallycast.operators import dynamic, features, metrics, panel as panels, reshape
from tallycast.operators.weights import split_holdout, stable_year_weight
from tallycast.plans import components as component_plan
from tallycast.plans import recursive as recursive_plan
from tallycast.plans import training, variants
from tallycast.registry import driver
from tallycast.registry.common import DAILY_SQL, PANEL_SQL, rounded
from tallycast.session import cut_lineage
from tallycast.sources.dimensions import date_spine, feature_meanings
from tallycast.sources.sinks import run_metadata

KEYS = driver.KEYS
BY_DAY = [*KEYS, "Date"]
# The default boosters with longer steps and less patience than a full run has.
SPECS = tuple(replace(spec, step=0.3, patience=5) for spec in boosted.DEFAULT_SPECS)


def _calendar(df):
    """Calendar features of the days of a table (no promotions: unknown in the future)."""
    date = F.col("Date")
    plain = df.withColumns(
        features.calendar_columns(date, origin=driver.TREND_ORIGIN, regime_year=driver.REGIME_YEAR)
        | features.fourier_columns(date) | features.holiday_columns(date))
    lunar = features.with_lunar(plain, driver.lunar_events(df.sparkSession))
    return cut_lineage(features.with_promo_windows(lunar))


def _frames(spark, sf):
    """History with calendar features, future with the same, and the feature names."""
    panel = driver.panel_once(spark, sf)
    days = _calendar(panel.select("Date").distinct())
    ahead = _calendar(date_spine(spark, driver.FORECAST_FIRST, driver.FORECAST_LAST))
    names = features.feature_names(days)
    every = F.sequence(F.lit(driver.FORECAST_FIRST), F.lit(driver.FORECAST_LAST), F.expr("interval 1 day"))
    future = panel.select(*KEYS).distinct().withColumn("Date", F.explode(every))
    future = features.attach_days(future, ahead)
    history = features.attach_days(panel, days)
    return panel, cut_lineage(history), cut_lineage(future), names, days, ahead


def _labelled(history, names, target="Revenue"):
    rows = history.withColumns({
        "label": to_log(F.col(target)),
        "weight": stable_year_weight(F.col("Date"), driver.STABLE_YEARS)})
    return cut_lineage(ridge.as_vectors(rows, names, [*BY_DAY, "label", "weight"]))


def ridge_forecast(spark, sf):
    """Ridge on calendar features, full fit, future days."""
    _, history, future, names, _, _ = _frames(spark, sf)
    model = ridge.fit_ridge(history.withColumn("label", to_log(F.col("Revenue"))), names, "label")
    return future.select(*BY_DAY, F.round(from_log(model.predict()), 4).alias("Revenue"))


def ridge_trend(spark, sf):
    """Ridge of log revenue on trend and weekend, small enough to solve in SQL."""
    days = driver.panel(spark, sf).select(
        *BY_DAY, to_log(F.col("Revenue")).alias("label"),
        F.datediff("Date", F.lit(driver.TREND_ORIGIN)).alias("t_days"),
        (F.weekday("Date") > 4).cast("int").alias("is_weekend"))
    rows = cut_lineage(days)
    model = ridge.fit_ridge(rows, ["t_days", "is_weekend"], "label")
    return rows.select(*BY_DAY, F.round(model.predict(), 6).alias("yhat"))


# A given model of log revenue, small enough for a recursive query.
GIVEN_SLOPES = {
    "Revenue_lag_1": 2e-7, "Revenue_lag_2": -1e-7, "Revenue_roll_mean_7": 1.5e-7, "Revenue_roll_std_7": 0.5e-7,
    "Revenue_ewm_7": -2.5e-7, "is_weekend": 0.25}
GIVEN = ridge.RidgeModel(
    features=tuple(GIVEN_SLOPES), means=dict.fromkeys(GIVEN_SLOPES, 0.0), scales=dict.fromkeys(GIVEN_SLOPES, 1.0),
    coefficients=GIVEN_SLOPES, intercept=12.5)


def recursive_given(spark, sf):
    """Recursion of a given model over the whole horizon of every segment."""
    panel = panels.densify(
        driver.panel(spark, sf), keys=KEYS, fill={"Revenue": 0.0, "COGS": 0.0},
        until=driver.HISTORY_END).select(*BY_DAY, "Revenue")
    days = date_spine(spark, driver.FORECAST_FIRST, driver.FORECAST_LAST).withColumn(
        "is_weekend", (F.weekday("Date") > 4).cast("int"))
    return rounded(recursive.recursive_forecast(
        panel, days, GIVEN, "Revenue", keys=KEYS), 2, "Revenue")


def boosted_forecast(spark, sf):
    """One booster whose size the hold-out decides, on future days, with its rounds."""
    _, history, future, names, _, _ = _frames(spark, sf)
    fitted = boosted.fit_with_holdout(
        SPECS[0], boosted.training_rows(_labelled(history, names)), after=driver.HOLDOUT_AFTER)
    return boosted.predict(fitted.full, ridge.as_vectors(future, names, BY_DAY), BY_DAY).withColumns({
        "rounds": F.lit(fitted.rounds), "stopped": F.lit(fitted.stopped)})


def specialist_forecast(spark, sf):
    """Quarterly specialists on future days, with the rounds of each."""
    _, history, future, names, _, _ = _frames(spark, sf)
    models = boosted.fit_specialists(
        SPECS[1], boosted.training_rows(_labelled(history, names)), after=driver.HOLDOUT_AFTER)
    rounds = F.create_map(*[F.lit(one) for quarter, fitted in models.items() for one in (quarter, fitted.rounds)])
    return boosted.predict_specialists(models, ridge.as_vectors(future, names, BY_DAY), BY_DAY).withColumn(
        "rounds", rounds[F.quarter("Date")])


def trained_variants(spark, sf):
    """The whole training pipeline: calibrated variants of the future days."""
    _, history, future, names, _, _ = _frames(spark, sf)
    run = training.train(
        history, future, names, keys=KEYS, after=driver.HOLDOUT_AFTER, specs=SPECS, stable_years=driver.STABLE_YEARS)
    return variants.targets_wide(run.future_variants, keys=["variant", *BY_DAY])


def component_forecast(spark, sf):
    """Orders times order value, three boosters with every seed."""
    panel, history, future, names, _, _ = _frames(spark, sf)
    rows = cut_lineage(component_plan.with_components(
        history, driver.components(spark, sf), keys=KEYS))
    ratios = panels.cogs_ratio(panel.where(F.col("Revenue") > 0), keys=KEYS)
    return component_plan.component_forecast(
        rows, future, names, ratios, keys=KEYS, after=driver.HOLDOUT_AFTER,
        specs=SPECS[:3], anchor=1_000_000.0, stable_years=driver.STABLE_YEARS)


def recursive_forecast(spark, sf):
    """Day-by-day forecast of both targets, anchored and capped."""
    panel, _, _, names, days, ahead = _frames(spark, sf)
    aligned = panels.densify(
        panel, keys=KEYS, fill={"Revenue": 0.0, "COGS": 0.0}, until=driver.HISTORY_END)
    result, _ = recursive_plan.recursive_plan(
        cut_lineage(aligned), days, ahead, names, keys=KEYS, warmup_end=driver.WARMUP_END)
    return result


def recursive_scores(spark, sf):
    """One-step hold-out scores of the recursive model."""
    panel, _, _, names, days, _ = _frames(spark, sf)
    frame = cut_lineage(recursive_plan.training_frame(
        panel, days, "Revenue", keys=KEYS, warmup_end=driver.WARMUP_END))
    return recursive_plan.holdout_scores(
        frame, [*names, *dynamic.dynamic_names("Revenue")], "Revenue", after=driver.HOLDOUT_AFTER)


def recursive_trees(spark, sf):
    """Day-by-day forecast of revenue by a forest on calendar and past values."""
    panel, _, _, names, days, ahead = _frames(spark, sf)
    aligned = cut_lineage(panels.densify(
        panel, keys=KEYS, fill={"Revenue": 0.0, "COGS": 0.0}, until=driver.HISTORY_END))
    model = recursive_plan.fit_trees(
        recursive_plan.training_frame(aligned, days, "Revenue", keys=KEYS, warmup_end=driver.WARMUP_END),
        [*names, *dynamic.dynamic_names("Revenue")], SPECS[1], keys=KEYS, after=driver.HOLDOUT_AFTER)
    return recursive.recursive_forecast(aligned, ahead, model, "Revenue", keys=KEYS)


def search_trials(spark, sf):
    """Adaptive search over two boosters with their hold-out scores."""
    _, history, _, names, _, _ = _frames(spark, sf)
    table = boosted.training_rows(_labelled(history, names))
    trials = search.search(
        table, [replace(spec, rounds=20, patience=3) for spec in SPECS[:2]], target="Revenue", after=driver.HOLDOUT_AFTER,
        trials=12)
    return trials.select("target", "model", "trial", "score")


def perm_importance(spark, sf):
    """Permutation importance over the whole history."""
    _, history, _, names, _, _ = _frames(spark, sf)
    rows = _labelled(history, names)
    fitted = boosted.fit_with_holdout(SPECS[1], boosted.training_rows(rows), after=driver.HOLDOUT_AFTER)
    return importance.permutation_importance(fitted.full, rows, names, keys=BY_DAY)


def forest_importance(spark, sf):
    """Mean absolute attribution of every feature of a forest over the whole history."""
    _, history, _, names, _, _ = _frames(spark, sf)
    rows = _labelled(history, names)
    fitted = boosted.fit_with_holdout(SPECS[1], boosted.training_rows(rows), after=driver.HOLDOUT_AFTER)
    return forest.tree_attribution(rows, {"trees": fitted.full}, names)


def ridge_importance(spark, sf):
    """Mean absolute attribution of every ridge feature."""
    _, history, _, names, _, _ = _frames(spark, sf)
    model = ridge.fit_ridge(history.withColumn("label", to_log(F.col("Revenue"))), names, "label")
    return ridge.linear_attribution(history, {"ridge": model.slopes}, model.means)


def run_record(spark, sf):
    """Metadata row of a ridge run: sizes, labels and hold-out scores."""
    _, history, _, names, _, _ = _frames(spark, sf)
    labelled = history.withColumn("label", to_log(F.col("Revenue")))
    train, held = split_holdout(labelled, driver.HOLDOUT_AFTER)
    model = ridge.fit_ridge(train, names, "label")
    scores = metrics.regression_metrics(held.select(
        F.lit("Revenue").alias("target"), F.col("Revenue").alias("y"),
        from_log(model.predict()).alias("yhat")), keys=["target"]).first()
    return run_metadata(
        spark, numbers={"n_features": float(len(names))}, labels={"model": "ridge"},
        scores={"Revenue": {name: scores[name] for name in ("mae", "rmse", "r2")}}).select(
        F.col("numbers")["n_features"].alias("n_features"), F.col("labels")["model"].alias("model"),
        F.col("scores")["Revenue"]["mae"].alias("mae"))


# Two given linear price models over line features.
SLOPES = {
    "model_a": {"l_quantity": 120.5, "l_discount": -3000.25, "l_tax": 1750.5, "l_linenumber": 10.75},
    "model_b": {"l_quantity": 80.25, "l_discount": -9000.5, "l_tax": 250.25, "l_linenumber": 99.5},
}
LINE_FEATURES = list(SLOPES["model_a"])


def _line_importance(spark, sf):
    return ridge.linear_attribution(driver.table(spark, sf, "lineitem"), SLOPES)


def line_attribution(spark, sf):
    return rounded(_line_importance(spark, sf), 4, "importance")


def importance_share(spark, sf):
    shares = importance.importance_shares(_line_importance(spark, sf))
    return rounded(shares.select("model", "feature", "share"), 8, "share")


def importance_wide(spark, sf):
    table = importance.combined_importance(_line_importance(spark, sf), list(SLOPES))
    return rounded(table, 8, *SLOPES, "total")


def importance_top(spark, sf):
    """Ranked features with their meaning; day features are explained, others are not."""
    combined = importance.combined_importance(
        _line_importance(spark, sf).replace({"l_linenumber": "t_days"}, subset=["feature"]), list(SLOPES))
    return rounded(importance.ranked_with_meaning(combined, feature_meanings(spark), 3), 8, "total")


def top_features(spark, sf):
    """Union of the two best features per model."""
    return importance.top_of_any_model(_line_importance(spark, sf), 2)


def dropped_features(spark, sf):
    """Features that a top-2 selection drops."""
    combined = cut_lineage(
        importance.combined_importance(_line_importance(spark, sf), list(SLOPES)))
    kept = combined.orderBy(F.desc("total"), "feature").limit(2)
    return reshape.names_not_in(combined, kept, "feature")


def dependence_table(spark, sf):
    """Attribution by cell of each feature's range."""
    lines = driver.table(spark, sf, "lineitem")
    slopes = SLOPES["model_a"]
    table = importance.dependence(
        lines, {name: F.col(name) * slope for name, slope in slopes.items()})
    return rounded(table, 6, "value", "attribution")


QUERIES = {fn.__name__: fn for fn in (
    ridge_forecast, ridge_trend, recursive_given, boosted_forecast, specialist_forecast, trained_variants, component_forecast,
    recursive_forecast, recursive_trees, recursive_scores, search_trials, perm_importance, forest_importance, ridge_importance,
    run_record, line_attribution, importance_share, importance_wide, importance_top, top_features,
    dropped_features, dependence_table,
)}


def _importance_sql() -> str:
    parts = [
        f"SELECT '{model}' AS model, '{name}' AS feature, "
        f"avg(abs({slope!r}::DOUBLE * ({name} - (SELECT avg({name}) FROM lineitem)))) AS importance FROM lineitem"
        for model, slopes in SLOPES.items() for name, slope in slopes.items()]
    return "WITH imp AS (" + " UNION ALL ".join(parts) + """),
share AS (SELECT model, feature, importance / sum(importance) OVER (PARTITION BY model) AS share FROM imp),
wide AS (SELECT feature, max(share) FILTER (model = 'model_a') AS model_a,
         max(share) FILTER (model = 'model_b') AS model_b, sum(share) AS total FROM share GROUP BY 1)"""


def _dependence_sql() -> str:
    slopes = SLOPES["model_a"]
    shares = ", ".join(str(k / 20) for k in range(1, 20))
    parts = [
        f"SELECT '{name}' AS feature, CAST({name} AS DOUBLE) AS v, {name} * {slope!r}::DOUBLE AS a, "
        f"(SELECT list_distinct(quantile_disc({name}::DOUBLE, [{shares}])) FROM lineitem) AS edges FROM lineitem"
        for name, slope in slopes.items()]
    return "WITH x AS (" + " UNION ALL ".join(parts) + """)
SELECT feature, CAST(len(list_filter(edges, lambda e: e < v)) AS INTEGER) AS cell,
       round(avg(v), 6) AS value, round(avg(a), 6) AS attribution, count(*) AS n FROM x GROUP BY 1, 2"""


_IMP = _importance_sql()
ORACLE = {
    "ridge_trend": f"""WITH {PANEL_SQL},
x AS (SELECT series, "Date", ln(1 + "Revenue") AS y, ("Date" - DATE '1998-01-01')::DOUBLE AS a,
      CASE WHEN isodow("Date") >= 6 THEN 1.0::DOUBLE ELSE 0 END AS b FROM panel),
m AS (SELECT count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, stddev_pop(a) AS sa, stddev_pop(b) AS sb,
      covar_pop(a, y) / stddev_pop(a) AS ca, covar_pop(b, y) / stddev_pop(b) AS cb,
      covar_pop(a, b) / stddev_pop(a) / stddev_pop(b) AS r FROM x),
w AS (SELECT *, ((n + 3) * n * ca - n * r * n * cb) / ((n + 3) ** 2 - (n * r) ** 2) AS wa,
             ((n + 3) * n * cb - n * r * n * ca) / ((n + 3) ** 2 - (n * r) ** 2) AS wb FROM m)
SELECT series, "Date", round(my + wa * (a - ma) / sa + wb * (b - mb) / sb, 6) AS yhat FROM x, w""",
    "recursive_given": f"""WITH RECURSIVE {DAILY_SQL},
whole AS (
  SELECT s.series, CAST(unnest(generate_series(s.first_day::TIMESTAMP, TIMESTAMP '{driver.HISTORY_END}', INTERVAL 1 DAY)) AS DATE) AS "Date"
  FROM (SELECT series, min("Date") AS first_day FROM daily GROUP BY 1) s),
full_days AS (
  SELECT w.series, w."Date", coalesce(d."Revenue", 0) AS y,
         row_number() OVER (PARTITION BY w.series ORDER BY w."Date" DESC) AS age, count(*) OVER (PARTITION BY w.series) AS n
  FROM whole w LEFT JOIN daily d ON w.series = d.series AND w."Date" = d."Date"),
walk AS (
  SELECT series, DATE '{driver.HISTORY_END}' AS "Date", list(y ORDER BY age DESC) FILTER (age <= 7) AS tail,
         sum(y * 0.75::DOUBLE ** (age - 1) * CASE WHEN age = n THEN 1 ELSE 0.25::DOUBLE END) AS ewm
  FROM full_days GROUP BY series
  UNION ALL
  SELECT series, day, list_append(tail[2:], v), v * 0.25::DOUBLE + ewm * 0.75::DOUBLE FROM (
    SELECT series, CAST("Date" + 1 AS DATE) AS day, tail, ewm,
           greatest(exp(12.5::DOUBLE + 2e-7::DOUBLE * tail[7] - 1e-7::DOUBLE * tail[6] + 1.5e-7::DOUBLE * list_avg(tail)
             + 0.5e-7::DOUBLE * list_aggregate(tail, 'stddev_samp') - 2.5e-7::DOUBLE * ewm
             + CASE WHEN isodow("Date" + 1) >= 6 THEN 0.25::DOUBLE ELSE 0 END) - 1, 0) AS v
    FROM walk WHERE "Date" < DATE '{driver.FORECAST_LAST}'))
SELECT series, "Date", round(tail[7], 2) AS "Revenue" FROM walk WHERE "Date" > DATE '{driver.HISTORY_END}'""",
    "line_attribution": f"{_IMP} SELECT model, feature, round(importance, 4) AS importance FROM imp",
    "importance_share": f"{_IMP} SELECT model, feature, round(share, 8) AS share FROM share",
    "importance_wide": f"""{_IMP} SELECT feature, round(model_a, 8) AS model_a, round(model_b, 8) AS model_b,
round(total, 8) AS total FROM wide""",
    "importance_top": f"""{_IMP}, t AS (
SELECT CASE feature WHEN 'l_linenumber' THEN 't_days' ELSE feature END AS feature, total FROM wide)
SELECT CAST(row_number() OVER (ORDER BY total DESC, feature) AS INTEGER) AS rank, feature, round(total, 8) AS total,
CASE feature WHEN 't_days' THEN '{constants.FEATURE_MEANINGS["t_days"]}' ELSE '—' END AS meaning
FROM t ORDER BY total DESC, feature LIMIT 3""",
    "top_features": f"""{_IMP}, r AS (SELECT *, row_number() OVER (
PARTITION BY model ORDER BY importance DESC, feature) AS k FROM imp)
SELECT DISTINCT feature FROM r WHERE k <= 2""",
    "dropped_features": f"""{_IMP}, r AS (SELECT feature, row_number() OVER (
ORDER BY total DESC, feature) AS k FROM wide) SELECT feature FROM r WHERE k > 2""",
    "dependence_table": _dependence_sql(),
}
