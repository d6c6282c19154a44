"""Complete runs over a folder of retail tables: read, compute, write.

Each job is one stage of the published workflow.  Stages hand results on as
files: the search writes parameters and the explanation writes importances,
both of which training reads when they exist.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import to_log
from tallycast.models import boosted, forest, importance, search
from tallycast.models.ridge import as_vectors
from tallycast.operators.dynamic import dynamic_names
from tallycast.operators.features import attach_days, build_features, feature_names, lunar_aligned_lag
from tallycast.operators.panel import cogs_ratio, daily_components
from tallycast.operators.weights import stable_year_weight
from tallycast.plans import (
    components, diagnostics, questions, recursive, seasonal, training, variants,
)
from tallycast.session import cut_lineage
from tallycast.sources import inputs, sinks
from tallycast.sources.dimensions import date_spine, feature_meanings, lunar_new_year
from tallycast.sources.tables import read_csv_table

KEYS = ["series"]
BY_DAY = [*KEYS, "Date"]


@dataclass(frozen=True)
class Period:
    """Dates a run depends on."""

    holdout_after: dt.date = constants.HOLDOUT_AFTER
    forecast_first: dt.date = constants.FORECAST_START
    forecast_last: dt.date = constants.FORECAST_END
    warmup_end: dt.date = constants.WARMUP_END
    stable_years: tuple[int, int] = constants.STABLE_YEARS
    full_years: tuple[int, int] = (2013, 2022)
    base_year: int = 2022


@dataclass(frozen=True)
class Prepared:
    """Sales and feature tables of history and forecast days."""

    sales: DataFrame
    days: DataFrame
    future_days: DataFrame
    history: DataFrame
    future: DataFrame
    features: list[str]


def read_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sales as a panel: by the column ``series`` where the file has one, else with
    the one series ``all``.  Rows of a panel without a series are left out."""
    sales = read_csv_table(spark, folder, "sales", further={"series": "string"})
    if "series" in sales.columns:
        return sales.where("series is not null")
    return sales.withColumn("series", F.lit("all"))


def prepare(
    spark: SparkSession, folder: str, period: Period = Period(), *, lunar_lag: bool = False
) -> Prepared:
    sales = cut_lineage(read_sales(spark, folder))
    promotions = read_csv_table(spark, folder, "promotions")
    events = lunar_new_year(spark)
    days = cut_lineage(build_features(
        sales.select("Date").distinct(), promotions=promotions, lunar_events=events))
    ahead = cut_lineage(build_features(
        date_spine(spark, period.forecast_first, period.forecast_last),
        promotions=promotions, lunar_events=events))
    asked = _forecast_days(sales, period)
    history, future = attach_days(sales, days), attach_days(asked, ahead)
    if lunar_lag:
        known = period.forecast_first.year - 1
        history = lunar_aligned_lag(history, sales, keys=KEYS, last_known_year=known)
        future = lunar_aligned_lag(future, sales, keys=KEYS, last_known_year=known)
    names = feature_names(history, exclude=KEYS)
    return Prepared(sales, days, ahead, cut_lineage(history), cut_lineage(future), names)


def _forecast_days(sales: DataFrame, period: Period) -> DataFrame:
    """Every forecast day of every series."""
    every = F.sequence(
        F.lit(period.forecast_first), F.lit(period.forecast_last), F.expr("interval 1 day"))
    return sales.select(*KEYS).distinct().withColumn("Date", F.explode(every))


def answers(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The ten business questions."""
    table = {name: read_csv_table(spark, folder, name) for name in (
        "orders", "order_items", "products", "customers", "returns", "web_traffic", "payments",
        "geography")}
    return {
        "median_order_gap": questions.median_order_gap(table["orders"]),
        "margin_by_segment": questions.margin_by_segment(table["products"]),
        "return_reasons": questions.return_reasons(
            table["returns"], table["products"], "Streetwear"),
        "bounce_by_source": questions.bounce_by_source(table["web_traffic"]),
        "promo_share": questions.promo_share(table["order_items"]),
        "orders_per_customer": questions.orders_per_customer(table["orders"], table["customers"]),
        "revenue_by_region": questions.revenue_by_region(
            table["orders"], table["order_items"], table["geography"]),
        "payment_counts": questions.payment_counts(table["orders"]),
        "return_rate_by_size": questions.return_rate_by_size(
            table["order_items"], table["returns"], table["products"]),
        "payment_by_installments": questions.payment_by_installments(table["payments"]),
    }


def analyze(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Diagnostics of the sales series and the promotions."""
    sales = read_sales(spark, folder)
    return {
        "summary": diagnostics.summary(sales, keys=KEYS),
        "yearly": diagnostics.yearly(sales, keys=KEYS),
        "by_weekday": diagnostics.by_weekday(sales, keys=KEYS),
        "by_month": diagnostics.by_month(sales, keys=KEYS),
        "cost_ratio": diagnostics.cost_ratio(sales, keys=KEYS),
        "promo_months": diagnostics.promo_months(read_csv_table(spark, folder, "promotions")),
        "top_days": diagnostics.top_days(sales),
        "weight_share": diagnostics.weight_share(sales, keys=KEYS),
        "events_seen": diagnostics.events_seen(lunar_new_year(spark), sales),
    }


def train(
    spark: SparkSession, folder: str, out: str, *, period: Period = Period(),
    specs: Sequence[boosted.TreeSpec] = boosted.DEFAULT_SPECS,
    weights: Mapping[str, Mapping[str, float]] = constants.BOOSTER_WEIGHTS,
    top_n: int = 0, published: str = "default",
) -> training.Training:
    """Fit, calibrate, score; write the forecasts of all variants and the run's record.

    Parameters below ``out`` are used if a search has written them, and with
    ``top_n`` only the most important features of an explanation are kept.
    """
    started = time.monotonic()
    data = prepare(spark, folder, period)
    names = data.features
    ranking = f"{out}/importance"
    if top_n and inputs.path_exists(spark, ranking):
        best = sinks.read_importance(spark, ranking)
        kept = set(importance.keep_top(best, top_n))
        names = [name for name in names if name in kept]
    run = training.train(
        data.history, data.future, names, keys=KEYS, after=period.holdout_after, weights=weights,
        specs=specs, stable_years=period.stable_years,
        tuned=inputs.read_parameters(spark, f"{out}/parameters"))
    wide = cut_lineage(variants.targets_wide(
        run.future_variants, keys=["variant", *BY_DAY], targets=list(weights)))
    scores = {f"{r.variant}_{r.target}": {"mae": r.mae, "rmse": r.rmse, "r2": r.r2}
              for r in run.scores.collect()}
    winner = run.best.first().variant
    sinks.write_forecasts(wide, f"{out}/forecasts")
    _write_one(sinks.publish_variant(wide, published), f"{out}/published")
    _write_one(sinks.publish_variant(wide, winner), f"{out}/best_on_holdout")
    sinks.write_metadata(sinks.run_metadata(
        spark,
        numbers={"n_features": float(len(names)), "elapsed_sec": time.monotonic() - started}
        | {f"factor_{target}": f for target, f in run.multipliers.overall.items()}
        | {f"factor_{target}_q{q}": f for (target, q), f in run.multipliers.quarterly.items()},
        labels={"best_variant": winner, "published_variant": published}, scores=scores),
        f"{out}/metadata")
    return run


def _write_one(forecast: DataFrame, path: str) -> None:
    """A published table in date order."""
    forecast.orderBy("Date").write.mode("overwrite").option("header", True).csv(path)


def _labelled(data: Prepared, names: Sequence[str], target: str, period: Period) -> DataFrame:
    """Feature vectors with the log target and the row weights, written once."""
    rows = data.history.withColumns({
        "label": to_log(F.col(target)),
        "weight": stable_year_weight(F.col("Date"), period.stable_years)})
    return cut_lineage(as_vectors(rows, names, [*BY_DAY, "label", "weight"]))


def explain(
    spark: SparkSession, folder: str, out: str, *, period: Period = Period(),
    specs: Sequence[boosted.TreeSpec] = (boosted.DEFAULT_SPECS[0], boosted.DEFAULT_SPECS[2]),
    targets: Sequence[str] = constants.TARGETS, report_rows: int = 15,
) -> DataFrame:
    """Mean absolute attribution of every feature per target and booster; writes the
    combined table and returns its top rows with their meaning."""
    data = prepare(spark, folder, period)
    rows = {target: _labelled(data, data.features, target, period) for target in targets}
    cases = [(target, spec) for target in targets for spec in specs]
    fitted = [one.full for own in rows.values() for one in boosted.fit_cases(
        boosted.training_rows(own), [boosted.Case(spec, after=period.holdout_after) for spec in specs])]
    names = [f"{target}_{spec.name}" for target, spec in cases]
    parts = [forest.tree_attribution(rows[target], {
        name: model for name, (own, _), model in zip(names, cases, fitted) if own == target}, data.features)
        for target in targets]
    combined = importance.combined_importance(cut_lineage(reduce(DataFrame.unionByName, parts)), names)
    sinks.write_importance(combined, f"{out}/importance")
    return importance.ranked_with_meaning(
        sinks.read_importance(spark, f"{out}/importance"),
        feature_meanings(spark), report_rows)


def tune(
    spark: SparkSession, folder: str, out: str, *, period: Period = Period(),
    specs: Sequence[boosted.TreeSpec] = boosted.DEFAULT_SPECS[:3],
    targets: Sequence[str] = constants.TARGETS, trials: int = 30, spaces: Mapping = search.SPACES,
) -> DataFrame:
    """Search parameters per target and booster; writes the best for training."""
    data = prepare(spark, folder, period)
    found = None
    for target in targets:
        part = search.search(
            boosted.training_rows(_labelled(data, data.features, target, period)), specs, target=target,
            after=period.holdout_after, trials=trials, spaces=spaces)
        found = part if found is None else found.unionByName(part)
    best = search.best_trials(found)
    sinks.write_metadata(best, f"{out}/parameters")
    return best


def forecast_components(
    spark: SparkSession, folder: str, out: str, *, period: Period = Period(), force: bool = False,
    **options,
) -> DataFrame:
    """Orders times order value; the daily components are kept as a table below ``out``."""
    data = prepare(spark, folder, period)

    def counted() -> DataFrame:
        orders = read_csv_table(spark, folder, "orders", further={"series": "string"})
        lines = read_csv_table(spark, folder, "order_items")
        if "series" not in orders.columns:
            return daily_components(orders, lines).withColumn("series", F.lit("all"))
        return daily_components(orders.where("series is not null"), lines, keys=KEYS)

    parts = inputs.cached_table(spark, f"{out}/daily_components", counted, force=force)
    rows = cut_lineage(components.with_components(data.history, parts, keys=KEYS))
    result = cut_lineage(components.component_forecast(
        rows, data.future, data.features, cogs_ratio(data.sales, keys=KEYS), keys=KEYS,
        after=period.holdout_after, stable_years=period.stable_years, **options))
    _write_one(sinks.as_forecast_file(result), f"{out}/components")
    return result


def forecast_recursively(
    spark: SparkSession, folder: str, out: str, *, period: Period = Period(),
    anchors: Mapping[str, float] = constants.RECURSIVE_ANCHOR, trees: boosted.TreeSpec | None = None,
) -> DataFrame:
    """Day-by-day forecast by ridge, or by ``trees``; writes it with one-step hold-out
    scores of the ridge model of each target."""
    data = prepare(spark, folder, period)
    names = data.features
    scores = {}
    for target in anchors:
        frame = cut_lineage(recursive.training_frame(
            data.sales, data.days, target, keys=KEYS, warmup_end=period.warmup_end))
        row = recursive.holdout_scores(
            frame, [*names, *dynamic_names(target)], target, after=period.holdout_after).first()
        scores[target] = {"mae": row.mae, "rmse": row.rmse, "r2": row.r2}
    result, models = recursive.recursive_plan(
        data.sales, data.days, data.future_days, names, keys=KEYS,
        warmup_end=period.warmup_end, anchors=anchors, trees=trees, after=period.holdout_after)
    result = cut_lineage(result)
    _write_one(sinks.as_forecast_file(result), f"{out}/recursive")
    sinks.write_metadata(sinks.run_metadata(
        spark, numbers={f"n_features_{t}": float(len(m.features)) for t, m in models.items()},
        labels={"model": "ridge" if trees is None else trees.name}, scores=scores), f"{out}/recursive_metadata")
    return result


def forecast_baseline(
    spark: SparkSession, folder: str, out: str, *, period: Period = Period()
) -> DataFrame:
    """Level × growth × seasonal profile of the forecast days."""
    sales = cut_lineage(read_sales(spark, folder))
    days = _forecast_days(sales, period)
    result = cut_lineage(seasonal.seasonal_forecast(
        sales, days, keys=KEYS, full_years=period.full_years, base_year=period.base_year))
    _write_one(sinks.as_forecast_file(result), f"{out}/baseline")
    return result
