"""Registered queries of boosted trees on problems that SQL can solve.

With one binary feature a tree of one split is two groups, so its leaves are
(weighted) means or medians per group, its rounds shrink a known distance, and its
attributions are distances between groups and the whole.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import to_log
from tallycast.models import boosted, forest, importance, search
from tallycast.operators import panel as panels
from tallycast.operators.weights import split_holdout, stable_year_weight
from tallycast.plans import components as component_plan
from tallycast.registry import driver
from tallycast.registry.common import COMPONENTS_SQL, PANEL_SQL, rounded
from tallycast.session import cut_lineage

KEYS = driver.KEYS
BY_DAY = [*KEYS, "Date"]
FEATURES = ["is_weekend"]
ROUND = boosted.TreeSpec("squared", "squared", 1.0, 1, min_leaf=1, rounds=1)
HALVES = replace(ROUND, step=0.5, rounds=4, patience=2)


def _days(panel: DataFrame) -> DataFrame:
    return panel.withColumns({
        "is_weekend": (F.weekday("Date") > 4).cast("double"),
        "weight": stable_year_weight(F.col("Date"), driver.STABLE_YEARS)})


def _vectors(spark, sf, target="Revenue"):
    days = _days(driver.panel(spark, sf)).withColumn("label", to_log(F.col(target)))
    return cut_lineage(days.select(*BY_DAY, "label", "weight", array_to_vector(F.array("is_weekend")).alias("features")))


def tree_squared(spark, sf):
    """Three rounds of half steps towards weighted means."""
    rows = _vectors(spark, sf)
    model = boosted.boost(replace(HALVES, rounds=3), boosted.training_rows(rows))
    return rounded(forest.with_prediction(model, rows, BY_DAY, name="yhat"), 8, "yhat")


def tree_median(spark, sf):
    """One round for the absolute error: every leaf is a weighted median."""
    rows = _vectors(spark, sf)
    model = boosted.boost(replace(ROUND, loss="quantile"), boosted.training_rows(rows))
    return rounded(forest.with_prediction(model, rows, BY_DAY, name="yhat"), 8, "yhat")


def tree_quantile(spark, sf):
    """One round for the loss of the upper decile."""
    rows = _vectors(spark, sf)
    model = boosted.boost(replace(ROUND, loss="quantile", share=0.9), boosted.training_rows(rows))
    return rounded(forest.with_prediction(model, rows, BY_DAY, name="yhat"), 8, "yhat")


def tree_holdout(spark, sf):
    """Rounds and error that the hold-out chooses, and the forecast of the refit."""
    rows = _vectors(spark, sf)
    fitted = boosted.fit_with_holdout(HALVES, boosted.training_rows(rows), after=driver.HOLDOUT_AFTER)
    scored = forest.with_prediction(fitted.full, rows, BY_DAY, name="yhat")
    early = forest.with_prediction(fitted.early, rows, BY_DAY, name="early")
    return rounded(scored.join(early, BY_DAY).groupBy(*KEYS).agg(
        F.avg("yhat").alias("yhat"), F.avg("early").alias("early"), F.lit(fitted.rounds).alias("rounds"),
        F.lit(fitted.error).alias("error")), 8, "yhat", "early", "error")


def tree_specialists(spark, sf):
    """Every day by the model of its quarter, whose rows weigh more."""
    rows = _vectors(spark, sf)
    models = boosted.fit_specialists(ROUND, boosted.training_rows(rows), after=driver.HOLDOUT_AFTER)
    return rounded(boosted.predict_specialists(models, rows, BY_DAY), 4, "yhat")


def tree_components(spark, sf):
    """Orders times order value, each the mean of its group over two seeds."""
    panel = driver.panel_once(spark, sf)
    rows = cut_lineage(component_plan.with_components(_days(panel), driver.components(spark, sf), keys=KEYS))
    ratios = panels.cogs_ratio(panel.where(F.col("Revenue") > 0), keys=KEYS)
    ahead = panel.select(*KEYS).distinct().withColumn("Date", F.explode(F.sequence(
        F.lit(driver.FORECAST_FIRST), F.lit(driver.FORECAST_LAST), F.expr("interval 1 day"))))
    result = component_plan.component_forecast(
        rows.drop("weight"), _days(ahead).drop("weight"), FEATURES, ratios, keys=KEYS, after=driver.HOLDOUT_AFTER, specs=[ROUND],
        seeds=(1, 2), anchor=1_000_000.0, stable_years=driver.STABLE_YEARS)
    return rounded(result.select(*BY_DAY, "Revenue", "COGS"), 3, "Revenue", "COGS")


def tree_attribution(spark, sf):
    """Mean absolute attribution of the split and of a feature without one."""
    rows = _vectors(spark, sf).withColumn("features", array_to_vector(F.concat(
        vector_to_array("features"), F.array(F.lit(1.0)))))
    model = boosted.boost(ROUND, boosted.training_rows(rows))
    return rounded(forest.tree_attribution(rows, {"trees": model}, [*FEATURES, "constant"]), 8, "importance")


def tree_dependence(spark, sf):
    """Attribution of a tree by cell of its feature."""
    rows = _vectors(spark, sf)
    model = boosted.boost(ROUND, boosted.training_rows(rows))
    return rounded(importance.tree_dependence(model, rows, FEATURES, FEATURES), 8, "attribution")


def search_scores(spark, sf):
    """Trials over a space of one point: the hold-out error of one round."""
    space = {"squared": {"step": ("real", 1.0, 1.0), "depth": ("int", 1, 1), "rounds": ("int", 1, 1)}}
    trials = search.search(
        boosted.training_rows(_vectors(spark, sf)), [ROUND], target="Revenue", after=driver.HOLDOUT_AFTER, trials=3, spaces=space)
    best = search.best_trials(trials)
    return rounded(best.select(
        "target", "model", F.col("params")["depth"].alias("depth"), F.col("params")["step"].alias("step"), "score"), 8, "score")


QUERIES = {fn.__name__: fn for fn in (
    tree_squared, tree_median, tree_quantile, tree_holdout, tree_specialists, tree_components, tree_attribution,
    tree_dependence, search_scores,
)}

_FIRST, _LAST = driver.STABLE_YEARS
_HELD = f"DATE '{driver.HOLDOUT_AFTER}'"


def _rows(table: str = "panel", label: str = 'ln(1 + "Revenue")') -> str:
    return f"""x AS (
  SELECT series, "Date", {label} AS y, CASE WHEN isodow("Date") >= 6 THEN 1 ELSE 0 END AS b, quarter("Date") AS q,
         CASE WHEN year("Date") BETWEEN {_FIRST} AND {_LAST} THEN 1.0::DOUBLE ELSE {constants.OTHER_YEAR_WEIGHT!r}::DOUBLE END AS w
  FROM {table})"""


_X = f"WITH {PANEL_SQL}, {_rows()}"
_MEANS = "a AS (SELECT sum(w * y) / sum(w) AS m FROM x), g AS (SELECT b, sum(w * y) / sum(w) AS v FROM x GROUP BY b)"


def _quantile_sql(share: float) -> str:
    return f"""{_X},
c AS (SELECT b, y, sum(w) OVER (PARTITION BY b ORDER BY y ROWS UNBOUNDED PRECEDING) AS upto,
      sum(w) OVER (PARTITION BY b) AS total FROM (SELECT b, y, sum(w) AS w FROM x GROUP BY b, y)),
g AS (SELECT b, min(y) AS v FROM c WHERE upto >= {share} * total GROUP BY b)
SELECT series, "Date", round(v, 8) AS yhat FROM x JOIN g USING (b)"""


def _component(name: str) -> str:
    rows = _rows("counted", f"ln(1 + {name})").replace("x AS (", f"x_{name} AS (", 1)
    return f"""{rows},
g_{name} AS (SELECT b, greatest(exp(sum(w * y) / sum(w)) - 1, 0) AS {name} FROM x_{name} GROUP BY b)"""


ORACLE = {
    "tree_squared": f"""{_X}, {_MEANS}
SELECT series, "Date", round(m + 0.875::DOUBLE * (v - m), 8) AS yhat FROM x JOIN g USING (b), a""",
    "tree_median": _quantile_sql(0.5),
    "tree_quantile": _quantile_sql(0.9),
    "tree_holdout": f"""{_X}, {_MEANS},
t AS (SELECT * FROM x WHERE "Date" <= {_HELD}), h AS (SELECT * FROM x WHERE "Date" > {_HELD}),
ta AS (SELECT sum(w * y) / sum(w) AS m FROM t), tg AS (SELECT b, sum(w * y) / sum(w) AS v FROM t GROUP BY b),
r AS (SELECT k, avg((y - (ta.m + (1 - 0.5::DOUBLE ** k) * (tg.v - ta.m))) ** 2) AS error
      FROM h JOIN tg USING (b), ta, (SELECT unnest([1, 2, 3, 4]) AS k) GROUP BY k),
best AS (SELECT k, error FROM r ORDER BY error, k LIMIT 1)
SELECT series, round(avg(a.m + (1 - 0.5::DOUBLE ** k) * (g.v - a.m)), 8) AS yhat,
       round(avg(ta.m + (1 - 0.5::DOUBLE ** k) * (tg.v - ta.m)), 8) AS early,
       CAST(any_value(k) AS INTEGER) AS rounds, round(any_value(error), 8) AS error
FROM x JOIN g USING (b) JOIN tg USING (b), a, ta, best GROUP BY series""",
    "tree_specialists": f"""{_X},
s AS (SELECT p.q, b, sum(y * w * CASE WHEN x.q = p.q THEN {constants.QUARTER_BOOST!r}::DOUBLE ELSE 1 END)
        / sum(w * CASE WHEN x.q = p.q THEN {constants.QUARTER_BOOST!r}::DOUBLE ELSE 1 END) AS v
      FROM x, (SELECT unnest([1, 2, 3, 4]) AS q) p GROUP BY p.q, b)
SELECT series, "Date", round(exp(v) - 1, 4) AS yhat FROM x JOIN s USING (q, b)""",
    "tree_components": f"""WITH {PANEL_SQL}, {COMPONENTS_SQL},
counted AS (SELECT p.series, p."Date", coalesce(n_orders, 0) AS n_orders,
            coalesce(aov, median(aov) OVER (PARTITION BY p.series)) AS aov
            FROM panel p LEFT JOIN comp c ON p.series = c.series AND p."Date" = c."Date"),
{_component("n_orders")}, {_component("aov")},
days AS (SELECT series, CAST(unnest(generate_series(TIMESTAMP '{driver.FORECAST_FIRST}', TIMESTAMP '{driver.FORECAST_LAST}',
         INTERVAL 1 DAY)) AS DATE) AS "Date" FROM (SELECT DISTINCT series FROM panel)),
f AS (SELECT series, "Date", n_orders * aov AS v FROM days
      JOIN g_n_orders g ON g.b = CASE WHEN isodow("Date") >= 6 THEN 1 ELSE 0 END JOIN g_aov a ON a.b = g.b),
ratios AS (SELECT series, median("COGS" / greatest("Revenue", 1)) AS ratio FROM panel WHERE "Revenue" > 0 GROUP BY 1),
scaled AS (SELECT series, "Date", v * 1000000.0::DOUBLE / avg(v) OVER (PARTITION BY series) AS v FROM f)
SELECT scaled.series, "Date", round(v, 3) AS "Revenue", round(least(v * ratio, v * {constants.COGS_CAP!r}::DOUBLE), 3) AS "COGS"
FROM scaled JOIN ratios ON scaled.series = ratios.series""",
    "tree_attribution": f"""{_X}, {_MEANS}
SELECT 'trees' AS model, 'is_weekend' AS feature, round(avg(abs(v - m)), 8) AS importance FROM x JOIN g USING (b), a
UNION ALL SELECT 'trees', 'constant', 0.0::DOUBLE""",
    "tree_dependence": f"""{_X}, {_MEANS}
SELECT 'is_weekend' AS feature, CAST(b AS INTEGER) AS cell, CAST(b AS DOUBLE) AS value, round(avg(v - m), 8) AS attribution,
       count(*) AS n FROM x JOIN g USING (b), a GROUP BY b""",
    "search_scores": f"""{_X},
tg AS (SELECT b, sum(w * y) / sum(w) AS v FROM x WHERE "Date" <= {_HELD} GROUP BY b)
SELECT 'Revenue' AS target, 'squared' AS model, 1.0::DOUBLE AS depth, 1.0::DOUBLE AS step, round(avg(abs(y - v)), 8) AS score
FROM x JOIN tg USING (b) WHERE "Date" > {_HELD}""",
}
