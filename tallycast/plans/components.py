"""Revenue as orders times average order value, each forecast on its own."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import to_log
from tallycast.models.boosted import DEFAULT_SPECS, TreeSpec, predict_over_seeds, training_rows
from tallycast.models.ridge import as_vectors
from tallycast.operators.blend import anchor_to_mean, cogs_from_ratio
from tallycast.operators.panel import fill_with_median
from tallycast.operators.weights import stable_year_weight
from tallycast.session import cut_lineage


def with_components(feature_rows: DataFrame, components: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Attach orders and order value to feature rows; days without orders count none
    and get the usual order value."""
    joined = feature_rows.join(
        components.select(*keys, "Date", "n_orders", "aov"), [*keys, "Date"], "left")
    counted = joined.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))
    return fill_with_median(counted, "aov", keys=keys)


def component_forecast(
    history: DataFrame,
    future: DataFrame,
    features: Sequence[str],
    cogs_ratios: DataFrame,
    *,
    keys: Sequence[str],
    after: dt.date = constants.HOLDOUT_AFTER,
    specs: Sequence[TreeSpec] = DEFAULT_SPECS[:3],
    seeds: Sequence[int] = constants.COMPONENT_SEEDS,
    anchor: float = constants.COMPONENT_ANCHOR,
    stable_years: tuple[int, int] = constants.STABLE_YEARS,
) -> DataFrame:
    """Revenue and COGS per key and future day.

    ``history`` carries the features, n_orders and aov (see ``with_components``).
    """
    by_day = [*keys, "Date"]
    ahead = cut_lineage(as_vectors(future, features, by_day))
    labels = {f"label_{component}": to_log(F.col(component)) for component in ("n_orders", "aov")}
    labelled = history.withColumns(labels | {"weight": stable_year_weight(F.col("Date"), stable_years)})
    table = training_rows(as_vectors(labelled, features, [*by_day, *labels, "weight"]), labels=list(labels))
    parts = predict_over_seeds(specs, table, ahead, by_day, after=after, seeds=seeds, labels=list(labels))
    product = parts["label_n_orders"].withColumnRenamed("yhat", "n_orders").join(
        parts["label_aov"].withColumnRenamed("yhat", "aov"), by_day)
    revenue = product.select(*by_day, (F.col("n_orders") * F.col("aov")).alias("Revenue"))
    anchored = anchor_to_mean(revenue, {"Revenue": anchor}, keys=keys)
    return cogs_from_ratio(anchored, cogs_ratios, keys=keys)
