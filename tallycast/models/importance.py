"""Which features a forecast depends on."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import ratio
from tallycast.models.forest import Forest, matrices, with_attribution
from tallycast.operators.ranking import ranked, top_rows
from tallycast.operators.reshape import to_wide

ROWS_PER_BUCKET = 1000


def permutation_importance(
    forest: Forest, rows: DataFrame, features: Sequence[str], *, keys: Sequence[str],
    buckets: int | None = None, seed: int = constants.SEED,
) -> DataFrame:
    """Rise of the MAE when one feature is shuffled (feature, importance, not below 0).

    Rows get a random bucket of about ROWS_PER_BUCKET rows and a random order in it; each takes the feature
    values of the next row of its bucket, the last those of the first.  Every
    value is used exactly once and no bucket grows with a key's frequency,
    because the random order depends on the whole row key.  Each task scores its
    rows once per feature and sends one sum for each.
    """
    if buckets is None:
        buckets = max(1, rows.count() // ROWS_PER_BUCKET)
    mixed = rows.select(
        "label", F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(buckets)).alias("bucket"),
        F.xxhash64(*keys, F.lit(seed + 1)).alias("place"), F.struct(*keys).alias("key"),
        vector_to_array("features").alias("own"))
    order = Window.partitionBy("bucket").orderBy("place", "key")
    paired = mixed.select("label", "own", F.coalesce(
        F.lead("own").over(order),
        F.first("own").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("other"))
    names = list(features)

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, count = np.zeros(len(names) + 1), 0
        for batch in batches:
            for part, own in matrices(batch, "own", len(names)):
                label = part.column("label").to_numpy(zero_copy_only=False)
                other = part.column("other").flatten().to_numpy(zero_copy_only=False).reshape(own.shape)
                count += len(label)
                totals[-1] += np.abs(label - forest.predict(own)).sum()
                changed = own.copy()
                for place in range(len(names)):
                    changed[:, place] = other[:, place]
                    totals[place] += np.abs(label - forest.predict(changed)).sum()
                    changed[:, place] = own[:, place]
        yield pa.RecordBatch.from_pydict({
            "feature": names, "total": totals[:-1], "plain": np.full(len(names), totals[-1]),
            "n": np.full(len(names), count)})

    sums = paired.mapInArrow(errors, "feature string, total double, plain double, n long").groupBy("feature").agg(
        *[F.sum(name).alias(name) for name in ("total", "plain", "n")])
    return sums.select("feature", F.greatest(ratio(F.col("total") - F.col("plain"), F.col("n")), F.lit(0.0)).alias("importance"))


def importance_shares(importance: DataFrame) -> DataFrame:
    """Importance of each feature as a share of its model's total."""
    model = Window.partitionBy("model")
    return importance.withColumn("share", ratio(F.col("importance"), F.sum("importance").over(model)))


def combined_importance(importance: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per feature with the share of every model and their sum, largest first."""
    wide = to_wide(importance_shares(importance), key="feature", column="model",
                   values=models, value="share")
    return wide.orderBy(F.desc("total"), "feature")


def ranked_with_meaning(
    combined: DataFrame, meanings: DataFrame, n: int = 15, default: str = constants.UNKNOWN_MEANING
) -> DataFrame:
    """The top features with rank and explanation."""
    best = top_rows(combined.select("feature", "total"), "total", n, "feature")
    # One group of n rows, all that the report shows.
    numbered = ranked(best, "total", n, within=[], ties=["feature"])
    return numbered.join(meanings, "feature", "left").select(
        "rank", "feature", "total", F.coalesce("meaning", F.lit(default)).alias("meaning"))


def top_of_any_model(importance: DataFrame, n: int = 10) -> DataFrame:
    """Features among the ``n`` most important of at least one model."""
    best = ranked(importance, "importance", n, within=["model"], ties=["feature"])
    return best.select("feature").distinct()


def keep_top(combined: DataFrame, n: int) -> list[str]:
    """Names of the ``n`` most important features."""
    return [row.feature for row in top_rows(combined, "total", n, "feature").collect()]


def dependence(
    df: DataFrame, attributions: Mapping[str, Column], *, cells: int = 20, accuracy: int = 100_000,
) -> DataFrame:
    """Attribution against feature value, over cells of about equally many rows.

    One pass finds the edges of all features with mergeable summaries, exact up to
    ``accuracy`` rows and within rows / accuracy beyond; a second one aggregates.  A
    cell ends at its edge, so equal values share a cell, and features with few values
    have fewer cells.
    """
    names = list(attributions)
    shares = F.array(*[F.lit(k / cells) for k in range(1, cells)])
    edges = df.agg(F.struct(*[
        F.array_distinct(F.percentile_approx(F.col(name).cast("double"), shares, accuracy)).alias(name)
        for name in names])).scalar()
    entries = []
    for name in names:
        value = F.col(name).cast("double")
        # How many edges lie below the value; equal edges were made one.
        cell = reduce(lambda count, k: count + F.coalesce((F.get(edges[name], F.lit(k)) < value).cast("int"), F.lit(0)),
                      range(cells - 1), F.lit(0))
        entries.append(F.struct(
            F.lit(name).alias("feature"), cell.alias("cell"), value.alias("value"),
            attributions[name].alias("attribution")))
    long = df.select(F.inline(F.array(*entries)))
    return long.where(F.col("value").isNotNull()).groupBy("feature", "cell").agg(
        F.avg("value").alias("value"), F.avg("attribution").alias("attribution"),
        F.count(F.lit(1)).alias("n"))


def tree_dependence(
    forest: Forest, rows: DataFrame, features: Sequence[str], shown: Sequence[str], *, cells: int = 20,
) -> DataFrame:
    """``dependence`` of a forest on some of its features; ``rows`` has ``features``."""
    explained = with_attribution(forest, rows.withColumn("x", vector_to_array("features")), ["x"])
    places = {name: list(features).index(name) for name in shown}
    wide = explained.select(
        *[F.get("x", F.lit(k)).alias(name) for name, k in places.items()],
        *[F.get("attribution", F.lit(k)).alias(f"of_{name}") for name, k in places.items()])
    return dependence(wide, {name: F.col(f"of_{name}") for name in shown}, cells=cells)
