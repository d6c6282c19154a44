"""Ridge regression on standardised features, fitted in one pass over the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallycast import constants


@dataclass(frozen=True)
class RidgeModel:
    """Fitted weights; ``slopes`` apply to the features as they are."""

    features: tuple[str, ...]
    means: dict[str, float]
    scales: dict[str, float]
    coefficients: dict[str, float]
    intercept: float

    @property
    def slopes(self) -> dict[str, float]:
        return {name: self.coefficients[name] / self.scales[name] for name in self.features}

    @property
    def origin(self) -> float:
        """Prediction for features that are all zero."""
        return self.intercept - sum(
            self.slopes[name] * self.means[name] for name in self.features)

    def term(self, names: Sequence[str]) -> Column:
        """Sum of the linear terms of some features."""
        parts = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * self.slopes[name]
                 for name in names if self.slopes[name] != 0.0]
        return reduce(lambda total, part: total + part, parts, F.lit(0.0))

    def predict(self) -> Column:
        return F.lit(self.origin) + self.term(self.features)


def as_vectors(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Columns to keep plus the features as one vector; missing values count as 0."""
    if set(keep) & set(features):
        raise ValueError(f"kept columns are features too: {sorted(set(keep) & set(features))}")
    filled = df.select(*keep, *features).na.fill(0.0, list(features))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return assembler.transform(filled).select(*keep, "features")


def column_moments(vectors: DataFrame, *extra: Column) -> Row:
    """Count, mean and population deviation of each vector entry (0 becomes 1), in one pass."""
    found = vectors.agg(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s"),
        *extra).first()
    summary = found["s"]
    n = int(summary["count"])
    spread = np.sqrt(summary["variance"].toArray() * (n - 1) / max(n, 1))
    scales = np.where(spread == 0.0, 1.0, spread)
    return Row(n=n, means=summary["mean"].toArray(), scales=scales, extra=found[1:])


def fit_ridge(
    df: DataFrame, features: Sequence[str], label: str, *,
    alpha: float = constants.RIDGE_ALPHA, weight: str | None = None,
) -> RidgeModel:
    """Least squares with penalty ``alpha`` on the weights of standardised features.

    Spark standardises inside its single pass over the rows.  It divides the
    squared error by the total row weight and measures the penalty in units of
    the label's deviation, hence the conversion of ``alpha``.  Columns without
    variation get weight 0.  With row weights, Spark's means and deviations
    are weighted too.
    """
    row_weight = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    named = df.withColumns({"__label": F.col(label).cast("double"), "__weight": row_weight})
    vectors = as_vectors(named, features, ["__label", "__weight"])
    y, w = F.col("__label"), F.col("__weight")
    moments = column_moments(vectors, F.sum(w), F.sum(w * y), F.sum(w * y * y))
    total, first, second = moments.extra
    deviation = math.sqrt(max(second / total - (first / total) ** 2, 0.0))
    fitted = LinearRegression(
        featuresCol="features", labelCol="__label", weightCol="__weight", solver="normal",
        elasticNetParam=0.0, standardization=True, regParam=alpha / total * deviation,
    ).fit(vectors)
    means = dict(zip(features, map(float, moments.means)))
    scales = dict(zip(features, map(float, moments.scales)))
    slopes = dict(zip(features, map(float, fitted.coefficients)))
    return RidgeModel(
        features=tuple(features), means=means, scales=scales,
        coefficients={name: slopes[name] * scales[name] for name in features},
        intercept=float(fitted.intercept) + sum(slopes[name] * means[name] for name in features),
    )


def linear_attribution(
    df: DataFrame, models: Mapping[str, Mapping[str, float]],
    means: Mapping[str, float] | None = None,
) -> DataFrame:
    """Mean absolute contribution of each feature of linear models (model, feature, importance).

    The contribution of a feature is its slope times the distance from its
    mean, which adds up to the prediction exactly.  Its mean size is the slope
    times the feature's mean absolute deviation, so one pass serves all models
    (and one more finds the means if they are not given).
    """
    names = list(dict.fromkeys(name for slopes in models.values() for name in slopes))
    if means is None:
        centre = df.agg(F.struct(*[F.avg(name).alias(name) for name in names])).scalar()
        distance = {name: F.abs(F.col(name) - centre[name]) for name in names}
    else:
        distance = {name: F.abs(F.col(name) - means[name]) for name in names}
    deviations = df.agg(*[F.avg(value).alias(name) for name, value in distance.items()])
    return deviations.select(F.inline(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(name).alias("feature"),
                 (F.col(name) * abs(slope)).alias("importance"))
        for model, slopes in models.items() for name, slope in slopes.items()])))
