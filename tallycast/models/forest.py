"""Boosted trees as arrays: prediction, and exact attribution of predictions to features.

A forest is small (its size depends on rounds and depth, not on rows), so it
travels with the tasks; rows are scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_AT_ONCE = 2048


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays, the root first; ``feature`` is -1 for a leaf.  Rows go left where
    the feature is at most the threshold.  ``cover`` is the training weight that
    reached a node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """Node of the leaf that each row ends in."""
        node = np.zeros(len(rows), np.int64)
        for _ in range(len(self.feature)):
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                break
            at = node[inner]
            low = rows[inner, self.feature[at]] <= self.threshold[at]
            node[inner] = np.where(low, self.left[at], self.right[at])
        return node

    def attribution(self, rows: np.ndarray) -> np.ndarray:
        """Contribution of each feature to each row's prediction, by the path of its leaves.

        A feature left out of a coalition follows both branches in proportion to
        their cover.  A leaf then is a game whose value is a product with one
        factor per feature of its path: 1 or 0 where the feature is in, by
        whether the row follows the path, and its share of cover where it is out.
        The shares of that game depend on the row only through which features
        follow, so they are tabled for every such pattern and looked up.
        """
        out = np.zeros(rows.shape)
        goes = {int(node): rows[:, self.feature[node]] <= self.threshold[node] for node in np.flatnonzero(self.feature >= 0)}
        for leaf, path in self._paths():
            names = sorted({int(self.feature[node]) for node, _ in path})
            place = {name: k for k, name in enumerate(names)}
            out_share = np.ones(len(names))
            follows = np.ones((len(names), len(rows)), bool)
            for node, left in path:
                child = self.left[node] if left else self.right[node]
                k = place[int(self.feature[node])]
                out_share[k] *= self.cover[child] / self.cover[node] if self.cover[node] else 0.0
                follows[k] &= goes[node] if left else ~goes[node]
            pattern = (1 << np.arange(len(names))) @ follows
            table = _game_shares(out_share) * self.value[leaf]
            out[:, names] += table[pattern]
        return out

    def _paths(self) -> Iterator[tuple[int, list[tuple[int, bool]]]]:
        waiting: list[tuple[int, list[tuple[int, bool]]]] = [(0, [])]
        while waiting:
            node, path = waiting.pop()
            if self.feature[node] < 0:
                if path:
                    yield node, path
            else:
                waiting.append((int(self.left[node]), [*path, (node, True)]))
                waiting.append((int(self.right[node]), [*path, (node, False)]))

    def mean(self) -> float:
        """Mean prediction over the training weight."""
        at = np.flatnonzero(self.feature < 0)
        return float(self.value[at] @ self.cover[at] / self.cover[at].sum()) if self.cover[at].sum() else 0.0


def _game_shares(out_share: np.ndarray) -> np.ndarray:
    """Shapley values of the product game for every pattern of followed features (bit k)."""
    size = len(out_share)
    follows = (np.arange(1 << size)[:, None] >> np.arange(size)) & 1
    shares = np.zeros((1 << size, size))
    for k in range(size):
        # Coefficient s: sum over coalitions of s other features of their product.
        sums = np.zeros((1 << size, size))
        sums[:, 0] = 1.0
        for other in range(size):
            if other != k:
                grown = sums * out_share[other]
                grown[:, 1:] += sums[:, :-1] * follows[:, other:other + 1]
                sums = grown
        weight = np.array([factorial(s) * factorial(size - 1 - s) for s in range(size)]) / factorial(size)
        shares[:, k] = (sums @ weight) * (follows[:, k] - out_share[k])
    return shares


@dataclass(frozen=True)
class Forest:
    """Sum of trees with weights on top of a constant."""

    origin: float
    trees: tuple[Tree, ...] = ()
    weights: tuple[float, ...] = field(default=())

    def first(self, count: int) -> Forest:
        """The forest after its first ``count`` rounds."""
        return Forest(self.origin, self.trees[:count], self.weights[:count])

    def predict(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.origin)
        for tree, weight in zip(self.trees, self.weights):
            out += weight * tree.value[tree.leaf_of(rows)]
        return out

    def attribution(self, rows: np.ndarray) -> np.ndarray:
        """Rows by features; a row's sum is its prediction less ``mean``."""
        out = np.zeros(rows.shape)
        for tree, weight in zip(self.trees, self.weights):
            out += weight * tree.attribution(rows)
        return out

    def mean(self) -> float:
        """Mean prediction over the training weight of each tree."""
        return self.origin + sum(weight * tree.mean() for tree, weight in zip(self.trees, self.weights))


@dataclass(frozen=True)
class NamedForest:
    """A forest with the names of its features, in their order."""

    features: tuple[str, ...]
    forest: Forest


def matrices(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch with their feature arrays as a matrix."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(at, ROWS_AT_ONCE)
        yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)


def with_prediction(
    forest: Forest, rows: DataFrame, keep: Sequence[str], *, features: str = "features", name: str = "prediction",
) -> DataFrame:
    """Kept columns and the prediction of each row (``features`` is a vector)."""
    given = rows.select(*keep, vector_to_array(features).alias("__x"))
    schema = T.StructType([*[rows.schema[one] for one in keep], T.StructField(name, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = _width(batch, "__x")
            for part, x in matrices(batch, "__x", width):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(forest.predict(x))], names=schema.names)

    return given.mapInArrow(scored, schema)


def _width(batch: pa.RecordBatch, column: str) -> int:
    return len(batch.column(column)[0]) if batch.num_rows else 0


def with_attribution(
    forest: Forest, rows: DataFrame, keep: Sequence[str], *, features: str = "features",
) -> DataFrame:
    """Kept columns, ``prediction``, and ``attribution``, one number per feature.

    They add up to the prediction less the forest's mean, row by row.
    """
    given = rows.select(*keep, vector_to_array(features).alias("__x"))
    schema = T.StructType([
        *[rows.schema[one] for one in keep], T.StructField("prediction", T.DoubleType()),
        T.StructField("attribution", T.ArrayType(T.DoubleType()))])

    def explained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = _width(batch, "__x")
            for part, x in matrices(batch, "__x", width):
                ends = pa.array(np.arange(0, x.size + 1, max(width, 1), dtype=np.int32))
                shares = pa.ListArray.from_arrays(ends, pa.array(forest.attribution(x).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(forest.predict(x)), shares], names=schema.names)

    return given.mapInArrow(explained, schema)


def tree_attribution(
    rows: DataFrame, models: dict[str, Forest], names: Sequence[str], *, features: str = "features",
) -> DataFrame:
    """Mean absolute attribution of each feature of each model (model, feature, importance).

    Each task sends one sum per model and feature.
    """
    given = rows.select(vector_to_array(features).alias("__x"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, count = {model: np.zeros(len(names)) for model in models}, 0
        for batch in batches:
            for part, x in matrices(batch, "__x", len(names)):
                count += part.num_rows
                for model, forest in models.items():
                    totals[model] += np.abs(forest.attribution(x)).sum(axis=0)
        yield pa.RecordBatch.from_pydict({
            "model": [model for model in models for _ in names], "feature": list(names) * len(models),
            "total": np.concatenate(list(totals.values())), "n": np.full(len(models) * len(names), count)})

    parts = given.mapInArrow(summed, "model string, feature string, total double, n long")
    return parts.groupBy("model", "feature").agg(
        (F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("importance"))
