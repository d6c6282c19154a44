"""Language identification with a string kernel.

The kernel of two texts counts the character n-grams (one to ``LONGEST``) that
both hold, each once, divided by the root of the product of their numbers.
N-grams are hashed into ``WIDTH`` places.  Nyström landmarks, a bounded sample
of the learned rows, approximate the kernel; one-versus-rest kernel ridge
regression is solved in their space.  Scores of a batch are one matrix product
of its presence rows with the landmarks folded into the coefficients, which is
the kernel to the landmarks times the coefficients, computed in the other order.

Texts are lower-cased and everything but letters counts as a space.  A null
text or one without a letter gets ``und`` and the score 0; so does every text
when there is nothing to learn from.  Rows are scored independently: repeated
rows and rows without an id are scored like others, ties go to the first label
in order, and nothing is shuffled but the bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.sampling import sample_per_label
from tallycast.llm.words import mixed, row_slices

LONGEST = 3
WIDTH = 1 << 13
PER_LABEL = 600
LANDMARKS_PER_LABEL = 100
RIDGE = 0.1
ROWS_AT_ONCE = 256
UNKNOWN = "und"
SEED = 7


@dataclass(frozen=True)
class LanguageModel:
    """``weights`` has one column per label, for normalised presence rows."""

    labels: tuple[str, ...]
    weights: np.ndarray


def letters(text: Column) -> Column:
    """A text in lower case with one space for whatever is no letter."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\P{L}+", " ")


def presence(texts: list[str]) -> np.ndarray:
    """A row per text, 1 at the place of every n-gram it holds."""
    out = np.zeros((len(texts), WIDTH), dtype=np.float32)
    flat = out.reshape(-1)
    joined = np.frombuffer("".join(f" {text} " for text in texts).encode("utf-32-le"), dtype=np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(text) + 2 for text in texts])
    codes = joined.astype(np.uint64)
    key = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        key = key[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:] + np.uint64(n)
        inside = row[:len(key)] == row[n - 1:]
        place = (mixed(key) % np.uint64(WIDTH)).astype(np.int64)
        flat[(row[:len(key)] * WIDTH + place)[inside]] = 1
    return out


def normalised(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


def fit_kernel_ridge(rows: np.ndarray, labels: list[str], landmark: np.ndarray) -> LanguageModel:
    """Ridge regression in the Nyström space of the rows marked as landmarks."""
    names = tuple(sorted(set(labels)))
    if not names:
        return LanguageModel((), np.zeros((WIDTH, 0), dtype=np.float32))
    unit = normalised(rows).astype(np.float64)
    marks = unit[landmark]
    values, vectors = np.linalg.eigh(marks @ marks.T)
    keep = values > 1e-8 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = unit @ marks.T @ root
    place = {name: n for n, name in enumerate(names)}
    own = np.array([place[label] for label in labels])
    target = np.where(own[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Each label weighs the same, however many of its rows were sampled.
    weight = 1.0 / np.bincount(own)[own]
    centre = np.average(target, axis=0, weights=weight)
    bias = np.hstack([mapped, np.ones((len(mapped), 1))])
    penalty = RIDGE * np.diag(np.append(np.ones(mapped.shape[1]), 0)) * weight.mean()
    solved = np.linalg.solve((bias * weight[:, None]).T @ bias + penalty + 1e-12 * np.eye(bias.shape[1]),
                             (bias * weight[:, None]).T @ (target - centre))
    folded = marks.T @ root @ solved[:-1]
    return LanguageModel(names, np.vstack([folded, solved[-1:] + centre]).astype(np.float32))


def fit(learned: DataFrame, *, per_label: int = PER_LABEL, landmarks: int = LANDMARKS_PER_LABEL) -> LanguageModel:
    """Fits on ``doc_id``, ``text`` and ``label``: at most ``per_label`` rows of each
    label, ``landmarks`` of them as landmarks.  The driver gets one bit per place
    of each of these rows."""
    chosen = sample_per_label(learned.select("doc_id", "label"), per_label, SEED)
    rows = learned.select("doc_id", letters(F.col("text")).alias("text")).join(
        F.broadcast(chosen), "doc_id").where("text rlike '[^ ]'")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                bits = np.packbits(presence(part.column("text").to_pylist()).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), part.column("rank"),
                     pa.array([bytes(one) for one in bits], type=pa.binary())],
                    names=["doc_id", "label", "rank", "bits"])

    sample = rows.mapInArrow(packed, "doc_id long, label string, rank int, bits binary")
    found = sorted(sample.collect(), key=lambda row: (row["label"], row["rank"], row["doc_id"], bytes(row["bits"])))
    if not found:
        return fit_kernel_ridge(np.zeros((0, WIDTH)), [], np.zeros(0, bool))
    matrix = np.unpackbits(np.array([np.frombuffer(row["bits"], np.uint8) for row in found]), axis=1)
    return fit_kernel_ridge(matrix.astype(np.float32), [row["label"] for row in found],
                            np.array([row["rank"] <= landmarks for row in found]))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in row_slices(batch, "text"):
        for at in range(0, part.num_rows, ROWS_AT_ONCE):
            yield part.slice(at, ROWS_AT_ONCE)


def classify(rows: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """``rows`` without the text, with ``lang_pred`` and ``score`` (in place of columns
    of these names)."""
    others = [name for name in rows.columns if name not in {text, "lang_pred", "score"}]
    prepared = rows.select(*[F.col(f"`{name}`") for name in others], letters(F.col(text)).alias("text"))
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in others]
    labels, weights = np.array([*model.labels, UNKNOWN], dtype=object), model.weights

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                texts = part.column("text").to_pylist()
                best, score = np.full(len(texts), len(labels) - 1), np.zeros(len(texts))
                known = np.array([not one.isspace() and one != "" for one in texts])
                if len(labels) > 1:
                    values = normalised(presence(texts)) @ weights[:-1] + weights[-1]
                    best = np.where(known, values.argmax(axis=1), best)
                    score = np.where(known, np.clip((values.max(axis=1) + 1) / 2, 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(list(labels[best]), pa.string()), pa.array(score.astype(np.float64))],
                    names=[*others, "lang_pred", "score"])

    return prepared.mapInArrow(scored, ", ".join([*fields, "lang_pred string", "score double"]))
