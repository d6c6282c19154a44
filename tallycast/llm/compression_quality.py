"""Text quality from compressed sizes.

Two zstandard dictionaries are built, one from good and one from bad labelled
texts.  A text is compressed piece by piece with each; the difference of the
two sizes divided by their sum says which it resembles.  A logistic curve over
that difference, and over the share of its size that the text compresses to,
gives the score, fitted on labelled texts that no dictionary was built from.

Fitting uses at most ``PER_LABEL`` labelled texts of each label; half build the
dictionaries, at most ``DICTIONARY_PIECES`` pieces of each label, half calibrate.
Every text is scored whole.  Null and empty texts compress to nothing: their
difference is 0 and their share 1, which gives them a score as well.  Without
labels of both kinds the score is the share of good labels, or 0.5 without any.
Rows are scored independently, and repeated rows alike; ids that are labelled
both good and bad count as bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.sampling import sample_per_label
from tallycast.llm.words import row_slices

PER_LABEL = 3000
DICTIONARY_PIECES = 4000
DICTIONARY_BYTES = 1 << 16
PIECE_BYTES = 1 << 12
LEVEL = 3
SEED = 3


@dataclass(frozen=True)
class QualityModel:
    """The dictionaries (none when there were too few labels) and the curve."""

    good: bytes | None
    bad: bytes | None
    curve: tuple[float, float, float]


def pieces_of(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[at:at + PIECE_BYTES] for at in range(0, len(raw), PIECE_BYTES)]


class Sizes:
    """Compressed sizes with either dictionary, without frame headers' constant parts."""

    def __init__(self, model: QualityModel) -> None:
        import zstandard

        def compressor(raw: bytes):
            plain = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False)
            words = zstandard.ZstdCompressionDict(raw)
            words.precompute_compress(compression_params=plain)
            return zstandard.ZstdCompressor(dict_data=words, compression_params=plain)

        self.both = [compressor(raw) for raw in (model.good, model.bad)]

    def features(self, text: str | None) -> tuple[float, float]:
        """The normalised difference (above 0: nearer to good) and the compressed share."""
        pieces = pieces_of(text)
        if not pieces:
            return 0.0, 1.0
        good, bad = (sum(len(one.compress(piece)) for piece in pieces) for one in self.both)
        return (bad - good) / (bad + good), (good + bad) / 2 / sum(map(len, pieces))


def _fitted_curve(features: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge."""
    rows = np.column_stack([features, np.ones(len(features))])
    beta = np.zeros(rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        gradient = rows.T @ (weight * (p - label)) + 1e-3 * beta
        hessian = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(one) for one in beta)


def _dictionary(pieces: list[bytes]) -> bytes | None:
    """A trained dictionary, or the pieces themselves where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:DICTIONARY_BYTES] or None


def fit(learned: DataFrame, labels: DataFrame, *, per_label: int = PER_LABEL) -> QualityModel:
    """Fits on texts (``doc_id``, ``text``) and labels (``doc_id``, ``label``, 0 or 1)."""
    one = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = sample_per_label(one, per_label, SEED)
    # At most per_label rows for each of two labels.
    rows = learned.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    counts = {row["label"]: row["n"] for row in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    constant = QualityModel(None, None, (0.0, 0.0, float(np.log(prior / (1 - prior)))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                names = [part.column(name).to_pylist() for name in ("doc_id", "label", "text")]
                found = [(doc, label, n, piece) for doc, label, text in zip(*names) for n, piece in enumerate(pieces_of(text))]
                columns = list(zip(*found)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in
                     zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                    names=["doc_id", "label", "n", "piece"])

    pieces = rows.where("rank % 2 = 0").select(
        F.col("doc_id").cast("long"), F.col("label").cast("int"), "text").mapInArrow(
        cut, "doc_id long, label int, n int, piece binary")
    raw = []
    for label in (1, 0):
        # A bounded choice by hash among all pieces, not the heads of texts.
        few = pieces.where(F.col("label") == label).orderBy(F.xxhash64("doc_id", "n"), "doc_id", "n").limit(DICTIONARY_PIECES)
        raw.append(_dictionary([bytes(row["piece"]) for row in few.select("piece").collect()]))
    if None in raw:
        return constant
    dictionaries = QualityModel(*raw, (0.0, 0.0, 0.0))
    sample = measured(rows.where("rank % 2 = 1").select("doc_id", F.col("label").cast("int").alias("label"), "text"),
                      dictionaries).select("doc_id", "label", "difference", "share").collect()
    found = np.array(sorted((row["doc_id"], row["label"], row["difference"], row["share"]) for row in sample))
    if not len(found) or len(set(found[:, 1])) < 2:
        return constant
    # Labels count as often as they occur, not as often as they were sampled.
    own = np.array([counts[label] / (found[:, 1] == label).sum() for label in found[:, 1]])
    return QualityModel(*raw, _fitted_curve(found[:, 2:], found[:, 1], own / own.mean()))


def measured(rows: DataFrame, model: QualityModel) -> DataFrame:
    """``rows`` without ``text``, with ``difference`` and ``share`` (in place of columns
    of these names)."""
    others = [name for name in rows.columns if name not in {"text", "difference", "share"}]
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in others]

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model)
        for batch in batches:
            for part in row_slices(batch, "text"):
                found = [sizes.features(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.select(others).columns, *[pa.array(column, pa.float64()) for column in zip(*found)]],
                    names=[*others, "difference", "share"])

    return rows.select(*[F.col(f"`{name}`") for name in others], "text").mapInArrow(
        sized, ", ".join([*fields, "difference double", "share double"]))


def score(rows: DataFrame, model: QualityModel) -> DataFrame:
    """``rows`` without ``text``, with ``difference``, ``share`` and ``score`` (0 to 1, higher is better)."""
    if model.good is None:
        found = rows.drop("text").withColumns({"difference": F.lit(0.0), "share": F.lit(1.0)})
    else:
        found = measured(rows, model)
    a, b, c = model.curve
    return found.withColumn("score", 1 / (1 + F.exp(-(F.lit(a) * F.col("difference") + F.lit(b) * F.col("share") + F.lit(c)))))
