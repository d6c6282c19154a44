"""Near-duplicate vectors by cross-polytope hashing.

Vectors are compared within a label (and a length).  Vectors that are null,
empty, zero or hold null or non-finite components, and vectors without a label
or an id, link with nothing.  Equal vectors of a label are one class; only
classes are paired, and their members are counted.  Rows with one id are one vector;
where they differ, the row with the smallest hash of label and vector counts, in
whatever order they come.  An empty table gives no rows.

A hash rotates the unit vector by three rounds of random signs and the fast
Hadamard transform and takes the vertex of the cross-polytope it is nearest
to.  A table joins ``PARTS`` hashes; a vector is stored in one bucket of each
of ``TABLES`` tables and looks into ``PARTS + 1``: its own and those where one
part is replaced by the second-nearest vertex.  Every pair that meets is
verified by its cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.components import components
from tallycast.llm.storage import cut_shuffled
from tallycast.llm.words import mixed

COSINE = 0.98
TABLES, PARTS = 8, 2
ROUNDS = 3
SEED = 9


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row; the width is a power of two."""
    width, step = rows.shape[1], 1
    while step < width:
        parts = rows.reshape(len(rows), width // (2 * step), 2, step)
        rows = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], axis=2)
        rows = rows.reshape(len(parts), width)
        step *= 2
    return rows


def vertices(units: np.ndarray, table: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the nearest and second-nearest vertex of each row after one rotation."""
    width = 1 << max(1, int(np.ceil(np.log2(max(2, units.shape[1])))))
    signs = np.random.default_rng([SEED, table, part, width]).choice([-1.0, 1.0], size=(ROUNDS, width))
    rows = np.zeros((len(units), width))
    rows[:, :units.shape[1]] = units
    for turn in range(ROUNDS):
        rows = hadamard(rows * signs[turn])
    order = np.argsort(-np.abs(rows), axis=1, kind="stable")[:, :2]
    picked = np.take_along_axis(rows, order, axis=1)
    return tuple((2 * order + (picked < 0))[:, n].astype(np.uint64) for n in (0, 1))


def bucket_keys(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys that each row is stored under (a column per table) and looks into."""
    stored, looked = [], []
    for table in range(TABLES):
        near = [vertices(units, table, part) for part in range(PARTS)]
        probes = [[0] * PARTS] + [[int(n == part) for n in range(PARTS)] for part in range(PARTS)]
        for turn, probe in enumerate(probes):
            key = np.full(len(units), mixed(np.array([table], np.uint64))[0])
            for part, choice in enumerate(probe):
                key = mixed(key + near[part][choice] + np.uint64(1))
            looked.append(key)
            if turn == 0:
                stored.append(key)
    return np.stack(stored, axis=1).view(np.int64), np.stack(looked, axis=1).view(np.int64)


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Usable vectors of a list column by length: row numbers and a matrix of doubles."""
    flat, offsets = column.flatten(), np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), dtype=np.float64)
    first = np.concatenate([[0], np.cumsum(offsets)])
    for width in np.unique(offsets[offsets > 0]):
        rows = np.flatnonzero(offsets == width)
        matrix = values[first[rows][:, None] + np.arange(width)]
        # Scaled by the largest component, so that no square overflows.
        most = np.abs(matrix).max(axis=1)
        good = np.isfinite(most) & (most > 0)
        yield rows[good], matrix[good]


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def hashed(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label``, ``width``, two hashes of the vector, ``stored`` and
    ``looked``, for the usable vectors."""
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for rows, matrix in _matrices(batch.column("embedding")):
                if not len(rows):
                    continue
                same = np.array([np.frombuffer(hashlib.blake2b((row + 0.0).tobytes(), digest_size=16).digest(), np.int64)
                                 for row in matrix])
                keys = [pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * one.shape[1], pa.int32()),
                                                 pa.array(one.ravel())) for one in bucket_keys(unit_rows(matrix))]
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(at), batch.column("label").take(at),
                     pa.array(np.full(len(rows), matrix.shape[1])), pa.array(same[:, 0]), pa.array(same[:, 1]), *keys],
                    names=["vec_id", "label", "width", "one", "two", "stored", "looked"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(
        rows_of, f"vec_id long, label {label}, width long, one long, two long, stored array<long>, looked array<long>")


def verified(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """Pairs ``a``, ``b`` with ``cosine``, of those that reach it."""
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [np.asarray(batch.column(name).flatten().cast(pa.float64())) for name in ("va", "vb")]
            widths = np.asarray(batch.column("va").value_lengths(), dtype=np.int64)
            first = np.concatenate([[0], np.cumsum(widths)])
            found = np.empty(batch.num_rows)
            for width in np.unique(widths):
                rows = np.flatnonzero(widths == width)
                place = first[rows][:, None] + np.arange(width)
                found[rows] = np.einsum("ij,ij->i", unit_rows(ends[0][place]), unit_rows(ends[1][place]))
            good = pa.array(np.flatnonzero(found >= least))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(good), batch.column("b").take(good), pa.array(found).take(good)],
                names=["a", "b", "cosine"])

    side = lambda name: vectors.select(F.col("vec_id").alias(name), F.col("embedding").alias(f"v{name}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "va", "vb")
    return joined.mapInArrow(checked, "a long, b long, cosine double")


def one_per_id(vectors: DataFrame) -> DataFrame:
    """``vectors`` without the rows whose id has another row that counts.  Only ids with
    different rows are looked up; equal rows all stay."""
    pick = F.xxhash64("label", "embedding")
    picks = vectors.select("vec_id", pick.alias("pick")).groupBy("vec_id").agg(
        F.min("pick").alias("least"), F.max("pick").alias("most"))
    unequal = cut_shuffled(picks.where("least < most").select("vec_id", "least"))
    kept = vectors.join(unequal, "vec_id", "left").where(F.col("least").isNull() | (pick == F.col("least")))
    return kept.drop("least")


def vector_classes(
    table: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    least: float = COSINE,
) -> tuple[DataFrame, DataFrame]:
    """One row per vector (``vec_id``, ``n_links``, ``component_id``, ``kept``), and the
    verified links ``a < b`` between vectors that stand for their equals."""
    vectors = table.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    usable = one_per_id(vectors.where("vec_id is not null and label is not null and embedding is not null"))
    rows = cut_shuffled(hashed(usable).dropDuplicates(["vec_id"]))
    same = ["label", "width", "one", "two"]
    classes = cut_shuffled(rows.groupBy(*same).agg(F.min("vec_id").alias("standing"), F.count("*").alias("copies")))
    members = cut_shuffled(rows.select("vec_id", *same).join(classes, same).select("vec_id", "standing", "copies"))
    own = rows.join(members.where("vec_id = standing").select("vec_id"), "vec_id")
    own = cut_shuffled(own.select("vec_id", "label", "width", "stored", "looked"))
    place = ["label", "width", "key"]
    stored = own.select(F.col("vec_id").alias("a"), "label", "width", F.explode("stored").alias("key"))
    looked = own.select(F.col("vec_id").alias("b"), "label", "width", F.explode("looked").alias("key"))
    # A bucket with one vector meets nobody unless another looks into it.
    pairs = stored.join(looked, place).where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    standing = usable.join(own.select("vec_id"), "vec_id", "left_semi").dropDuplicates(["vec_id"])
    links = cut_shuffled(verified(pairs, standing.select("vec_id", "embedding"), least))
    weight = members.select("standing", "copies").distinct()
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(weight, F.col("b") == F.col("standing")).groupBy("a").agg(F.sum("copies").alias("others"))
    found = components(links.select("a", "b")).select(F.col("node").alias("standing"), F.col("component"))
    facts = cut_shuffled(found.join(degree.withColumnRenamed("a", "standing"), "standing"))
    linked = members.join(facts, "standing", "left").select(
        "vec_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "standing").alias("component_id"))
    # Rows that cannot link are added as they are.
    result = vectors.select("vec_id").join(linked.distinct(), "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), links
