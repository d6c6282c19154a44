"""Ranked lexical search: the best documents of every item by an integer score.

A document is a vector of impacts, one per term; an item is a vector of term
weights; a score is their inner product.  Documents are ordered by the length of
their vectors and cut into buckets of like length.  An item visits the buckets
from long to short with the score of its last-ranked document so far.  A bucket
whose longest vector cannot reach that score (Cauchy-Schwarz) is passed over.
Inside a bucket the item's heaviest coordinates come first, as few as leave the
others unable to reach the score alone: documents without any of them drop out,
and the rest are bounded by what these coordinates give plus Cauchy-Schwarz over
what remains of both vectors.  Survivors are scored again over all their terms in
64-bit integers.  Bounds only ever drop documents that cannot rank, so results are
exact.

Terms are the runs of ASCII letters, digits and all characters beyond ASCII, only
A-Z lower-cased, known by a 64-bit hash; two of v terms share one with a
probability of v²/2^65, about 1 in 10,000 for 60 million.  Only terms that may occur in an item are carried
on, by a bit table of fixed size, in which other terms pass by chance and are
dropped later by equality.

Null texts and texts without a term count nowhere and are never ranked; items
without a term have no rows, nor does any item over an empty table.  Rows with one
``item_id`` are one item, whose terms add up, exact copies of a row counting once;
a null id is an item too.  Every row of the documents is ranked, repeated rows one
by one; equal scores go by ``doc_id``, null last.  Other columns are not read.

Vectors are shuffled once, by range of length and id, and written to the
checkpoint folder, so that a lost executor costs its own tasks; equal lengths are
split by the id and a random number.  Items go through in blocks of about ``PAIRS_AT_ONCE`` terms, each
handed to all tasks, and each block in waves from long to short vectors, whose
results (``top`` rows per task and item) meet in a grouping by item.  The driver
holds one block of items and the last-ranked score of each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.words import row_slices, words_of
from tallycast.session import ensure_checkpoint_dir

TOP = 10
PAIRS_AT_ONCE = 1 << 20
TABLE_BITS = 22
BUCKET = 1 << 12
# Shares of the documents, longest first, that the waves reach down to.
WAVES = (1 / 32, 1 / 4, 1.0)
IMPACT = 1_000_000_000
_CODES = np.arange(256)
_OUTSIDE = (_CODES < 0x30) | ((_CODES > 0x39) & (_CODES < 0x41)) | ((_CODES > 0x5A) & (_CODES < 0x61)) | (
    (_CODES > 0x7A) & (_CODES < 0x80))
_FOLDED = np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 0x20, _CODES).astype(np.uint8)


def _counted(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every different term of the texts, and the terms per row."""
    words = words_of(column, _OUTSIDE, _FOLDED)
    size = np.diff(words.first)
    row = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((words.hashes, row))
    row, hashes = row[order], words.hashes[order]
    opens = np.ones(len(row), bool)
    opens[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(opens)
    return row[at], hashes[at].view(np.int64), np.diff(np.append(at, len(row))), size


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def term_counts(rows: DataFrame, key: str, table: np.ndarray | None = None) -> DataFrame:
    """``key``, ``n`` (terms with repeats), ``terms`` and ``counts`` of every row that has
    a term; of the terms only those whose bit is set in ``table``, if one is given."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                row, terms, counts, size = _counted(part.column("text"))
                if table is not None:
                    known = _in_table(table, terms)
                    row, terms, counts = row[known], terms[known], counts[known]
                per_row = np.bincount(row, minlength=len(size))
                out = pa.RecordBatch.from_arrays(
                    [part.column(key), pa.array(size.astype(np.int64)), _lists(terms, per_row, pa.int64()),
                     _lists(counts, per_row, pa.int64())], names=[key, "n", "terms", "counts"])
                yield out.filter(pa.array(size > 0))

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "text").mapInArrow(
        counted, f"`{key}` {kind}, n long, terms array<long>, counts array<long>")


def _places(terms: np.ndarray) -> np.ndarray:
    return (terms.view(np.uint64) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _in_table(table: np.ndarray, terms: np.ndarray) -> np.ndarray:
    place = _places(terms)
    return (table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def term_table(terms: DataFrame) -> np.ndarray:
    """Bits of the terms of all items (column ``term``); the driver gets at most
    2^TABLE_BITS / 64 numbers."""
    place = f"shiftrightunsigned(term, {64 - TABLE_BITS})"
    cells = terms.selectExpr(f"{place} div 64 AS cell", f"shiftleft(1L, cast({place} % 64 AS int)) AS bit")
    table = np.zeros((1 << TABLE_BITS) // 64, dtype=np.int64)
    for row in cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect():
        table[row["cell"]] = row["bits"]
    return table.view(np.uint8)


def impact_vectors(counted: DataFrame, documents: int, words: int) -> DataFrame:
    """``doc_id``, ``length``, ``terms`` and ``impacts`` of documents with a term of an item."""
    share = F.lit(25) + F.expr(f"(75 * n * {documents}L) div {words}L")
    rows = counted.where(F.size("terms") > 0).withColumn("m", share)
    impacts = F.expr(f"transform(counts, tf -> ({IMPACT}L * tf) div (1000L * tf + 8L * m))")
    rows = rows.select("doc_id", "terms", impacts.alias("impacts"))
    length = F.sqrt(F.aggregate("impacts", F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double")))
    return rows.select("doc_id", length.alias("length"), "terms", "impacts")


@dataclass
class Items:
    """A block of items: item k has ``terms[first[k]:first[k + 1]]``, places in the sorted
    ``vocabulary``, and their weights, heaviest first; ``rest`` is the length of what
    the item has from each place on."""

    names: list
    vocabulary: np.ndarray
    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, names: list, number: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> Items:
        order = np.lexsort((terms, -weights, number))
        number, terms, weights = number[order], terms[order], weights[order]
        vocabulary, place = np.unique(terms, return_inverse=True)
        first = np.searchsorted(number, np.arange(len(names) + 1))
        rest = np.zeros(len(terms) + 1)
        for a, b in zip(first[:-1], first[1:]):
            rest[a:b] = np.sqrt(np.cumsum(weights[a:b][::-1].astype(float) ** 2)[::-1])
        return cls(names, vocabulary, first, place, weights, rest)


@dataclass
class Best:
    """The best documents of one item so far, best first, and the score to reach."""

    floor: int = 0
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    docs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def add(self, scores: np.ndarray, docs: np.ndarray, null: np.ndarray, top: int) -> None:
        scores, docs, null = (np.concatenate(pair) for pair in (
            (self.scores, scores), (self.docs, docs), (self.null, null)))
        order = np.lexsort((docs, null, -scores))[:top]
        self.scores, self.docs, self.null = scores[order], docs[order], null[order]
        if len(order) == top:
            self.floor = max(self.floor, int(self.scores[-1]))


class Bucket:
    """Vectors of like length, over the vocabulary of a block of items."""

    def __init__(self, batch: pa.RecordBatch, vocabulary: np.ndarray) -> None:
        ids = batch.column("doc_id")
        self.null = np.asarray(ids.is_null())
        self.docs = ids.fill_null(0).to_numpy(zero_copy_only=False)
        lists = batch.column("terms")
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        terms = lists.flatten().to_numpy(zero_copy_only=False)
        impact = batch.column("impacts").flatten().to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
        known = vocabulary[place] == terms
        self.row = np.repeat(np.arange(batch.num_rows), size)[known]
        self.term, self.impact = place[known], impact[known]
        self.start = np.searchsorted(self.row, np.arange(batch.num_rows + 1))
        self.mass = np.bincount(self.row, self.impact.astype(float) ** 2, minlength=batch.num_rows)
        self.longest = float(np.sqrt(self.mass.max())) if batch.num_rows else 0.0
        order = np.argsort(self.term, kind="stable")
        self.by_term, self.of_term = self.row[order], self.impact[order].astype(float)
        self.term_start = np.searchsorted(self.term[order], np.arange(len(vocabulary) + 1))

    def visit(self, terms: np.ndarray, weights: np.ndarray, rest: np.ndarray, dense: np.ndarray, best: Best, top: int) -> None:
        """Adds what can rank to ``best``; ``dense`` has the item's weight of each term."""
        reach = best.floor * (1 - 1e-9)
        # What the first coordinates leave to the others, at the longest vector.
        focus = int(np.argmax(np.append(rest, 0.0) * self.longest < reach)) if reach > 0 else len(terms)
        if reach > 0 and focus == 0:
            return
        got, spent = np.zeros(len(self.mass)), np.zeros(len(self.mass))
        for term, weight in zip(terms[:focus].tolist(), weights[:focus].tolist()):
            a, b = self.term_start[term], self.term_start[term + 1]
            rows, values = self.by_term[a:b], self.of_term[a:b]
            got[rows] += weight * values
            spent[rows] += values * values
        left = rest[focus] if focus < len(terms) else 0.0
        seen = np.flatnonzero(got)
        if len(seen) >= top:
            # Scores so far only grow, so the top of them bounds the last rank as well.
            reach = max(reach, float(np.partition(got[seen], len(seen) - top)[len(seen) - top]) * (1 - 1e-9))
        bound = got[seen] + left * np.sqrt(np.maximum(self.mass[seen] - spent[seen], 0.0)) * (1 + 1e-9)
        alive = seen[bound >= reach]
        if not len(alive):
            return
        size = self.start[alive + 1] - self.start[alive]
        at = np.repeat(self.start[alive] - np.cumsum(size) + size, size) + np.arange(size.sum())
        scores = np.add.reduceat(dense[self.term[at]] * self.impact[at], np.cumsum(size) - size)
        good = scores > 0
        best.add(scores[good], self.docs[alive][good], self.null[alive][good], top)


def search_blocks(vectors: DataFrame, items: Items, floors: np.ndarray, top: int) -> DataFrame:
    """The best documents of each item among the vectors of each task: ``item`` (place
    in the block), ``doc_id``, ``score``.  Vectors come longest first."""
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(int(floor)) for floor in floors]
        dense = np.zeros(len(items.vocabulary), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                bucket = Bucket(batch.slice(at, BUCKET), items.vocabulary)
                for k, best in enumerate(found):
                    span = slice(items.first[k], items.first[k + 1])
                    terms, weights = items.terms[span], items.weights[span]
                    dense[terms] = weights
                    bucket.visit(terms, weights, items.rest[span], dense, best, top)
                    dense[terms] = 0
        counts = [len(best.scores) for best in found]
        docs = np.concatenate([best.docs for best in found])
        null = np.concatenate([best.null for best in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(found)), counts), pa.int32()), pa.array(docs, pa.int64(), mask=null),
             pa.array(np.concatenate([best.scores for best in found]), pa.int64())], names=["item", "doc_id", "score"])

    return vectors.select("doc_id", "terms", "impacts").mapInArrow(searched, "item int, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``top`` best documents of each
    item.  ``docs`` has ``doc_id`` (integer) and ``text``, ``items`` has ``item_id`` and ``text``."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/search-{uuid.uuid4().hex}"

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    pairs = stored(term_counts(items.select("item_id", "text").distinct(), "item_id").select(
        "item_id", F.explode(F.arrays_zip("terms", "counts")).alias("pair")).groupBy(
            "item_id", F.col("pair.terms").alias("term")).agg(F.sum("pair.counts").alias("count")), "items")
    counted = stored(term_counts(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", term_table(pairs)), "counts")
    documents, words = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if documents:
        frequencies = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.log((2.0 * documents + 2.0) / (2.0 * F.col("df") + 1.0)))
        weighted = stored(pairs.join(frequencies, "term").select(
            "item_id", "term", (F.col("count") * weight).alias("weight")).where("weight > 0"), "weights")
        # Equal lengths, as of many copies, are parted by the id and a draw.
        vectors = stored(impact_vectors(counted, documents, words).withColumn("turn", F.rand(0)).repartitionByRange(
            F.desc("length"), "doc_id", "turn").sortWithinPartitions(F.desc("length"), "doc_id", "turn").drop("turn"),
            "vectors")
        total = weighted.count()
    found = None
    if documents and total:
        edges = [0.0, *vectors.approxQuantile("length", [1 - share for share in WAVES[:-1]], 0.01)[::-1]]
        waves = sorted(set(edges), reverse=True)
        blocks = -(-total // PAIRS_AT_ONCE)
        for block in range(blocks):
            part = weighted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
            found = _block(spark, vectors, part, waves, top, found, stored, block)
    if found is None:
        found = spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, "
                                          "rank int, doc_id long, score long")
    return found


def _block(spark, vectors, part, waves, top, before, stored, number):
    """One block of items through all waves, after the results of the blocks before it."""
    table = part.toArrow()
    names = table.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
    values = names.dictionary.to_pylist()
    items = Items.of(values, names.indices.to_numpy(zero_copy_only=False), table.column("term").to_numpy(),
                     table.column("weight").to_numpy())
    floors, best = np.zeros(len(values), np.int64), None
    for turn, low in enumerate(waves):
        wave = vectors.where(F.col("length") >= low)
        if turn:
            wave = wave.where(F.col("length") < waves[turn - 1])
        found = search_blocks(wave, items, floors, top)
        best = stored(_ranked(found if best is None else best.drop("rank").unionByName(found), top), f"best-{number}-{turn}")
        for row in best.where(F.col("rank") == top).select("item", "score").collect():
            floors[row["item"]] = row["score"]
    keys = spark.createDataFrame(list(enumerate(values)), f"item int, item_id {part.schema['item_id'].dataType.simpleString()}")
    out = best.join(keys, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")
    return out if before is None else before.unionByName(out)
