"""Near-duplicate texts by improved consistent weighted sampling.

A text is its five-word shingles, weighted by count times inverse document
frequency; shorter texts have one shingle of all their words.  Frequencies are
counted over all documents in ``IDF_BUCKETS`` hashed buckets, a table of fixed
size whose values depend on shares, not on the number of documents; the weight
of rarity runs from 1 to 2.  Similarity is the weighted Jaccard similarity over
the shingles themselves.

1. Document frequencies: each task counts its buckets, Spark adds them up.
2. Samples: improved consistent weighted sampling draws ``BANDS * ROWS``
   samples per text (two texts agree in one with a probability of their
   similarity); each band of ``ROWS`` samples becomes a key.  Texts of the same
   words are copies and one of them, of the smallest id, stands for all.
3. Leaders: in each group of texts with one key, every text is paired with a few
   leaders, the one that meets most texts in all its groups and some chosen by the
   hash of their id; in groups of up to that many texts, these are all pairs.
   Each pair is verified by its exact weighted similarity.
4. The rest: texts of a larger group that the links so far do not join to the
   group's largest class are compared with all texts of the group, in blocks of
   ``BLOCK`` by ``BLOCK`` texts, and each keeps its most similar partner of every
   other class in a block.  So all texts of one key that are similar end up in one
   class, while a large group of near copies of one text takes few pairs for each.
5. Classes are the connected components of the verified links.

Null, empty and blank texts have no shingles and are classes of their own.
Rows with one document id are one document; rows without an id are not
compared.  Ties are decided by the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.components import components
from tallycast.llm.storage import cut_shuffled, packed, unpacked
from tallycast.llm.words import mixed, row_slices, runs_of, words_of
from tallycast.session import cut_lineage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3
LEADERS = 4
BLOCK = 256
IDF_BUCKETS = 1 << 16
# Random numbers of the sampling are drawn from tables of this many values.
TABLE = 1 << 12
SEED = 6


def shingles_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: hashes, counts, and where each row begins."""
    words = words_of(column)
    hashes, _, rows = runs_of(words, SHINGLE_WORDS)
    first = np.searchsorted(rows, np.arange(len(column) + 1))
    values, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in zip(first[:-1], first[1:]):
        value, count = np.unique(hashes[a:b], return_counts=True)
        values.append(value)
        counts.append(count)
    return np.concatenate(values), np.concatenate(counts), np.cumsum([len(one) for one in values])


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(IDF_BUCKETS - 1)).astype(np.int64)


def rarity(spark: SparkSession, docs: DataFrame, text: str = "text") -> np.ndarray:
    """The weight of rarity of each bucket, from the frequencies over all documents."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(IDF_BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for part in row_slices(batch, text):
                values, _, first = shingles_of(part.column(text))
                row = np.repeat(np.arange(part.num_rows), np.diff(first))
                once = np.unique(row * IDF_BUCKETS + bucket_of(values))
                found += np.bincount(once % IDF_BUCKETS, minlength=IDF_BUCKETS)
                rows += int((np.diff(first) > 0).sum())
        kept = np.flatnonzero(found)
        # The number of documents travels as a bucket of its own.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(kept, -1)), pa.array(np.append(found[kept], rows))], names=["bucket", "n"])

    sums = docs.select(text).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequency = np.zeros(IDF_BUCKETS + 1)
    for bucket, n in sums.collect():
        frequency[bucket] = n
    total = max(frequency[-1], 1.0)
    return 1 + np.clip(np.log(total / np.maximum(frequency[:-1], 1)) / np.log(IDF_BUCKETS), 0, 1)


def sampling_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of Gamma(2, 1), of the logarithm of Gamma(2, 1) and of Uniform(0, 1)."""
    draw = np.random.default_rng(SEED)
    return (draw.gamma(2.0, 1.0, TABLE).astype(np.float32),
            np.log(draw.gamma(2.0, 1.0, TABLE)).astype(np.float32), draw.random(TABLE).astype(np.float32))


def samples_of(hashes: np.ndarray, weights: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """Samples of rows that have shingles: one row of ``count`` 64-bit values each."""
    gamma, log_gamma, uniform = sampling_tables()
    log_weight = np.log(weights).astype(np.float32)
    out = np.empty((len(first) - 1, count), dtype=np.uint64)
    places = np.arange(len(hashes), dtype=np.uint64)
    size, bits = np.uint64(TABLE - 1), TABLE.bit_length() - 1
    for k in range(count):
        drawn = mixed(hashes ^ mixed(np.uint64(SEED * 1000 + k)))
        r = gamma[drawn & size]
        log_c = log_gamma[drawn >> np.uint64(bits) & size]
        beta = uniform[drawn >> np.uint64(2 * bits) & size]
        t = np.floor(log_weight / r + beta)
        # ln a = ln c - r (t - beta) - r; floats of one sign order like their bits.
        key = np.exp(log_c - r * (t - beta + 1)).astype(np.float32)
        ordered = key.view(np.uint32).astype(np.uint64) << np.uint64(32) | places
        at = (np.minimum.reduceat(ordered, first[:-1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out[:, k] = mixed(hashes[at] + mixed(t[at].astype(np.int64).astype(np.uint64)))
    return out


def signatures(docs: DataFrame, weights: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, two hashes of the words in order, ``bands``; only of texts with a word."""
    step = np.random.default_rng(SEED + 1).integers(1, 1 << 62, size=ROWS, dtype=np.uint64) | np.uint64(1)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for part in row_slices(batch, "text"):
                values, counts, first = shingles_of(part.column("text"))
                some = np.flatnonzero(np.diff(first) > 0)
                if not len(some):
                    continue
                words = words_of(part.column("text"))
                digests = np.array([np.frombuffer(hashlib.blake2b(
                    words.hashes[words.first[row]:words.first[row + 1]].tobytes(), digest_size=16).digest(), np.int64)
                    for row in some])
                weight = counts * weights[bucket_of(values)]
                drawn = samples_of(values, weight, np.append(first[some], len(values)), BANDS * ROWS)
                rows = drawn.reshape(len(some), BANDS, ROWS)
                keys = mixed((rows * step).sum(axis=2, dtype=np.uint64) + mixed(np.arange(BANDS, dtype=np.uint64)))
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(some) + 1) * BANDS, pa.int32()), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(some)), pa.array(digests[:, 0]), pa.array(digests[:, 1]), bands],
                    names=["doc_id", "one", "two", "bands"])

    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(signed, "doc_id long, one long, two long, bands array<long>")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets of shingles with counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float((np.minimum(a[1][i], b[1][j]) * weights[bucket_of(a[0][i])]).sum())
    every = sum(float((counts * weights[bucket_of(values)]).sum()) for values, counts in (a, b)) - both
    return both / every if every else 0.0


def verified(pairs: DataFrame, texts: DataFrame, weights: np.ndarray, least: float) -> DataFrame:
    """Pairs ``a``, ``b`` with ``similarity``, of those that reach it."""
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text_a"):
                sets = [shingles_of(part.column(name)) for name in ("text_a", "text_b")]
                rows = lambda s, n: (s[0][s[2][n]:s[2][n + 1]], s[1][s[2][n]:s[2][n + 1]])
                found = np.array([similarity(rows(sets[0], n), rows(sets[1], n), weights)
                                  for n in range(part.num_rows)])
                good = pa.array(np.flatnonzero(found >= least))
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").take(good), part.column("b").take(good), pa.array(found).take(good)],
                    names=["a", "b", "similarity"])

    side = lambda name: texts.select(F.col("doc_id").alias(name), F.col("text").alias(f"text_{name}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(checked, "a long, b long, similarity double")


def _paired_with_leaders(members: DataFrame, width: int) -> DataFrame:
    """Pairs of every text of a group (``key``, ``doc_id``, ``n`` texts) with its leaders."""
    turn = F.xxhash64("doc_id", F.lit(SEED))
    low = F.pmod(turn, F.lit(1 << 20))
    met = members.groupBy("doc_id").agg(F.sum("n").alias("met"))
    rows = cut_shuffled(members.join(met, "doc_id").withColumn("standing", F.col("met") * (1 << 20) + low))
    groups = cut_shuffled(rows.groupBy("key").agg(F.max_by("doc_id", "standing").alias("always")))
    joined = rows.join(groups, "key")
    chosen = (F.col("doc_id") == F.col("always")) | (low * F.col("n") < (width << 20)) | (F.col("n") <= width)
    leaders = joined.where(chosen).select("key", F.col("doc_id").alias("leader"))
    return rows.select("key", "doc_id").join(leaders, "key").where("doc_id <> leader").select(
        F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct()


def _left_over(members: DataFrame, links: DataFrame, width: int) -> DataFrame:
    """Texts of groups that hold several classes: ``key``, ``doc_id``, ``n``, ``component``, whether
    a text is ``open`` (outside the largest class of its group) and how many are."""
    large = members.where(F.col("n") > width)
    found = components(links.select("a", "b")).withColumnRenamed("node", "doc_id")
    placed = cut_shuffled(large.join(found, "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")))
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = cut_shuffled(sizes.groupBy("key").agg(
        F.max("size").alias("size"), F.sum("size").alias("all"),
        F.max_by("component", F.col("size").cast("decimal(38,0)") * (1 << 62) - F.col("component")).alias("main")))
    mixed_groups = largest.where("size < all").select("key", "main", (F.col("all") - F.col("size")).alias("n_open"))
    return cut_shuffled(placed.join(mixed_groups, "key").select(
        "key", "doc_id", "n", "n_open", "component", (F.col("component") != F.col("main")).alias("open")))


def _compared_in_blocks(rows: DataFrame, texts: DataFrame, weights: np.ndarray, least: float) -> DataFrame:
    """Links of open texts with their most similar partner of every other class in every
    block of their groups.  Texts that are not open are of one class, so one pass joins
    all classes of a group that have similar texts."""
    def blocks(count: str):
        return F.ceil(F.col(count) / BLOCK).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), blocks(count) - 1))

    own = lambda count: F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), blocks(count))
    rows = rows.join(texts, "doc_id")
    asked = rows.where("open").withColumn("row", own("n_open").cast("int")).withColumn("column", every("n"))
    given = rows.withColumn("column", own("n").cast("int")).withColumn("row", every("n_open"))
    fields = ["key", "row", "column", "doc_id", "component", "text"]
    cells = asked.select(*fields, F.lit(True).alias("asks")).unionByName(given.select(*fields, F.lit(False).alias("asks")))

    def compared(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        values, counts, first = shingles_of(cell.column("text").combine_chunks())
        ids, asks = cell.column("doc_id").to_numpy(), cell.column("asks").to_numpy()
        component = cell.column("component").to_numpy()
        distinct, place = np.unique(values, return_inverse=True)
        doc = np.repeat(np.arange(len(ids)), np.diff(first))
        weight = weights[bucket_of(values)]
        total = np.bincount(doc, weights=counts * weight, minlength=len(ids))
        held, out = np.zeros(len(distinct)), []
        for n in np.flatnonzero(asks):
            span = slice(first[n], first[n + 1])
            held[place[span]] = counts[span]
            both = np.bincount(doc, weights=np.minimum(held[place], counts) * weight, minlength=len(ids))
            held[place[span]] = 0
            alike = np.where(asks | (component == component[n]), 0.0, both / np.maximum(total + total[n] - both, 1e-300))
            good = np.flatnonzero(alike >= least)
            good = good[np.lexsort((ids[good], -alike[good], component[good]))]
            for m in good[np.append(True, np.diff(component[good]) != 0)[:len(good)]]:
                out.append((min(ids[n], ids[m]), max(ids[n], ids[m]), alike[m]))
        columns = list(zip(*out)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=["a", "b", "similarity"])

    return cells.groupBy("key", "row", "column").applyInArrow(compared, "a long, b long, similarity double")


def near_links(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY,
) -> tuple[DataFrame, DataFrame]:
    """Verified links ``a < b`` with ``similarity`` that join the texts of each class,
    between texts that stand for their copies, and ``doc_id`` with ``standing`` for
    every text with a word."""
    weights = rarity(docs.sparkSession, docs, text)
    signed = cut_lineage(signatures(docs, weights, doc_id, text))
    standing = cut_shuffled(signed.groupBy("one", "two").agg(F.min("doc_id").alias("standing")))
    # Joined as plain tables, so that a text with very many copies can be split.
    copies = cut_shuffled(signed.join(standing, ["one", "two"]).select("doc_id", "standing", "bands"))
    keys = copies.where("doc_id = standing").dropDuplicates(["doc_id"]).select(
        "doc_id", F.explode("bands").alias("key"))
    shared = cut_shuffled(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = cut_shuffled(keys.join(shared, "key"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = cut_lineage(rows.join(members.select("doc_id").distinct(), "doc_id").dropDuplicates(["doc_id"]))
    pairs = _paired_with_leaders(members, LEADERS)
    links = cut_shuffled(verified(pairs, texts, weights, least))
    rest = _left_over(members, links, LEADERS)
    if not rest.isEmpty():
        links = links.unionByName(cut_shuffled(_compared_in_blocks(rest, texts, weights, least)))
    return links, copies.select("doc_id", "standing").distinct()


def near_classes(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY,
) -> DataFrame:
    """One row per document id: ``doc_id``, ``standing`` (smallest id of the same words),
    ``class_id`` (smallest id of the class) and ``kept`` (whether it is the class's own)."""
    links, copies = near_links(docs, doc_id=doc_id, text=text, least=least)
    classes = components(links.select("a", "b")).select(F.col("node").alias("standing"), F.col("component"))
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    rows = ids.join(copies, "doc_id", "left").withColumn("standing", F.coalesce("standing", "doc_id"))
    return rows.join(classes, "standing", "left").select(
        "doc_id", "standing", F.coalesce("component", "standing").alias("class_id"),
    ).withColumn("kept", F.col("doc_id") == F.col("class_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay: the one of the smallest id of each class.  Rows that
    agree in id and text count once; rows without an id stay."""
    kept = near_classes(docs).where("kept").select(F.col("doc_id").alias("kept_id"))
    used = ("doc_id", "text")
    rows = packed(docs, *used).join(kept, F.col("doc_id") == F.col("kept_id"))
    rows = rows.dropDuplicates(["doc_id", "text"]).select(*unpacked(docs, *used))
    return rows.unionByName(docs.where("doc_id is null"))
