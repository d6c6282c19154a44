"""Mixing sources to target weights by drawing blocks of words.

1. Words of a source are packed into blocks of ``block_words``.  Documents are
   dealt by hash into buckets of about ``bucket_docs``, each packed by itself,
   so that no source is laid out in one task; the blocks of a source are then
   numbered through its buckets.  The last block of a bucket can be shorter.
2. Targets follow the weights and stop at ``most`` times the size of the
   source; the excess goes to the other sources by weight.  A target divided
   by the mean size of the source's blocks is its number of slots, at most
   ``most`` times its blocks.
3. The slots of each source are spread over the output shards by a multinomial
   draw, so a shard's counts per source are multinomial while the totals hold.
4. Slot i of a source is block P(i mod n) of its n blocks, P a pseudorandom
   permutation (a Feistel network that walks its cycles) for each source and
   epoch i div n.  So a block is drawn once in an epoch, and no document is
   taken more than ``most`` times.
5. Slots meet blocks by source and number; the words of a document in a block
   count as often as the block was drawn.

Everything follows from the seed and the rows; reruns agree.  A null source is
a source, the last one.  Null, empty and blank texts have size 0 and are never
taken.  Rows without an id and repeated rows are rows like others.  A table
without words gives targets of 0.

Texts never move: the plan works on sizes.  The table of sources (one row per
source) is ordered in one task, as its weights ask for; its sums come from a
grouping with map-side combining.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.native import count_words
from tallycast.llm.storage import cut_shuffled, packed, unpacked
from tallycast.llm.words import mixed

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)


@dataclass(frozen=True)
class Mix:
    """What is to be mixed: the share of all words that the mix has, and how often a
    document may be taken."""

    weights: tuple[int, ...] = WEIGHTS
    share: float = 1.5
    most: int = 2
    block_words: int = 64
    bucket_docs: int = 4096
    shards: int = 64
    run_slots: int = 4096
    seed: int = 20


def with_targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Adds ``no``, ``weight`` and ``target`` to one row per source (``source``, ``source_size``)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(weight)) for weight in mix.weights])
    rows = sources.withColumn("no", F.row_number().over(order)).withColumn(
        "weight", F.get(weights, (F.col("no") - 1) % len(mix.weights))).withColumn(
        "most", F.col("source_size") * F.lit(float(mix.most)))
    # Sources reach their limits in the order of limit to weight.  The level is what is
    # left divided by the weights left; it is highest at the first source below its limit.
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), "no")
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    every = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(every) * F.lit(mix.share)
    level = (wanted - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return rows.withColumn("target", F.least("most", F.col("weight") * F.col("level"))).drop("most", "level")


def permuted(place: np.ndarray, count: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The number that a permutation of 0 to count - 1, chosen by the key, gives each place."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(count, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    half = half.astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    # 2 ** (2 * half) numbers; those beyond the count walk on until they are inside.
    out, walking = place.astype(np.uint64), np.arange(len(place))
    while len(walking):
        h, m, k = half[walking], low[walking], key[walking]
        left, right = out[walking] >> h, out[walking] & m
        for turn in range(4):
            left, right = right, left ^ (mixed(right + mixed(k + np.uint64(turn))) & m)
        out[walking] = left << h | right
        walking = walking[out[walking] >= count[walking].astype(np.uint64)]
    return out.astype(np.int64)


def _spread(mix: Mix):
    """Multinomial counts of a source's slots over the shards, as runs of slots."""
    def runs(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            for no, slots, blocks in zip(table["no"], table["slots"], table["blocks"]):
                draw = np.random.default_rng([mix.seed, int(no)])
                counts = draw.multinomial(int(slots), np.full(mix.shards, 1 / mix.shards))
                yield pd.DataFrame({
                    "no": np.full(mix.shards, no), "shard": np.arange(mix.shards),
                    "first": np.cumsum(counts) - counts, "n": counts, "blocks": np.full(mix.shards, blocks)})
    return runs


def _numbers(mix: Mix):
    def numbers(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            slot, blocks, no = (table[name].to_numpy(dtype=np.int64) for name in ("slot", "blocks", "no"))
            epoch = slot // blocks
            key = mixed(mixed(np.uint64(mix.seed) + no.astype(np.uint64)) + epoch.astype(np.uint64))
            yield pd.DataFrame({
                "no": no, "shard": table["shard"], "slot": slot, "number": permuted(slot % blocks, blocks, key)})
    return numbers


def slots_of(sources: DataFrame, mix: Mix) -> DataFrame:
    """Every slot of the mix: ``no``, ``shard``, ``slot`` and the ``number`` of its block."""
    shares = sources.where("blocks > 0").select(
        "no", "blocks", F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long").alias("slots"))
    counted = shares.where("slots > 0").mapInPandas(_spread(mix), "no int, shard int, first long, n long, blocks long")
    starts = F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(mix.run_slots)))
    runs = counted.where("n > 0").select("no", "shard", "first", "n", "blocks", starts.alias("from"))
    # Few small rows become very many slots: without a number of partitions they would
    # be opened by one task.
    partitions = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(partitions, "no", "shard", "from")
    upto = F.least(F.col("n"), F.col("from") + mix.run_slots) - 1
    slots = runs.select("no", "shard", "blocks", F.explode(F.sequence("from", upto)).alias("at"), "first")
    slots = slots.select("no", "shard", "blocks", (F.col("first") + F.col("at")).alias("slot"))
    return slots.mapInPandas(_numbers(mix), "no int, shard int, slot long, number long")


def mixed_documents(
    docs: DataFrame, mix: Mix = Mix(), *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    once: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``source``, ``size``,
    ``source_size``, ``target``, ``taken``, and ``parts``, what was drawn of it in
    text order: (first word, words, draws).  With ``once``, rows that agree in id,
    source and text are packed and drawn as one."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("text_hash"),
        count_words(F.col(text)).alias("size"))
    if once:
        rows = rows.distinct()
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = cut_shuffled(with_targets(sums, mix))
    placed = rows.join(
        sources.withColumnRenamed("source", "_source").drop("weight"),
        F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    salt = F.xxhash64("doc_id", "text_hash", F.lit(mix.seed))
    placed = placed.withColumn(
        "bucket", F.pmod(salt, F.ceil(F.col("docs") / mix.bucket_docs).cast("long")))
    inside = Window.partitionBy("no", "bucket").orderBy(F.col("doc_id"), F.col("text_hash"))
    placed = placed.withColumns({
        "turn": F.row_number().over(inside),
        "start": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")})
    placed = cut_shuffled(placed.drop("docs"))
    buckets = placed.groupBy("no", "bucket").agg(
        F.ceil(F.sum("size") / mix.block_words).cast("long").alias("own"))
    before = Window.partitionBy("no").orderBy("bucket")
    buckets = buckets.select("no", "bucket", (F.sum("own").over(before) - F.col("own")).alias("base"), "own")
    buckets = cut_shuffled(buckets)
    blocks = buckets.groupBy("no").agg(F.sum("own").alias("blocks"))
    slots = slots_of(sources.join(blocks, "no"), mix)
    draws = slots.groupBy("no", "number").agg(F.count("*").alias("draws"))
    # A document is cut where blocks meet.
    numbers = F.when(F.col("size") > 0, F.sequence(
        F.expr(f"start div {mix.block_words}"), F.expr(f"(start + size - 1) div {mix.block_words}")))
    pieces = placed.join(buckets.drop("own"), ["no", "bucket"]).withColumn("block", F.explode_outer(numbers))
    opens = F.greatest(F.col("start"), F.col("block") * mix.block_words)
    closes = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * mix.block_words)
    pieces = pieces.withColumns({
        "number": F.col("base") + F.col("block"), "from": opens - F.col("start"), "words": closes - opens})
    # The draws grow with the mix, which no estimate before the slots are opened shows.
    drawn = pieces.join(draws.hint("merge"), ["no", "number"], "left")
    part = F.when(F.col("draws").isNotNull(), F.struct("from", "words", "draws"))
    names = ["doc_id", "text_hash", "source", "size", "source_size", "target"]
    return drawn.groupBy("no", "bucket", "turn", *names).agg(
        F.coalesce(F.sum(F.col("words") * F.col("draws")), F.lit(0)).cast("long").alias("taken"),
        F.array_sort(F.collect_list(part)).alias("parts")).select(*names, "taken", "parts")


def mixed_texts(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: a row for each epoch in which some of a document was
    drawn, its text the words drawn in that epoch with the spaces after them (the
    whole text if all were drawn), ``n_chars`` to match where it exists.

    Rows that agree in id, source and text are drawn as one, and each of them
    comes back with what was drawn.
    """
    used = [name for name in ("doc_id", "text", "source", "n_chars") if name in docs.columns]
    plan = mixed_documents(docs, mix, once=True).where("taken > 0").select(
        F.col("doc_id").alias("own_id"), F.col("text_hash"), F.col("source").alias("own_source"), "size", "parts")
    same = (F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.xxhash64("text") == F.col("text_hash"))
            & F.col("source").eqNullSafe(F.col("own_source")))
    rows = packed(docs, *used).join(plan, same)
    rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(mix.most))))
    rows = rows.withColumn("got", F.filter("parts", lambda part: part["draws"] >= F.col("turn")))
    rows = rows.where(F.size("got") > 0)
    whole = F.aggregate("got", F.lit(0).cast("long"), lambda total, part: total + part["words"]) == F.col("size")
    rows = rows.withColumn("whole", whole).withColumn("pieces", F.when(
        ~F.col("whole"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"))))
    taken = F.array_join(F.flatten(F.transform("got", lambda part: F.slice(
        "pieces", (part["from"] + 1).cast("int"), part["words"].cast("int")))), "")
    rows = rows.withColumn("text", F.when(F.col("whole"), F.col("text")).otherwise(taken))
    if "n_chars" in used:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*unpacked(docs, *used))
