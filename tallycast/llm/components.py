"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.storage import cut_shuffled


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of
    the links ``a``, ``b``.  Links with a null end or equal ends join nothing.

    Each round, a node takes the smallest label among its own label's label and
    those of its neighbours, and passes a neighbour's label on to its old label.
    Labels only fall, so an unchanged sum ends the rounds; their number is about
    the logarithm of the longest path.  Labels and links are read from the
    checkpoint folder in every join, so that a node with very many links can be
    split by adaptive execution; the minimum is combined before its shuffle.
    """
    one = links.where("a is not null and b is not null and a <> b").select(
        F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    both = cut_shuffled(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_shuffled(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")))
    total = F.sum(F.col("label").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    while True:
        of = lambda name, label: labels.select(F.col("node").alias(name), F.col("label").alias(label))
        jumped = labels.join(of("label", "next"), "label").select("node", F.col("next").alias("label"))
        ends = both.join(of("b", "theirs"), "b").join(of("a", "mine"), "a")
        heard = ends.select(F.col("a").alias("node"), F.col("theirs").alias("label"))
        passed = ends.select(F.col("mine").alias("node"), F.col("theirs").alias("label"))
        labels = cut_shuffled(labels.unionByName(jumped).unionByName(heard).unionByName(passed)
                             .groupBy("node").agg(F.min("label").alias("label")))
        after = labels.agg(total).first()[0]
        if after == before:
            return labels.withColumnRenamed("label", "component")
        before = after
