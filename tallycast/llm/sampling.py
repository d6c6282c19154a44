"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.storage import cut_shuffled


def sample_per_label(rows: DataFrame, per_label: int, seed: int) -> DataFrame:
    """At most ``per_label`` rows of each label, those with the smallest hash of their id.

    ``rows`` has ``doc_id`` and ``label``.  Counts per label thin the rows to
    about twice the number wanted before they are ranked, so that no task ranks
    all rows of a frequent label; a label with fewer rows keeps them all.
    """
    known = rows.where("doc_id is not null and label is not null").distinct()
    turn = F.xxhash64("doc_id", F.lit(seed))
    counts = cut_shuffled(known.groupBy("label").agg(F.count("*").alias("n")))
    thinned = known.join(counts, "label").withColumn("turn", turn).where(
        F.pmod("turn", F.lit(1 << 40)).cast("double") / float(1 << 40) * F.col("n") < 2 * per_label + 50)
    order = Window.partitionBy("label").orderBy("turn", "doc_id")
    ranked = thinned.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= per_label).select("doc_id", "label", "rank")
