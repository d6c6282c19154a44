"""Lineage cuts of the operators, and columns that pass through them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.session import cut_lineage

TASKS_PER_CORE = 2
SHUFFLE_SHARE = 4


def cut_shuffled(df: DataFrame, *, free: bool = False) -> DataFrame:
    """``df``, the result of a shuffle of narrow rows, written to the checkpoint folder
    as few files: every file of a checkpoint costs its executor a call to the file
    system (on local disks a process), and later joins deal the rows anew.  There
    are at least two per core and a quarter of the session's shuffle partitions,
    which grow with the data.  ``free`` is that of ``cut_lineage``."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions")) // SHUFFLE_SHARE
    return cut_lineage(df.coalesce(max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, partitions)), free=free)


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns, and all others in one column ``rest``, so that no name of
    theirs can meet a name that an operator adds."""
    others = [F.col(f"`{name}`") for name in docs.columns if name not in used]
    return docs.select(*used, (F.struct(*others) if others else F.lit(None).cast("string")).alias("rest"))


def unpacked(docs: DataFrame, *used: str) -> list[Column]:
    """The columns of ``docs`` in their order, out of its packed form."""
    return [F.col(f"`{name}`") if name in used else F.col("rest").getField(name).alias(name) for name in docs.columns]
