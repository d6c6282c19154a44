"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, folder of tables) and returns a DataFrame; all
but the last return the columns of documents.  ``run`` writes each result as
Parquet into the shared checkpoint folder and reads it again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm import line_dedup, mixing, near_dedup, quality_rules, queries
from tallycast.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the rule ledger."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the three-line windows that occur earlier; every document stays."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        own = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", own)
    return cleaned.select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix draws, as documents."""
    return mixing.mixed_texts(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text of the mix, as digests with the bytes they decode to."""
    return queries.bpe_digests(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near),
    ("mixing", mixture),
    ("byte-level BPE", encoded),
]

# Sampling and the permutations of the mix cannot be said in SQL; the stages are
# tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents of a folder."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if place + 1 == len(STAGES):
            return result
        result.write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
