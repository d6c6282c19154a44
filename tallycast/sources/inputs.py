"""Checks of the input folder, reuse of intermediate tables, optional parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.sources.dimensions import literal_table


def missing_inputs(
    spark: SparkSession,
    folder: str,
    tables: Iterable[str] = constants.REQUIRED_TABLES,
    suffix: str = ".csv",
) -> DataFrame:
    """Required files that are not in the folder; every name is looked up on its own,
    so that the folder may hold any number of others."""
    absent = [(name + suffix,) for name in tables if not path_exists(spark, f"{folder}/{name}{suffix}")]
    return literal_table(spark, absent, "file string") if absent else spark.createDataFrame([], "file string")


def require_inputs(spark: SparkSession, folder: str, **options) -> None:
    absent = sorted(row.file for row in missing_inputs(spark, folder, **options).collect())
    if absent:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(absent)}")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def cached_table(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], *, force: bool = False
) -> DataFrame:
    """Read the Parquet table at ``path``, building it first if absent or forced.

    Only a table with its success marker counts, so a write that a lost
    driver left half done is built again.
    """
    if force or not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_parameters(spark: SparkSession, path: str) -> dict[tuple[str, str], dict]:
    """Tuned parameters by (target, model); an absent file means none."""
    if not path_exists(spark, path):
        return {}
    rows = spark.read.schema(
        "target string, model string, params map<string, double>, score double"
    ).json(path)
    best = rows.groupBy("target", "model").agg(F.min_by("params", "score").alias("params"))
    return {(row.target, row.model): dict(row.params) for row in best.collect()}
