"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str, *, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    On a cluster ``master`` and sizes come from spark-submit; anything in
    ``conf`` wins over the defaults here.  Keyword names use ``__`` for dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        # Call sites of single column expressions cost more than the expressions.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the cluster; make one only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tallycast-checkpoint-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame, *, free: bool = False) -> DataFrame:
    """Write ``df`` to the checkpoint folder once, so that many later jobs read
    it from shared storage and a lost executor does not recompute its inputs.

    With ``free``, the shuffle files behind ``df`` are deleted as soon as it is
    written; otherwise they stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not free:
        return df.checkpoint(eager=True)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        # Spark reads the setting when a DataFrame is made.
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
