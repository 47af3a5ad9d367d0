"""Session settings the package relies on, and checkpointing on shared storage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Semantics: UTC makes zone-less and zoned timestamps agree, ANSI mode turns an
# overflow into an error instead of a wrong number (casts that may fail use try_cast).
SEMANTIC_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Execution: re-planning at run time, including splitting of skewed join partitions.
EXECUTION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot never compiles a method of more than 8,000 bytes. Typing wide text rows makes
    # such methods; beyond this limit Spark generates smaller ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "perkmill", **settings: str) -> SparkSession:
    """Create or reuse a session with the package settings; ``settings`` win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_SETTINGS, **EXECUTION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which every executor can reach.

    The folder named by the cluster (``spark.checkpoint.dir``) is used as it is. A
    temporary one is made only on a local master, where nothing names a folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="perkmill-checkpoint-", dir=os.environ.get("TMPDIR", "/tmp"))
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
