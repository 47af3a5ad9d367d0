"""Intermediate tables in the shared folder, and small helpers for inputs."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.session import shared_folder

# Settings the Python stages rely on: small Arrow batches bound a worker's memory.
ARROW_ROWS = "256"


def release(spark: SparkSession) -> None:
    """Let the driver collect the plans of finished steps.

    Spark deletes shuffle files and broadcasts once nothing refers to them any more, which it
    learns from the driver's garbage collector. By itself that runs when the heap is full, or
    every half hour: many short steps would keep all their shuffle files until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables of one run, below the folder all executors share.

    A stored table cuts the lineage: what is computed from it survives the loss of any
    executor without running the steps before it again.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.made = 0

    def store(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.parquet(path)
        release(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_since(self, made: int, *keep: DataFrame) -> None:
        """Delete the tables stored after the first ``made`` ones, but for those that ``keep`` reads."""
        read = {f.rsplit("/", 1)[0] for df in keep for f in df.inputFiles()}
        name = self.root.rsplit("/", 1)[-1]
        for number in range(made + 1, self.made + 1):
            if not any(path.endswith(f"{name}/{number}") for path in read):
                self._delete(f"{self.root}/{number}")

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def drop(self, df: DataFrame) -> None:
        """Delete a stored table that nothing will read again."""
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if self.root.split("://")[-1].split(":", 1)[-1].lstrip("/") in path:
                self._delete(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def is_held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves no remainder modulo 5; NULL ids do not count."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
