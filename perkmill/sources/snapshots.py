"""Versioned table folders: write everything, then make it visible at once.

A root holds one folder per version (``v=00000001``), each with one Parquet folder per
table. A version counts once its ``_COMMITTED`` file exists, so a load of several tables
is seen whole or not at all and a reader never sees a folder that is being overwritten.
One writer at a time: a second one that picks the same version fails.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_PREFIX, _COMMITTED, _CLAIMED = "v=", "_COMMITTED", "_CLAIMED"


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, path = _path(spark, root)
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path) if status.isDirectory()]
    return sorted(int(n[len(_PREFIX):]) for n in names if n.startswith(_PREFIX))


def _folder(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{_PREFIX}{version:08d}"


def committed_version(spark: SparkSession, root: str) -> int | None:
    """Newest version whose tables are all written."""
    for version in reversed(_versions(spark, root)):
        fs, marker = _path(spark, _folder(root, version), _COMMITTED)
        if fs.exists(marker):
            return version
    return None


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Every version whose tables are all written, oldest first."""
    found = []
    for version in _versions(spark, root):
        fs, marker = _path(spark, _folder(root, version), _COMMITTED)
        if fs.exists(marker):
            found.append(version)
    return found


def markers(spark: SparkSession, root: str, version: int, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of a version's marker files."""
    fs, path = _path(spark, _folder(root, version))
    names = [status.getPath().getName() for status in fs.listStatus(path) if status.isFile()]
    return [n[len(prefix):] for n in names if n.startswith(prefix)]


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Stored bytes below ``path``; 0 if there is nothing."""
    fs, folder = _path(spark, path)
    return fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0


def remove_table(spark: SparkSession, root: str, table: str, version: int) -> None:
    """Delete one table of a version that nobody reads any more."""
    fs, path = _path(spark, _folder(root, version), table)
    fs.delete(path, True)


def table_path(spark: SparkSession, root: str, table: str, version: int | None = None) -> str:
    version = committed_version(spark, root) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return f"{_folder(root, version)}/{table}"


def read_table(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(table_path(spark, root, table, version))


class Snapshot:
    """A version being written. Leaving the ``with`` block normally commits it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.version = max(_versions(spark, root), default=0) + 1

    def __enter__(self) -> "Snapshot":
        self._touch(_CLAIMED)
        return self

    def __exit__(self, error, *_) -> None:
        if error is None:
            self._touch(_COMMITTED)

    def _touch(self, name: str) -> None:
        fs, path = _path(self.spark, _folder(self.root, self.version), name)
        fs.create(path, False).close()

    def mark(self, name: str) -> None:
        """An empty file whose name says something about this version."""
        self._touch(name)

    def path(self, table: str) -> str:
        return f"{_folder(self.root, self.version)}/{table}"

    def write(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write one table and return it as stored, so that later steps do not recompute it."""
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))


def write_snapshot(spark: SparkSession, root: str, tables: Mapping[str, DataFrame]) -> int:
    """Write all tables as one version; nothing is visible if one of them fails."""
    with Snapshot(spark, root) as snapshot:
        for table, df in tables.items():
            snapshot.write(table, df)
    return snapshot.version


def register_layer(spark: SparkSession, layer: str, paths: Mapping[str, str]) -> None:
    """Make tables queryable as ``layer.table``, the layer name used exactly as given."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    for table, path in paths.items():
        name = f"`{layer}`.`{table}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source="parquet")
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)


def register_partitioned(spark: SparkSession, layer: str, table: str, path: str, columns: StructType, partition: str) -> None:
    """Make a table with one text partition column queryable, even if it has no rows and thus no files."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    name = f"`{layer}`.`{table}`"
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({listed}, `{partition}` string) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)


def register_view(spark: SparkSession, layer: str, view: str, query: str) -> None:
    """Make a query readable as ``layer.view``, in place of a table or view of that name."""
    name = f"`{layer}`.`{view}`"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def overwrite_source_files(df: DataFrame, path: str) -> None:
    """Replace only the partitions of the source files found in ``df``; others stay."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_file").parquet(path)
    )
