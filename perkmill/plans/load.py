"""Full-refresh load of the contracted sources, and reading what was loaded."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from perkmill.schemas import RAW, SOURCES
from perkmill.sources.lineage import OFFSETS, PLACE, block_offsets, has_block, numbered
from perkmill.sources.readers import blank_relations, read_raw, scan_contracted
from perkmill.sources.snapshots import Snapshot, folder_bytes, table_path, write_snapshot

# Stored bytes of block offsets up to which they are sent to all tasks: some 400,000 blocks.
BROADCAST_BYTES = 4 << 20


def _offsets_table(relation: str) -> str:
    return f"{relation}_blocks"


def load_sources(
    spark: SparkSession, paths: Mapping[str, str], root: str, format: str = "csv", multi_line: bool = False,
) -> int:
    """Read every source, then store all of them as one version of ``root``.

    ``paths`` maps raw relation names to files or folders. A source that is missing or has
    another header raises before anything is written. CSV text is read and written once, with
    the place of every row; the blocks are counted in the stored columns.
    """
    scans = {s.relation: scan_contracted(spark, s, paths[s.relation], format, multi_line) for s in SOURCES}
    with Snapshot(spark, root) as snapshot:
        for relation, scan in scans.items():
            stored = snapshot.write(relation, scan)
            if has_block(scan):
                snapshot.write(_offsets_table(relation), block_offsets(stored))
    return snapshot.version


def read_loaded(spark: SparkSession, root: str, relation: str, version: int | None = None) -> DataFrame:
    """A raw relation as stored by a load or a reset, with its row numbers. Runs no job."""
    path = table_path(spark, root, relation, version)
    offsets_path = table_path(spark, root, _offsets_table(relation), version)
    stored_bytes = folder_bytes(spark, offsets_path)
    if not stored_bytes:
        return read_raw(spark, relation, path)
    offsets = spark.read.schema(OFFSETS).parquet(offsets_path)
    text = [f for f in RAW[relation].fields if f.name != "source_row_number"]
    rows = spark.read.schema(T.StructType([*text, *PLACE.fields])).parquet(path)
    placed = numbered(rows, F.broadcast(offsets) if stored_bytes <= BROADCAST_BYTES else offsets)
    return placed.select(*RAW[relation].names)


def reset(spark: SparkSession, root: str) -> int:
    """Store all raw relations empty, as the next version."""
    return write_snapshot(spark, root, blank_relations(spark))
