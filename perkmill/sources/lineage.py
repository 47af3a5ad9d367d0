"""Row numbers for text files, which do not carry any.

A row number counts the rows of its own file from 2 on, the header being row 1. A sort
of the whole file would do; instead rows are numbered inside each block of a file as it
is read, blocks are counted, and each block starts after the ones before it. Only one row
per block is shuffled, and sent to all tasks while there are not too many of them.

A load stores its rows with their block and position and counts the stored columns, so the text
is read and written once; the numbers are put together when the relation is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from perkmill.operators.joins import broadcast_up_to
from perkmill.session import checkpoint

_POSITION, _PATH, _BLOCK, _SHIFT = "__position", "__path", "__block", "__shift"
FIRST_ROW = 2
PLACE = T.StructType([
    T.StructField(_PATH, T.StringType()), T.StructField(_BLOCK, T.LongType()), T.StructField(_POSITION, T.LongType())])
OFFSETS = T.StructType([*PLACE.fields[:2], T.StructField(_SHIFT, T.LongType())])

# At 128 MB a block this is 25 TB of text in one load, and some 40 MB to broadcast.
BROADCAST_BLOCKS = 200_000


def with_block(df: DataFrame) -> DataFrame:
    """Remember file and block; to be called directly on a file scan, which may be a stream."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias(_PATH),
        F.col("_metadata.file_block_start").alias(_BLOCK),
    )


def has_block(df: DataFrame) -> bool:
    return _BLOCK in df.columns


def with_position(df: DataFrame) -> DataFrame:
    """Remember the reading order, before anything moves the rows."""
    return df.withColumn(_POSITION, F.monotonically_increasing_id())


def with_block_position(df: DataFrame) -> DataFrame:
    """Remember file, block and reading order; to be called directly on a file scan."""
    return with_position(with_block(df))


def number_rows(df: DataFrame) -> DataFrame:
    """Turn block positions into ``source_row_number`` (text).

    The rows are checkpointed first: file splits and positions may come out differently
    when a scan is repeated on a grown cluster, and counts must fit the rows they number.
    """
    rows = checkpoint(df)
    return numbered(rows, broadcast_up_to(block_offsets(rows), BROADCAST_BLOCKS))


def block_offsets(rows: DataFrame) -> DataFrame:
    """One row per block: what to add to a position to get the row number.

    ``rows`` must be stored: a scan that is repeated may come out in another order.
    """
    blocks = rows.groupBy(_PATH, _BLOCK).agg(
        F.min(_POSITION).alias("__start"), F.count(F.lit(1)).alias("__rows")
    )
    earlier = Window.partitionBy(_PATH).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        _PATH, _BLOCK,
        (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__start") + FIRST_ROW).alias(_SHIFT),
    )


def numbered(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Block and position of every row turned into ``source_row_number`` (text)."""
    joined = rows.join(offsets, [_PATH, _BLOCK]).withColumn(
        "source_row_number", (F.col(_POSITION) + F.col(_SHIFT)).cast("string")
    )
    return joined.drop(_PATH, _BLOCK, _POSITION, _SHIFT)
