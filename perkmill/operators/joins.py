"""Joins and key differences."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from perkmill.session import checkpoint

# Keys of a batch are sent to all tasks up to this size.
BATCH_KEY_BYTES = 32 << 20


def left_join_default(
    left: DataFrame, right: DataFrame, key: str, defaults: Mapping[str, object] | None = None,
    match_flag: str | None = None,
) -> DataFrame:
    """Left join on ``key``; NULL in a defaulted column becomes its default.

    ``match_flag`` adds a column telling whether a partner was found.
    """
    if match_flag:
        right = right.withColumn(match_flag, F.lit(True))
        defaults = {**(defaults or {}), match_flag: False}
    joined = left.join(right, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """Store a lookup table and broadcast it if it has at most ``rows`` rows.

    A greater one is returned without a hint: Spark then shuffles both sides and splits
    skewed partitions.
    """
    stored = checkpoint(df)
    return F.broadcast(stored) if stored.count() <= rows else stored


def missing_from(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored; a row without key is never stored."""
    return df.join(stored.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


def planned_bytes(df: DataFrame) -> int:
    """Size that the optimizer expects of ``df`` from the files it is read from. Runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def missing_of_batch(batch: DataFrame, stored: DataFrame, key: str, most_bytes: int = BATCH_KEY_BYTES) -> DataFrame:
    """As ``missing_from``, for a batch that is small beside what is stored.

    The keys of the batch go to all tasks, which look for them while they read the stored keys;
    only the ones found, at most as many as the batch has, are shuffled. The stored side stays
    where it is. A batch whose keys are expected to take more than ``most_bytes`` is joined
    as two shuffled sides.
    """
    keys = batch.select(key).filter(F.col(key).isNotNull())
    if planned_bytes(keys) > most_bytes:
        return missing_from(batch, stored, key)
    known = stored.select(key).join(F.broadcast(keys), key, "left_semi").distinct()
    return batch.join(F.broadcast(known), key, "left_anti")


def unique_or_fail(df: DataFrame, key: str) -> DataFrame:
    """The same rows, failing the job if a key occurs twice; only keys are shuffled.

    ``df`` is read twice, so it should be stored.
    """
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    first = repeated.agg(F.min(F.coalesce(F.col(key).cast("string"), F.lit("NULL")))).scalar()
    message = F.concat(F.lit(f"duplicate {key}: "), first)
    return df.filter(F.when(first.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The same rows, failing the job if a key occurs twice.

    Written as an aggregation, not a window: copies of one key are combined before the
    shuffle, and after a join on ``key`` it needs no shuffle of its own.
    """
    copies = "__copies"
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(
        F.count(F.lit(1)).alias(copies), *[F.first(c).alias(c) for c in others]
    )
    message = F.concat(F.lit(f"duplicate {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    is_unique = F.when(F.col(copies) > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.filter(is_unique).select(*df.columns)


def update_rows(
    target: DataFrame, affected: Column, changes: DataFrame, key: str, assignments: Mapping[str, Column],
) -> DataFrame:
    """Rows of ``target`` that are ``affected`` and have a change get ``assignments``.

    Only affected rows are shuffled to meet their changes; all others pass straight
    through. Columns of ``changes`` are read in ``assignments`` as ``change.<name>``.
    """
    matched = F.col("change").isNotNull()
    touched = target.filter(affected).join(_one_change_per_key(changes, key), key, "left").select(*[
        F.when(matched, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
        for c in target.columns
    ])
    return target.filter(~affected | affected.isNull()).unionByName(touched)


def updated_rows(
    target: DataFrame, affected: Column, changes: DataFrame, key: str, assignments: Mapping[str, Column],
) -> DataFrame:
    """As ``update_rows``, but only the rows that get assignments."""
    return target.filter(affected).join(_one_change_per_key(changes, key), key).select(*[
        assignments[c].cast(target.schema[c].dataType).alias(c) if c in assignments else F.col(c) for c in target.columns])


def _one_change_per_key(changes: DataFrame, key: str) -> DataFrame:
    return require_unique(changes, key).select(F.col(key), F.struct(*[c for c in changes.columns if c != key]).alias("change"))
