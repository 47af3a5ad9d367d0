"""Changes of whole tables as functions from one snapshot to the next."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from perkmill.operators.joins import missing_of_batch, unique_or_fail


def rows_to_insert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target lacks; two new rows with one key fail the job."""
    return unique_or_fail(missing_of_batch(source, target, key), key)


def insert_only_merge(target: DataFrame, source: DataFrame, key: str, defaults: Mapping[str, Column]) -> DataFrame:
    """Target plus the new source rows; existing rows stay untouched."""
    new = rows_to_insert(target, source, key).withColumns(dict(defaults))
    return target.unionByName(new.select(*[F.col(c).cast(target.schema[c].dataType) for c in target.columns]))


def replace_by_source_file(stored: DataFrame, new: DataFrame, *source_files: str) -> DataFrame:
    """Stored rows of these files are replaced by ``new``; loading twice changes nothing."""
    kept = stored.filter(~F.coalesce(F.col("source_file").isin(*source_files), F.lit(False)))
    return kept.unionByName(new)


def assign_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows where ``condition`` is true; one pass, no shuffle.

    The condition is a column of its own, so it is worked out once per row however many
    columns are set.
    """
    hit, schema = F.col("__hit"), df.schema
    return df.withColumn("__hit", condition).select(*[
        F.when(hit, assignments[c]).otherwise(F.col(c)).cast(schema[c].dataType).alias(c)
        if c in assignments else F.col(c)
        for c in schema.names
    ])


def changed_rows(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Only the rows where ``condition`` is true, with the columns set."""
    schema = df.schema
    return df.filter(condition).select(*[
        assignments[c].cast(schema[c].dataType).alias(c) if c in assignments else F.col(c) for c in schema.names])


def emptied(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)
