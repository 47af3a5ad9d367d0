"""Aggregations: all of them combine on the map side, so a hot group stays small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from perkmill.functions.measures import months_before


def greatest_value(df: DataFrame, column: str):
    """Greatest value of a column, None on empty input. Runs a job."""
    return df.agg(F.max(column)).first()[0]


def pivot_filtered_max(df: DataFrame, name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One row, one column per name holding the greatest value recorded under it."""
    return df.agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def trailing_window(df: DataFrame, day: str, as_of: Column, months: int) -> DataFrame:
    """Rows dated from ``months`` before ``as_of`` up to ``as_of``, both ends included."""
    return df.filter(F.col(day).between(months_before(as_of, months), as_of))


def trailing_counts(df: DataFrame, key: str, day: str, as_of: Column, months: int) -> DataFrame:
    """Count, first and last day per key in the trailing window."""
    return trailing_window(df, day, as_of, months).groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def filtered_counts(conditions: Mapping[str, Column]) -> list[Column]:
    """``count(*) filter (where condition)`` for each name."""
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]


def total_or_zero(c: Column, scale: int | None = None) -> Column:
    total = F.sum(c)
    return F.coalesce(total if scale is None else F.round(total, scale), F.lit(0))


def histogram(df: DataFrame, key: str, count_name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
