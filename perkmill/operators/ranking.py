"""Newest row per key, and ordered batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_RANK = "__rank"

# So many sort keys are brought into one task at most.
MOST_SORTED = 100_000
_BITS = 16


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row that is greatest in ``order`` for each key, NULL being greatest.

    The rank filter lets Spark keep one row per key inside every input partition before
    the shuffle, so a key that holds most rows still sends only one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    return df.withColumn(_RANK, F.row_number().over(ranked)).filter(F.col(_RANK) == 1).drop(_RANK)


def earliest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row that is smallest in ``order`` for each key, NULL being greatest."""
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn(_RANK, F.row_number().over(ranked)).filter(F.col(_RANK) == 1).drop(_RANK)


def first_rows(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows: a top-k per partition, then a merge of those."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    return df.orderBy(*order).limit(limit)


def kth_key(df: DataFrame, order: Sequence[str], k: int, newest: bool = False, most_sorted: int | None = None):
    """Values of ``order`` in the ``k``-th row (the last row if there are fewer); None if there is none.

    Rows are counted by the highest 16 bits of the first column, then by the next 16 bits of
    those in the bin that holds the row, and so on, until few enough are left to sort. A level
    sends at most 65,536 counts to the driver; no task holds more than ``most_sorted`` keys.
    Columns are timestamps or whole numbers, and not NULL. Runs its jobs at once.
    """
    most_sorted = MOST_SORTED if most_sorted is None else most_sorted
    left = df.select(*order)
    # A flipped sign bit puts negative numbers first, as 16 bits are compared without a sign.
    bits = {c: F.col(c).cast("timestamp") if isinstance(df.schema[c].dataType, T.TimestampNTZType) else F.col(c) for c in order}
    bits = {c: (F.unix_micros(e) if isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType)) else e.cast("long")).bitwiseXOR(
        F.lit(-(1 << 63))) for c, e in bits.items()}
    for column in order:
        for shift in range(64 - _BITS, -1, -_BITS):
            digit = F.shiftrightunsigned(bits[column], shift).bitwiseAND((1 << _BITS) - 1)
            counts = sorted(((r.d, r.n) for r in left.groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=newest)
            if not counts:
                return None
            k = min(k, sum(n for _, n in counts))
            for found, n in counts:
                if k <= n:
                    break
                k -= n
            left = left.filter(digit == found)
            if n <= most_sorted:
                sort = [F.col(c).desc() if newest else F.col(c).asc() for c in order]
                return tuple(left.orderBy(*sort).limit(k).collect()[-1])
    return tuple(left.first())  # rows equal in all columns


def batch_boundary(df: DataFrame, order: Sequence[str], size: int, newest: bool = False) -> Column:
    """Sort key of the last row of a batch of ``size`` rows, as a scalar subquery.

    Comparing rows with this one value selects the batch in a pass without shuffle, where
    ranking all rows would bring them into a single task. ``order`` must be unique and not
    NULL. The value is NULL when ``df`` is empty. Batches of more than MOST_SORTED rows are
    found by counting (``kth_key``) and come as a literal.
    """
    if size <= 0:
        raise ValueError("batch size must be positive")
    if size > MOST_SORTED:
        kind, found = df.select(F.struct(*order).alias("k")).schema["k"].dataType, kth_key(df, order, size, newest)
        return F.lit(None).cast(kind) if found is None else F.struct(*[F.lit(v).alias(c) for c, v in zip(order, found)]).cast(kind)
    key = F.struct(*order).alias("k")
    sort = [F.col(c).desc() if newest else F.col(c).asc() for c in order]
    edge = F.min("k") if newest else F.max("k")
    return df.orderBy(*sort).limit(size).select(key).agg(edge.alias("edge")).scalar()
