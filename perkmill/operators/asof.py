"""Effective-dated lookups.

``versions_at`` serves one date. ``as_of_join`` serves a date per row: it answers the
lookup once per distinct day and joins the answers, so facts are never paired with
versions. Per day it does not try every version either. A version is stored under the
few aligned blocks of days (of 1, 2, 4, ... days) that tile its interval, the best one
per block is kept, and a day asks only the blocks it lies in. With V versions and D days
the work is (V + D) x 44 rows at most, and each step combines before it shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from perkmill.functions.rules import covers
from perkmill.operators.joins import broadcast_up_to
from perkmill.operators.ranking import latest_by_key

# Blocks of 2^0 ... 2^21 days: the greatest ones tile the whole calendar up to year 9999.
_LEVELS = 22
_EPOCH = "0001-01-01"

# A day table of this many rows is joined by broadcast; a greater one is shuffled.
BROADCAST_DAYS = 100_000


def versions_at(versions: DataFrame, day: Column, name: str, order: Sequence[str]) -> DataFrame:
    """Newest version per name among those in force on ``day``."""
    in_force = versions.filter(covers(F.col("valid_from"), F.col("valid_to"), day))
    return latest_by_key(in_force, [name], order)


def _day_number(day: Column) -> Column:
    return F.datediff(day, F.lit(_EPOCH).cast("date"))


def _tiles(start: Column, end: Column) -> Column:
    """Blocks ``(level, block)`` that tile days ``start`` to ``end`` exactly (end excluded)."""
    def at_level(level: Column) -> Column:
        size = F.pow(F.lit(2), level).cast("long")
        first = F.floor((start + size - 1) / size)
        last = F.floor(end / size)
        single_left = F.when((first < last) & (first % 2 == 1), F.struct(level.alias("level"), first.alias("block")))
        single_right = F.when((first < last) & (last % 2 == 1), F.struct(level.alias("level"), (last - 1).alias("block")))
        return F.array_distinct(F.array_compact(F.array(single_left, single_right)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_LEVELS - 1)), at_level))


def _ancestors(day: Column) -> Column:
    """Every block ``(level, block)`` a day lies in."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(_LEVELS - 1)),
        lambda level: F.struct(
            level.alias("level"), F.floor(day / F.pow(F.lit(2), level).cast("long")).alias("block")
        ),
    )


def resolve_by_day(
    days: DataFrame, versions: DataFrame, day: str, name: str, value: str, names: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """One row per distinct day with one column per name: the value in force on that day."""
    # Rank with NULL greatest: a struct compares NULL as smallest, so say it in a flag.
    rank = F.struct(*[p for c in order for p in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))])
    start = _day_number(F.col("valid_from"))
    # An open end reaches the end of the calendar.
    end = _day_number(F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast("date"))) + 1
    stored = (
        versions.filter(F.col("valid_from").isNotNull() & F.col(name).isin(*names))
        .select(F.col(name).alias("name"), F.col(value).alias("value"), rank.alias("rank"),
                F.explode(_tiles(start, end)).alias("tile"))
        .groupBy("tile.level", "tile.block", "name")
        .agg(F.max(F.struct("rank", "value")).alias("best"))
    )
    asked = (
        days.select(F.col(day).alias("day")).filter(F.col("day").isNotNull()).distinct()
        .select("day", F.explode(_ancestors(_day_number(F.col("day")))).alias("tile"))
        .select("day", "tile.level", "tile.block")
    )
    # The best version per name is the best of the per-block ones; NULL never wins a max
    # over structs, so a block without that name does not count.
    winners = [F.max(F.when(F.col("name") == n, F.col("best")))["value"].alias(n) for n in names]
    found = asked.join(stored, ["level", "block"]).groupBy("day").agg(*winners)
    return found.withColumnRenamed("day", day)


def as_of_join(
    facts: DataFrame, versions: DataFrame, day: str, name: str, value: str, names: Sequence[str],
    order: Sequence[str], broadcast_days: int = BROADCAST_DAYS,
) -> DataFrame:
    """Every fact with the value of each name in force on its own ``day``.

    The day table has one narrow row per distinct day. It is stored and its rows are
    counted first: up to ``broadcast_days`` rows it is broadcast and the facts stay where
    they are; beyond that the join is shuffled, and Spark splits the partition of a hot day.
    """
    resolved = resolve_by_day(facts, versions, day, name, value, names, order)
    return facts.join(broadcast_up_to(resolved, broadcast_days), day, "left")
