"""Connected components of links, by alternating star joins on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkmill.llm.tables import Scratch

MOST_ROUNDS = 60


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every end of ``links`` (a, b); component is the smallest id reachable.

    Each round points larger neighbours to the smallest one, first from both sides of a
    link, then among smaller neighbours only. Rounds grow with the logarithm of a chain's
    length. Only a count and a checksum of the links come to the driver. A hub is a skewed
    join key, which adaptive execution splits; minima are combined before the shuffle.
    """
    edges = scratch.store(_down(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    state = _checksum(edges)
    for _ in range(MOST_ROUNDS):
        following = scratch.store(_small_star(_large_star(edges)))
        scratch.drop(edges)
        edges, before, state = following, state, _checksum(following)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    ends = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("id"), "component")).distinct()


def grown_components(components: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``components`` (stored) after the stored ``links`` were added to theirs.

    What is known enters as one link for each end, so only the new links take rounds.
    """
    if links.isEmpty():
        return components
    known = components.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    return scratch.store(connected_components(known.unionByName(links.select("a", "b")), scratch))


def _down(edges: DataFrame) -> DataFrame:
    """Links from the larger to the smaller end, once each."""
    return edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return _down(both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _down(moved.unionByName(smallest.select("u", F.col("m").alias("v"))))


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
