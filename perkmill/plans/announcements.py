"""The announcement job around the queue. Sending the messages is left to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from perkmill import vocabulary as V
from perkmill.functions.responses import delivery_outcome, link_outcome
from perkmill.operators.joins import left_join_default
from perkmill.plans import queue as Q


def start_batch(
    queue: DataFrame, limit: int, now: Column, retry_errors: bool = False,
    stale_minutes: int = V.DEFAULT_STALE_MINUTES,
) -> tuple[DataFrame, DataFrame]:
    """Expire stale claims, claim the next batch and write its messages."""
    fresh = Q.expire_stale_claims(queue, stale_minutes, now)
    claimed_queue, batch = Q.claim_batch(fresh, limit, retry_errors, now)
    return claimed_queue, Q.with_announcement(batch)


def delivery_results(deliveries: DataFrame, links: DataFrame) -> DataFrame:
    """Results to settle a batch with, from captured responses.

    Both inputs have ``activity_id, error, http_status, body``.
    """
    sent = deliveries.select("activity_id", delivery_outcome(
        F.col("error"), F.col("http_status"), F.col("body")).alias("o")).select("activity_id", "o.*")
    return left_join_default(sent, link_results(links), "activity_id")


def link_results(links: DataFrame) -> DataFrame:
    """Link results from captured link responses."""
    return links.select("activity_id", link_outcome(
        F.col("error"), F.col("http_status"), F.col("body")).alias("o")).select("activity_id", "o.*")


def finish_batch(queue: DataFrame, deliveries: DataFrame, links: DataFrame, now: Column) -> DataFrame:
    """Queue after the batch: published or failed row by row."""
    return Q.apply_deliveries(queue, delivery_results(deliveries, links), now)
