"""The publication queue on storage: every transition writes the rows it changes, and no others.

The store is a base partitioned by status and a log of changes (``sources/change_store.py``),
for batch jobs and for the stream alike. A transition reads only the statuses it starts from.
Changed rows pass the queue's audits before they can be seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from perkmill import vocabulary as V
from perkmill.plans import marts, queue as Q, staging
from perkmill.plans.announcements import delivery_results, link_results
from perkmill.plans.audits import enforce, run_audits
from perkmill.schemas import QUEUE, QUEUE_FACT_COLUMNS, RAW
from perkmill.sources.change_store import Change, ChangeStore

LEDGER = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("batch", T.LongType()),
    *[T.StructField(name, T.LongType()) for name in ("arrived", "queued", "known", "invalid")],
])


class QueueStore:
    """The queue below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = ChangeStore(spark, root, QUEUE, "activity_id", "publication_status")

    def create(self, rows: DataFrame | None = None) -> "QueueStore":
        """An empty queue, or one that starts with ``rows``, which are audited first."""
        if rows is not None:
            enforce(run_audits({Q.RELATION: rows}, Q.queue_audits()))
        self.store.create(rows)
        return self

    def exists(self) -> bool:
        return self.store.exists()

    def read(self, *statuses: str) -> DataFrame:
        return self.store.read(*statuses)

    def _change(self, make: Callable[[], DataFrame], tag: str | None = None) -> DataFrame:
        with self.store.change(tag) as change:
            return _audited(change, make())

    # -- transitions ------------------------------------------------------------------

    def synchronise(self, fact: DataFrame, now: Column | None = None) -> DataFrame:
        """Queue the stored facts that are not queued yet; returns the new rows."""
        return self._change(lambda: Q.new_rows_of_batch(self.store.keys(), fact, now))

    def backfill(self, keep_newest: int = 0, now: Column | None = None) -> DataFrame:
        return self._change(lambda: Q.backfill_changes(self.read(V.PENDING), keep_newest, now))

    def expire_stale_claims(self, stale_minutes: int = V.DEFAULT_STALE_MINUTES, now: Column | None = None) -> DataFrame:
        return self._change(lambda: Q.expire_changes(self.read(V.IN_PROGRESS), stale_minutes, now))

    def claim(self, limit: int, retry_errors: bool = False, now: Column | None = None) -> DataFrame:
        """Claim the oldest rows; returns what is to be announced, as claimed."""
        statuses = (V.PENDING, V.ERROR) if retry_errors else (V.PENDING,)
        claimed = self._change(lambda: Q.claim_changes(self.read(*statuses), limit, retry_errors, now))
        return claimed.select(*QUEUE_FACT_COLUMNS)

    def settle(self, deliveries: DataFrame, links: DataFrame, now: Column | None = None) -> DataFrame:
        """Publish or fail the claimed rows by their captured responses."""
        return self._change(lambda: Q.delivery_changes(self.read(V.IN_PROGRESS), delivery_results(deliveries, links), now))

    def repair_links(self, links: DataFrame, now: Column | None = None) -> DataFrame:
        return self._change(lambda: Q.link_changes(self.read(V.PUBLISHED), link_results(links), now))

    def reset(self) -> None:
        """An empty queue; the old states stay readable until they are removed."""
        self.store.replace(self.store.spark.createDataFrame([], QUEUE))

    # -- arriving batches -------------------------------------------------------------

    def append_batch(self, raw: DataFrame, source: str, batch: int, now: Column | None = None) -> None:
        """Queue the valid new activities of a raw batch, keep its invalid rows and its ledger.

        ``source`` and ``batch`` name the batch: given again after it was committed, it changes
        nothing; after a failure before that, it is made anew and nothing of the first try is
        seen. The batch is typed once. Every arrived row is queued, known or invalid.
        """
        tag = f"{source}-{batch}"
        if self.store.has(tag):
            return
        with self.store.change(tag) as change:
            staged = change.write("staged", staging.sport_activities(raw))
            fact = marts.activity_fact(staged)
            queued = _audited(change, Q.new_rows_of_batch(self.store.keys(), fact, now)).count()
            arrived, invalid = staged.agg(
                F.count(F.lit(1)), F.count_if(~F.coalesce(F.col("record_is_valid"), F.lit(False)))).first()
            change.write("ledger", self.store.spark.createDataFrame(
                [(source, batch, arrived, queued, arrived - invalid - queued, invalid)], LEDGER))

    def ledger(self) -> DataFrame:
        """One row per batch: how many rows arrived, and what became of them."""
        return self.store.companions("ledger", LEDGER)

    def invalid_rows(self) -> DataFrame:
        """Arrived rows that were not valid, as staged."""
        spark = self.store.spark
        blank = staging.sport_activities(spark.createDataFrame([], RAW["sport_activities_txt"]))
        return self.store.companions("staged", blank.schema).filter(~F.coalesce(F.col("record_is_valid"), F.lit(False)))


def _audited(change: Change, rows: DataFrame) -> DataFrame:
    stored = change.rows(rows)
    enforce(run_audits({Q.RELATION: stored}, Q.queue_audits()))
    return stored
