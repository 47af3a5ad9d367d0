"""The publication queue: every transition maps one snapshot to the next.

States: PENDING -> IN_PROGRESS -> PUBLISHED or ERROR; PENDING -> BACKFILLED; ERROR ->
IN_PROGRESS only when errors are retried. One writer at a time. Transitions that select a
batch compare rows with the sort key of the batch's last row, so the queue itself is
neither ranked nor joined with the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from perkmill import vocabulary as V
from perkmill.functions.announcement import announcement_text
from perkmill.functions.measures import older_than
from perkmill.operators.aggregates import histogram
from perkmill.operators.joins import missing_of_batch, unique_or_fail, update_rows, updated_rows
from perkmill.operators.quality import Audit, is_true, not_null, unique
from perkmill.operators.ranking import batch_boundary, first_rows
from perkmill.operators.tables import assign_where, changed_rows, insert_only_merge, rows_to_insert
from perkmill.plans.audits import enforce, run_audits
from perkmill.schemas import QUEUE, QUEUE_DEFAULTS, QUEUE_FACT_COLUMNS, QUEUE_REQUIRED
from perkmill.sources.snapshots import Snapshot

RELATION = "slack_publication_queue"
_AGE = ("activity_start_datetime", "activity_id")


def _now(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now


def _status(*values: str) -> Column:
    c = F.col("publication_status")
    return c == values[0] if len(values) == 1 else c.isin(*values)


def _positive(**numbers: int) -> None:
    for name, number in numbers.items():
        if number <= 0:
            raise ValueError(f"{name} must be positive")


def as_queue_source(fact: DataFrame) -> DataFrame:
    """The fact columns a queue row starts from, in queue types."""
    return fact.select(*[F.col(c).cast(QUEUE[c].dataType).alias(c) for c in QUEUE_FACT_COLUMNS])


def _defaults(now: Column) -> dict[str, Column]:
    given = {**{k: F.lit(v) for k, v in QUEUE_DEFAULTS.items()}, "created_at": now, "updated_at": now}
    rest = [f.name for f in QUEUE.fields if f.name not in given and f.name not in QUEUE_FACT_COLUMNS]
    return {**given, **{name: F.lit(None) for name in rest}}


def new_rows(queue: DataFrame, fact: DataFrame, now: Column | None = None) -> DataFrame:
    """Queue rows for facts not queued yet. A fact listed twice fails the job."""
    fresh = rows_to_insert(queue, as_queue_source(fact), "activity_id").withColumns(_defaults(_now(now)))
    return fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUEUE.fields])


def new_rows_of_batch(stored_keys: DataFrame, fact: DataFrame, now: Column | None = None) -> DataFrame:
    """As ``new_rows``, for stored facts that are few beside the stored keys, which are not moved."""
    source = as_queue_source(fact)
    fresh = missing_of_batch(unique_or_fail(source, "activity_id"), stored_keys, "activity_id").withColumns(_defaults(_now(now)))
    return fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUEUE.fields])


def synchronise(queue: DataFrame, fact: DataFrame, now: Column | None = None) -> DataFrame:
    """Insert-only merge of the facts; rows already queued stay as they are."""
    return insert_only_merge(queue, as_queue_source(fact), "activity_id", _defaults(_now(now)))


def backfill(queue: DataFrame, keep_newest: int = 0, now: Column | None = None) -> DataFrame:
    """All pending rows but the ``keep_newest`` newest become BACKFILLED."""
    return assign_where(queue, *_backfilling(queue, keep_newest, now))


def backfill_changes(queue: DataFrame, keep_newest: int = 0, now: Column | None = None) -> DataFrame:
    """The rows that ``backfill`` changes."""
    return changed_rows(queue, *_backfilling(queue, keep_newest, now))


def _backfilling(queue: DataFrame, keep_newest: int, now: Column | None) -> tuple[Column, dict[str, Column]]:
    if keep_newest < 0:
        raise ValueError("keep_newest must not be negative")
    older = _status(V.PENDING)
    if keep_newest:
        edge = batch_boundary(queue.filter(_status(V.PENDING)), _AGE, keep_newest, newest=True)
        older = older & (F.struct(*_AGE) < edge)
    return older, {
        "publication_status": F.lit(V.BACKFILLED), "claimed_at": F.lit(None), "last_error": F.lit(None),
        "updated_at": _now(now),
    }


def expire_stale_claims(
    queue: DataFrame, stale_minutes: int = V.DEFAULT_STALE_MINUTES, now: Column | None = None,
) -> DataFrame:
    """Claims older than ``stale_minutes`` become errors."""
    return assign_where(queue, *_expiring(stale_minutes, now))


def expire_changes(queue: DataFrame, stale_minutes: int = V.DEFAULT_STALE_MINUTES, now: Column | None = None) -> DataFrame:
    """The rows that ``expire_stale_claims`` changes."""
    return changed_rows(queue, *_expiring(stale_minutes, now))


def _expiring(stale_minutes: int, now: Column | None) -> tuple[Column, dict[str, Column]]:
    _positive(stale_minutes=stale_minutes)
    stale = _status(V.IN_PROGRESS) & older_than(F.col("claimed_at"), stale_minutes, _now(now))
    return stale, {
        "publication_status": F.lit(V.ERROR), "last_error": F.lit(V.STALE_CLAIM_ERROR), "updated_at": _now(now),
    }


def _claimable(retry_errors: bool) -> Column:
    return _status(V.PENDING, V.ERROR) if retry_errors else _status(V.PENDING)


def preview_batch(queue: DataFrame, limit: int, retry_errors: bool = False) -> DataFrame:
    """The rows the next claim would take, oldest first; nothing changes."""
    _positive(limit=limit)
    order = [F.col(c) for c in _AGE]
    return first_rows(queue.filter(_claimable(retry_errors)), order, limit).select(*QUEUE_FACT_COLUMNS)


def claim_batch(
    queue: DataFrame, limit: int, retry_errors: bool = False, now: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(next snapshot, claimed rows)`` for the ``limit`` oldest claimable rows.

    Both are computed from ``queue``. Pass a fixed ``now`` if they must carry the very same
    time, and store the snapshot before publishing what was claimed.
    """
    taken, claimed = _claiming(queue, limit, retry_errors, now)
    batch = queue.filter(taken).select(*QUEUE_FACT_COLUMNS)
    return assign_where(queue, taken, claimed), batch


def claim_changes(queue: DataFrame, limit: int, retry_errors: bool = False, now: Column | None = None) -> DataFrame:
    """The rows that ``claim_batch`` claims, as they are afterwards."""
    return changed_rows(queue, *_claiming(queue, limit, retry_errors, now))


def _claiming(queue: DataFrame, limit: int, retry_errors: bool, now: Column | None) -> tuple[Column, dict[str, Column]]:
    _positive(limit=limit)
    claimable = _claimable(retry_errors)
    edge = batch_boundary(queue.filter(claimable), _AGE, limit)
    return claimable & (F.struct(*_AGE) <= edge), {
        "publication_status": F.lit(V.IN_PROGRESS), "attempt_count": F.col("attempt_count") + 1,
        "claimed_at": _now(now), "updated_at": _now(now), "last_error": F.lit(None),
    }


def with_announcement(batch: DataFrame) -> DataFrame:
    """Add the text to publish for each row."""
    return batch.withColumn("message", announcement_text(
        F.col("activity_id"), F.col("employee_id"), F.col("activity_start_datetime"), F.col("sport_type"),
        F.col("distance_meters"), F.col("elapsed_seconds"), F.col("activity_comment"),
    ))


def apply_deliveries(queue: DataFrame, results: DataFrame, now: Column | None = None) -> DataFrame:
    """Settle claimed rows with their delivery results.

    ``results`` has one row per activity: ``activity_id, succeeded, channel_id, message_ts,
    error_message, permalink, link_error``. Rows no longer in progress stay as they are.
    """
    return update_rows(queue, _status(V.IN_PROGRESS), results, "activity_id", _settled(now))


def delivery_changes(queue: DataFrame, results: DataFrame, now: Column | None = None) -> DataFrame:
    """The rows that ``apply_deliveries`` changes."""
    return updated_rows(queue, _status(V.IN_PROGRESS), results, "activity_id", _settled(now))


def _settled(now: Column | None) -> dict[str, Column]:
    change = F.col("change")
    ok = F.coalesce(change["succeeded"], F.lit(False))

    def on_success(value: Column, column: str) -> Column:
        return F.when(ok, value).otherwise(F.col(column))

    failure = F.substring(F.coalesce(change["error_message"], F.lit("UNKNOWN_ERROR")), 1, V.ERROR_TEXT_LENGTH)
    return {
        "publication_status": F.when(ok, F.lit(V.PUBLISHED)).otherwise(F.lit(V.ERROR)),
        "published_at": on_success(_now(now), "published_at"),
        "slack_channel_id": on_success(change["channel_id"], "slack_channel_id"),
        "slack_message_ts": on_success(change["message_ts"], "slack_message_ts"),
        "slack_permalink": on_success(change["permalink"], "slack_permalink"),
        "last_error": F.when(ok, change["link_error"]).otherwise(failure),
        "updated_at": _now(now),
    }


def links_to_repair(queue: DataFrame, limit: int) -> DataFrame:
    """Published rows without a link, longest published first."""
    _positive(limit=limit)
    lacking = (
        _status(V.PUBLISHED) & F.col("slack_permalink").isNull()
        & F.col("slack_channel_id").isNotNull() & F.col("slack_message_ts").isNotNull()
    )
    order = [F.col("published_at").asc_nulls_last(), F.col("activity_id")]
    return first_rows(queue.filter(lacking), order, limit).select(
        "activity_id", "slack_channel_id", "slack_message_ts"
    )


def apply_links(queue: DataFrame, links: DataFrame, now: Column | None = None) -> DataFrame:
    """Store repaired links (``activity_id, permalink, link_error``) of published rows."""
    return update_rows(queue, _status(V.PUBLISHED), links, "activity_id", _linked(now))


def link_changes(queue: DataFrame, links: DataFrame, now: Column | None = None) -> DataFrame:
    """The rows that ``apply_links`` changes."""
    return updated_rows(queue, _status(V.PUBLISHED), links, "activity_id", _linked(now))


def _linked(now: Column | None) -> dict[str, Column]:
    change = F.col("change")
    return {"slack_permalink": change["permalink"], "last_error": change["link_error"], "updated_at": _now(now)}


def status_histogram(queue: DataFrame) -> DataFrame:
    return histogram(queue, "publication_status", "activity_count").orderBy("publication_status")


def queue_audits(relation: str = RELATION) -> list[Audit]:
    """What a queue snapshot must satisfy before it is stored: violations are errors."""
    statuses = ", ".join(f"'{s}'" for s in V.PUBLICATION_STATUSES)
    return [
        unique("queue_activity_id_unique", relation, "activity_id", "error"),
        is_true("queue_status_is_known", relation, f"publication_status in ({statuses})", "error"),
        is_true("queue_attempts_not_negative", relation, "attempt_count >= 0", "error"),
        *[not_null(f"queue_{c}_not_null", relation, c, "error") for c in QUEUE_REQUIRED],
    ]


def store(queue: DataFrame, root: str) -> DataFrame:
    """Store a snapshot as the next version of ``root`` and return it as stored.

    It is written and audited first; a snapshot that breaks an invariant stays invisible.
    """
    with Snapshot(queue.sparkSession, root) as snapshot:
        stored = snapshot.write(RELATION, queue)
        enforce(run_audits({RELATION: stored}, queue_audits()))
    return stored


def gate_states(queue: DataFrame) -> DataFrame:
    """For every activity: how many others are pending, and whether ``publication_gate`` lets it pass."""
    pending = queue.filter(_status(V.PENDING)).agg(F.count(F.lit(1)).alias("n")).scalar()
    others = pending - F.coalesce(_status(V.PENDING), F.lit(False)).cast("long")
    return queue.select("activity_id", "publication_status", others.alias("other_pending_count")).withColumn(
        "is_open", F.coalesce(_status(V.PENDING), F.lit(False)) & (F.col("other_pending_count") == 0))


def publication_gate(queue: DataFrame, activity_id: int) -> None:
    """Refuse to go on unless the activity is pending and no other one is."""
    mine = F.col("activity_id") == activity_id
    others, status = queue.agg(
        F.count_if(_status(V.PENDING) & ~mine), F.max(F.when(mine, F.col("publication_status")))
    ).first()
    if others:
        raise RuntimeError(f"{others} other activities are still {V.PENDING}")
    if status != V.PENDING:
        raise RuntimeError(f"activity {activity_id} must be {V.PENDING}, is {status or 'absent'}")
