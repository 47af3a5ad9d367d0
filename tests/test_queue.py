from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from perkmill import vocabulary as V
from perkmill.plans import announcements, queue as Q
from perkmill.plans.audits import AuditFailure, enforce, run_audits
from perkmill.schemas import QUEUE, RAW
from perkmill.sources.snapshots import read_table
from perkmill.streaming import queue_merge

T0 = dt.datetime(2026, 6, 21, 12, 0)


def at(minutes):
    return F.lit(str(T0 + dt.timedelta(minutes=minutes))).cast("timestamp")


@pytest.fixture
def facts(spark):
    rows = [(i, 7, T0 + dt.timedelta(hours=i), "Tennis", None, 600, "  a \t b " if i == 2 else None, "s")
            for i in range(1, 6)]
    return spark.createDataFrame(
        rows, "activity_id int, employee_id int, activity_start_datetime timestamp_ntz, sport_type string, "
              "distance_meters decimal(18,6), elapsed_seconds int, activity_comment string, source_system string")


@pytest.fixture
def pending(spark, facts):
    return Q.synchronise(spark.createDataFrame([], QUEUE), facts, at(0))


def states(queue):
    return {r.activity_id: r.publication_status for r in queue.collect()}


def test_merge_inserts_once(pending, facts):
    assert pending.schema.names == QUEUE.names and states(pending) == dict.fromkeys(range(1, 6), V.PENDING)
    started = Q.claim_batch(pending, 2, now=at(1))[0]
    again = Q.synchronise(started, facts, at(9))
    assert sorted(map(str, again.collect())) == sorted(map(str, started.collect()))


def test_a_repeated_new_activity_fails(spark, facts):
    with pytest.raises(PySparkException, match="duplicate activity_id: 1"):
        Q.synchronise(spark.createDataFrame([], QUEUE), facts.unionByName(facts.limit(1))).count()


def test_claim_takes_the_oldest_and_never_twice(pending):
    preview = [r.activity_id for r in Q.preview_batch(pending, 2).collect()]
    queue, batch = Q.claim_batch(pending, 2, now=at(1))
    assert sorted(r.activity_id for r in batch.collect()) == preview == [1, 2]
    assert [r.attempt_count for r in queue.orderBy("activity_id").collect()] == [1, 1, 0, 0, 0]
    assert sorted(r.activity_id for r in Q.claim_batch(queue, 10, now=at(2))[1].collect()) == [3, 4, 5]
    assert Q.claim_batch(Q.claim_batch(queue, 10)[0], 1)[1].count() == 0


def test_stale_claims_expire_and_errors_are_retried_on_request(pending):
    queue = Q.claim_batch(pending, 1, now=at(0))[0]
    assert states(Q.expire_stale_claims(queue, 15, at(15)))[1] == V.IN_PROGRESS
    expired = Q.expire_stale_claims(queue, 15, at(16))
    assert expired.filter("activity_id = 1").first().last_error == V.STALE_CLAIM_ERROR
    assert [r.activity_id for r in Q.preview_batch(expired, 1).collect()] == [2]
    retried, batch = Q.claim_batch(expired, 1, retry_errors=True, now=at(20))
    row = retried.filter("activity_id = 1").first()
    assert [r.activity_id for r in batch.collect()] == [1] and (row.attempt_count, row.last_error) == (2, None)


@pytest.mark.parametrize("keep, kept", [(0, []), (2, [4, 5]), (5, [1, 2, 3, 4, 5]), (50, [1, 2, 3, 4, 5])])
def test_backfill(pending, keep, kept):
    found = states(Q.backfill(pending, keep, at(1)))
    assert [a for a, s in sorted(found.items()) if s == V.PENDING] == kept


def test_a_batch_from_claim_to_repaired_link(spark, pending):
    queue, batch = announcements.start_batch(pending, 4, at(1))
    messages = {r.activity_id: r.message for r in batch.collect()}
    assert messages[2].splitlines() == [
        "Nouvelle activité sportive", "Activité : Tennis", "Salarié : 7", "Début : 21/06/2026 à 14:00 UTC",
        "Distance : non renseignée", "Durée : 10 min 00 s", "Identifiant activité : 2", "Commentaire : a b"]
    assert len(messages[1].splitlines()) == 7
    schema = "activity_id long, error string, http_status int, body string"
    sent = '{"ok":true,"channel":"C1","ts":"%d.0"}'
    deliveries = spark.createDataFrame(
        [(1, None, 200, sent % 1), (2, "x" * 3000, None, None), (3, None, 200, sent % 3), (5, None, 200, sent % 5)], schema)
    links = spark.createDataFrame(
        [(1, None, 200, '{"ok":true,"permalink":"https://l/1"}'), (3, None, 200, '{"ok":false,"error":"gone"}')], schema)
    done = announcements.finish_batch(queue, deliveries, links, at(2))
    rows = {r.activity_id: r for r in done.collect()}
    assert states(done) == {1: V.PUBLISHED, 2: V.ERROR, 3: V.PUBLISHED, 4: V.IN_PROGRESS, 5: V.PENDING}
    assert (rows[1].slack_permalink, rows[1].last_error, rows[1].slack_message_ts) == ("https://l/1", None, "1.0")
    assert len(rows[2].last_error) == 2000 and rows[3].last_error == "PERMALINK_SLACK_ERROR: gone"
    assert [tuple(r) for r in Q.links_to_repair(done, 9).collect()] == [(3, "C1", "3.0")]
    repaired = Q.apply_links(done, announcements.link_results(spark.createDataFrame(
        [(3, None, 200, '{"ok":true,"permalink":"https://l/3"}'), (2, None, 200, '{"ok":true,"permalink":"p"}')], schema)),
        at(3))
    again = {r.activity_id: (r.slack_permalink, r.publication_status) for r in repaired.collect()}
    assert again[3] == ("https://l/3", V.PUBLISHED) and again[2] == (None, V.ERROR)


def test_arguments_are_checked(pending):
    for call in (lambda: Q.claim_batch(pending, 0), lambda: Q.preview_batch(pending, -1),
                 lambda: Q.expire_stale_claims(pending, 0), lambda: Q.backfill(pending, -1)):
        with pytest.raises(ValueError):
            call()


def test_gate_and_invariants(pending):
    Q.publication_gate(Q.backfill(pending, 1), 5)
    with pytest.raises(RuntimeError, match="4 other"):
        Q.publication_gate(pending, 5)
    with pytest.raises(RuntimeError, match="absent"):
        Q.publication_gate(Q.backfill(pending, 0), 77)
    name = "slack_publication_queue"
    enforce(run_audits({name: pending}, Q.queue_audits()))
    broken = pending.unionByName(pending.limit(1)).withColumn("attempt_count", F.lit(-1))
    with pytest.raises(AuditFailure, match="unique: 1; queue_attempts_not_negative: 6"):
        enforce(run_audits({name: broken}, Q.queue_audits()))


def test_only_sound_snapshots_become_visible(spark, pending, tmp_path):
    root = str(tmp_path / "ops")
    stored = Q.store(pending, root)
    assert states(stored) == states(pending) and stored.count() == 5
    with pytest.raises(AuditFailure, match="queue_status_is_known: 5"):
        Q.store(stored.withColumn("publication_status", F.lit("LOST")), root)
    assert states(read_table(spark, root, Q.RELATION)) == dict.fromkeys(range(1, 6), V.PENDING)


def test_stream_merges_arrivals_once(spark, tmp_path):
    folder, queue_path, state = (str(tmp_path / n) for n in ("arriving", "queue", "state"))
    queue_merge.create_queue(spark, queue_path)

    def arrive(*ids):
        rows = [("f", str(i), str(i), "7", "2026-06-21 18:30:00", "Tennis", "", "2026-06-21 19:00:00",
                 "0" if i == 3 else "1800", None, "s") for i in ids]
        spark.createDataFrame(rows, RAW["sport_activities_txt"]).write.mode("append").parquet(folder)

    def run(checkpoint):
        queue_merge.merge_stream(
            queue_merge.read_activity_stream(spark, folder), queue_path, checkpoint, at(0)).awaitTermination()
        return sorted(r.activity_id for r in spark.read.parquet(queue_path).collect())

    arrive(1, 2, 3)
    assert run(state) == [1, 2]
    arrive(2, 4)
    assert run(state) == [1, 2, 4]
    # Everything replayed from the start, as after a lost checkpoint: nothing is added twice.
    arrive(5)
    stored = spark.read.parquet(queue_path)
    batch = spark.read.parquet(folder).dropDuplicates(["activity_id"])
    queue_merge.append_batch(batch, queue_path, at(0))
    queue_merge.append_batch(batch, queue_path, at(0))
    assert sorted(r.activity_id for r in spark.read.parquet(queue_path).collect()) == [1, 2, 4, 5]
    assert stored.schema == spark.read.schema(QUEUE).parquet(queue_path).schema


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_stream_numbers_files_without_lineage(spark, tmp_path, format):
    folder, queue_path, state = (str(tmp_path / n) for n in ("arriving", "queue", "state"))
    queue_merge.create_queue(spark, queue_path)
    rows = [(str(i), "7", "2026-06-21 18:30:00", "Tennis", "", "2026-06-21 19:00:00",
             "0" if i == 3 else "1800", None, "s") for i in range(1, 6)]
    files = spark.createDataFrame(rows, RAW["sport_activities_txt"][2:]).coalesce(1)
    files.write.format(format).option("header", True).save(folder)
    queue_merge.merge_stream(
        queue_merge.read_activity_stream(spark, folder, format), queue_path, state, at(0)).awaitTermination()
    assert sorted(r.activity_id for r in spark.read.parquet(queue_path).collect()) == [1, 2, 4, 5]
    invalid = spark.read.parquet(queue_merge.invalid_rows_path(queue_path)).collect()
    assert [(r.activity_id, r.source_row_number, bool(r.source_file)) for r in invalid] == [(3, 4, True)]
