"""The queue on storage: what is written, what is read, batches and their ledger."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from perkmill import vocabulary as V
from perkmill.operators import joins, ranking
from perkmill.plans import announcements, queue as Q
from perkmill.plans.audits import AuditFailure
from perkmill.plans.queue_store import QueueStore
from perkmill.schemas import QUEUE, RAW
from perkmill.session import checkpoint
from perkmill.sources.snapshots import table_path
from perkmill.streaming import queue_merge

T0 = dt.datetime(2026, 6, 21, 12, 0)
RESPONSE = "activity_id long, error string, http_status int, body string"


def at(minutes):
    return F.lit(str(T0 + dt.timedelta(minutes=minutes))).cast("timestamp")


def facts(spark, ids):
    rows = [(i, 7, T0 + dt.timedelta(minutes=i), "Tennis", None, 600, None, "s") for i in ids]
    return spark.createDataFrame(rows, "activity_id int, employee_id int, activity_start_datetime timestamp_ntz, sport_type string, "
                                       "distance_meters decimal(38,10), elapsed_seconds int, activity_comment string, source_system string")


@pytest.fixture
def store(spark, tmp_path):
    made = QueueStore(spark, str(tmp_path / "queue")).create()
    made.synchronise(facts(spark, range(1, 201)), at(0))
    made.store.compact()
    return made


def files(folder):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(folder) for n in names}


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_every_transition_equals_the_snapshot_function(spark, store):
    sent = [(i, None, 200, '{"ok":true,"channel":"C1","ts":"%d.0"}' % i) if i % 3 else (i, "lost", None, None) for i in range(1, 41)]
    deliveries = spark.createDataFrame(sent, RESPONSE)
    links = spark.createDataFrame([(i, None, 200, '{"ok":true,"permalink":"https://l/%d"}' % i) for i in range(1, 41, 2)], RESPONSE)
    repaired = spark.createDataFrame([(2, None, 200, '{"ok":true,"permalink":"https://l/2"}')], RESPONSE)
    plain = Q.synchronise(spark.createDataFrame([], QUEUE), facts(spark, range(1, 201)), at(0))
    plain, batch = Q.claim_batch(plain, 40, now=at(1))
    assert rows(store.claim(40, now=at(1))) == rows(batch)
    plain = announcements.finish_batch(plain, deliveries, links, at(2))
    store.settle(deliveries, links, at(2))
    plain = Q.apply_links(plain, announcements.link_results(repaired), at(3))
    store.repair_links(repaired, at(3))
    plain = Q.claim_batch(plain, 5, True, at(4))[0]
    store.claim(5, True, at(4))
    store.store.compact()
    plain = Q.expire_stale_claims(plain, 10, at(40))
    store.expire_stale_claims(10, at(40))
    plain = Q.backfill(plain, 100, at(50))
    store.backfill(100, at(50))
    plain = checkpoint(plain)
    assert rows(store.read()) == rows(plain)
    for status in V.PUBLICATION_STATUSES:
        assert rows(store.read(status)) == rows(plain.filter(F.col("publication_status") == status))


def test_a_claim_writes_its_rows_and_nothing_else(spark, store):
    before = files(store.store.root)
    store.claim(40, now=at(1))
    after = files(store.store.root)
    assert {k: after[k] for k in before} == before
    new = spark.read.parquet(table_path(spark, f"{store.store.root}/log", "rows", max(store.store.entries())))
    assert new.count() == 40 and {r.publication_status for r in new.collect()} == {V.IN_PROGRESS}
    assert store.read(V.PENDING).count() == 160 and store.read().count() == 200


def test_only_the_asked_statuses_are_opened(store):
    store.claim(40, now=at(1))
    plan = store.read(V.PUBLISHED)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and f"publication_status#" in plan and "BroadcastHashJoin" in plan
    assert store.read(V.PUBLISHED).count() == 0


def test_unsound_changes_stay_unseen(store):
    before = rows(store.read())
    with pytest.raises(AuditFailure, match="queue_attempts_not_negative"):
        store._change(lambda: store.read(V.PENDING).limit(1).withColumn("attempt_count", F.lit(-1)))
    assert rows(store.read()) == before
    assert store.claim(3, now=at(1)).count() == 3  # the next change is not held up


def test_compaction_and_removal_keep_the_rows(spark, store):
    store.claim(40, now=at(1))
    expected = rows(store.read())
    store.store.compact()
    store.store.remove_superseded()
    assert rows(store.read()) == expected
    with pytest.raises(FileExistsError):
        store.create()
    store.reset()
    assert store.read().count() == 0 and store.synchronise(facts(spark, [5])).count() == 1


def test_a_repeated_new_activity_fails(spark, store):
    with pytest.raises(PySparkException, match="duplicate activity_id: 900"):
        store.synchronise(facts(spark, [900, 900, 901]))
    assert store.read().count() == 200


def raw(spark, ids, invalid=()):
    made = [("f", str(i), str(i), "7", "2026-06-21 18:30:00", "Tennis", "", "2026-06-21 19:00:00", "0" if i in invalid else "1800", None, "s")
            for i in ids]
    return spark.createDataFrame(made, RAW["sport_activities_txt"])


def test_ledger_of_batches(spark, store):
    store.append_batch(raw(spark, [199, 200, 201, 202, 203], {203}), "a", 0, at(5))
    again = rows(store.read())
    store.append_batch(raw(spark, [199, 200, 201, 202, 203], {203}), "a", 0, at(6))  # replayed
    store.append_batch(raw(spark, [199, 200, 201, 202, 203], {203}), "b", 0, at(7))  # from a lost checkpoint
    store.append_batch(raw(spark, []), "a", 1, at(8))
    assert sorted(tuple(r) for r in store.ledger().collect()) == [("a", 0, 5, 2, 2, 1), ("a", 1, 0, 0, 0, 0), ("b", 0, 5, 0, 4, 1)]
    assert rows(store.read()) == again
    assert sorted((r.activity_id, r.source_row_number) for r in store.invalid_rows().collect()) == [(203, 203), (203, 203)]


def test_a_failed_batch_leaves_nothing_and_can_be_repeated(spark, store, monkeypatch):
    def lost(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr("perkmill.plans.queue_store._audited", lost)
    with pytest.raises(RuntimeError, match="executor lost"):
        store.append_batch(raw(spark, [300]), "a", 0, at(5))
    monkeypatch.undo()
    assert store.read().count() == 200 and store.ledger().count() == 0
    store.append_batch(raw(spark, [300]), "a", 0, at(5))
    assert store.read().count() == 201 and [r.queued for r in store.ledger().collect()] == [1]


def test_stream_into_the_store(spark, tmp_path):
    folder, made = str(tmp_path / "arriving"), QueueStore(spark, str(tmp_path / "queue")).create()
    raw(spark, [1, 2, 3], {3}).write.parquet(folder)
    for source in ("first", "first", "second"):
        queue_merge.merge_into_store(queue_merge.read_activity_stream(spark, folder), made, str(tmp_path / source), source, at(0)).awaitTermination()
    assert sorted(tuple(r) for r in made.ledger().collect()) == [("first", 0, 3, 2, 0, 1), ("second", 0, 3, 0, 2, 1)]
    assert sorted(r.activity_id for r in made.read().collect()) == [1, 2]


# -- lookups by the small side --------------------------------------------------------

def test_the_stored_side_is_not_exchanged(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.range(0, 50_000, 2).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(path)
    stored = spark.read.parquet(path)
    spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (49_999, "d"), (49_998, "e")], "k long, v string").write.parquet(path + "-batch")
    batch = spark.read.parquet(path + "-batch")
    small = joins.missing_of_batch(batch, stored, "k")
    assert sorted(r.v for r in small.collect()) == ["a", "c", "d"]
    plan = small._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("Initial Plan")]
    # The only exchange by key is that of the keys found, above the semi join.
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("LeftSemi")
    large = joins.missing_of_batch(batch, stored, "k", most_bytes=0)
    assert sorted(r.v for r in large.collect()) == ["a", "c", "d"]


def test_unique_or_fail_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    assert sorted(r.v for r in joins.unique_or_fail(df, "k").collect()) == ["a", "b", "c"]
    with pytest.raises(PySparkException, match="duplicate k: NULL"):
        joins.unique_or_fail(df.unionByName(df.filter("k is null")), "k").collect()


# -- batches of any size --------------------------------------------------------------

@pytest.mark.parametrize("newest", [False, True])
@pytest.mark.parametrize("size", [1, 7, 300, 999, 1000, 5000])
def test_boundary_by_descent(spark, size, newest):
    moments = [T0 + dt.timedelta(seconds=(i * i) % 700 - 350 + (10 ** 7 if i % 50 == 0 else 0)) for i in range(1000)]
    df = spark.createDataFrame([(m, i * 97 - 5000) for i, m in enumerate(moments)], "m timestamp_ntz, i long")
    ordered = sorted(((m, i * 97 - 5000) for i, m in enumerate(moments)), reverse=newest)
    found = ranking.kth_key(df, ["m", "i"], size, newest, most_sorted=20)
    assert found == ordered[min(size, len(ordered)) - 1]


def test_boundary_of_nothing_and_of_large_batches(spark, store, monkeypatch):
    assert ranking.kth_key(spark.createDataFrame([], "m timestamp, i long"), ["m", "i"], 5) is None
    expected = rows(Q.backfill(store.read(), 120, at(1)))
    monkeypatch.setattr(ranking, "MOST_SORTED", 10)
    assert rows(Q.backfill(store.read(), 120, at(1))) == expected
    assert Q.claim_batch(store.read(), 150, now=at(1))[1].count() == 150
