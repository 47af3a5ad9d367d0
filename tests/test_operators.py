from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from perkmill.operators import aggregates, asof, joins, quality, ranking, tables

ORDER = ("valid_from", "source_row_number", "source_file")


def _versions(seed, count):
    rng = random.Random(seed)
    first = dt.date(2020, 1, 1)
    rows = []
    for i in range(count):
        start = first + dt.timedelta(days=rng.randrange(400))
        end = None if rng.random() < 0.3 else start + dt.timedelta(days=rng.randrange(120))
        rows.append((rng.choice(["a", "b", "c"]), i, start, end, rng.choice([None, 1, 2, 3]), f"f{i:03d}"))
    return rows


def _brute_force(versions, day, name):
    live = [v for v in versions if v[0] == name and v[2] <= day and (v[3] is None or v[3] >= day)]
    best = max(live, key=lambda v: (v[2], v[4] is None, v[4] or 0, v[5]), default=None)
    return best and best[1]


@pytest.mark.parametrize("broadcast_days", [100_000, 0])
def test_as_of_join_equals_trying_every_version(spark, broadcast_days):
    versions = _versions(7, 60)
    days = [dt.date(2019, 12, 30) + dt.timedelta(days=d) for d in range(0, 560, 3)]
    frame = spark.createDataFrame(
        versions, "name string, value int, valid_from date, valid_to date, source_row_number int, source_file string")
    # One day holds a third of all facts.
    facts = [(i, d) for i, d in enumerate(days + [days[50]] * (len(days) // 2))] + [(-1, None)]
    found = asof.as_of_join(
        spark.createDataFrame(facts, "id int, day date"), frame, "day", "name", "value", ["a", "b", "c"], ORDER,
        broadcast_days,
    ).collect()
    assert len(found) == len(facts)
    for row in found:
        expected = [None] * 3 if row.day is None else [_brute_force(versions, row.day, n) for n in "abc"]
        assert [row.a, row.b, row.c] == expected, row


def test_as_of_join_reaches_the_ends_of_the_calendar(spark):
    frame = spark.createDataFrame(
        [("a", 1, dt.date(1, 1, 1), None, 1, "f")],
        "name string, value int, valid_from date, valid_to date, source_row_number int, source_file string")
    days = spark.createDataFrame([(dt.date(1, 1, 1),), (dt.date(9999, 12, 31),)], "day date")
    found = asof.as_of_join(days, frame, "day", "name", "value", ["a"], ORDER)
    assert [r.a for r in found.collect()] == [1, 1]


def test_latest_by_key_puts_null_first_and_limits_before_the_shuffle(spark):
    frame = spark.createDataFrame([("k", 1, 5), ("k", 1, None), ("k", 0, 9), ("m", None, 1), ("m", 7, 1)],
                                  "k string, a int, b int")
    latest = ranking.latest_by_key(frame, ["k"], ["a", "b"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in latest.collect()) == [("k", 1, None), ("m", None, 1)]
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hash") == 1


def test_batch_boundary(spark):
    frame = spark.createDataFrame([(i % 3, i) for i in range(10)], "t int, id int")
    key = F.struct("t", "id")
    oldest = frame.filter(key <= ranking.batch_boundary(frame, ["t", "id"], 5))
    newest = frame.filter(key >= ranking.batch_boundary(frame, ["t", "id"], 2, newest=True))
    assert sorted(tuple(r) for r in oldest.collect()) == [(0, 0), (0, 3), (0, 6), (0, 9), (1, 1)]
    assert sorted(tuple(r) for r in newest.collect()) == [(2, 5), (2, 8)]
    assert frame.filter("false").filter(key <= ranking.batch_boundary(frame.filter("false"), ["t", "id"], 5)).count() == 0


def test_pivot_and_greatest_value_always_answer(spark):
    empty = spark.createDataFrame([], "name string, value int")
    assert [tuple(r) for r in aggregates.pivot_filtered_max(empty, "name", "value", ["a", "b"]).collect()] == [(None, None)]
    assert aggregates.greatest_value(empty, "value") is None


def test_trailing_window_includes_both_ends(spark):
    days = ["2025-06-20", "2025-06-21", "2026-06-21", "2026-06-22"]
    frame = spark.createDataFrame([(1, d) for d in days], "e int, d string").withColumn("d", F.col("d").cast("date"))
    row = aggregates.trailing_counts(frame, "e", "d", F.lit("2026-06-21").cast("date"), 12).first()
    assert (row.row_count, str(row.first_day), str(row.last_day)) == (2, "2025-06-21", "2026-06-21")


def test_require_unique(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert joins.require_unique(frame, "k").count() == 2
    with pytest.raises(PySparkException, match="duplicate k: 1"):
        joins.require_unique(frame.unionByName(frame.limit(1)), "k").count()


def test_update_rows_touches_affected_rows_only(spark):
    target = spark.createDataFrame([(1, "x", 0), (2, "x", 0), (3, "y", 0), (4, None, 0)], "k int, s string, n int")
    changes = spark.createDataFrame([(1, 7), (3, 8), (9, 9)], "k int, n int")
    updated = joins.update_rows(target, F.col("s") == "x", changes, "k", {"n": F.col("change")["n"]})
    assert sorted(updated.collect()) == sorted([(1, "x", 7), (2, "x", 0), (3, "y", 0), (4, None, 0)])


def test_left_join_default_and_missing_from(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, 5), (1, 6), (None, 1)], "k int, n int")
    joined = joins.left_join_default(left, right, "k", {"n": 0}, match_flag="found")
    assert sorted(map(tuple, joined.fillna(-1, ["k"]).collect())) == [
        (-1, 0, False), (1, 5, True), (1, 6, True), (2, 0, False)]
    assert sorted(str(r.k) for r in joins.missing_from(left, right, "k").collect()) == ["2", "None"]


def test_replace_by_source_file_is_idempotent(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "source_file string, v int")
    new = spark.createDataFrame([("b", 3), ("b", 4)], "source_file string, v int")
    once = tables.replace_by_source_file(stored, new, "b")
    twice = tables.replace_by_source_file(once, new, "b")
    assert sorted(once.collect()) == sorted(twice.collect()) == [("a", 1), ("b", 3), ("b", 4)]
    assert tables.emptied(once).count() == 0 and tables.emptied(once).schema == once.schema


def test_audits_count_null_as_failing(spark):
    frame = spark.createDataFrame([(1, True), (1, False), (None, None)], "k int, record_is_valid boolean")
    checks = [quality.valid_records("valid", "r"), quality.not_null("known", "r", "k"),
              quality.unique("once", "r", "k"), quality.is_true("positive", "r", "k > 0")]
    assert [len(c.failures(frame).collect()) for c in checks] == [2, 1, 1, 1]
    assert quality.failure_counts(frame, checks).first().asDict() == {"valid": 2, "known": 1, "once": 1, "positive": 1}
    assert [tuple(r) for r in checks[2].failures(frame).collect()] == [(1, 2)]


def test_assert_value(spark):
    frame = spark.range(3).agg(F.count(F.lit(1)).alias("n"))
    quality.assert_value(frame, "3")
    with pytest.raises(AssertionError, match="rows: expected 4, got 3"):
        quality.assert_value(frame, "4", "rows")
