from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from perkmill.plans import routes
from perkmill.plans.load import load_sources, read_loaded, reset
from perkmill.plans.workspace import Workspace
from perkmill.schemas import HR_SOURCE, PROFILE_SOURCE, RAW
from perkmill.sources import readers, releases, snapshots

HEADER = "ID salarié,Pratique d'un sport"


def _write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")
    return path


def test_contracted_csv_keeps_text_and_numbers_rows(spark, tmp_path):
    path = _write(tmp_path, "profiles.csv", HEADER, "007,Tennis", "8,", "NA, null ", '9,"a, ""b"""')
    rows = readers.read_contracted(spark, PROFILE_SOURCE, path).orderBy("source_row_number").collect()
    assert [tuple(r) for r in rows] == [
        ("profiles.csv", "2", "007", "Tennis"), ("profiles.csv", "3", "8", ""),
        ("profiles.csv", "4", "NA", " null "), ("profiles.csv", "5", "9", 'a, "b"')]


def test_rows_are_numbered_across_blocks_and_files(spark, tmp_path):
    for file, count in (("a.csv", 5000), ("b.csv", 700)):
        _write(tmp_path / "in", file, HEADER, *[f"{i},{file}" for i in range(2, count + 2)])
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "9000")
    try:
        read = readers.read_contracted(spark, PROFILE_SOURCE, str(tmp_path / "in"))
        wrong = read.filter((F.col("employee_id") != F.col("source_row_number"))
                            | (F.col("declared_sport") != F.col("source_file"))).count()
        assert (read.count(), wrong) == (5700, 0)
    finally:
        spark.conf.set(setting, before)


def test_line_breaks_inside_values(spark, tmp_path):
    path = _write(tmp_path, "p.csv", HEADER, '1,"two', 'lines"', "2,x")
    rows = readers.read_contracted(spark, PROFILE_SOURCE, path, multi_line=True).orderBy("source_row_number").collect()
    assert [tuple(r)[1:] for r in rows] == [("2", "1", "two\nlines"), ("3", "2", "x")]


def test_contracted_parquet(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.createDataFrame([("1", None), ("2", "x")], PROFILE_SOURCE.source_columns).coalesce(1).write.parquet(path)
    rows = readers.read_contracted(spark, PROFILE_SOURCE, path, "parquet").orderBy("source_row_number").collect()
    assert [tuple(r)[1:] for r in rows] == [("2", "1", ""), ("3", "2", "x")]


@pytest.mark.parametrize("header", ["Pratique d'un sport,ID salarié", "ID salarié", "id salarié,Pratique d'un sport"])
def test_another_header_raises(spark, tmp_path, header):
    path = _write(tmp_path, "p.csv", header, "1,2")
    with pytest.raises(readers.HeaderMismatch):
        readers.read_contracted(spark, PROFILE_SOURCE, path)


def test_load_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "raw")
    profiles = _write(tmp_path, "profiles.csv", HEADER, "1,Tennis")
    people = _write(tmp_path, "people.csv", ",".join(HR_SOURCE.source_columns), ",".join("abcdefghijk"))
    paths = {HR_SOURCE.relation: people, PROFILE_SOURCE.relation: profiles}
    version = load_sources(spark, paths, root)
    with pytest.raises(Exception):
        load_sources(spark, {**paths, PROFILE_SOURCE.relation: str(tmp_path / "absent.csv")}, root)
    assert snapshots.committed_version(spark, root) == version
    assert snapshots.read_table(spark, root, "hr_employees_txt").first().employee_id == "a"
    assert reset(spark, root) == version + 1
    assert {n: snapshots.read_table(spark, root, n).count() for n in RAW} == dict.fromkeys(RAW, 0)
    assert snapshots.read_table(spark, root, "hr_employees_txt", version).count() == 1


def test_a_failed_snapshot_stays_invisible(spark, tmp_path):
    root = str(tmp_path)
    first = snapshots.write_snapshot(spark, root, {"t": spark.range(3)})
    with pytest.raises(RuntimeError):
        with snapshots.Snapshot(spark, root) as snapshot:
            snapshot.write("t", spark.range(9))
            raise RuntimeError("lost")
    assert snapshots.committed_version(spark, root) == first and snapshots.read_table(spark, root, "t").count() == 3
    assert snapshots.write_snapshot(spark, root, {"t": spark.range(4)}) == first + 2


def test_overwriting_one_source_file(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "v int, source_file string"
    snapshots.overwrite_source_files(spark.createDataFrame([(1, "a"), (2, "b")], schema), path)
    snapshots.overwrite_source_files(spark.createDataFrame([(3, "b")], schema), path)
    assert sorted((r.v, r.source_file) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]


def test_route_candidates_and_responses(spark, raw_frame):
    people = raw_frame("hr_employees_txt", [
        {"employee_id": e, "home_address": h, "commute_mode": m} for e, h, m in [
            ("99", "x", "Marche/running"), ("1000", " y ", " Vélo/Trottinette/Autres"), ("5", "z", "Voiture"),
            ("6", "  ", "Marche/running"), ("1000", "y", "Vélo/Trottinette/Autres"), ("7", "w", "Marche/running")]])
    nothing = spark.createDataFrame([], RAW["google_routes_responses_txt"])
    first = routes.route_candidates(people, nothing, "Office", limit=2)
    assert [(r.employee_id, r.google_travel_mode) for r in first.collect()] == [("1000", "BICYCLE"), ("7", "WALK")]
    captured = first.select("request_key", F.lit(None).cast("string").alias("error"), F.lit(500).alias("http_status"),
                            F.lit("{}").alias("body"))
    stored = readers.append_responses(nothing, routes.response_rows(first, captured, "Office"))
    assert {r.response_http_status for r in stored.collect()} == {"500"}
    left = routes.route_candidates(people, stored, "Office", limit=9)
    assert [r.employee_id for r in left.collect()] == ["99"]
    assert routes.route_candidates(people, stored, "Office", limit=9, retry_failed=True).count() == 3
    assert readers.append_responses(stored, stored).count() == stored.count()
    nameless = stored.withColumn("request_key", F.lit(None).cast("string"))
    assert readers.append_responses(stored, nameless).count() == 2 * stored.count()


def test_arrivals_with_an_extra_column_are_appended(raw_frame):
    from pyspark.sql import functions as F

    from perkmill.sources.readers import append_responses
    stored = raw_frame("google_routes_responses_txt", [{"request_key": "a", "requested_at": "2026-01-01"}])
    arrived = raw_frame("google_routes_responses_txt", [
        {"request_key": "a", "requested_at": "2026-01-02"}, {"request_key": "b", "requested_at": "2026-01-02"},
        {"requested_at": "2026-01-03"}]).withColumn("batch", F.lit(7))
    out = append_responses(stored, arrived)
    assert out.columns == stored.columns
    assert sorted(r.request_key or "" for r in out.collect()) == ["", "a", "b"]


def test_loaded_rows_are_numbered_on_reading(spark, tmp_path):
    """Text is written once with its place; numbers come from block counts, without a job and without shuffling rows."""
    for file, count in (("a.csv", 5000), ("b.csv", 700), ("c.csv", 0)):
        _write(tmp_path / "in", file, HEADER, *[f"{i},{file}" for i in range(2, count + 2)])
    people = _write(tmp_path, "people.csv", ",".join(HR_SOURCE.source_columns), ",".join("abcdefghijk"))
    root, setting = str(tmp_path / "raw"), "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "9000")
    try:
        load_sources(spark, {HR_SOURCE.relation: people, PROFILE_SOURCE.relation: str(tmp_path / "in")}, root)
    finally:
        spark.conf.set(setting, before)
    blocks = snapshots.read_table(spark, root, f"{PROFILE_SOURCE.relation}_blocks")
    assert blocks.count() > 5 and blocks.select("__path").distinct().count() == 2
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    rows = read_loaded(spark, root, PROFILE_SOURCE.relation)
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows.columns == RAW[PROFILE_SOURCE.relation].names
    wrong = rows.filter((F.col("employee_id") != F.col("source_row_number")) | (F.col("declared_sport") != F.col("source_file")))
    assert (rows.count(), wrong.count()) == (5700, 0)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert read_loaded(spark, root, HR_SOURCE.relation).first().source_row_number == "2"
    reset(spark, root)
    assert read_loaded(spark, root, PROFILE_SOURCE.relation).count() == 0


def test_large_offsets_are_joined_without_a_broadcast_hint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("perkmill.plans.load.BROADCAST_BYTES", 0)
    profiles = _write(tmp_path, "profiles.csv", HEADER, "1,Tennis", "2,")
    people = _write(tmp_path, "people.csv", ",".join(HR_SOURCE.source_columns), ",".join("abcdefghijk"))
    load_sources(spark, {HR_SOURCE.relation: people, PROFILE_SOURCE.relation: profiles}, str(tmp_path / "raw"))
    rows = read_loaded(spark, str(tmp_path / "raw"), PROFILE_SOURCE.relation).orderBy("source_row_number").collect()
    assert [tuple(r) for r in rows] == [("profiles.csv", "2", "1", "Tennis"), ("profiles.csv", "3", "2", "")]


def test_areas_are_released_together(spark, tmp_path):
    root = str(tmp_path)
    assert releases.released(spark, root) == {}
    releases.publish(spark, root, {"marts": 1, "audit": 1})
    second = releases.publish(spark, root, {"marts": 2})
    assert releases.released(spark, root) == {"marts": 2, "audit": 1}
    assert releases.released(spark, root, second - 1) == {"marts": 1, "audit": 1}


def test_a_reset_that_fails_changes_nothing(spark, raw_frame, tmp_path, monkeypatch):
    space = Workspace(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        space.queue()
    space.store_raw({"sport_activities_txt": raw_frame("sport_activities_txt", [{"activity_id": "1"}])})
    queue = space.create_queue()
    assert space.create_queue().store.root == queue.store.root
    queue.append_batch(raw_frame("sport_activities_txt", [
        {"activity_id": "1", "employee_id": "2", "activity_start_datetime": "2026-01-01 10:00:00", "sport_type": "x",
         "activity_end_datetime": "2026-01-01 11:00:00", "elapsed_seconds": "60"}]), "s", 0)

    def state():
        return {**{name: df.count() for name, df in space.raw().items()}, "queue": space.queue().read().count()}

    filled = {**dict.fromkeys(RAW, 0), "sport_activities_txt": 1, "queue": 1}
    assert state() == filled

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr("perkmill.plans.workspace.publish", lost)
        with pytest.raises(RuntimeError):
            space.reset()
    assert state() == filled
    space.reset()
    assert state() == dict.fromkeys(filled, 0)
