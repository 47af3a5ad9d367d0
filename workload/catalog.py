"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from perkmill import vocabulary as V
from perkmill.functions import announcement, casting, jsontext, measures, responses, text
from perkmill.operators import aggregates, asof, joins, quality, ranking, tables
from perkmill.operators.projection import valid_rows
from perkmill.plans import announcements, audits, marts, parameters, queue as Q, refresh, reports, routes, staging
from perkmill.plans.queue_store import QueueStore
from perkmill.plans.workspace import Workspace
from perkmill.schemas import QUEUE, RAW, SOURCES, SourceSpec
from perkmill.session import checkpoint, shared_folder
from perkmill.sources import readers
from perkmill.sources.readers import append_responses
from perkmill.streaming import queue_merge
from workload.standins import OFFICE, standin, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = "2000-01-01 00:00:00"
BATCH = 40


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def now():
    return F.lit(NOW).cast("timestamp")


def portable(df: DataFrame) -> DataFrame:
    """Zoned timestamps as zone-less UTC ones, which both engines show alike."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name) for f in df.schema.fields
    ])


# -- inputs ---------------------------------------------------------------------------

def raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: standin(spark, sf, name) for name in RAW}


class _Staged(dict):
    """Typed relations, each planned when it is first asked for."""

    def __init__(self, spark: SparkSession, sf: str):
        super().__init__()
        self.inputs = (spark, sf)
        self.plans = {model: (relation, plan) for model, relation, plan in refresh.STAGING_MODELS}

    def __missing__(self, model: str) -> DataFrame:
        relation, plan = self.plans[model]
        self[model] = plan(standin(*self.inputs, relation))
        return self[model]


def staged(spark: SparkSession, sf: str) -> _Staged:
    return _Staged(spark, sf)


def built(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return refresh.build_marts(staged(spark, sf))


def commute_mart(spark: SparkSession, sf: str) -> DataFrame:
    models = staged(spark, sf)
    return marts.commute_bonus(
        models["stg_hr_employees"], models["stg_google_routes_responses"], models["config_benefit_parameters"],
        marts.activity_fact(models["stg_sport_activities"]))


def wellbeing_mart(spark: SparkSession, sf: str) -> DataFrame:
    models = staged(spark, sf)
    return marts.wellbeing(
        models["stg_hr_employees"], models["stg_employee_sport_profile"], models["config_benefit_parameters"],
        marts.activity_fact(models["stg_sport_activities"]))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return marts.activity_fact(staging.sport_activities(standin(spark, sf, "sport_activities_txt")))


def history(spark: SparkSession, sf: str) -> DataFrame:
    return staging.benefit_parameters(standin(spark, sf, "parameter_history_txt"))


def queue(spark: SparkSession, sf: str) -> DataFrame:
    df = standin(spark, sf, "queue")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUEUE.fields])


# -- scalar functions -----------------------------------------------------------------

@query
def clean_text(spark, sf):
    return standin(spark, sf, "sport_activities_txt").select(
        "activity_id", text.clean_text(F.col("activity_comment")).alias("activity_comment"),
        text.clean_text(F.col("distance_meters")).alias("distance_meters"),
    )


@query
def safe_cast_integer(spark, sf):
    return standin(spark, sf, "hr_employees_txt").select(
        "employee_id", casting.safe_cast(F.col("employee_id"), "integer").alias("id_value"),
        casting.safe_cast(F.col("employee_id"), "bigint").alias("id_long"),
        casting.safe_cast(F.col("paid_leave_days"), "integer").alias("leave_value"),
        casting.safe_cast(F.col("home_address"), "integer").alias("address_value"),
    )


@query
def safe_cast_numeric(spark, sf):
    return standin(spark, sf, "sport_activities_txt").select(
        "activity_id", casting.safe_cast(F.col("distance_meters"), "numeric").alias("distance_value"),
        casting.safe_cast(F.col("elapsed_seconds"), "numeric").alias("elapsed_value"),
    )


@query
def safe_cast_date(spark, sf):
    return standin(spark, sf, "parameter_history_txt").select(
        "parameter_comment", casting.safe_cast(F.col("valid_from"), "date").alias("from_value"),
        casting.safe_cast(F.col("valid_to"), "date").alias("to_value"),
    ).unionByName(standin(spark, sf, "hr_employees_txt").select(
        F.col("last_name").alias("parameter_comment"),
        casting.safe_cast(F.col("birth_date"), "date").alias("from_value"),
        casting.safe_cast(F.col("hire_date"), "date").alias("to_value"),
    ))


@query
def safe_cast_timestamp(spark, sf):
    return standin(spark, sf, "sport_activities_txt").select(
        "activity_id", casting.safe_cast(F.col("activity_start_datetime"), "timestamp").alias("start_value"),
        casting.safe_cast(F.col("activity_end_datetime"), "timestamp").alias("end_value"),
    )


@query
def safe_cast_timestamp_zone(spark, sf):
    return portable(standin(spark, sf, "google_routes_responses_txt").select(
        "request_key", casting.safe_cast(F.col("requested_at"), "timestamp with time zone").alias("requested_value"),
    ))


@query
def json_validation(spark, sf):
    return standin(spark, sf, "google_routes_responses_txt").select(
        "request_key", casting.safe_cast(F.col("response_payload_json"), "jsonb").alias("document"),
    )


@query
def json_path_text(spark, sf):
    document = casting.safe_cast(F.col("response_payload_json"), "jsonb")
    return standin(spark, sf, "google_routes_responses_txt").select(
        "request_key", jsontext.json_path(document, "routes[0].distanceMeters").alias("distance_text"),
        jsontext.json_path(document, "routes[0].duration").alias("duration_text"),
    )


@query
def normalise_labels(spark, sf):
    return standin(spark, sf, "employee_sport_profile_txt").select(
        "source_file", "employee_id",
        text.normalise_label(F.col("declared_sport"), V.SPORT_SPELLINGS).alias("sport_type"),
    )


@query
def whitespace_and_truncation(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", text.collapse_whitespace(F.col("text")).alias("one_line"),
        text.strip_all(F.col("text")).alias("stripped"),
        F.substring("text", 1, V.ERROR_TEXT_LENGTH).alias("truncated"),
    )


@query
def calendar_and_units(spark, sf):
    start = F.col("activity_start_datetime")
    return fact(spark, sf).select(
        "activity_id", measures.month_start(start).alias("month"), start.cast("date").alias("day"),
        measures.months_before(start.cast("date"), 12).alias("year_before"),
        measures.seconds_to_minutes(F.col("elapsed_seconds")).alias("minutes"),
        measures.metres_to_km(F.col("elapsed_seconds")).alias("kilometres"),
    )


@query
def announcement_text(spark, sf):
    return Q.with_announcement(queue(spark, sf)).select(
        "activity_id", announcement.distance_text(F.col("distance_meters")).alias("distance_text"),
        announcement.duration_text(F.col("elapsed_seconds")).alias("duration_text"), "message",
    )


@query
def request_keys(spark, sf):
    return routes.route_requests(standin(spark, sf, "hr_employees_txt"), OFFICE).drop("employee_id_text")


@query
def response_classes(spark, sf):
    captured = standin(spark, sf, "all_deliveries")
    error, status, body = F.col("error"), F.col("http_status"), F.col("body")
    outcome = responses.route_status(error, status, body)
    return captured.select(
        "activity_id", outcome.alias("status_text"), responses.route_payload(error, body).alias("payload"),
        responses.is_failed_status(outcome).alias("is_failure"),
    )


@query
def delivery_outcomes(spark, sf):
    return standin(spark, sf, "all_deliveries").select(
        "activity_id", responses.delivery_outcome(F.col("error"), F.col("http_status"), F.col("body")).alias("o")
    ).select("activity_id", "o.*")


@query
def link_outcomes(spark, sf):
    return announcements.link_results(standin(spark, sf, "all_links"))


# -- typed and validated relations ----------------------------------------------------

@query
def stg_hr_employees(spark, sf):
    return staged(spark, sf)["stg_hr_employees"]


@query
def stg_employee_sport_profile(spark, sf):
    return staged(spark, sf)["stg_employee_sport_profile"]


@query
def stg_sport_activities(spark, sf):
    return staged(spark, sf)["stg_sport_activities"]


@query
def stg_google_routes_responses(spark, sf):
    return portable(staged(spark, sf)["stg_google_routes_responses"])


@query
def config_benefit_parameters(spark, sf):
    return history(spark, sf)


@query
def row_validation_flags(spark, sf):
    df = staged(spark, sf)["stg_sport_activities"]
    flags = [c for c in df.columns if c.startswith("has_valid_")]
    return df.groupBy(*flags, "record_is_valid").agg(F.count(F.lit(1)).alias("row_count"))


@query
def valid_rows_only(spark, sf):
    return valid_rows(staged(spark, sf)["stg_google_routes_responses"]).select(
        "request_key", "employee_id", "route_distance_meters", "route_distance_km", "route_duration_seconds"
    )


@query
def validity_null_semantics(spark, sf):
    return history(spark, sf).groupBy("parameter_name", "record_is_valid").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(quality.holds(F.col("record_is_valid"))).alias("usable_rows"),
    )


# -- relational operators -------------------------------------------------------------

@query
def activity_fact(spark, sf):
    return fact(spark, sf)


@query
def as_of_parameters(spark, sf):
    as_of = marts.calculation_date(fact(spark, sf))
    known = valid_rows(history(spark, sf))
    return asof.versions_at(known, as_of, "parameter_name", marts.PARAMETER_ORDER).select(
        "parameter_name", "parameter_value", "valid_from", "valid_to", "source_row_number"
    )


@query
def parameter_pivot(spark, sf):
    as_of = marts.calculation_date(fact(spark, sf))
    return marts.active_parameters(history(spark, sf), as_of, V.PARAMETER_NAMES)


@query
def as_of_join_per_fact(spark, sf):
    facts = fact(spark, sf).select("activity_id", "activity_date")
    return asof.as_of_join(
        facts, valid_rows(history(spark, sf)), "activity_date", "parameter_name", "parameter_value",
        V.PARAMETER_NAMES, marts.PARAMETER_ORDER,
    )


@query
def latest_row_per_key(spark, sf):
    events = table(spark, sf, "events")
    return ranking.latest_by_key(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "ts", "event_type"
    )


@query
def trailing_window_counts(spark, sf):
    facts = fact(spark, sf)
    return aggregates.trailing_counts(
        facts, "employee_id", "activity_date", marts.calculation_date(facts), marts.WINDOW_MONTHS
    )


@query
def left_join_default(spark, sf):
    counts = table(spark, sf, "orders").filter("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").groupBy(
        F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("urgent_orders"))
    people = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return joins.left_join_default(people, counts, "c_custkey", {"urgent_orders": 0}, match_flag="has_urgent")


@query
def missing_keys(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", "c_name")
    served = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey"))
    return joins.missing_from(people, served, "c_custkey")


@query
def row_counts(spark, sf):
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("relation", F.lit(name))
             for name, df in raw(spark, sf).items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# -- marts and reports ----------------------------------------------------------------

@query
def commute_eligibility(spark, sf):
    return portable(commute_mart(spark, sf))


@query
def commute_eligibility_without_rate(spark, sf):
    models = staged(spark, sf)
    lacking = models["config_benefit_parameters"].filter(F.col("parameter_name") != V.BONUS_RATE)
    return portable(marts.commute_bonus(
        models["stg_hr_employees"], models["stg_google_routes_responses"], lacking, fact(spark, sf)))


@query
def wellbeing_eligibility(spark, sf):
    return wellbeing_mart(spark, sf)


@query
def impact_by_unit(spark, sf):
    return built(spark, sf)["mart_benefits_impact_by_business_unit"]


@query
def impact_report(spark, sf):
    return marts.impact_report(commute_mart(spark, sf))


@query
def state_fingerprint(spark, sf):
    return reports.state_fingerprint(commute_mart(spark, sf))


@query
def bonus_by_unit(spark, sf):
    return reports.bonus_by_unit(built(spark, sf)["mart_benefits_impact_by_business_unit"])


@query
def bonus_beneficiaries(spark, sf):
    return reports.bonus_beneficiaries(commute_mart(spark, sf))


@query
def wellbeing_beneficiaries(spark, sf):
    return reports.wellbeing_beneficiaries(wellbeing_mart(spark, sf))


@query
def unit_summary(spark, sf):
    return reports.unit_summary(built(spark, sf)["mart_benefits_impact_by_business_unit"])


@query
def full_refresh(spark, sf):
    """Everything stored layer by layer; the impact mart as read back."""
    root = f"{shared_folder(spark)}/refresh-{uuid.uuid4().hex}"
    result = refresh.refresh(spark, raw(spark, sf), root)
    return result.tables["mart_benefits_impact_by_business_unit"]


# -- table changes --------------------------------------------------------------------

@query
def insert_only_merge(spark, sf):
    stored = queue(spark, sf).filter(F.col("last_error").isNotNull() | F.col("published_at").isNotNull())
    return portable(Q.synchronise(stored, _stored_fact(spark, sf), now()))


@query
def replace_by_source_file(spark, sf):
    stored = standin(spark, sf, "employee_sport_profile_txt")
    again = stored.filter("source_file = 'second profile'").withColumn("declared_sport", F.lit("Voile"))
    return tables.replace_by_source_file(stored, again, "second profile")


@query
def revise_parameter(spark, sf):
    return parameters.revise_parameter(
        standin(spark, sf, "parameter_history_txt"), V.BONUS_RATE, "0.06", "2001-07-01", "2001-06-30",
        "revision", only_version_from="1994-06-01",
    )


@query
def revise_parameter_open_ended(spark, sf):
    return parameters.revise_rate_now(standin(spark, sf, "parameter_history_txt"), "0.07", "revision", now())


@query
def parameter_history(spark, sf):
    return parameters.parameter_history(standin(spark, sf, "parameter_history_txt"), V.BONUS_RATE)


@query
def seeded_parameters(spark, sf):
    """The initial versions, seeded twice into the stored ones."""
    initial = readers.initial_parameters(spark)
    once = tables.replace_by_source_file(standin(spark, sf, "parameter_history_txt"), initial, "initial_parameters")
    return tables.replace_by_source_file(once, initial, "initial_parameters")


@query
def status_histogram(spark, sf):
    return Q.status_histogram(queue(spark, sf))


@query
def backfill_keep_newest(spark, sf):
    return portable(Q.backfill(queue(spark, sf), BATCH, now()))


@query
def backfill_all(spark, sf):
    return portable(Q.backfill(queue(spark, sf), 0, now()))


@query
def expire_stale_claims(spark, sf):
    return portable(Q.expire_stale_claims(queue(spark, sf), V.DEFAULT_STALE_MINUTES, now()))


@query
def preview_batch(spark, sf):
    return portable(Q.preview_batch(queue(spark, sf), BATCH, retry_errors=True))


@query
def claim_batch(spark, sf):
    return portable(Q.claim_batch(queue(spark, sf), BATCH, False, now())[0])


@query
def claimed_rows(spark, sf):
    return portable(Q.claim_batch(queue(spark, sf), BATCH, True, now())[1])


@query
def apply_delivery_results(spark, sf):
    return portable(announcements.finish_batch(
        queue(spark, sf), standin(spark, sf, "deliveries"), standin(spark, sf, "links"), now()))


@query
def started_batch(spark, sf):
    """Stale claims expired, the next batch claimed, its messages written."""
    _, batch = announcements.start_batch(queue(spark, sf), BATCH, now(), retry_errors=True)
    return batch.select("activity_id", "message")


@query
def publication_gate(spark, sf):
    return Q.gate_states(queue(spark, sf))


@query
def links_to_repair(spark, sf):
    return Q.links_to_repair(queue(spark, sf), BATCH)


@query
def apply_repaired_links(spark, sf):
    links = announcements.link_results(standin(spark, sf, "links"))
    return portable(Q.apply_links(queue(spark, sf), links, now()))


@query
def stream_queue_merge(spark, sf):
    """All activities arrive as files and are merged into an empty queue, twice."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    arriving, queue_path = f"{root}/arriving", f"{root}/queue"
    standin(spark, sf, "sport_activities_txt").drop("source_file", "source_row_number").write.parquet(arriving)
    queue_merge.create_queue(spark, queue_path)
    for run in ("first", "replayed"):
        stream = queue_merge.read_activity_stream(spark, arriving)
        queue_merge.merge_stream(stream, queue_path, f"{root}/{run}", now()).awaitTermination()
    return portable(spark.read.schema(QUEUE).parquet(queue_path))


def _stored_fact(spark, sf) -> DataFrame:
    """The fact table as a stored table, which is what the queue is filled from."""
    path = f"{shared_folder(spark)}/fact-{uuid.uuid4().hex}"
    rows = fact(spark, sf)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _store(spark, sf) -> QueueStore:
    """The whole queue as a store."""
    return QueueStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}").create(queue(spark, sf))


@query
def store_synchronise(spark, sf):
    store = QueueStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}").create(
        queue(spark, sf).filter(F.col("last_error").isNotNull() | F.col("published_at").isNotNull()))
    store.synchronise(_stored_fact(spark, sf), now())
    return portable(store.read())


@query
def store_claim_batch(spark, sf):
    store = _store(spark, sf)
    store.claim(BATCH, False, now())
    return portable(store.read())


@query
def store_settle_batch(spark, sf):
    store = _store(spark, sf)
    store.settle(standin(spark, sf, "deliveries"), standin(spark, sf, "links"), now())
    return portable(store.read())


@query
def store_repair_links(spark, sf):
    store = _store(spark, sf)
    store.repair_links(standin(spark, sf, "links"), now())
    return portable(store.read())


@query
def store_backfill(spark, sf):
    """Backfilled through the store; read back after its log went into a new base."""
    store = _store(spark, sf)
    store.backfill(BATCH, now())
    store.store.compact()
    store.store.remove_superseded()
    return portable(store.read())


@query
def store_log_rows(spark, sf):
    """What a claim, an expiry and a repair wrote: rows by change and status."""
    store = _store(spark, sf)
    store.claim(BATCH, False, now())
    store.expire_stale_claims(V.DEFAULT_STALE_MINUTES, now())
    store.repair_links(standin(spark, sf, "links"), now())
    return store.store.logged().groupBy("change_number", "publication_status").agg(F.count(F.lit(1)).alias("row_count"))


@query
def stream_ledger(spark, sf):
    """What became of all activities that arrived, and of all of them again from a lost checkpoint."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    standin(spark, sf, "sport_activities_txt").drop("source_file", "source_row_number").write.parquet(f"{root}/arriving")
    store = QueueStore(spark, f"{root}/queue").create()
    for run in ("first", "replayed"):
        stream = queue_merge.read_activity_stream(spark, f"{root}/arriving")
        queue_merge.merge_into_store(stream, store, f"{root}/{run}", run, now()).awaitTermination()
    return store.ledger().groupBy("source").agg(*[F.sum(c).alias(c) for c in ("arrived", "queued", "known", "invalid")])


@query
def boundary_of_half(spark, sf):
    """The newest half of the pending rows stays: found by counting, no task sorts them."""
    rows = queue(spark, sf)
    half = rows.filter(F.col("publication_status") == V.PENDING).count() // 2
    edge = ranking.kth_key(rows.filter(F.col("publication_status") == V.PENDING), ["activity_start_datetime", "activity_id"], half, True, 100)
    age = F.struct("activity_start_datetime", "activity_id")
    pending = F.col("publication_status") == V.PENDING
    return rows.filter(pending & (age >= F.struct(*[F.lit(v) for v in edge]).cast(rows.select(age.alias("k")).schema["k"].dataType))).select("activity_id")


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_ORDERS = SourceSpec("orders", _ORDER_COLUMNS, _ORDER_COLUMNS)


@query
def row_lineage(spark, sf):
    return readers.read_contracted(spark, _ORDERS, f"{sf}/orders.parquet", "parquet").select(
        "source_file", "source_row_number", F.col("o_orderkey").cast("long").alias("o_orderkey"))


def _as_csv(df: DataFrame, spec: SourceSpec, path: str) -> str:
    """A raw relation as CSV files with the contracted header, in order of the employees."""
    rows = df.repartitionByRange(4, F.trim("employee_id").cast("long")).sortWithinPartitions(F.trim("employee_id").cast("long"))
    named = [F.col(t).alias(s) for s, t in zip(spec.source_columns, spec.target_columns)]
    rows.select(*named).write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def _loaded(spark, sf) -> Workspace:
    """A workspace whose employees and profiles were loaded from CSV files."""
    root = f"{shared_folder(spark)}/workspace-{uuid.uuid4().hex}"
    inputs = raw(spark, sf)
    space = Workspace(spark, f"{root}/lake")
    space.load({s.relation: _as_csv(inputs[s.relation], s, f"{root}/{s.relation}") for s in SOURCES})
    space.store_raw({name: df for name, df in inputs.items() if name not in {s.relation for s in SOURCES}})
    return space


@query
def loaded_row_numbers(spark, sf):
    """Row numbers of loaded CSV files; with the rows of earlier files they count all employees in order."""
    rows = _loaded(spark, sf).raw()["hr_employees_txt"].select(
        F.trim("employee_id").cast("long").alias("employee_id"), "source_file", F.col("source_row_number").cast("long").alias("row_number"))
    files = rows.groupBy("source_file").agg(F.min("employee_id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = files.alias("a").join(files.alias("b"), F.col("b.first") < F.col("a.first"), "left").groupBy(
        F.col("a.source_file").alias("source_file")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    return rows.join(earlier, "source_file").select("employee_id", (F.col("row_number") - 1 + F.col("before")).alias("place"))


@query
def workspace_run(spark, sf):
    """Load, refresh and queue below one root; the impact mart as released."""
    space = _loaded(spark, sf)
    space.refresh()
    return space.table("mart_benefits_impact_by_business_unit")


@query
def workspace_reset(spark, sf):
    """Rows of the raw relations and the queue before and after a reset."""
    space = _loaded(spark, sf)
    space.store_raw({"benefit_parameters_txt": standin(spark, sf, "parameter_history_txt")})
    space.refresh()
    space.create_queue().synchronise(space.table("fct_sport_activities"), now())

    def counted(moment: str) -> DataFrame:
        tables = {**space.raw(), "queue": space.queue().read()}
        parts = [df.groupBy().agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(moment).alias("moment"), F.lit(name).alias("relation"), "row_count") for name, df in tables.items()]
        return functools.reduce(DataFrame.unionByName, parts)

    before = counted("before")
    space.reset()
    return before.unionByName(counted("after"))


@query
def route_candidates(spark, sf):
    people, stored = _candidate_inputs(spark, sf)
    return routes.route_candidates(people, stored, OFFICE, limit=100)


@query
def new_route_requests(spark, sf):
    people, stored = _candidate_inputs(spark, sf)
    return routes.new_candidates(people, stored, OFFICE).drop("employee_id_text")


def _candidate_inputs(spark, sf):
    """Employees; responses are stored for those of one business unit."""
    people = standin(spark, sf, "hr_employees_txt")
    stored = routes.route_requests(people.filter("business_unit = 'MACHINERY'"), OFFICE).select("request_key")
    return people, stored


@query
def append_responses_by_key(spark, sf):
    arrived = standin(spark, sf, "google_routes_responses_txt").withColumn(
        "request_key", F.concat(F.lit("key-"), F.col("employee_id"), F.col("google_travel_mode")))
    return append_responses(arrived.filter("response_http_status = 'NO_ROUTE'"), arrived)


# -- audits ---------------------------------------------------------------------------

@query
def audit_unique(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn(
        "line_key", F.col("l_orderkey").cast("long") * 10 + F.col("l_linenumber"))
    return quality.repeated(lines, "line_key")


@query
def audit_not_null(spark, sf):
    return quality.not_null("n", "q", "distance_meters").failures(queue(spark, sf)).select(
        "activity_id", "sport_type")


@query
def audit_is_true(spark, sf):
    check = quality.is_true("t", "lineitem", "l_discount <= 0.05 and l_quantity < 40")
    return check.failures(table(spark, sf, "lineitem")).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("failing_rows"))


@query
def audit_valid_records(spark, sf):
    check = quality.valid_records("v", "stg_sport_activities")
    return check.failures(staged(spark, sf)["stg_sport_activities"]).select(
        "activity_id_raw", "sport_type", "elapsed_seconds_raw", "record_is_valid")


@query
def audit_duplicate_profiles(spark, sf):
    return quality.repeated(wellbeing_mart(spark, sf), "employee_id")


@query
def model_audit_counts(spark, sf):
    """Failing rows of each of the fifteen audits, one row per audit.

    The marts are stored before they are audited, as in a full run.
    """
    relations = staged(spark, sf)
    marts_built = refresh.build_marts(relations)
    commute = checkpoint(marts_built["mart_commute_bonus_eligibility"])
    well = checkpoint(marts_built["mart_wellbeing_eligibility"])
    relations.update({
        "mart_commute_bonus_eligibility": commute, "mart_wellbeing_eligibility": well,
        "mart_benefits_impact_by_business_unit": marts.impact_by_unit(commute, well),
    })
    parts = []
    for relation in dict.fromkeys(a.relation for a in audits.MODEL_AUDITS):
        checks = [a for a in audits.MODEL_AUDITS if a.relation == relation]
        wide = quality.failure_counts(relations[relation], checks)
        pairs = F.array(*[F.struct(F.lit(a.name).alias("audit"), F.col(a.name).alias("failing_rows")) for a in checks])
        parts.append(wide.select(F.explode(pairs).alias("p")).select("p.*"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def stored_audit_rows(spark, sf):
    """Every failing row of a whole run, read back from the stored audit tables."""
    root = f"{shared_folder(spark)}/audited-{uuid.uuid4().hex}"
    inputs = raw(spark, sf)
    result = refresh.refresh(spark, inputs, root)
    models = {**refresh.stage(inputs), **result.tables}
    parts = []
    for audit in refresh.ALL_AUDITS:
        found = audits.stored_failures(spark, f"{root}/audit", audit, models[audit.relation])
        key = next(c for c in ("unique_field", "source_row_number_raw", "employee_id", "business_unit") if c in found.columns)
        parts.append(found.select(F.lit(audit.name).alias("audit"), F.col(key).cast("string").alias("row_key")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def range_audit_rows(spark, sf):
    """Rows whose numbers 38 digits cannot hold."""
    models = staged(spark, sf)
    models["config_benefit_parameters"] = history(spark, sf)
    number = {"stg_hr_employees": "gross_salary_raw", "stg_sport_activities": "distance_meters_raw",
              "config_benefit_parameters": "parameter_value_raw"}
    parts = [check.failures(models[check.relation]).select(
        F.lit(check.relation).alias("relation"), "source_row_number_raw", F.col(number[check.relation]).alias("number_text"))
        for check in audits.RANGE_AUDITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def rate_bounds(spark, sf):
    return parameters.rate_bounds().failures(history(spark, sf)).select("source_row_number_raw", "parameter_value_raw")


@query
def delivery_figures(spark, sf):
    models = staged(spark, sf)
    facts = fact(spark, sf)
    commute = marts.commute_bonus(
        models["stg_hr_employees"], models["stg_google_routes_responses"], models["config_benefit_parameters"], facts)
    return reports.delivery_figures(raw(spark, sf), facts, commute, Q.backfill(queue(spark, sf), 0, now()))


@query
def registered_layers(spark, sf):
    """Rows of the stored marts and of an audit, by SQL over the registered layers."""
    refresh.refresh(spark, raw(spark, sf), f"{shared_folder(spark)}/registered-{uuid.uuid4().hex}", register=True)
    names = [f"marts.{name}" for name in refresh.MART_MODELS] + ["audit.stg_sport_activities_invalid_records"]
    return spark.sql(" UNION ALL ".join(f"SELECT '{n.split('.')[1]}' AS name, count(*) AS row_count FROM {n}" for n in names))


@query
def queue_audit_counts(spark, sf):
    checks = Q.queue_audits()
    counts = quality.failure_counts(queue(spark, sf), checks)
    return counts.select(*[F.col(a.name).alias(a.name) for a in checks])
