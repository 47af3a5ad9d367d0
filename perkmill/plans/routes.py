"""Route requests still to be made, and captured responses as raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from perkmill import vocabulary as V
from perkmill.functions.keys import request_document, request_key
from perkmill.functions.responses import is_failed_status, route_payload, route_status
from perkmill.functions.rules import translate_value
from perkmill.functions.text import clean_text, strip_all
from perkmill.operators.joins import missing_from
from perkmill.operators.ranking import earliest_by_key, first_rows
from perkmill.schemas import RAW


def route_requests(raw_employees: DataFrame, office_address: str) -> DataFrame:
    """One request per active commuter with an identifier and an address."""
    declared = F.trim(F.col("commute_mode"))
    travel = translate_value(declared, V.TRAVEL_MODES)
    office = F.lit(office_address)
    return (
        raw_employees
        .filter(declared.isin(*V.TRAVEL_MODES))
        .filter(clean_text(F.col("employee_id")).isNotNull() & clean_text(F.col("home_address")).isNotNull())
        .select(
            "source_row_number",
            F.col("employee_id").alias("employee_id_text"),
            strip_all(F.col("employee_id")).alias("employee_id"),
            strip_all(F.col("home_address")).alias("home_address"),
            declared.alias("declared_commute_mode"),
            travel.alias("google_travel_mode"),
            request_key(F.col("employee_id"), F.col("home_address"), office, declared, travel).alias("request_key"),
            request_document(strip_all(F.col("home_address")), office, travel).alias("request_payload_json"),
        )
    )


def new_candidates(
    raw_employees: DataFrame, stored_responses: DataFrame, office_address: str, retry_failed: bool = False,
) -> DataFrame:
    """Distinct requests whose key is not stored yet.

    A stored response blocks its key even when it failed, unless ``retry_failed``. Of
    several employees rows with one key the first in the order of the batch is kept.
    """
    if retry_failed:
        stored_responses = stored_responses.filter(~is_failed_status(F.col("response_http_status")))
    fresh = missing_from(route_requests(raw_employees, office_address), stored_responses, "request_key")
    return earliest_by_key(fresh, ["request_key"], ["employee_id_text", "source_row_number"])


def route_candidates(
    raw_employees: DataFrame, stored_responses: DataFrame, office_address: str, limit: int,
    retry_failed: bool = False,
) -> DataFrame:
    """The next ``limit`` requests, by employee identifier compared as text."""
    candidates = new_candidates(raw_employees, stored_responses, office_address, retry_failed)
    order = [F.col("employee_id_text"), F.col("source_row_number"), F.col("request_key")]
    return first_rows(candidates, order, limit).drop("employee_id_text")


def response_rows(
    candidates: DataFrame, captured: DataFrame, office_address: str, requested_at: Column | None = None,
) -> DataFrame:
    """Captured responses (``request_key, error, http_status, body``) as raw rows."""
    moment = F.current_timestamp() if requested_at is None else requested_at
    error, status, body = F.col("error"), F.col("http_status"), F.col("body")
    values = {
        "source_file": F.lit(V.ROUTE_SOURCE),
        "office_address": F.lit(office_address),
        "response_http_status": route_status(error, status, body),
        "response_payload_json": route_payload(error, body),
        "requested_at": F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")),
    }
    return candidates.join(captured, "request_key").withColumns(values).select(
        *RAW["google_routes_responses_txt"].names
    )
