"""Typed and validated relations over the raw text relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from perkmill import vocabulary as V
from perkmill.functions.jsontext import json_path
from perkmill.functions.measures import metres_to_km
from perkmill.functions.casting import safe_cast
from perkmill.functions.rules import absent_or, holds, paired, present
from perkmill.operators.projection import Field, type_columns, with_validity
from perkmill.schemas import AMOUNT, RATE

_LINEAGE = (Field("source_file"), Field("source_row_number", "integer"))
_HAS_LINEAGE = ("source_file", "source_row_number")

_HR_FIELDS = (
    *_LINEAGE,
    Field("employee_id", "integer"),
    Field("last_name"), Field("first_name"),
    Field("birth_date", "date"),
    Field("business_unit"),
    Field("hire_date", "date"),
    Field("gross_salary", AMOUNT),
    Field("contract_type"),
    Field("paid_leave_days", "integer"),
    Field("home_address"), Field("commute_mode"),
)

_PROFILE_FIELDS = (
    *_LINEAGE,
    Field("employee_id", "integer"),
    Field("declared_sport", label=True, alias="sport_type"),
)

_ACTIVITY_FIELDS = (
    *_LINEAGE,
    Field("activity_id", "integer"), Field("employee_id", "integer"),
    Field("activity_start_datetime", "timestamp"),
    Field("sport_type", label=True),
    Field("distance_meters", AMOUNT),
    Field("activity_end_datetime", "timestamp"),
    Field("elapsed_seconds", "integer"),
    Field("activity_comment"), Field("source_system"),
)

_ROUTE_FIELDS = (
    *_LINEAGE,
    Field("request_key"),
    Field("employee_id", "integer"),
    Field("home_address"), Field("office_address"),
    Field("declared_commute_mode"), Field("google_travel_mode"),
    Field("request_payload_json", alias="request_payload_json_raw"),
    Field("response_http_status", "integer"),
    Field("response_payload_json", "jsonb"),
    Field("requested_at", "timestamp with time zone"),
)

_PARAMETER_FIELDS = (
    *_LINEAGE,
    Field("parameter_name"),
    Field("parameter_value", RATE),
    Field("valid_from", "date"), Field("valid_to", "date"),
    Field("parameter_comment"),
)


def _columns(*names: str):
    return present(*[F.col(n) for n in names])


def hr_employees(raw: DataFrame) -> DataFrame:
    """``stg_hr_employees``"""
    salary, leave = F.col("gross_salary"), F.col("paid_leave_days")
    rules = [
        *_columns(*_HAS_LINEAGE, "employee_id", "last_name", "first_name", "birth_date", "business_unit",
                  "hire_date", "contract_type", "home_address", "commute_mode"),
        holds(salary > 0),
        holds(leave >= 0),
    ]
    return with_validity(type_columns(raw, _HR_FIELDS), rules)


def sport_profiles(raw: DataFrame) -> DataFrame:
    """``stg_employee_sport_profile``: the sport itself is optional."""
    return with_validity(
        type_columns(raw, _PROFILE_FIELDS),
        _columns(*_HAS_LINEAGE, "employee_id"),
        flags={"has_declared_sport": F.col("sport_type").isNotNull()},
    )


def sport_activities(raw: DataFrame) -> DataFrame:
    """``stg_sport_activities``: one flag per rule, valid when all hold."""
    start, end = F.col("activity_start_datetime"), F.col("activity_end_datetime")
    seconds, metres = F.col("elapsed_seconds"), F.col("distance_meters")
    in_file, row = _columns(*_HAS_LINEAGE)
    flags = {
        "has_valid_source_metadata": in_file & row,
        "has_valid_activity_id": F.col("activity_id").isNotNull(),
        "has_valid_employee_id": F.col("employee_id").isNotNull(),
        "has_valid_time_range": holds(end > start),
        "has_valid_sport_type": F.col("sport_type").isNotNull(),
        "has_valid_elapsed_seconds": holds(seconds > 0),
        "has_valid_distance": absent_or(F.col("distance_meters_raw"), metres >= 0),
    }
    return with_validity(type_columns(raw, _ACTIVITY_FIELDS), flags.values(), flags=flags)


def route_responses(raw: DataFrame) -> DataFrame:
    """``stg_google_routes_responses``: distance and duration read from the stored JSON."""
    document = F.col("response_payload_json")
    # A cast mentions its input twice, so the texts are columns first: the JSON is read once.
    texts = type_columns(raw, _ROUTE_FIELDS).withColumns({
        "__metres": json_path(document, "routes[0].distanceMeters"),
        "__seconds": F.regexp_replace(json_path(document, "routes[0].duration"), r"s\z", ""),
    })
    parsed = texts.withColumns({
        "route_distance_meters": safe_cast(F.col("__metres"), "integer"),
        "route_duration_seconds": safe_cast(F.col("__seconds"), "integer"),
    }).drop("__metres", "__seconds")
    metres, seconds, employee = (
        F.col(c) for c in ("route_distance_meters", "route_duration_seconds", "employee_id")
    )
    rules = [
        *_columns(*_HAS_LINEAGE, "request_key", "home_address", "office_address", "requested_at",
                  "response_payload_json"),
        holds(employee > 0),
        # The pairs also say which modes are known at all.
        paired(F.col("declared_commute_mode"), F.col("google_travel_mode"), V.TRAVEL_MODES),
        F.col("response_http_status") == 200,
        holds(metres > 0),
        holds(seconds >= 0),
    ]
    return with_validity(
        parsed.withColumn("route_distance_km", metres_to_km(metres)), rules, never_null=True
    )


def benefit_parameters(raw: DataFrame) -> DataFrame:
    """``config_benefit_parameters``: validity is NULL when only the name is missing."""
    value, first, last = F.col("parameter_value"), F.col("valid_from"), F.col("valid_to")
    rules = [
        F.col("parameter_name").isin(*V.PARAMETER_NAMES),
        holds(value >= 0),
        first.isNotNull(),
        last.isNull() | (last >= first),
    ]
    return with_validity(type_columns(raw, _PARAMETER_FIELDS), rules)
