"""The registered queries as DuckDB SQL, written from the rules and not from the plans."""

from __future__ import annotations

import re

from workload.standins import STANDINS, duckdb_sql

DAY = r"\d{4}-\d{1,2}-\d{1,2}"
CLOCK = r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?"
MOMENT = rf"\s*{DAY}([ T]{CLOCK}( ?(Z|UTC|[+-](\d{{1,2}}|\d{{2}}:?\d{{2}})))?)?\s*"
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NUMBER = r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d{1,4})?\s*"
NOW = "TIMESTAMP '2000-01-01 00:00:00'"


def clean(c: str) -> str:
    return f"nullif(trim({c}, ' '), '')"


def shaped(c: str, pattern: str, value: str) -> str:
    return f"CASE WHEN regexp_full_match({clean(c)}, '{pattern}') THEN {value} END"


def integer(c: str, kind: str = "INTEGER") -> str:
    return shaped(c, r"\s*[+-]?\d+\s*", f"TRY_CAST({clean(c)} AS {kind})")


def numeric(c: str, scale: int = 10) -> str:
    return shaped(c, NUMBER, f"TRY_CAST({clean(c)} AS DECIMAL(38,{scale}))")


# Ways to write a day besides year-month-day, as format strings.
DAY_FORMATS = ("%m/%d/%y", "%m-%d-%y", "%m.%d.%y", "%Y/%m/%d", "%Y.%m.%d", "%m/%d/%Y", "%m-%d-%Y", "%m.%d.%Y", "%y%m%d", "%Y%m%d",
               "%B %d, %Y", "%b %d, %Y", "%B %d %Y", "%b %d %Y", "%b-%d-%Y", "%d %B %Y", "%d %b %Y", "%d-%b-%y", "%d-%b-%Y", "%Y-%b-%d")
OTHER_DAYS = ", ".join(f"'{day}{time}'" for day in DAY_FORMATS for time in ("", " %H:%M:%S"))


def date(c: str) -> str:
    usual = shaped(c, MOMENT, f"TRY_CAST(regexp_extract({clean(c)}, '{DAY}') AS DATE)")
    return f"coalesce({usual}, CAST(try_strptime({clean(c)}, [{OTHER_DAYS}]) AS DATE))"


def timestamp(c: str) -> str:
    return f"coalesce({shaped(c, MOMENT, f'TRY_CAST({clean(c)} AS TIMESTAMP)')}, try_strptime({clean(c)}, [{OTHER_DAYS}]))"


def zoned(c: str) -> str:
    return shaped(c, MOMENT, f"timezone('UTC', TRY_CAST({clean(c)} AS TIMESTAMPTZ))")


def is_json(c: str) -> str:
    return rf"coalesce(regexp_full_match({c}, '(?s)\s*(\{{.*\}}|\[.*\])\s*') AND json_valid({c}), false)"


def is_json_value(c: str) -> str:
    return rf"coalesce(json_valid({c}) AND NOT contains(replace({c}, '\\', ''), '\u0000'), false)"


def label(c: str) -> str:
    return f"CASE WHEN lower({clean(c)}) = 'runing' THEN 'Course à pied' ELSE {clean(c)} END"


def path(document: str, p: str) -> str:
    return f"CASE WHEN {is_json(document)} THEN json_extract_string({document}, '$.{p}') END"


def truthy(value: str) -> str:
    return f"coalesce({value} NOT IN ('', 'false', '0', '0.0', '-0', '[]', '{{}}'), false)"


LINEAGE = f"""{clean('source_file')} AS source_file, {clean('source_row_number')} AS source_row_number_raw,
    {integer('source_row_number')} AS source_row_number"""


def parameters(source: str) -> str:
    return f"""SELECT *, {verdict(*PARAMETER_RULES)} AS record_is_valid
    FROM (SELECT {LINEAGE}, {clean('parameter_name')} AS parameter_name,
      {clean('parameter_value')} AS parameter_value_raw, {numeric('parameter_value', 14)} AS parameter_value,
      {clean('valid_from')} AS valid_from_raw, {date('valid_from')} AS valid_from,
      {clean('valid_to')} AS valid_to_raw, {date('valid_to')} AS valid_to,
      {clean('parameter_comment')} AS parameter_comment FROM {source})"""


def active(source: str, names: tuple[str, ...]) -> str:
    columns = ", ".join(f"max(parameter_value) FILTER (WHERE parameter_name = '{n}') AS {n}" for n in names)
    return f"SELECT {columns} FROM {ranked_versions(source)} WHERE version_rank = 1"


def ranked_versions(source: str) -> str:
    return f"""(SELECT p.*, row_number() OVER (PARTITION BY parameter_name ORDER BY valid_from DESC NULLS FIRST,
        source_row_number DESC NULLS FIRST, source_file DESC NULLS FIRST) AS version_rank
      FROM {source} p, as_of WHERE record_is_valid AND valid_from <= as_of.d
        AND (valid_to IS NULL OR valid_to >= as_of.d))"""


WALK, CYCLE = "'Marche/running'", "'Vélo/Trottinette/Autres'"
RATE, WALK_KM, CYCLE_KM = "bonus_rate", "max_commute_distance_walking_km", "max_commute_distance_cycling_km"
ALL_NAMES = (RATE, "wellbeing_activity_threshold", "wellbeing_days", WALK_KM, CYCLE_KM)


# Reasons against a bonus, in the order in which they count.
REASONS = {
    "PARAMETERS_NOT_AVAILABLE": "rate IS NULL OR walk_km IS NULL OR cycle_km IS NULL",
    "NOT_ACTIVE_COMMUTE_DECLARED": "NOT declares_active",
    "ROUTE_INVALID_OR_MISSING": "route_key IS NULL",
    "DISTANCE_ABOVE_LIMIT": "route_distance_km > limit_km",
    "ELIGIBLE": "true",
}


def unscaled(c: str) -> str:
    """A decimal as the whole number of its last decimals."""
    return f"CAST(replace(CAST({c} AS VARCHAR), '.', '') AS HUGEINT)"


def commute(parameter_source: str) -> str:
    """Every reason that holds is a row of its own; the first one decides."""
    cents = f"({unscaled('gross_salary')} * {unscaled('rate')} + 5000000000000000000000) // 10000000000000000000000"
    given = " UNION ALL ".join(
        f"SELECT person, {place} AS place, '{reason}' AS reason FROM people WHERE {condition}"
        for place, (reason, condition) in enumerate(REASONS.items()))
    return f"""WITH newest_route AS (
        SELECT employee_id AS route_key, unnest(max_by(r, (requested_at, source_row_number, source_file, request_key)))
        FROM stg_google_routes_responses r WHERE record_is_valid GROUP BY employee_id),
      people AS (
        SELECT row_number() OVER () AS person, e.employee_id, last_name, first_name, business_unit, gross_salary, commute_mode,
          d AS calculation_as_of_date, {RATE} AS rate, {WALK_KM} AS walk_km, {CYCLE_KM} AS cycle_km,
          commute_mode IN ({WALK}, {CYCLE}) AS declares_active,
          map {{{WALK}: {WALK_KM}, {CYCLE}: {CYCLE_KM}}}[commute_mode] AS limit_km, route_key, google_travel_mode,
          route_distance_meters, route_distance_km, route_duration_seconds, requested_at
        FROM stg_hr_employees e LEFT JOIN newest_route ON route_key = e.employee_id, as_of, ({active(parameter_source, (RATE, WALK_KM, CYCLE_KM))})
        WHERE e.record_is_valid),
      given AS ({given}),
      decided AS (SELECT person, min_by(reason, place) AS eligibility_reason FROM given GROUP BY person)
      SELECT employee_id, last_name, first_name, business_unit, gross_salary, commute_mode, calculation_as_of_date,
        rate AS {RATE}, walk_km AS {WALK_KM}, cycle_km AS {CYCLE_KM}, google_travel_mode, route_distance_meters, route_distance_km,
        route_duration_seconds, CAST(round(route_duration_seconds / 60.0, 2) AS DECIMAL(18,2)) AS route_duration_minutes,
        requested_at AS route_requested_at, declares_active AS is_active_commute_declared, route_key IS NOT NULL AS has_valid_route,
        limit_km AS maximum_authorized_distance_km, eligibility_reason, eligibility_reason = 'ELIGIBLE' AS is_commute_bonus_eligible,
        CAST(CASE eligibility_reason WHEN 'ELIGIBLE' THEN CAST({cents} AS DECIMAL(30,0)) * CAST(0.01 AS DECIMAL(3,2)) ELSE 0 END
          AS DECIMAL(38,2)) AS annual_commute_bonus_gross
      FROM people JOIN decided USING (person)"""


def verdict(*rules: str) -> str:
    """False if a rule is broken, else NULL if one cannot be judged, else true."""
    listed = f"[{', '.join(rules)}]"
    return f"""(CASE WHEN len(list_filter({listed}, lambda x: NOT x)) > 0 THEN false
        WHEN len(list_filter({listed}, lambda x: x IS NULL)) = 0 THEN true END)"""


def given(*columns: str) -> list[str]:
    return [f"{c} IS NOT NULL" for c in columns]


def known(test: str) -> str:
    """A test that an unknown value does not pass."""
    return f"coalesce({test}, false)"


HR_RULES = [*given("source_file", "source_row_number", "employee_id", "last_name", "first_name", "birth_date", "business_unit", "hire_date",
                   "contract_type", "home_address", "commute_mode"), known("gross_salary > 0"), known("paid_leave_days >= 0")]
ACTIVITY_RULES = {
    "has_valid_source_metadata": verdict(*given("source_file", "source_row_number")),
    "has_valid_activity_id": "activity_id IS NOT NULL",
    "has_valid_employee_id": "employee_id IS NOT NULL",
    "has_valid_time_range": known("activity_end_datetime - activity_start_datetime > INTERVAL 0 SECOND"),
    "has_valid_sport_type": "sport_type IS NOT NULL",
    "has_valid_elapsed_seconds": known("elapsed_seconds > 0"),
    "has_valid_distance": known("distance_meters >= 0 OR distance_meters_raw IS NULL"),
}
ROUTE_RULES = [known(rule) for rule in (
    *given("source_file", "source_row_number", "request_key", "home_address", "office_address", "requested_at", "response_payload_json"),
    "employee_id > 0", f"(declared_commute_mode, google_travel_mode) IN (({WALK}, 'WALK'), ({CYCLE}, 'BICYCLE'))",
    "response_http_status = 200", "route_distance_meters > 0", "route_duration_seconds >= 0")]
PARAMETER_RULES = [
    f"list_contains([{', '.join(repr(n) for n in ALL_NAMES)}], parameter_name) OR CAST(nullif(parameter_name IS NULL, true) AS BOOLEAN)",
    known("parameter_value >= 0"), "valid_from IS NOT NULL", "valid_to IS NULL OR valid_to >= valid_from"]


REFUSAL = f"""CASE WHEN error IS NOT NULL THEN '%sREQUEST_ERROR: ' || error
      WHEN NOT {is_json('body')} THEN '%sINVALID_JSON_RESPONSE: HTTP ' || http_status
      WHEN NOT {truthy(path('body', 'ok'))} THEN '%sSLACK_ERROR: ' || coalesce({path('body', 'error')}, 'unknown_error')"""


def refusal(prefix: str) -> str:
    return REFUSAL.replace("%s", prefix)


OFFICE = "1 Office Square"

CTES = {
    **{f"raw_{name}": duckdb_sql(name) for name in STANDINS},
    "stg_hr_employees": f"""SELECT *, {verdict(*HR_RULES)} AS record_is_valid
      FROM (SELECT {LINEAGE}, {clean('employee_id')} AS employee_id_raw, {integer('employee_id')} AS employee_id,
        {clean('last_name')} AS last_name, {clean('first_name')} AS first_name,
        {clean('birth_date')} AS birth_date_raw, {date('birth_date')} AS birth_date,
        {clean('business_unit')} AS business_unit,
        {clean('hire_date')} AS hire_date_raw, {date('hire_date')} AS hire_date,
        {clean('gross_salary')} AS gross_salary_raw, {numeric('gross_salary')} AS gross_salary,
        {clean('contract_type')} AS contract_type,
        {clean('paid_leave_days')} AS paid_leave_days_raw, {integer('paid_leave_days')} AS paid_leave_days,
        {clean('home_address')} AS home_address, {clean('commute_mode')} AS commute_mode
        FROM raw_hr_employees_txt)""",
    "stg_employee_sport_profile": f"""SELECT *, sport_type IS NOT NULL AS has_declared_sport,
        (source_file IS NOT NULL AND source_row_number IS NOT NULL AND employee_id IS NOT NULL) AS record_is_valid
      FROM (SELECT {LINEAGE}, {clean('employee_id')} AS employee_id_raw, {integer('employee_id')} AS employee_id,
        {clean('declared_sport')} AS declared_sport_raw, {label('declared_sport')} AS sport_type
        FROM raw_employee_sport_profile_txt)""",
    "stg_sport_activities": f"""SELECT *, {verdict(*ACTIVITY_RULES)} AS record_is_valid
      FROM (SELECT *, {", ".join(f"{rule} AS {name}" for name, rule in ACTIVITY_RULES.items())}
        FROM (SELECT {LINEAGE}, {clean('activity_id')} AS activity_id_raw, {integer('activity_id')} AS activity_id,
          {clean('employee_id')} AS employee_id_raw, {integer('employee_id')} AS employee_id,
          {clean('activity_start_datetime')} AS activity_start_datetime_raw,
          {timestamp('activity_start_datetime')} AS activity_start_datetime,
          {clean('sport_type')} AS sport_type_raw, {label('sport_type')} AS sport_type,
          {clean('distance_meters')} AS distance_meters_raw, {numeric('distance_meters')} AS distance_meters,
          {clean('activity_end_datetime')} AS activity_end_datetime_raw,
          {timestamp('activity_end_datetime')} AS activity_end_datetime,
          {clean('elapsed_seconds')} AS elapsed_seconds_raw, {integer('elapsed_seconds')} AS elapsed_seconds,
          {clean('activity_comment')} AS activity_comment, {clean('source_system')} AS source_system
          FROM raw_sport_activities_txt))""",
    "stg_google_routes_responses": f"""SELECT *, {verdict(*ROUTE_RULES)} AS record_is_valid
      FROM (SELECT *, CAST(route_distance_meters / 1000.0 AS DECIMAL(18,6)) AS route_distance_km
        FROM (SELECT *, {integer(path('response_payload_json', 'routes[0].distanceMeters'))} AS route_distance_meters,
            {integer("regexp_replace(" + path('response_payload_json', 'routes[0].duration') + ", 's$', '')")}
              AS route_duration_seconds
          FROM (SELECT {LINEAGE}, {clean('request_key')} AS request_key, {clean('employee_id')} AS employee_id_raw,
            {integer('employee_id')} AS employee_id, {clean('home_address')} AS home_address,
            {clean('office_address')} AS office_address, {clean('declared_commute_mode')} AS declared_commute_mode,
            {clean('google_travel_mode')} AS google_travel_mode,
            {clean('request_payload_json')} AS request_payload_json_raw,
            {clean('response_http_status')} AS response_http_status_raw,
            {integer('response_http_status')} AS response_http_status,
            {clean('response_payload_json')} AS response_payload_json_raw,
            CASE WHEN {is_json_value(clean('response_payload_json'))} THEN {clean('response_payload_json')} END
              AS response_payload_json,
            {clean('requested_at')} AS requested_at_raw, {zoned('requested_at')} AS requested_at
            FROM raw_google_routes_responses_txt)))""",
    "config_benefit_parameters": parameters("raw_benefit_parameters_txt"),
    "parameters_without_rate": "SELECT * FROM config_benefit_parameters WHERE parameter_name <> 'bonus_rate'",
    "history": parameters("raw_parameter_history_txt"),
    "fact": """SELECT activity_id, employee_id, activity_start_datetime, activity_end_datetime,
        CAST(activity_start_datetime AS DATE) AS activity_date,
        CAST(date_trunc('month', activity_start_datetime) AS DATE) AS activity_month,
        sport_type, distance_meters, elapsed_seconds,
        CAST(round(elapsed_seconds / 60.0, 2) AS DECIMAL(18,2)) AS elapsed_minutes,
        activity_comment, source_system, source_file, source_row_number
      FROM stg_sport_activities WHERE record_is_valid""",
    "as_of": "SELECT max(activity_date) AS d FROM fact",
    "window_counts": """SELECT employee_id, count(*) AS row_count, min(activity_date) AS first_day,
        max(activity_date) AS last_day
      FROM fact, as_of WHERE activity_date >= CAST(as_of.d - INTERVAL 12 MONTH AS DATE) AND activity_date <= as_of.d
      GROUP BY employee_id""",
    "commute": commute("config_benefit_parameters"),
    "wellbeing": f"""SELECT e.employee_id, last_name, first_name, business_unit,
        coalesce(p.has_declared_sport, false) AS has_declared_sport,
        coalesce(c.row_count, 0) AS activity_count_last_12_months, as_of.d AS calculation_as_of_date,
        a.wellbeing_activity_threshold, a.wellbeing_days,
        coalesce(c.row_count, 0) >= a.wellbeing_activity_threshold AS is_wellbeing_eligible,
        CAST(CASE WHEN coalesce(c.row_count, 0) >= a.wellbeing_activity_threshold THEN a.wellbeing_days ELSE 0 END
          AS DECIMAL(38,14)) AS awarded_wellbeing_days,
        c.first_day AS first_activity_date, c.last_day AS last_activity_date
      FROM stg_hr_employees e LEFT JOIN stg_employee_sport_profile p ON p.employee_id = e.employee_id
      LEFT JOIN window_counts c ON c.employee_id = e.employee_id
      CROSS JOIN ({active('config_benefit_parameters', ('wellbeing_activity_threshold', 'wellbeing_days'))}) a
      CROSS JOIN as_of WHERE e.record_is_valid""",
    # One row of marks per pair of mart rows of an employee; the mart is their sums.
    "marks": """SELECT calculation_as_of_date, business_unit, 1 AS heads, is_active_commute_declared::INT AS active,
        has_valid_route::INT AS routed, is_commute_bonus_eligible::INT AS bonus, is_wellbeing_eligible::INT AS well,
        annual_commute_bonus_gross AS amount, awarded_wellbeing_days AS days
      FROM (SELECT employee_id, calculation_as_of_date, business_unit, is_active_commute_declared, has_valid_route,
          is_commute_bonus_eligible, annual_commute_bonus_gross FROM commute)
      JOIN (SELECT employee_id, is_wellbeing_eligible, awarded_wellbeing_days FROM wellbeing) USING (employee_id)""",
    "impact": f"""SELECT calculation_as_of_date, business_unit, {", ".join(
        f"CAST(coalesce(sum({mark}), 0) AS {kind}) AS {name}" for name, mark, kind in (
            ("employee_count", "heads", "BIGINT"), ("active_commute_declared_employee_count", "active", "BIGINT"),
            ("employee_with_valid_route_count", "routed", "BIGINT"), ("commute_bonus_eligible_employee_count", "bonus", "BIGINT"),
            ("annual_commute_bonus_gross", "amount", "DECIMAL(38,2)"), ("wellbeing_eligible_employee_count", "well", "BIGINT"),
            ("awarded_wellbeing_days", "days", "DECIMAL(38,14)"),
            ("employee_with_at_least_one_benefit_count", "greatest(well, bonus)", "BIGINT"),
            ("employee_with_both_benefits_count", "least(well, bonus)", "BIGINT")))}
      FROM marks GROUP BY calculation_as_of_date, business_unit""",
    "queue": "SELECT * FROM raw_queue",
    "delivery": f"""SELECT activity_id, problem IS NULL AS succeeded,
        CASE WHEN problem IS NULL THEN {path('body', 'channel')} END AS channel_id,
        CASE WHEN problem IS NULL THEN {path('body', 'ts')} END AS message_ts, problem AS error_message
      FROM (SELECT *, {refusal('')}
          WHEN NOT ({truthy(path('body', 'channel'))} AND {truthy(path('body', 'ts'))})
            THEN 'SLACK_ERROR: missing_channel_or_message_ts' END AS problem FROM raw_all_deliveries)""",
    "link": f"""SELECT activity_id, CASE WHEN problem IS NULL THEN {path('body', 'permalink')} END AS permalink,
        problem AS link_error
      FROM (SELECT *, {refusal('PERMALINK_')}
          WHEN NOT {truthy(path('body', 'permalink'))} THEN 'PERMALINK_SLACK_ERROR: missing_permalink' END AS problem
        FROM raw_all_links)""",
    "requests": f"""SELECT source_row_number, trim(employee_id, ' ') AS employee_id,
        trim(home_address, ' ') AS home_address, trim(commute_mode, ' ') AS declared_commute_mode, mode AS google_travel_mode,
        sha256(trim(employee_id, ' ') || '|' || trim(home_address, ' ') || '|{OFFICE}|' || trim(commute_mode, ' ')
          || '|' || mode) AS request_key,
        '{{"destination": {{"address": "{OFFICE}"}}, "languageCode": "fr-FR", "origin": {{"address": "'
          || trim(home_address, ' ') || '"}}, "travelMode": "' || mode || '", "units": "METRIC"}}'
          AS request_payload_json,
        employee_id AS id_text, business_unit
      FROM (SELECT *, CASE trim(commute_mode, ' ') WHEN {WALK} THEN 'WALK' WHEN {CYCLE} THEN 'BICYCLE' END AS mode
        FROM raw_hr_employees_txt)
      WHERE mode IS NOT NULL AND {clean('employee_id')} IS NOT NULL AND {clean('home_address')} IS NOT NULL""",
    "fresh_requests": """SELECT * FROM requests WHERE request_key NOT IN
        (SELECT request_key FROM requests WHERE business_unit = 'MACHINERY')""",
    "claimable": """SELECT *, row_number() OVER (ORDER BY activity_start_datetime, activity_id) AS rn
      FROM queue WHERE publication_status = 'PENDING'""",
    "claimable_or_failed": """SELECT *, row_number() OVER (ORDER BY activity_start_datetime, activity_id) AS rn
      FROM queue WHERE publication_status IN ('PENDING', 'ERROR')""",
    "newest_pending": """SELECT *, row_number() OVER (ORDER BY activity_start_datetime DESC, activity_id DESC) AS rn
      FROM queue WHERE publication_status = 'PENDING'""",
}

_FACT_COLUMNS = """activity_id, employee_id, activity_start_datetime, sport_type, distance_meters, elapsed_seconds,
    activity_comment, source_system"""


def _backfilled(where: str) -> str:
    return f"""SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN 'BACKFILLED' ELSE publication_status END AS publication_status,
        CASE WHEN hit THEN NULL ELSE claimed_at END AS claimed_at,
        CASE WHEN hit THEN NULL ELSE last_error END AS last_error,
        CASE WHEN hit THEN {NOW} ELSE updated_at END AS updated_at)
      FROM (SELECT q.*, q.activity_id IN ({where}) AS hit FROM queue q)"""


# Tests that rows must pass, by relation; a relation without a test must not repeat an employee.
COUNTS = ("active_commute_declared_employee_count", "employee_with_valid_route_count", "commute_bonus_eligible_employee_count",
          "annual_commute_bonus_gross", "wellbeing_eligible_employee_count", "awarded_wellbeing_days",
          "employee_with_at_least_one_benefit_count", "employee_with_both_benefits_count")
AUDITS = {
    "stg_hr_employees_invalid_records": ("stg_hr_employees", "record_is_valid"),
    "stg_employee_sport_profile_invalid_records": ("stg_employee_sport_profile", "record_is_valid"),
    "stg_sport_activities_invalid_records": ("stg_sport_activities", "record_is_valid"),
    "mart_wellbeing_employee_id_unique": ("wellbeing", None),
    "mart_wellbeing_employee_id_not_null": ("wellbeing", "employee_id IS NOT NULL"),
    "mart_wellbeing_eligibility_matches_activity_threshold": (
        "wellbeing", "is_wellbeing_eligible = (activity_count_last_12_months >= wellbeing_activity_threshold)"),
    "mart_wellbeing_days_match_eligibility": (
        "wellbeing", "awarded_wellbeing_days = CASE WHEN is_wellbeing_eligible THEN wellbeing_days ELSE 0 END"),
    "mart_commute_bonus_employee_id_unique": ("commute", None),
    "mart_commute_bonus_employee_id_not_null": ("commute", "employee_id IS NOT NULL"),
    "mart_commute_bonus_flag_matches_reason": ("commute", "is_commute_bonus_eligible = (eligibility_reason = 'ELIGIBLE')"),
    "mart_commute_bonus_amount_matches_eligibility": (
        "commute", f"{unscaled('annual_commute_bonus_gross')} = CASE WHEN is_commute_bonus_eligible THEN ({unscaled('gross_salary')}"
        f" * {unscaled('bonus_rate')} + 5000000000000000000000) // 10000000000000000000000 ELSE 0 END"),
    "mart_commute_bonus_eligible_employee_has_valid_route": (
        "commute", "NOT is_commute_bonus_eligible OR (is_active_commute_declared AND has_valid_route"
        " AND route_distance_km <= maximum_authorized_distance_km)"),
    "mart_benefits_impact_calculation_date_not_null": ("impact", "calculation_as_of_date IS NOT NULL"),
    "mart_benefits_impact_business_unit_not_null": ("impact", "business_unit IS NOT NULL"),
    "mart_benefits_impact_counts_and_amounts_are_non_negative": (
        "impact", f"employee_count > 0 AND least({', '.join(COUNTS)}) >= 0"),
}


def _audit_counts() -> str:
    def count(name: str, relation: str, test: str | None) -> str:
        if test is None:
            return f"""SELECT '{name}' AS audit, count(*) AS failing_rows FROM (SELECT employee_id FROM {relation}
              WHERE employee_id IS NOT NULL GROUP BY employee_id HAVING count(*) > 1)"""
        return f"SELECT '{name}' AS audit, count(*) AS failing_rows FROM {relation} WHERE NOT coalesce({test}, false)"

    return " UNION ALL ".join(count(name, *audit) for name, audit in AUDITS.items())


def _out_of_range(relation: str, column: str) -> str:
    return f"""FROM {relation} WHERE {shaped(column + '_raw', NUMBER, 'true')} AND ({column} IS NULL
      OR coalesce(TRY_CAST({column}_raw AS DECIMAL(38,20)) <> TRY_CAST({column} AS DECIMAL(38,20)), false))"""


NUMBERS = {"stg_hr_employees": "gross_salary", "stg_sport_activities": "distance_meters", "config_benefit_parameters": "parameter_value"}


def _audit_rows() -> str:
    keys = {"wellbeing": "employee_id", "commute": "employee_id", "impact": "business_unit"}

    def rows(name: str, relation: str, test: str | None) -> str:
        key = f"CAST({keys.get(relation, 'source_row_number_raw')} AS VARCHAR) AS row_key"
        if test is None:
            return f"""SELECT '{name}' AS audit, {key} FROM {relation} WHERE employee_id IS NOT NULL
              GROUP BY employee_id HAVING count(*) > 1"""
        return f"SELECT '{name}' AS audit, {key} FROM {relation} WHERE NOT coalesce({test}, false)"

    return " UNION ALL ".join([*[rows(name, *audit) for name, audit in AUDITS.items()], *[
        f"SELECT '{relation}_numbers_kept', source_row_number_raw {_out_of_range(relation, column)}"
        for relation, column in NUMBERS.items()]])


def _queue_audits() -> str:
    required = ("activity_id", "employee_id", "activity_start_datetime", "sport_type", "publication_status",
                "attempt_count", "created_at", "updated_at")
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS queue_{c}_not_null" for c in required)
    return f"""SELECT (SELECT count(*) FROM (SELECT activity_id FROM queue GROUP BY 1 HAVING count(*) > 1))
        AS queue_activity_id_unique,
      count(*) FILTER (WHERE NOT coalesce(publication_status IN ('PENDING', 'IN_PROGRESS', 'PUBLISHED', 'ERROR',
        'BACKFILLED'), false)) AS queue_status_is_known,
      count(*) FILTER (WHERE NOT coalesce(attempt_count >= 0, false)) AS queue_attempts_not_negative, {nulls}
      FROM queue"""


_DISTANCE_TEXT = "CASE WHEN distance_meters IS NULL THEN 'non renseignée' ELSE printf('%.2f', CAST(distance_meters AS DOUBLE) / 1000) || ' km' END"
_DURATION_TEXT = """CASE WHEN elapsed_seconds IS NULL THEN 'non renseignée'
    WHEN elapsed_seconds >= 3600 THEN printf('%d h %02d min', elapsed_seconds // 3600, elapsed_seconds % 3600 // 60)
    ELSE printf('%d min %02d s', elapsed_seconds // 60, elapsed_seconds % 60) END"""

_RESPONSE_STATUS = f"""CASE WHEN error IS NOT NULL THEN 'REQUEST_ERROR'
    WHEN http_status = 200 AND NOT coalesce({is_json('body')} AND {truthy("CASE WHEN " + is_json('body') + " THEN " + path('body', 'routes') + " END")}, false)
      THEN 'NO_ROUTE' ELSE CAST(http_status AS VARCHAR) END"""

_ROUTE_COLUMNS = """source_file, source_row_number, request_key, employee_id, home_address, office_address,
    declared_commute_mode, google_travel_mode, request_payload_json, response_http_status, response_payload_json,
    requested_at"""
_KEYED_ROUTES = """(SELECT * REPLACE ('key-' || employee_id || google_travel_mode AS request_key)
    FROM raw_google_routes_responses_txt)"""

ORACLE = {
    "clean_text": f"""SELECT activity_id, {clean('activity_comment')} AS activity_comment,
        {clean('distance_meters')} AS distance_meters FROM raw_sport_activities_txt""",
    "safe_cast_integer": f"""SELECT employee_id, {integer('employee_id')} AS id_value,
        {integer('employee_id', 'BIGINT')} AS id_long, {integer('paid_leave_days')} AS leave_value,
        {integer('home_address')} AS address_value FROM raw_hr_employees_txt""",
    "safe_cast_numeric": f"""SELECT activity_id, {numeric('distance_meters')} AS distance_value,
        {numeric('elapsed_seconds')} AS elapsed_value FROM raw_sport_activities_txt""",
    "safe_cast_date": f"""SELECT parameter_comment, {date('valid_from')} AS from_value, {date('valid_to')} AS to_value
        FROM raw_parameter_history_txt
        UNION ALL SELECT last_name, {date('birth_date')}, {date('hire_date')} FROM raw_hr_employees_txt""",
    "safe_cast_timestamp": f"""SELECT activity_id, {timestamp('activity_start_datetime')} AS start_value,
        {timestamp('activity_end_datetime')} AS end_value FROM raw_sport_activities_txt""",
    "safe_cast_timestamp_zone": f"""SELECT request_key, {zoned('requested_at')} AS requested_value
        FROM raw_google_routes_responses_txt""",
    "json_validation": f"""SELECT request_key, CASE WHEN {is_json_value(clean('response_payload_json'))}
        THEN {clean('response_payload_json')} END AS document FROM raw_google_routes_responses_txt""",
    "json_path_text": f"""SELECT request_key, {path('response_payload_json', 'routes[0].distanceMeters')} AS distance_text,
        {path('response_payload_json', 'routes[0].duration')} AS duration_text FROM stg_google_routes_responses""",
    "normalise_labels": "SELECT source_file, employee_id_raw AS employee_id, sport_type FROM stg_employee_sport_profile",
    "whitespace_and_truncation": f"""SELECT conv_id, turn, trim(regexp_replace(text, '{SPACE}+', ' ', 'g'), ' ') AS one_line,
        regexp_replace(text, '^{SPACE}+|{SPACE}+$', '', 'g') AS stripped, substr(text, 1, 2000) AS truncated
        FROM conversations""",
    "calendar_and_units": """SELECT activity_id, activity_month AS month, activity_date AS day,
        CAST(activity_date - INTERVAL 12 MONTH AS DATE) AS year_before, elapsed_minutes AS minutes,
        CAST(elapsed_seconds / 1000.0 AS DECIMAL(18,6)) AS kilometres FROM fact""",
    "announcement_text": f"""SELECT activity_id, {_DISTANCE_TEXT} AS distance_text, {_DURATION_TEXT} AS duration_text,
        concat_ws(chr(10), 'Nouvelle activité sportive', 'Activité : ' || sport_type, 'Salarié : ' || employee_id,
          'Début : ' || strftime(activity_start_datetime, '%d/%m/%Y à %H:%M UTC'),
          'Distance : ' || {_DISTANCE_TEXT}, 'Durée : ' || {_DURATION_TEXT}, 'Identifiant activité : ' || activity_id,
          CASE WHEN activity_comment <> '' THEN 'Commentaire : '
            || trim(regexp_replace(activity_comment, '{SPACE}+', ' ', 'g'), ' ') END) AS message
        FROM queue""",
    "request_keys": "SELECT * EXCLUDE (id_text, business_unit) FROM requests",
    "response_classes": f"""SELECT activity_id, {_RESPONSE_STATUS} AS status_text,
        CASE WHEN error IS NOT NULL THEN '{{"request_error": ' || to_json(error) || '}}'
          WHEN {is_json('body')} THEN body ELSE '{{"raw_response": ' || to_json(body) || '}}' END AS payload,
        {_RESPONSE_STATUS} NOT LIKE '2%' AS is_failure FROM raw_all_deliveries""",
    "delivery_outcomes": "SELECT * FROM delivery",
    "link_outcomes": "SELECT * FROM link",

    "stg_hr_employees": "SELECT * FROM stg_hr_employees",
    "stg_employee_sport_profile": "SELECT * FROM stg_employee_sport_profile",
    "stg_sport_activities": "SELECT * FROM stg_sport_activities",
    "stg_google_routes_responses": "SELECT * FROM stg_google_routes_responses",
    "config_benefit_parameters": "SELECT * FROM history",
    "row_validation_flags": """SELECT has_valid_source_metadata, has_valid_activity_id, has_valid_employee_id,
        has_valid_time_range, has_valid_sport_type, has_valid_elapsed_seconds, has_valid_distance, record_is_valid,
        count(*) AS row_count FROM stg_sport_activities GROUP BY ALL""",
    "valid_rows_only": """SELECT request_key, employee_id, route_distance_meters, route_distance_km,
        route_duration_seconds FROM stg_google_routes_responses WHERE record_is_valid""",
    "validity_null_semantics": """SELECT parameter_name, record_is_valid, count(*) AS row_count,
        count(*) FILTER (WHERE record_is_valid) AS usable_rows FROM history GROUP BY ALL""",

    "activity_fact": "SELECT * FROM fact",
    "as_of_parameters": f"""SELECT parameter_name, parameter_value, valid_from, valid_to, source_row_number
        FROM {ranked_versions('history')} WHERE version_rank = 1""",
    "parameter_pivot": active("history", ALL_NAMES),
    "as_of_join_per_fact": f"""SELECT f.activity_id, f.activity_date, {', '.join(f'v.{n}' for n in ALL_NAMES)}
        FROM fact f LEFT JOIN (SELECT day, {', '.join(f"max(parameter_value) FILTER (WHERE parameter_name = '{n}') AS {n}" for n in ALL_NAMES)}
          FROM (SELECT d.day, p.*, row_number() OVER (PARTITION BY d.day, p.parameter_name ORDER BY valid_from DESC,
              source_row_number DESC NULLS FIRST, source_file DESC NULLS FIRST) AS rn
            FROM (SELECT DISTINCT activity_date AS day FROM fact) d JOIN history p
              ON p.record_is_valid AND p.valid_from <= d.day AND (p.valid_to IS NULL OR p.valid_to >= d.day))
          WHERE rn = 1 GROUP BY day) v ON v.day = f.activity_date""",
    "latest_row_per_key": """SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER
        (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn FROM events) WHERE rn = 1""",
    "trailing_window_counts": "SELECT * FROM window_counts",
    "left_join_default": """SELECT c.c_custkey, c_mktsegment, coalesce(n, 0) AS urgent_orders, n IS NOT NULL AS has_urgent
        FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders
          WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY 1) o ON o.o_custkey = c.c_custkey""",
    "missing_keys": """SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS
        (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderpriority = '1-URGENT')""",
    "row_counts": " UNION ALL ".join(
        f"SELECT count(*) AS row_count, '{n}' AS relation FROM raw_{n}" for n in (
            "hr_employees_txt", "employee_sport_profile_txt", "sport_activities_txt",
            "google_routes_responses_txt", "benefit_parameters_txt")),

    "commute_eligibility": "SELECT * FROM commute",
    "commute_eligibility_without_rate": f"SELECT * FROM ({commute('parameters_without_rate')})",
    "wellbeing_eligibility": "SELECT * FROM wellbeing",
    "impact_by_unit": "SELECT * FROM impact",
    "impact_report": """SELECT calculation_as_of_date, bonus_rate,
        count(*) FILTER (WHERE is_commute_bonus_eligible) AS eligible_employee_count,
        CAST(round(sum(annual_commute_bonus_gross), 2) AS DECIMAL(38,2)) AS annual_commute_bonus_gross
        FROM commute GROUP BY 1, 2""",
    "state_fingerprint": r"""SELECT concat_ws('|', CAST(calculation_as_of_date AS VARCHAR),
          regexp_replace(CAST(bonus_rate AS VARCHAR), '\.?0+$', ''),
          CAST(count(*) FILTER (WHERE is_commute_bonus_eligible) AS VARCHAR),
          CAST(CAST(round(sum(annual_commute_bonus_gross), 2) AS DECIMAL(38,2)) AS VARCHAR)) AS state
        FROM commute GROUP BY calculation_as_of_date, bonus_rate""",
    "bonus_by_unit": """SELECT business_unit, calculation_as_of_date, annual_commute_bonus_gross,
        commute_bonus_eligible_employee_count FROM impact""",
    "bonus_beneficiaries": """SELECT employee_id, last_name, first_name, business_unit, commute_mode, route_distance_km,
        annual_commute_bonus_gross FROM commute WHERE is_commute_bonus_eligible""",
    "wellbeing_beneficiaries": """SELECT employee_id, last_name, first_name, business_unit,
        activity_count_last_12_months, awarded_wellbeing_days FROM wellbeing WHERE is_wellbeing_eligible""",
    "unit_summary": """SELECT business_unit, CAST(sum(employee_count) AS BIGINT) AS employees,
        CAST(sum(employee_with_at_least_one_benefit_count) AS BIGINT) AS with_a_benefit,
        CAST(sum(employee_with_both_benefits_count) AS BIGINT) AS with_both_benefits,
        CAST(sum(annual_commute_bonus_gross) AS DECIMAL(38,2)) AS bonus_total,
        CAST(sum(awarded_wellbeing_days) AS DECIMAL(38,14)) AS wellbeing_days_total FROM impact GROUP BY 1""",

    "insert_only_merge": f"""SELECT * FROM queue WHERE last_error IS NOT NULL OR published_at IS NOT NULL
        UNION ALL SELECT CAST(activity_id AS BIGINT), employee_id, activity_start_datetime, sport_type, distance_meters,
          elapsed_seconds, activity_comment, source_system, 'PENDING', 0, NULL, NULL, NULL, NULL, NULL, NULL, {NOW}, {NOW}
        FROM fact WHERE activity_id NOT IN
          (SELECT activity_id FROM queue WHERE last_error IS NOT NULL OR published_at IS NOT NULL)""",
    "replace_by_source_file": """SELECT source_file, source_row_number, employee_id,
        CASE WHEN source_file = 'second profile' THEN 'Voile' ELSE declared_sport END AS declared_sport
        FROM raw_employee_sport_profile_txt""",
    "revise_parameter": f"""SELECT source_file, source_row_number, parameter_name, parameter_value, valid_from,
        CASE WHEN hit THEN '2001-06-30' ELSE valid_to END AS valid_to,
        CASE WHEN hit THEN 'Taux initial de la prime sportive, clôturé avant révision' ELSE parameter_comment END
          AS parameter_comment
        FROM (SELECT *, parameter_name = 'bonus_rate' AND {clean('valid_to')} IS NULL AND valid_from = '1994-06-01'
          AS hit FROM raw_parameter_history_txt)
        UNION ALL SELECT 'revision', '1', 'bonus_rate', '0.06', '2001-07-01', '', 'Taux révisé de la prime sportive'""",
    "revise_parameter_open_ended": f"""SELECT source_file, source_row_number, parameter_name, parameter_value, valid_from,
        CASE WHEN hit THEN '2000-01-01 00:00:00.000000+00' ELSE valid_to END AS valid_to,
        CASE WHEN hit THEN 'Taux initial de la prime sportive, clôturé avant révision' ELSE parameter_comment END
          AS parameter_comment
        FROM (SELECT *, parameter_name = 'bonus_rate' AND {clean('valid_to')} IS NULL AS hit
          FROM raw_parameter_history_txt)
        UNION ALL SELECT 'revision', '1', 'bonus_rate', '0.07', '2000-01-01 00:00:00.000000+00', '',
          'Taux révisé de la prime sportive'""",
    "parameter_history": """SELECT parameter_value AS bonus_rate, valid_from, nullif(valid_to, '') AS valid_to,
        parameter_comment FROM raw_parameter_history_txt WHERE parameter_name = 'bonus_rate'""",
    "status_histogram": "SELECT publication_status, count(*) AS activity_count FROM queue GROUP BY 1",
    "backfill_keep_newest": _backfilled("SELECT activity_id FROM newest_pending WHERE rn > 40"),
    "backfill_all": _backfilled("SELECT activity_id FROM newest_pending"),
    "expire_stale_claims": f"""SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN 'ERROR' ELSE publication_status END AS publication_status,
        CASE WHEN hit THEN 'STALE_IN_PROGRESS_CLAIM' ELSE last_error END AS last_error,
        CASE WHEN hit THEN {NOW} ELSE updated_at END AS updated_at)
        FROM (SELECT *, coalesce(publication_status = 'IN_PROGRESS' AND claimed_at < {NOW} - INTERVAL 15 MINUTE, false)
          AS hit FROM queue)""",
    "preview_batch": f"SELECT {_FACT_COLUMNS} FROM claimable_or_failed WHERE rn <= 40",
    "claimed_rows": f"SELECT {_FACT_COLUMNS} FROM claimable_or_failed WHERE rn <= 40",
    "claim_batch": f"""SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN 'IN_PROGRESS' ELSE publication_status END AS publication_status,
        CAST(CASE WHEN hit THEN attempt_count + 1 ELSE attempt_count END AS INTEGER) AS attempt_count,
        CASE WHEN hit THEN {NOW} ELSE claimed_at END AS claimed_at,
        CASE WHEN hit THEN NULL ELSE last_error END AS last_error,
        CASE WHEN hit THEN {NOW} ELSE updated_at END AS updated_at)
        FROM (SELECT q.*, q.activity_id IN (SELECT activity_id FROM claimable WHERE rn <= 40) AS hit FROM queue q)""",
    "apply_delivery_results": f"""SELECT activity_id, employee_id, activity_start_datetime, sport_type, distance_meters,
        elapsed_seconds, activity_comment, source_system,
        CASE WHEN sent THEN 'PUBLISHED' WHEN failed THEN 'ERROR' ELSE publication_status END AS publication_status,
        attempt_count, claimed_at,
        CASE WHEN sent THEN {NOW} ELSE published_at END AS published_at,
        CASE WHEN sent THEN channel_id ELSE slack_channel_id END AS slack_channel_id,
        CASE WHEN sent THEN message_ts ELSE slack_message_ts END AS slack_message_ts,
        CASE WHEN sent THEN permalink ELSE slack_permalink END AS slack_permalink,
        CASE WHEN sent THEN link_error WHEN failed THEN substr(error_message, 1, 2000) ELSE last_error END AS last_error,
        created_at, CASE WHEN sent OR failed THEN {NOW} ELSE updated_at END AS updated_at
        FROM (SELECT q.*, d.channel_id, d.message_ts, d.error_message, l.permalink, l.link_error,
            coalesce(publication_status = 'IN_PROGRESS' AND d.succeeded, false) AS sent,
            coalesce(publication_status = 'IN_PROGRESS' AND NOT d.succeeded, false) AS failed
          FROM queue q LEFT JOIN (SELECT * FROM delivery WHERE activity_id IN (SELECT activity_id FROM raw_deliveries)) d
            ON d.activity_id = q.activity_id
          LEFT JOIN (SELECT * FROM link WHERE activity_id IN (SELECT activity_id FROM raw_links)) l ON l.activity_id = q.activity_id)""",
    "links_to_repair": """SELECT activity_id, slack_channel_id, slack_message_ts FROM queue
        WHERE publication_status = 'PUBLISHED' AND slack_permalink IS NULL AND slack_channel_id IS NOT NULL
          AND slack_message_ts IS NOT NULL ORDER BY published_at, activity_id LIMIT 40""",
    "apply_repaired_links": f"""SELECT * EXCLUDE (permalink, link_error, hit)
        REPLACE (CASE WHEN hit THEN permalink ELSE slack_permalink END AS slack_permalink,
        CASE WHEN hit THEN link_error ELSE last_error END AS last_error,
        CASE WHEN hit THEN {NOW} ELSE updated_at END AS updated_at)
        FROM (SELECT q.*, l.permalink, l.link_error, publication_status = 'PUBLISHED' AND l.activity_id IS NOT NULL AS hit
          FROM queue q LEFT JOIN (SELECT * FROM link WHERE activity_id IN (SELECT activity_id FROM raw_links)) l
            ON l.activity_id = q.activity_id)""",
    "full_refresh": "SELECT * FROM impact",
    "stream_queue_merge": f"""SELECT CAST(activity_id AS BIGINT) AS activity_id, employee_id, activity_start_datetime,
        sport_type, distance_meters, elapsed_seconds, activity_comment, source_system, 'PENDING' AS publication_status,
        0 AS attempt_count, CAST(NULL AS TIMESTAMP) AS claimed_at, CAST(NULL AS TIMESTAMP) AS published_at,
        CAST(NULL AS VARCHAR) AS slack_channel_id, CAST(NULL AS VARCHAR) AS slack_message_ts,
        CAST(NULL AS VARCHAR) AS slack_permalink, CAST(NULL AS VARCHAR) AS last_error,
        {NOW} AS created_at, {NOW} AS updated_at FROM fact""",
    "row_lineage": """SELECT 'orders.parquet' AS source_file, CAST(row_number() OVER () + 1 AS VARCHAR)
        AS source_row_number, o_orderkey FROM orders""",
    "loaded_row_numbers": "SELECT c_custkey AS employee_id, row_number() OVER (ORDER BY c_custkey) AS place FROM customer",
    "workspace_reset": " UNION ALL ".join([*[
        f"SELECT '{moment}' AS moment, '{name}' AS relation, {count} AS row_count FROM {source}"
        for name, source in (("hr_employees_txt", "customer"), ("employee_sport_profile_txt", "raw_employee_sport_profile_txt"),
                             ("sport_activities_txt", "orders"), ("google_routes_responses_txt", "events"),
                             ("benefit_parameters_txt", "supplier"), ("queue", "fact"))
        for moment, count in (("before", "count(*)"), ("after", "0 * count(*)"))]]),
    "route_candidates": """SELECT * EXCLUDE (id_text, business_unit) FROM fresh_requests
        ORDER BY id_text, source_row_number, request_key LIMIT 100""",
    "new_route_requests": "SELECT * EXCLUDE (id_text, business_unit) FROM fresh_requests",
    "append_responses_by_key": f"""SELECT {_ROUTE_COLUMNS} FROM {_KEYED_ROUTES} WHERE response_http_status = 'NO_ROUTE'
        UNION ALL SELECT {_ROUTE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY request_key
            ORDER BY requested_at, source_row_number, employee_id, response_payload_json) AS rn
          FROM {_KEYED_ROUTES} WHERE request_key NOT IN
            (SELECT request_key FROM {_KEYED_ROUTES} WHERE response_http_status = 'NO_ROUTE')) WHERE rn = 1""",

    "audit_unique": """SELECT l_orderkey * 10 + l_linenumber AS unique_field, count(*) AS n_records FROM lineitem
        GROUP BY 1 HAVING count(*) > 1""",
    "audit_not_null": "SELECT activity_id, sport_type FROM queue WHERE distance_meters IS NULL",
    "audit_is_true": """SELECT l_returnflag, l_linestatus, count(*) AS failing_rows FROM lineitem
        WHERE NOT coalesce(l_discount <= 0.05 AND l_quantity < 40, false) GROUP BY 1, 2""",
    "audit_valid_records": """SELECT activity_id_raw, sport_type, elapsed_seconds_raw, record_is_valid
        FROM stg_sport_activities WHERE NOT coalesce(record_is_valid, false)""",
    "audit_duplicate_profiles": """SELECT employee_id AS unique_field, count(*) AS n_records FROM wellbeing
        WHERE employee_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "model_audit_counts": _audit_counts(),
    "stored_audit_rows": _audit_rows(),
    "queue_audit_counts": _queue_audits(),
    "range_audit_rows": " UNION ALL ".join(
        f"SELECT '{relation}' AS relation, source_row_number_raw, {column}_raw AS number_text "
        + _out_of_range("history" if relation == "config_benefit_parameters" else relation, column)
        for relation, column in NUMBERS.items()),
}


_PUBLIC = "publication_status IN ('PENDING', 'ERROR') OR coalesce(publication_status = 'IN_PROGRESS' AND claimed_at < " + NOW + " - INTERVAL 15 MINUTE, false)"

ORACLE.update({
    "started_batch": f"""SELECT * FROM ({ORACLE["announcement_text"]}) WHERE activity_id IN (SELECT activity_id FROM queue
        WHERE {_PUBLIC} ORDER BY activity_start_datetime, activity_id LIMIT 40)""".replace(
        f"activity_id, {_DISTANCE_TEXT} AS distance_text, {_DURATION_TEXT} AS duration_text,", "activity_id,"),
    "publication_gate": """SELECT activity_id, publication_status, pending - mine AS other_pending_count, pending = 1 AND mine = 1 AS is_open
        FROM (SELECT *, CAST(publication_status = 'PENDING' AS BIGINT) AS mine FROM queue),
          (SELECT count(*) AS pending FROM queue WHERE publication_status = 'PENDING')""",
    "rate_bounds": """SELECT source_row_number_raw, parameter_value_raw FROM history
        WHERE parameter_name = 'bonus_rate' AND NOT coalesce(parameter_value BETWEEN 0.01 AND 1, false)""",
    "delivery_figures": " UNION ALL ".join([*[
        f"SELECT '{name}' AS figure, CAST(count(*) AS VARCHAR) AS value FROM {source}" for name, source in (
            ("hr_employees_txt", "customer"), ("employee_sport_profile_txt", "raw_employee_sport_profile_txt"),
            ("sport_activities_txt", "orders"), ("google_routes_responses_txt", "events"), ("fct_sport_activities", "fact"),
            ("BACKFILLED", "queue WHERE publication_status IN ('BACKFILLED', 'PENDING')"))],
        f"SELECT 'state', state FROM ({ORACLE['state_fingerprint']})"]),
    "registered_layers": " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS row_count FROM {source}" for name, source in (
            ("fct_sport_activities", "fact"), ("mart_commute_bonus_eligibility", "commute"), ("mart_wellbeing_eligibility", "wellbeing"),
            ("mart_benefits_impact_by_business_unit", "impact"),
            ("stg_sport_activities_invalid_records", "stg_sport_activities WHERE NOT coalesce(record_is_valid, false)"))),
    "seeded_parameters": """SELECT * FROM raw_parameter_history_txt UNION ALL SELECT 'initial_parameters', * FROM (VALUES
        ('1', 'bonus_rate', '0.05', '2025-06-20', '', 'Taux initial de la prime sportive'),
        ('2', 'wellbeing_activity_threshold', '15', '2025-06-20', '', 'Nombre minimal d activités sur douze mois'),
        ('3', 'wellbeing_days', '5', '2025-06-20', '', 'Nombre de jours bien-être accordés'),
        ('4', 'max_commute_distance_walking_km', '15', '2025-06-20', '', 'Distance maximale marche ou course à pied'),
        ('5', 'max_commute_distance_cycling_km', '25', '2025-06-20', '', 'Distance maximale vélo, trottinette ou autre'))""",
    "workspace_run": ORACLE["full_refresh"],
    "store_synchronise": ORACLE["insert_only_merge"],
    "store_claim_batch": ORACLE["claim_batch"],
    "store_settle_batch": ORACLE["apply_delivery_results"],
    "store_repair_links": ORACLE["apply_repaired_links"],
    "store_backfill": ORACLE["backfill_keep_newest"],
    "store_log_rows": f"""SELECT change_number, publication_status, count(*) AS row_count FROM (
        SELECT 1::BIGINT AS change_number, 'IN_PROGRESS' AS publication_status FROM claimable WHERE rn <= 40
        UNION ALL SELECT 2, 'ERROR' FROM queue WHERE publication_status = 'IN_PROGRESS' AND claimed_at < {NOW} - INTERVAL 15 MINUTE
        UNION ALL SELECT 3, 'PUBLISHED' FROM queue WHERE publication_status = 'PUBLISHED'
          AND activity_id IN (SELECT activity_id FROM raw_links)) GROUP BY ALL""",
    "stream_ledger": """SELECT source, CAST(count(*) AS BIGINT) AS arrived,
        count(*) FILTER (WHERE source = 'first' AND record_is_valid) AS queued,
        count(*) FILTER (WHERE source = 'replayed' AND record_is_valid) AS known,
        count(*) FILTER (WHERE NOT coalesce(record_is_valid, false)) AS invalid
        FROM stg_sport_activities, (VALUES ('first'), ('replayed')) AS s(source) GROUP BY source""",
    "boundary_of_half": """SELECT activity_id FROM newest_pending
        WHERE rn <= (SELECT count(*) // 2 FROM queue WHERE publication_status = 'PENDING')""",
})


def _needed(sql: str) -> list[str]:
    """Common table expressions a statement uses, directly or not, in dependency order."""
    order: list[str] = []

    def visit(text: str, seen: tuple[str, ...]) -> None:
        for name in CTES:
            if name not in seen and re.search(rf"(FROM|JOIN|,)\s+\(*{name}\b", text):
                visit(CTES[name], (*seen, name))
                if name not in order:
                    order.append(name)

    visit(sql, ())
    return order


def full_sql(name: str) -> str:
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in _needed(ORACLE[name]))
    return f"WITH {ctes}\n{ORACLE[name]}" if ctes else ORACLE[name]
