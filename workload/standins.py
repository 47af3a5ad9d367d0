"""Raw benefit relations derived from the driver's tables.

The driver's tables play the parts of the raw inputs: customers are employees, orders are
activities, events are route responses, suppliers are parameter versions. Every stand-in
reads its whole table. Some values are made blank or unreadable on purpose, so that each
validation branch is taken. The derivations are plain SQL that Spark and DuckDB share;
``{plus:...}`` marks the one construct that differs between the two, ``{shaped:...}`` a day that
is written in many ways.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "orders", "lineitem", "events", "supplier", "conversations")

OFFICE = "1 Office Square"

_START = "{plus:o_orderdate|o_orderkey % 86000}"
_SECONDS = "(60 + (o_orderkey * 37) % 7200)"

STANDINS = {
    "hr_employees_txt": """
        SELECT 'customer' AS source_file, CAST(c_custkey + 2 AS STRING) AS source_row_number,
          CASE WHEN c_custkey % 61 = 60 THEN '  ' || CAST(c_custkey AS STRING) || ' '
               ELSE CAST(c_custkey AS STRING) END AS employee_id,
          c_name AS last_name, 'N' || CAST(c_nationkey AS STRING) AS first_name,
          CASE WHEN c_custkey % 53 = 7 THEN '2026-02-30' WHEN c_custkey % 53 = 8 THEN 'today'
               ELSE {shaped:born|c_custkey % 23} END AS birth_date,
          c_mktsegment AS business_unit,
          CASE WHEN c_custkey % 59 = 8 THEN '20/06/2026'
               ELSE {shaped:hired|c_custkey % 29} END AS hire_date,
          CASE c_custkey % 41 WHEN 11 THEN '1e13' WHEN 12 THEN '0.00000001' WHEN 13 THEN '123456789012345.1250000001'
               WHEN 14 THEN '1' || repeat('0', 39) WHEN 15 THEN '1000.00000000004' WHEN 16 THEN '7e-12' WHEN 17 THEN '0012.50e2'
               ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) END AS gross_salary,
          CASE WHEN c_nationkey % 2 = 0 THEN 'CDI' ELSE 'CDD' END AS contract_type,
          CASE WHEN c_custkey % 67 = 9 THEN '1.5' ELSE CAST(c_nationkey AS STRING) END AS paid_leave_days,
          CASE WHEN c_custkey % 71 = 10 THEN '   ' ELSE c_name || ', ' || c_mktsegment END AS home_address,
          CASE c_nationkey % 3 WHEN 0 THEN 'Marche/running' WHEN 1 THEN ' Vélo/Trottinette/Autres '
               ELSE 'Voiture' END AS commute_mode
        FROM (SELECT *, CAST(date '1960-01-01' + CAST(c_custkey % 12000 AS INT) AS STRING) AS born,
            CAST(date '1990-01-01' + CAST(c_custkey % 9000 AS INT) AS STRING) AS hired FROM customer) AS c""",
    "employee_sport_profile_txt": """
        SELECT 'customer' AS source_file, CAST(c_custkey + 2 AS STRING) AS source_row_number,
          CAST(c_custkey AS STRING) AS employee_id,
          CASE c_nationkey % 5 WHEN 0 THEN 'Runing' WHEN 1 THEN ' RUNING ' WHEN 2 THEN 'Tennis'
               WHEN 3 THEN '  ' ELSE NULL END AS declared_sport
        FROM customer
        UNION ALL
        SELECT 'second profile', CAST(c_custkey + 2 AS STRING), CAST(c_custkey AS STRING), 'Natation'
        FROM customer WHERE c_acctbal > 9000""",
    "sport_activities_txt": f"""
        SELECT 'orders' AS source_file, CAST(o_orderkey + 2 AS STRING) AS source_row_number,
          CAST(o_orderkey AS STRING) AS activity_id, CAST(o_custkey AS STRING) AS employee_id,
          {{shaped:started|o_orderkey % 149}} AS activity_start_datetime,
          CASE WHEN o_orderkey % 91 = 2 THEN '  '
               WHEN o_orderpriority = '1-URGENT' THEN 'Runing' WHEN o_orderpriority = '2-HIGH' THEN ' runing '
               WHEN o_orderpriority = '3-MEDIUM' THEN 'Tennis' WHEN o_orderpriority = '5-LOW' THEN 'Voile'
               ELSE 'Natation' END AS sport_type,
          CASE WHEN o_orderpriority = '3-MEDIUM' THEN '' WHEN o_orderkey % 79 = 5 THEN '-5'
               WHEN o_orderkey % 73 = 4 THEN 'abc'
               WHEN o_orderkey % 107 = 6 THEN '1e12' WHEN o_orderkey % 107 = 7 THEN '.00000000001' WHEN o_orderkey % 107 = 8 THEN '5e40'
               ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS distance_meters,
          CASE WHEN o_orderkey % 83 = 0 THEN CAST({_START} AS STRING)
               WHEN o_orderkey % 101 = 1 THEN 'now'
               ELSE CAST({{plus:{{plus:o_orderdate|o_orderkey % 86000}}|{_SECONDS}}} AS STRING) END
            AS activity_end_datetime,
          CASE WHEN o_orderkey % 89 = 3 THEN '0' WHEN o_orderkey % 97 = 4 THEN '1e3'
               ELSE CAST({_SECONDS} AS STRING) END AS elapsed_seconds,
          CASE WHEN o_orderkey % 4 = 0 THEN '  ' WHEN o_orderkey % 4 = 1 THEN 'Belle   sortie'
               ELSE 'Order ' || o_orderstatus END AS activity_comment,
          'orders' AS source_system
        FROM (SELECT *, CAST({_START} AS STRING) AS started FROM orders) AS o""",
    "google_routes_responses_txt": """
        SELECT 'events' AS source_file, CAST(event_id + 2 AS STRING) AS source_row_number,
          'request-' || CAST(event_id AS STRING) AS request_key, CAST(user_id AS STRING) AS employee_id,
          'home of ' || CAST(user_id AS STRING) AS home_address, '1 Office Square' AS office_address,
          CASE WHEN user_id % 2 = 0 THEN 'Marche/running' ELSE 'Vélo/Trottinette/Autres' END
            AS declared_commute_mode,
          CASE WHEN event_type = 'signup' THEN 'WALK'
               WHEN user_id % 2 = 0 THEN 'WALK' ELSE 'BICYCLE' END AS google_travel_mode,
          props AS request_payload_json,
          CASE WHEN event_type <> 'error' THEN '200' WHEN event_id % 3 = 0 THEN 'NO_ROUTE'
               WHEN event_id % 3 = 1 THEN 'REQUEST_ERROR' ELSE '404' END AS response_http_status,
          CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN '[]'
               WHEN event_id % 13 = 1 THEN '{"routes":[{"distanceMeters":' || k || '00.0,"duration":"60s"}]}'
               WHEN event_id % 13 = 2 THEN '{"routes":[{"distanceMeters":' || k || '00,"duration":"56.5s"}]}'
               WHEN event_id % 13 = 3 THEN '{"routes":[{"distanceMeters":' || k || '00,"duration":"60s"}]} tail'
               WHEN event_id % 13 = 4 THEN '{"routes":[]}'
               WHEN event_id % 13 = 5 THEN '{"routes":[{"distanceMeters":null,"duration":"60s"}]}'
               WHEN event_id % 13 = 6 THEN '{bad'
               WHEN event_id % 13 = 7 THEN '{"routes":[{"distanceMeters":1' || k || '00,"duration":"60"}]} {"a":1}'
               WHEN event_id % 131 = 8 THEN k WHEN event_id % 131 = 9 THEN '"text"' WHEN event_id % 131 = 10 THEN ' null '
               WHEN event_id % 131 = 11 THEN '{"a":"' || chr(92) || 'u0000"}' WHEN event_id % 131 = 12 THEN '{"a":"' || chr(92) || 'ud800 x"}'
               WHEN event_id % 131 = 13 THEN '{"a":"' || chr(92) || 'ud83d' || chr(92) || 'ude00"}' WHEN event_id % 131 = 14 THEN 'true false'
               ELSE '{"routes":[{"duration":"' || k || '7s","distanceMeters":' || k || '00}]}' END
            AS response_payload_json,
          CASE WHEN event_id % 103 = 5 THEN 'yesterday' ELSE CAST(ts AS STRING) || '+00:00' END AS requested_at
        FROM (SELECT *, CAST(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) % 400 AS STRING) AS k FROM events) AS e""",
    # The parameters the marts look up.
    "benefit_parameters_txt": """
        SELECT * FROM (VALUES
          ('initial', '1', 'bonus_rate', '0.05', '1990-01-01', '2001-06-30', 'closed'),
          ('revision', '1', 'bonus_rate', '0.06', '2001-07-01', '', 'current'),
          ('planned', '1', 'bonus_rate', '0.09', '2005-01-01', '', 'future'),
          ('initial', '2', 'wellbeing_activity_threshold', '2', '1990-01-01', '', ''),
          ('initial', '3', 'wellbeing_days', '5', '1990-01-01', '  ', ''),
          ('other', '9', 'wellbeing_days', '-1', '2001-01-01', '', 'invalid value'),
          ('initial', '4', 'max_commute_distance_walking_km', '15', '1990-01-01', '', ''),
          ('other', CAST(NULL AS STRING), 'max_commute_distance_cycling_km', '26', '1990-01-01', '', 'no row number'),
          ('initial', '5', 'max_commute_distance_cycling_km', '25', '1990-01-01', '', ''),
          ('other', '7', 'unknown_parameter', '1', '1990-01-01', '', ''),
          ('other', '8', CAST(NULL AS STRING), '1', '1990-01-01', '', '')
        ) AS p (source_file, source_row_number, parameter_name, parameter_value, valid_from, valid_to,
                parameter_comment)""",
    # A long parameter history: one version per supplier, many of them overlapping.
    "parameter_history_txt": """
        SELECT 'supplier' AS source_file,
          CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE CAST(s_suppkey AS STRING) END AS source_row_number,
          CASE s_suppkey % 7 WHEN 0 THEN 'bonus_rate' WHEN 1 THEN 'wellbeing_activity_threshold'
               WHEN 2 THEN 'wellbeing_days' WHEN 3 THEN 'max_commute_distance_walking_km'
               WHEN 4 THEN 'max_commute_distance_cycling_km' WHEN 5 THEN 'unknown_parameter'
               ELSE NULL END AS parameter_name,
          CASE WHEN s_suppkey % 29 = 3 THEN 'n/a' WHEN s_suppkey % 29 = 4 THEN '1e23' WHEN s_suppkey % 29 = 5 THEN '1e24'
               WHEN s_suppkey % 29 = 6 THEN '0.00000001' ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS STRING) END
            AS parameter_value,
          CASE WHEN s_suppkey % 31 = 4 THEN '1996'
               ELSE {shaped:since|s_suppkey % 17} END AS valid_from,
          CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL
               WHEN 2 THEN CAST(date '1994-06-01' + CAST((s_suppkey * 97) % 2600 - 1 AS INT) AS STRING)
               ELSE CAST(date '1994-06-01' + CAST((s_suppkey * 97) % 2600 + 40 + (s_suppkey * 13) % 900 AS INT)
                    AS STRING) || ' 12:00:00+00' END AS valid_to,
          s_name AS parameter_comment
        FROM (SELECT *, CAST(date '1994-06-01' + CAST((s_suppkey * 97) % 2600 AS INT) AS STRING) AS since FROM supplier) AS s""",
    # The publication queue holding every order.
    "queue": f"""
        SELECT o_orderkey AS activity_id, CAST(o_custkey AS INT) AS employee_id,
          {_START} AS activity_start_datetime, o_orderpriority AS sport_type,
          CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL
               ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,10)) END AS distance_meters,
          CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST({_SECONDS} AS INT) END AS elapsed_seconds,
          CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Order  ' || o_orderstatus END AS activity_comment,
          'orders' AS source_system,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'PENDING' WHEN '2-HIGH' THEN 'IN_PROGRESS'
               WHEN '3-MEDIUM' THEN 'PUBLISHED' WHEN '4-NOT SPECIFIED' THEN 'ERROR' ELSE 'BACKFILLED' END
            AS publication_status,
          CAST(o_orderkey % 3 AS INT) AS attempt_count,
          CASE WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') THEN {_START} END AS claimed_at,
          CASE WHEN o_orderpriority = '3-MEDIUM' THEN {{plus:o_orderdate|o_orderkey % 50}} END AS published_at,
          CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'C1' END AS slack_channel_id,
          CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS STRING) END
            AS slack_message_ts,
          CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderkey % 2 = 0 THEN 'https://link.example' END
            AS slack_permalink,
          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'failed' END AS last_error,
          o_orderdate AS created_at, o_orderdate AS updated_at
        FROM orders""",
    # One captured delivery response per order.
    "all_deliveries": """
        SELECT o_orderkey AS activity_id,
          CASE WHEN o_orderkey % 7 = 0 THEN 'connection to ' || o_orderstatus || ' lost' END AS error,
          CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN 502 ELSE 200 END AS http_status,
          CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '<html>bad gateway</html>'
               WHEN 2 THEN '{"ok":false,"error":"channel_not_found"}' WHEN 3 THEN '{"ok":false}'
               WHEN 4 THEN '{"ok":true,"channel":"C9"}'
               ELSE '{"ok":true,"channel":"C9","ts":"' || CAST(o_orderkey AS STRING) || '.5"}' END AS body
        FROM orders""",
    "all_links": """
        SELECT o_orderkey AS activity_id,
          CASE WHEN o_orderkey % 11 = 0 THEN 'timeout' END AS error,
          CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 200 END AS http_status,
          CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'oops' WHEN 2 THEN '{"ok":false,"error":"message_not_found"}'
               WHEN 3 THEN '{"ok":true,"permalink":""}'
               ELSE '{"ok":true,"permalink":"https://link.example/' || CAST(o_orderkey AS STRING) || '"}' END AS body
        FROM orders""",
}
# Batches that are not answered whole: missing responses are what settling has to bear.
STANDINS["deliveries"] = STANDINS["all_deliveries"] + " WHERE o_orderstatus <> 'P'"
STANDINS["links"] = STANDINS["all_links"] + " WHERE o_orderstatus = 'O'"

_SHAPED = re.compile(r"\{shaped:([^{}|]*)\|([^{}|]*)\}")
# Other ways to write a day, by the value of the chosen remainder.
_WAYS = ("{y}/{m}/{d}", "{y}.{m}.{d}", "{m}/{d}/{y}", "{m}-{d}-{y}", "{m}/{d}/{yy}", "{y}{m}{d}", "{yy}{m}{d}", "{month} {d}, {y}",
         "{mon} {d} {y}", "{d} {MONTH} {y}", "{d}-{mon}-{y}", "{d}-{mon}-{yy}", "{y}-{mon}-{d}", "{mon}-{d}-{y}")
# The months in nine characters each.
_MONTH_NAMES = "January  February March    April    May      June     July     August   SeptemberOctober  November December "


def _shaped(text: str, way: str) -> str:
    """``text``, which begins with yyyy-mm-dd, written in the way that ``way`` says, or as it is."""
    name = f"trim(substr('{_MONTH_NAMES}', 9 * CAST(substr({text}, 6, 2) AS INT) - 8, 9))"
    parts = {"y": f"substr({text}, 1, 4)", "yy": f"substr({text}, 3, 2)", "m": f"substr({text}, 6, 2)", "d": f"substr({text}, 9, 2)",
             "month": name, "mon": f"substr({name}, 1, 3)", "MONTH": f"upper({name})"}
    cases = []
    for value, form in enumerate(_WAYS, 1):
        pieces = [parts[p] if i % 2 else f"'{p}'" for i, p in enumerate(re.split(r"[{}]", form)) if p]
        cases.append(f"WHEN {value} THEN {' || '.join(pieces)} || substr({text}, 11)")
    return f"(CASE {way} {' '.join(cases)} ELSE {text} END)"


_PLUS = re.compile(r"\{plus:([^{}|]*)\|([^{}|]*)\}")


def _render(sql: str, plus: str) -> str:
    while _PLUS.search(sql):
        sql = _PLUS.sub(lambda m: plus.format(moment=m.group(1), seconds=m.group(2)), sql)
    return _SHAPED.sub(lambda m: _shaped(m.group(1), m.group(2)), sql)


def duckdb_sql(name: str) -> str:
    return _render(STANDINS[name], "({moment} + to_seconds(CAST({seconds} AS BIGINT)))")


def spark_sql(name: str) -> str:
    return _render(STANDINS[name], "timestampadd(SECOND, {seconds}, {moment})")


# Columns of the tables used, so that opening a file needs no job to find its schema.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in as a lazy DataFrame."""
    for t in TABLES:
        if re.search(rf"\bFROM {t}\b", STANDINS[name]):
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(spark_sql(name))
