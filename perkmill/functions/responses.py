"""Outcome of captured service responses.

A captured response is three columns: the transport error (NULL when an answer came),
the HTTP status and the body text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from perkmill import vocabulary as V
from perkmill.functions.jsontext import is_json_document, is_truthy, json_path, json_string


def route_status(error: Column, http_status: Column, body: Column) -> Column:
    """Status text stored with a route response."""
    has_routes = is_json_document(body) & is_truthy(json_path(body, "routes"))
    return (
        F.when(error.isNotNull(), F.lit(V.REQUEST_ERROR))
        .when((http_status == 200) & ~has_routes, F.lit(V.NO_ROUTE))
        .otherwise(http_status.cast("string"))
    )


def route_payload(error: Column, body: Column) -> Column:
    """Body stored with a route response; anything but JSON is wrapped in JSON."""
    return (
        F.when(error.isNotNull(), F.concat(F.lit('{"request_error": '), json_string(error), F.lit("}")))
        .when(is_json_document(body), body)
        .otherwise(F.concat(F.lit('{"raw_response": '), json_string(F.coalesce(body, F.lit(""))), F.lit("}")))
    )


def is_failed_status(status: Column) -> Column:
    return ~status.startswith("2")


def _refusal(error: Column, http_status: Column, body: Column, prefix: str) -> Column:
    """Error text of a response that is no acceptance; NULL when it is one."""
    reason = F.coalesce(json_path(body, "error"), F.lit(V.UNKNOWN_ERROR))
    return (
        F.when(error.isNotNull(), F.concat(F.lit(f"{prefix}{V.REQUEST_ERROR}: "), error))
        .when(~is_json_document(body) | body.isNull(),
              F.concat(F.lit(f"{prefix}{V.INVALID_JSON_RESPONSE}: HTTP "), http_status.cast("string")))
        .when(~is_truthy(json_path(body, "ok")), F.concat(F.lit(f"{prefix}{V.DELIVERY_ERROR}: "), reason))
    )


def delivery_outcome(error: Column, http_status: Column, body: Column) -> Column:
    """Struct ``succeeded, channel_id, message_ts, error_message`` of a delivery response."""
    channel, message_ts = json_path(body, "channel"), json_path(body, "ts")
    complete = is_truthy(channel) & is_truthy(message_ts)
    problem = F.coalesce(
        _refusal(error, http_status, body, ""),
        F.when(~complete, F.lit(f"{V.DELIVERY_ERROR}: {V.MISSING_DELIVERY_FIELDS}")),
    )
    return F.struct(
        problem.isNull().alias("succeeded"),
        F.when(problem.isNull(), channel).alias("channel_id"),
        F.when(problem.isNull(), message_ts).alias("message_ts"),
        problem.alias("error_message"),
    )


def link_outcome(error: Column, http_status: Column, body: Column) -> Column:
    """Struct ``permalink, link_error`` of a link response."""
    link = json_path(body, "permalink")
    problem = F.coalesce(
        _refusal(error, http_status, body, V.LINK_ERROR_PREFIX),
        F.when(~is_truthy(link), F.lit(f"{V.LINK_ERROR_PREFIX}{V.DELIVERY_ERROR}: {V.MISSING_LINK}")),
    )
    return F.struct(F.when(problem.isNull(), link).alias("permalink"), problem.alias("link_error"))
