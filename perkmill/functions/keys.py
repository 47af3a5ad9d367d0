"""Deterministic request keys and request documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from perkmill.functions.jsontext import json_string
from perkmill.functions.text import strip_all


def request_key(employee_id: Column, home: Column, office: Column, declared: Column, travel: Column) -> Column:
    """SHA-256 (hex) of the five parts joined by ``|``; NULL when a part is NULL."""
    parts = [strip_all(employee_id), strip_all(home), office, strip_all(declared), travel]
    bar = F.lit("|")
    joined = [piece for part in parts for piece in (part, bar)][:-1]
    return F.sha2(F.concat(*joined), 256)


def request_document(home: Column, office: Column, travel: Column) -> Column:
    """Route request as JSON text, keys sorted, ``", "`` and ``": "`` as separators."""
    return F.concat(
        F.lit('{"destination": {"address": '), json_string(office),
        F.lit('}, "languageCode": "fr-FR", "origin": {"address": '), json_string(home),
        F.lit('}, "travelMode": '), json_string(travel),
        F.lit(', "units": "METRIC"}'),
    )
