"""JSON kept as text: validation and path access."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Spark's JSON functions let these pass where JSON does not: ' as a quote, control
# characters inside strings. A text with any of them is checked by the strict reader.
_SUSPECT = r"['\x00-\x1f]"

# After an even number of backslashes: zero, a high half without a low one, a low half without a high one.
_ESCAPE, _HIGH, _LOW = r"(?<!\\)(?:\\\\)*\\u", r"[dD][89abAB][0-9a-fA-F]{2}", r"[dD][c-fC-F][0-9a-fA-F]{2}"
_NO_CHARACTER = rf"{_ESCAPE}(?:0000|{_HIGH}(?!\\u{_LOW}))|(?<!\\u{_HIGH}){_ESCAPE}{_LOW}"


def _is_one_value(text: Column) -> Column:
    """True when the whole text is exactly one JSON value, ``null`` excepted; may be NULL.

    Spark's JSON readers stop after the first value, so text after it goes unseen. Put
    inside an object *and* inside an array, a text that is more than one value breaks at
    least one of the two: it cannot close both wrappers with the same character.
    """
    as_member = F.concat(F.lit('{"v":'), text, F.lit("}"))
    in_object = F.when(
        text.rlike(_SUSPECT), F.from_json(as_member, "v string", _STRICT)["v"].isNotNull()
    ).otherwise(F.size(F.json_object_keys(as_member)) == 1)
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return in_array & in_object


def is_json_document(text: Column) -> Column:
    """True when the whole text is exactly one JSON object or array."""
    bracketed = text.rlike(r"(?s)\A\s*(\{.*\}|\[.*\])\s*\z")
    return F.coalesce(bracketed & _is_one_value(text), F.lit(False))


def is_json_value(text: Column) -> Column:
    """True when the whole text is exactly one JSON value that can be stored: any kind of value.

    Escapes that stand for no character cannot: ``\u0000`` and one half of a surrogate pair.
    """
    value = _is_one_value(text) & F.when(text.contains("\\u"), ~text.rlike(_NO_CHARACTER)).otherwise(F.lit(True))
    return F.coalesce(value | text.rlike(r"\A[ \t\r\n]*null[ \t\r\n]*\z"), F.lit(False))


def json_path(document: Column, path: str) -> Column:
    """Value at ``path`` (as ``routes[0].duration``) as text; NULL when absent or null."""
    return F.get_json_object(document, "$." + path)


def is_truthy(value: Column) -> Column:
    """JSON text that is neither absent, null, false, zero nor empty."""
    return F.coalesce(~value.isin("", "false", "0", "0.0", "-0", "[]", "{}"), F.lit(False))


def json_string(c: Column) -> Column:
    """Text as a quoted JSON string."""
    quoted = F.to_json(F.array(c))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)
