"""Casts of dirty text that give NULL, never an error.

Spark's ``try_cast`` alone is too generous: it reads ``2026`` as a date, ``now`` as
today and ignores whatever follows the day. A pattern decides first whether the text
has an accepted shape; ``try_cast`` then rejects impossible values such as 30 February.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F, types as T

from perkmill.functions.jsontext import is_json_value
from perkmill.functions.text import clean_text
from perkmill.schemas import AMOUNT

_WHOLE = r"\A\s*[+-]?\d+\s*\z"
_NUMBER = r"\A\s*([+-]?)(?=\.?\d)(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d{1,4}))?\s*\z"
_CLOCK = r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?"
_OFFSET = r" ?(Z|UTC|[+-](\d{1,2}|\d{2}:?\d{2}))"
_REST = rf"([ T]{_CLOCK}({_OFFSET})?)?"

# Names of the months, whole or short.
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_MONTH = (r"(?i)(?<![a-z])(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|"
          r"oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)(?![a-z])")
_ISO = rf"\A\s*(?!0{{4,6}}-)\d{{4,6}}-\d{{1,2}}-\d{{1,2}}{_REST}\s*\z"

# What stands before the number of a named month, and around years of two digits until they are whole.
_NAMED, _LOW, _HIGH = "\ue000", "\ue001", "\ue002"


class _Shape:
    """The parts of one way to write a day; its groups carry its number."""

    def __init__(self, number: int):
        n = str(number)
        self.year = rf"(?<Y{n}>\d{{4,6}})"
        self.short_year = rf"(?:(?<l{n}>[0-6]\d)|(?<h{n}>[7-9]\d))"
        self.any_year = rf"(?:{self.short_year}|{self.year})(?!\d)"
        self.month, self.day = rf"(?<M{n}>\d{{1,2}})", rf"(?<D{n}>\d{{1,2}})"
        self.name = rf"{_NAMED}(?<M{n}>\d+)"
        self.same = rf"\k<S{n}>"
        self.number = n

    def mark(self, characters: str) -> str:
        return f"(?<S{self.number}>[{characters}])"


# Ways to write a day besides year-month-day.
DAY_SHAPES = (
    lambda s: s.year + s.mark("/.") + s.month + s.same + s.day,  # 2026/06/20
    lambda s: s.month + s.mark("-/.") + s.day + s.same + s.any_year,  # 06/20/2026, 6/20/26
    lambda s: rf"(?<Y{s.number}>\d{{4}})(?<M{s.number}>\d{{2}})(?<D{s.number}>\d{{2}})",  # 20260620
    lambda s: rf"{s.short_year}(?<M{s.number}>\d{{2}})(?<D{s.number}>\d{{2}})",  # 260620
    lambda s: s.name + "[ -]+" + s.day + "(?:, *|[ -]+)" + s.any_year,  # June 20, 2026
    lambda s: s.day + "[ -]*" + s.name + "(?:, *|[ -]+)" + s.any_year,  # 20-Jun-2026
    lambda s: s.year + "[ -]+" + s.name + "[ -]+" + s.day,  # 2026 June 20
)


def _one_pattern(shapes: Sequence[Callable[[_Shape], str]]) -> tuple[str, str]:
    """All shapes as one pattern, and what a text of any of them is replaced by.

    Groups of the shapes that a text has not are empty, so years, months and days of all
    shapes stand side by side in the replacement.
    """
    ways = "|".join(shape(_Shape(number)) for number, shape in enumerate(shapes))

    def groups(kind: str) -> str:
        return "".join(f"${{{kind}{n}}}" for n in range(len(shapes)) if f"(?<{kind}{n}>" in ways)

    return (rf"\A\s*(?:{ways})(?<rest>{_REST})\s*\z",
            f"{groups('Y')}{_LOW}{groups('l')}{_HIGH}{groups('h')}-{groups('M')}-{groups('D')}${{rest}}")


_ANY_DAY, _AS_ISO = _one_pattern(DAY_SHAPES)


def _moment(spark_type: str) -> Callable[[Column], Column]:
    """Text of any day shape, with or without a time of day, as ``spark_type``.

    Year-month-day is by far the most common way and needs no rewriting. Other texts are
    rewritten by one pattern, after a month's name has become its number. Years of two
    digits are those from 1970 to 2069.
    """
    def cast(c: Column) -> Column:
        name = F.lower(F.substring(F.regexp_extract(c, _MONTH, 1), 1, 3))
        number = ((F.position(name, F.lit(_MONTHS)) + 3) / 4).cast("int").cast("string")
        # Few texts have letters, and only those are searched for a month.
        named = F.when(c.rlike("[A-Za-z]{3}"), F.regexp_replace(c, F.lit(_MONTH), F.concat(F.lit(_NAMED), number))).otherwise(c)
        text = F.regexp_replace(named, _ANY_DAY, _AS_ISO)
        for part, reads in ((f"{_LOW}{_HIGH}-", "-"), (_LOW + _HIGH, "19"), (_LOW, "20"), (_HIGH, "")):
            text = F.replace(text, F.lit(part), F.lit(reads))
        # What still has another shape is not found, and empty text is no moment.
        return F.when(c.rlike(_ISO), c.try_cast(spark_type)).otherwise(F.regexp_extract(text, _ISO, 0).try_cast(spark_type))

    return cast


def _whole_number(spark_type: str) -> Callable[[Column], Column]:
    return lambda c: F.when(c.rlike(_WHOLE), c.try_cast(spark_type))


_CASTS: dict[str, Callable[[Column], Column]] = {
    "integer": _whole_number("int"),
    "bigint": _whole_number("bigint"),
    "date": _moment("date"),
    "timestamp": _moment("timestamp_ntz"),
    "timestamp with time zone": _moment("timestamp"),
}


def safe_cast(c: Column, target: str | T.DecimalType) -> Column:
    """Text as ``target``; NULL when blank, malformed or out of range.

    A decimal type, or ``numeric`` for AMOUNT, reads numbers; decimals it has no room for
    are rounded. The text is not cleaned first where it need not be: the patterns allow
    white space around the value, casts skip it, and blank text has no accepted shape.
    """
    if target == "text":
        return clean_text(c)
    if target == "jsonb":
        text = clean_text(c)
        return F.when(is_json_value(text), text)
    if target == "numeric":
        target = AMOUNT
    if isinstance(target, T.DecimalType):
        return F.when(c.rlike(_NUMBER), c.try_cast(target.simpleString()))
    return _CASTS[target](c)


def keeps_number(c: Column, target: T.DecimalType) -> Column:
    """Whether ``safe_cast`` to ``target`` keeps a number exactly; true for text that is no number.

    Decided by counting the digits of the text before and after its decimal point, once the
    exponent has moved it. Nearly all texts have no exponent and few enough digits, zeros at
    both ends included: one look at them is enough. A branch (``|`` is none) keeps the counting
    from being done for them all the same.
    """
    short = c.rlike(rf"\A\s*[+-]?\d{{0,{target.precision - target.scale}}}(\.\d{{0,{target.scale}}})?\s*\z")

    def part(group: int) -> Column:
        return F.regexp_extract(c, _NUMBER, group)

    zero = F.lit("0")
    whole, decimals = F.ltrim(part(2), zero), F.rtrim(part(3), zero)
    exponent = F.coalesce(F.nullif(part(4), F.lit("")).try_cast("int"), F.lit(0))
    digits = F.concat(part(2), part(3))
    leading = F.when(whole != "", F.length(whole)).otherwise(-(F.length(part(3)) - F.length(F.ltrim(part(3), zero))))
    trailing = F.when(decimals != "", F.length(decimals)).otherwise(
        -(F.length(part(2)) - F.length(F.rtrim(part(2), zero))))
    fits = (leading + exponent <= target.precision - target.scale) & (trailing - exponent <= target.scale)
    is_zero = F.ltrim(digits, zero) == ""
    return F.when(short, True).otherwise(F.coalesce(~c.rlike(_NUMBER) | is_zero | fits, F.lit(True)))
