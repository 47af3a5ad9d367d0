"""Text cleaning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Every character Unicode counts as white space, plus the four ASCII separators.
WHITESPACE = r"[\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def clean_text(c: Column) -> Column:
    """Strip spaces (only spaces: tabs are content) and turn blank text into NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def strip_all(c: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.regexp_replace(c, rf"\A{WHITESPACE}+|{WHITESPACE}+\z", "")


def collapse_whitespace(c: Column) -> Column:
    """One space for every run of white space, none at the ends."""
    return F.trim(F.regexp_replace(c, WHITESPACE + "+", " "))


def normalise_label(c: Column, spellings: Mapping[str, str]) -> Column:
    """Clean a label and replace known spellings, compared in lower case."""
    cleaned = clean_text(c)
    label = cleaned
    for spelling, replacement in spellings.items():
        label = F.when(F.lower(cleaned) == spelling, F.lit(replacement)).otherwise(label)
    return label


def fingerprint(*columns: Column) -> Column:
    """Columns as text joined by ``|``; NULLs are left out."""
    return F.concat_ws("|", *[c.cast("string") for c in columns])
