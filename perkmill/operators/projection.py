"""Typing of text relations and row validation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from perkmill.functions.casting import safe_cast
from perkmill.functions.rules import all_of
from perkmill.functions.text import clean_text, normalise_label
from perkmill.vocabulary import SPORT_SPELLINGS


@dataclass(frozen=True)
class Field:
    """One raw text column and the typed columns made from it.

    ``target`` is a cast target; ``label`` asks for spelling correction instead. A field
    that is not plain text keeps its cleaned text beside it as ``<name>_raw``.
    """

    name: str
    target: str | T.DecimalType = "text"
    label: bool = False
    alias: str | None = None
    raw_name: str | None = None

    def columns(self) -> list[Column]:
        source, name = F.col(self.name), self.alias or self.name
        if self.label:
            typed = normalise_label(source, SPORT_SPELLINGS)
        elif self.target == "text":
            return [clean_text(source).alias(name)]
        else:
            typed = safe_cast(source, self.target)
        return [clean_text(source).alias(self.raw_name or f"{self.name}_raw"), typed.alias(name)]


def type_columns(raw: DataFrame, fields: Iterable[Field]) -> DataFrame:
    return raw.select(*[c for f in fields for c in f.columns()])


def with_validity(
    df: DataFrame,
    rules: Iterable[Column],
    flags: Mapping[str, Column] | None = None,
    never_null: bool = False,
) -> DataFrame:
    """Add one column per named flag and ``record_is_valid``, the conjunction of ``rules``."""
    verdict = all_of(rules)
    if never_null:
        verdict = F.when(verdict, True).otherwise(False)
    return df.withColumns({**(flags or {}), "record_is_valid": verdict})


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows whose validity is true; NULL counts as invalid.

    Validity is made from casts of text. Spark would move the filter below those casts
    and repeat them inside it, then do them again for the rows that pass, gaining nothing:
    a condition on a cast cannot reach the files. It does not move a filter past a row
    number, so each cast is done once.
    """
    once = "__once"
    numbered = df.withColumn(once, F.monotonically_increasing_id())
    return numbered.filter(F.col("record_is_valid") & (F.col(once) >= 0)).drop(once)
