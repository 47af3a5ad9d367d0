"""Predicates with explicit three-valued logic, and ordered decisions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F


def all_of(rules: Iterable[Column]) -> Column:
    """Conjunction; NULL stays NULL unless some rule is false."""
    return reduce(and_, rules)


def any_of(rules: Iterable[Column]) -> Column:
    return reduce(or_, rules)


def present(*columns: Column) -> list[Column]:
    return [c.isNotNull() for c in columns]


def holds(test: Column) -> Column:
    """NULL counts as false.

    A comparison with an unknown value is NULL, so ``holds(x > 0)`` says that ``x`` is
    known and positive while reading ``x`` once. That matters where ``x`` is a cast that
    Spark repeats for every mention in a filter.
    """
    return F.coalesce(test, F.lit(False))


def absent_or(raw: Column, test: Column) -> Column:
    """An optional field: not given at all, or readable and passing ``test``."""
    return raw.isNull() | holds(test)


def paired(left: Column, right: Column, pairs: Mapping[str, str]) -> Column:
    """``(left, right)`` is one of the allowed pairs."""
    return any_of((left == a) & (right == b) for a, b in pairs.items())


def covers(valid_from: Column, valid_to: Column, day: Column) -> Column:
    """``day`` lies in the interval, both ends included, open when ``valid_to`` is NULL."""
    return (valid_from <= day) & (valid_to.isNull() | (valid_to >= day))


def first_match(decisions: Sequence[tuple[Column, str]], default: str) -> Column:
    """Value of the first decision whose condition is true."""
    (condition, value), *rest = decisions
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def translate_value(c: Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup; NULL when the key is unknown."""
    keys = list(mapping.items())
    chain = F.when(c == keys[0][0], F.lit(keys[0][1]))
    for key, value in keys[1:]:
        chain = chain.when(c == key, F.lit(value))
    return chain
