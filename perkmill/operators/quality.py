"""Audits: each returns the rows that break a rule. NULL never passes a test."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from perkmill.functions.rules import any_of, holds

AUDIT = "audit"


@dataclass(frozen=True)
class Audit:
    """A named check on one relation. ``warn`` reports, ``error`` stops the run.

    ``passes`` is the row test when the check looks at rows one by one, so that several
    checks of a relation can be counted in one pass.
    """

    name: str
    relation: str
    failures: Callable[[DataFrame], DataFrame]
    passes: Callable[[], Column] | None = None
    severity: str = "warn"


def failing(df: DataFrame, test: Column) -> DataFrame:
    return df.filter(~holds(test))


def repeated(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number; NULLs are not compared."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def _row_audit(name: str, relation: str, test: Callable[[], Column], severity: str) -> Audit:
    return Audit(name, relation, lambda df: failing(df, test()), test, severity)


def row_rule(name: str, relation: str, test: Callable[[], Column], severity: str = "warn") -> Audit:
    """A rule that is written as a column."""
    return _row_audit(name, relation, test, severity)


def valid_records(name: str, relation: str, severity: str = "warn") -> Audit:
    return _row_audit(name, relation, lambda: F.col("record_is_valid"), severity)


def is_true(name: str, relation: str, expression: str, severity: str = "warn") -> Audit:
    return _row_audit(name, relation, lambda: F.expr(expression), severity)


def not_null(name: str, relation: str, column: str, severity: str = "warn") -> Audit:
    return _row_audit(name, relation, lambda: F.col(column).isNotNull(), severity)


def unique(name: str, relation: str, column: str, severity: str = "warn") -> Audit:
    return Audit(name, relation, lambda df: repeated(df, column), None, severity)


def tagged_failures(df: DataFrame, audits: Sequence[Audit]) -> DataFrame:
    """Rows that break the rules of ``audits``, once for each broken rule, named in ``audit``.

    All rules are tested in one pass over ``df``; a row that breaks none leaves it at once.
    Only for audits that look at rows one by one.

    Spark interprets what an explode is given, row by row. The tests are columns of their own
    below it, so they are compiled, and only rows that break a rule reach it. As in
    ``valid_rows``, the row number keeps the filter above the tests and the casts they need.
    """
    if AUDIT in df.columns:
        raise ValueError(f"{AUDIT} is the column that names the broken rule")
    once, tests = "__once", {f"__broken_{i}": ~holds(a.passes()) for i, a in enumerate(audits)}
    tested = df.withColumns({once: F.monotonically_increasing_id(), **tests})
    found = tested.filter(any_of(F.col(t) for t in tests) & (F.col(once) >= 0))
    broken = F.array_compact(F.array(*[F.when(F.col(t), F.lit(a.name)) for t, a in zip(tests, audits)]))
    return found.withColumn(AUDIT, F.explode(broken)).drop(once, *tests)


def failure_counts(df: DataFrame, audits: list[Audit]) -> DataFrame:
    """One row with the number of failing rows of each audit, in one pass over ``df``."""
    row_tests = [F.count_if(~holds(a.passes())).alias(a.name) for a in audits if a.passes]
    counts = df.agg(*row_tests) if row_tests else df.sparkSession.range(1).select()
    key_tests = {a.name: a.failures(df).agg(F.count(F.lit(1)).alias("n")).scalar() for a in audits if not a.passes}
    return counts.withColumns(key_tests).select(*[a.name for a in audits])


def assert_value(df: DataFrame, expected: str, label: str = "value") -> None:
    """Fail unless ``df`` is one row and one column whose text equals ``expected``."""
    rows = df.select(F.col(df.columns[0]).cast("string")).limit(2).collect()
    actual = rows[0][0] if len(rows) == 1 else f"{len(rows)} rows"
    if actual != expected:
        raise AssertionError(f"{label}: expected {expected}, got {actual}")
