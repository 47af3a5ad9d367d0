"""The audits of the models, and storing what they find."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from perkmill.functions.casting import keeps_number
from perkmill.operators.quality import (
    AUDIT, Audit, failure_counts, is_true, not_null, row_rule, tagged_failures, unique, valid_records,
)
from perkmill.plans.marts import bonus_amount
from perkmill.schemas import AMOUNT, RATE
from perkmill.sources.snapshots import (
    Snapshot, read_table, register_layer, register_partitioned, register_view, table_path,
)

CONCURRENT_AUDITS = 4

_WELLBEING = "mart_wellbeing_eligibility"
_COMMUTE = "mart_commute_bonus_eligibility"
_IMPACT = "mart_benefits_impact_by_business_unit"

_COUNTS_AND_AMOUNTS = (
    "active_commute_declared_employee_count", "employee_with_valid_route_count",
    "commute_bonus_eligible_employee_count", "annual_commute_bonus_gross",
    "wellbeing_eligible_employee_count", "awarded_wellbeing_days",
    "employee_with_at_least_one_benefit_count", "employee_with_both_benefits_count",
)

# Names and rules of the audits.
MODEL_AUDITS: tuple[Audit, ...] = (
    valid_records("stg_hr_employees_invalid_records", "stg_hr_employees"),
    valid_records("stg_employee_sport_profile_invalid_records", "stg_employee_sport_profile"),
    valid_records("stg_sport_activities_invalid_records", "stg_sport_activities"),

    unique("mart_wellbeing_employee_id_unique", _WELLBEING, "employee_id"),
    not_null("mart_wellbeing_employee_id_not_null", _WELLBEING, "employee_id"),
    is_true("mart_wellbeing_eligibility_matches_activity_threshold", _WELLBEING,
            "is_wellbeing_eligible = (activity_count_last_12_months >= wellbeing_activity_threshold)"),
    is_true("mart_wellbeing_days_match_eligibility", _WELLBEING,
            "awarded_wellbeing_days = if(is_wellbeing_eligible, wellbeing_days, 0)"),

    unique("mart_commute_bonus_employee_id_unique", _COMMUTE, "employee_id"),
    not_null("mart_commute_bonus_employee_id_not_null", _COMMUTE, "employee_id"),
    is_true("mart_commute_bonus_flag_matches_reason", _COMMUTE,
            "is_commute_bonus_eligible = (eligibility_reason = 'ELIGIBLE')"),
    row_rule("mart_commute_bonus_amount_matches_eligibility", _COMMUTE, lambda: F.col("annual_commute_bonus_gross") == F.when(
        F.col("is_commute_bonus_eligible"), bonus_amount(F.col("gross_salary"), F.col("bonus_rate"))).otherwise(0)),
    is_true("mart_commute_bonus_eligible_employee_has_valid_route", _COMMUTE,
            "not is_commute_bonus_eligible or (is_active_commute_declared and has_valid_route"
            " and route_distance_km <= maximum_authorized_distance_km)"),

    not_null("mart_benefits_impact_calculation_date_not_null", _IMPACT, "calculation_as_of_date"),
    not_null("mart_benefits_impact_business_unit_not_null", _IMPACT, "business_unit"),
    is_true("mart_benefits_impact_counts_and_amounts_are_non_negative", _IMPACT,
            " and ".join(["employee_count > 0", *[f"{c} >= 0" for c in _COUNTS_AND_AMOUNTS]])),
)


def _numbers_kept(relation: str, column: str, kept_as: T.DecimalType) -> Audit:
    return row_rule(f"{relation}_numbers_kept", relation, lambda: keeps_number(F.col(f"{column}_raw"), kept_as))


# Numbers that 38 digits cannot hold: rounded if they have too many decimals, NULL if they are too great.
RANGE_AUDITS: tuple[Audit, ...] = (
    _numbers_kept("stg_hr_employees", "gross_salary", AMOUNT),
    _numbers_kept("stg_sport_activities", "distance_meters", AMOUNT),
    _numbers_kept("config_benefit_parameters", "parameter_value", RATE),
)


@dataclass(frozen=True)
class AuditResult:
    name: str
    severity: str
    failing_rows: int


class AuditFailure(RuntimeError):
    """A check of severity ``error`` found failing rows."""


def run_audits(relations: Mapping[str, DataFrame], audits: Sequence[Audit] = MODEL_AUDITS) -> list[AuditResult]:
    """Count failing rows: one job per relation, however many audits it has."""
    results = []
    for relation, checks in by_relation(audits).items():
        counts = failure_counts(relations[relation], checks).first()
        results += [AuditResult(a.name, a.severity, counts[a.name]) for a in checks]
    return results


def failures_table(relation: str) -> str:
    return f"{relation}_failures"


def by_relation(audits: Sequence[Audit]) -> dict[str, list[Audit]]:
    grouped: dict[str, list[Audit]] = defaultdict(list)
    for audit in audits:
        grouped[audit.relation].append(audit)
    return dict(grouped)


def store_failures(
    snapshot: Snapshot, relations: Mapping[str, DataFrame], audits: Sequence[Audit] = MODEL_AUDITS,
) -> list[AuditResult]:
    """Store what every audit finds and report the number of failing rows.

    The rules of a relation are tested in one pass over it, so it is worked out once. Its
    failing rows go to one table (``failures_table``) with a partition for each broken rule;
    a row that breaks two rules is in both. Repeated keys have columns of their own and go to
    a table named after their audit, from a pass over the key alone. Rows are counted in the
    stored tables. A ``warn`` audit never stops the run; an ``error`` audit does, once
    everything is stored.
    """
    def store_rules(relation: str, rules: Sequence[Audit]) -> dict[str, int]:
        found = tagged_failures(relations[relation], rules)
        # The failing rows of a rule are brought together, so that they make few files.
        stored = snapshot.write(failures_table(relation), found.hint("rebalance", F.col(AUDIT)), partition_by=[AUDIT])
        counts = dict.fromkeys((a.name for a in rules), 0)
        return counts | {r[AUDIT]: r["count"] for r in stored.groupBy(AUDIT).count().collect()}

    def store_repeated(audit: Audit) -> dict[str, int]:
        return {audit.name: snapshot.write(audit.name, audit.failures(relations[audit.relation])).count()}

    rules = by_relation([a for a in audits if a.passes])
    # Most audits are small jobs: a few at a time keep the cluster busy.
    with ThreadPoolExecutor(CONCURRENT_AUDITS) as pool:
        jobs = [pool.submit(store_rules, relation, checks) for relation, checks in rules.items()]
        jobs += [pool.submit(store_repeated, a) for a in audits if not a.passes]
        counts = {name: n for job in jobs for name, n in job.result().items()}
    results = [AuditResult(a.name, a.severity, counts[a.name]) for a in audits]
    enforce(results)
    return results


def stored_failures(
    spark: SparkSession, root: str, audit: Audit, relation: DataFrame, version: int | None = None,
) -> DataFrame:
    """What ``audit`` found in a version of ``root`` (the newest by default), as stored.

    ``relation`` is only asked for its columns. One partition is read.
    """
    if not audit.passes:
        return read_table(spark, root, audit.name, version)
    schema = T.StructType([*relation.schema.fields, T.StructField(AUDIT, T.StringType())])
    path = table_path(spark, root, failures_table(audit.relation), version)
    return spark.read.schema(schema).parquet(path).filter(F.col(AUDIT) == audit.name).drop(AUDIT)


def register_failures(snapshot: Snapshot, relations: Mapping[str, DataFrame], audits: Sequence[Audit], layer: str = "audit") -> None:
    """Make what every audit found queryable as ``layer.<audit>``."""
    spark = snapshot.spark
    register_layer(spark, layer, {a.name: snapshot.path(a.name) for a in audits if not a.passes})
    for relation, checks in by_relation([a for a in audits if a.passes]).items():
        table, columns = failures_table(relation), relations[relation].schema
        register_partitioned(spark, layer, table, snapshot.path(table), columns, AUDIT)
        shown = ", ".join(f"`{c}`" for c in columns.names)
        for audit in checks:
            register_view(spark, layer, audit.name, f"SELECT {shown} FROM `{layer}`.`{table}` WHERE {AUDIT} = '{audit.name}'")


def enforce(results: Sequence[AuditResult]) -> None:
    broken = [f"{r.name}: {r.failing_rows}" for r in results if r.severity == "error" and r.failing_rows]
    if broken:
        raise AuditFailure("; ".join(broken))
