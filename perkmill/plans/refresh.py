"""The whole run: typed relations, marts, audits; and reading its results."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from perkmill.plans import marts, staging
from perkmill.plans.audits import MODEL_AUDITS, RANGE_AUDITS, AuditResult, register_failures, store_failures
from perkmill.sources.snapshots import Snapshot, register_layer

# Typed relations: model name, raw relation, plan.
STAGING_MODELS = (
    ("stg_hr_employees", "hr_employees_txt", staging.hr_employees),
    ("stg_employee_sport_profile", "employee_sport_profile_txt", staging.sport_profiles),
    ("stg_sport_activities", "sport_activities_txt", staging.sport_activities),
    ("stg_google_routes_responses", "google_routes_responses_txt", staging.route_responses),
    ("config_benefit_parameters", "benefit_parameters_txt", staging.benefit_parameters),
)

ALL_AUDITS = (*MODEL_AUDITS, *RANGE_AUDITS)
MART_MODELS = ("fct_sport_activities", "mart_commute_bonus_eligibility", "mart_wellbeing_eligibility",
               "mart_benefits_impact_by_business_unit")


def stage(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five typed relations, not computed yet."""
    return {model: plan(raw[relation]) for model, relation, plan in STAGING_MODELS}


def build_marts(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All marts as one plan each, nothing stored in between."""
    fact = marts.activity_fact(staged["stg_sport_activities"])
    people, parameters = staged["stg_hr_employees"], staged["config_benefit_parameters"]
    as_of = marts.calculation_date(fact)
    commute = marts.commute_bonus(people, staged["stg_google_routes_responses"], parameters, fact, as_of)
    well = marts.wellbeing(people, staged["stg_employee_sport_profile"], parameters, fact, as_of)
    return {
        "fct_sport_activities": fact,
        "mart_commute_bonus_eligibility": commute,
        "mart_wellbeing_eligibility": well,
        "mart_benefits_impact_by_business_unit": marts.impact_by_unit(commute, well),
    }


@dataclass(frozen=True)
class RefreshResult:
    version: int
    tables: Mapping[str, DataFrame]
    audits: list[AuditResult]
    range_audits: list[AuditResult]
    audit_version: int


def refresh(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, register: bool = False) -> RefreshResult:
    """Rebuild every mart and audit table under ``root`` as one new version.

    Typed relations stay views. Each mart is stored before the next one reads it, so the
    fact table is computed once although three later steps use it; it is partitioned by
    month, which lets the twelve-month window skip older folders. ``register`` makes the
    tables queryable as ``marts.<name>`` and ``audit.<name>``.
    """
    staged = stage(raw)
    # Two marts and the audits read the typed employees. They are typed once and kept on the
    # executors' disks for the run; typed activities are so wide that keeping them takes
    # longer than typing them again for the audits.
    people = staged["stg_hr_employees"].persist(StorageLevel.DISK_ONLY)
    try:
        return _refresh(spark, staged, root, register)
    finally:
        people.unpersist()


def _refresh(spark: SparkSession, staged: Mapping[str, DataFrame], root: str, register: bool) -> RefreshResult:
    people, parameters = staged["stg_hr_employees"], staged["config_benefit_parameters"]
    with Snapshot(spark, f"{root}/marts") as stored, Snapshot(spark, f"{root}/audit") as audit_tables:
        fact = stored.write(
            "fct_sport_activities",
            # Rows of a month are brought together, so that it gets few files; a month with
            # very many rows is split over several tasks.
            marts.activity_fact(staged["stg_sport_activities"]).hint("rebalance", F.col("activity_month")),
            partition_by=["activity_month"],
        )
        as_of = marts.calculation_date(fact)
        recent = fact.filter(
            F.col("activity_month") >= F.trunc(F.add_months(as_of, -marts.WINDOW_MONTHS), "month")
        )
        commute = stored.write("mart_commute_bonus_eligibility", marts.commute_bonus(
            people, staged["stg_google_routes_responses"], parameters, fact, as_of))
        well = stored.write("mart_wellbeing_eligibility", marts.wellbeing(
            people, staged["stg_employee_sport_profile"], parameters, recent, as_of))
        impact = stored.write("mart_benefits_impact_by_business_unit", marts.impact_by_unit(commute, well))
        tables = {
            "fct_sport_activities": fact,
            "mart_commute_bonus_eligibility": commute,
            "mart_wellbeing_eligibility": well,
            "mart_benefits_impact_by_business_unit": impact,
        }
        results = store_failures(audit_tables, {**staged, **tables}, ALL_AUDITS)
    if register:
        for name, df in staged.items():
            df.createOrReplaceTempView(name)
        register_layer(spark, "marts", {name: stored.path(name) for name in tables})
        register_failures(audit_tables, {**staged, **tables}, ALL_AUDITS)
    return RefreshResult(stored.version, tables, results[:len(MODEL_AUDITS)], results[len(MODEL_AUDITS):], audit_tables.version)
