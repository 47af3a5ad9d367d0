"""Read-only datasets over the marts."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from perkmill import vocabulary as V
from perkmill.functions.text import fingerprint
from perkmill.operators.quality import assert_value
from perkmill.schemas import MONEY, RATE


def bonus_by_unit(impact: DataFrame) -> DataFrame:
    """Bonus cost and beneficiaries per business unit, most expensive first."""
    return impact.select(
        "business_unit", "calculation_as_of_date", "annual_commute_bonus_gross",
        "commute_bonus_eligible_employee_count",
    ).orderBy(F.col("annual_commute_bonus_gross").desc_nulls_last(), "business_unit")


def bonus_beneficiaries(commute: DataFrame) -> DataFrame:
    return commute.filter("is_commute_bonus_eligible").select(
        "employee_id", "last_name", "first_name", "business_unit", "commute_mode", "route_distance_km",
        "annual_commute_bonus_gross",
    )


def wellbeing_beneficiaries(wellbeing: DataFrame) -> DataFrame:
    return wellbeing.filter("is_wellbeing_eligible").select(
        "employee_id", "last_name", "first_name", "business_unit", "activity_count_last_12_months",
        "awarded_wellbeing_days",
    )


def unit_summary(impact: DataFrame) -> DataFrame:
    """Heads, beneficiaries and benefits per business unit."""
    return impact.groupBy("business_unit").agg(
        F.sum("employee_count").alias("employees"),
        F.sum("employee_with_at_least_one_benefit_count").alias("with_a_benefit"),
        F.sum("employee_with_both_benefits_count").alias("with_both_benefits"),
        F.sum("annual_commute_bonus_gross").cast(MONEY).alias("bonus_total"),
        F.sum("awarded_wellbeing_days").cast(RATE).alias("wellbeing_days_total"),
    )


def state_fingerprint(commute: DataFrame) -> DataFrame:
    """``date|rate|eligible heads|total bonus`` per date and rate, as one text column.

    The rate is shown without trailing zeros.
    """
    rate = F.regexp_replace(F.col("bonus_rate").cast("string"), r"\.?0+\z", "")
    return commute.groupBy("calculation_as_of_date", "bonus_rate").agg(
        F.count_if(F.col("is_commute_bonus_eligible")).alias("heads"),
        F.round(F.sum("annual_commute_bonus_gross"), 2).cast(MONEY).alias("total"),
    ).select(fingerprint(F.col("calculation_as_of_date"), rate, F.col("heads"), F.col("total")).alias("state"))


# Raw relations whose rows are counted when a delivery is checked.
_DELIVERED = ("hr_employees_txt", "employee_sport_profile_txt", "sport_activities_txt", "google_routes_responses_txt")


def delivery_figures(raw: Mapping[str, DataFrame], fact: DataFrame, commute: DataFrame, queue: DataFrame) -> DataFrame:
    """What a delivery is checked by, as ``figure, value`` rows of text.

    Rows of the raw relations, of the fact table and of the backfilled part of the queue under
    their names, and the state of the commute bonus (``state``) per date and rate.
    """
    counted = {**{name: raw[name] for name in _DELIVERED}, "fct_sport_activities": fact,
               V.BACKFILLED: queue.filter(F.col("publication_status") == V.BACKFILLED)}
    figures = [df.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit(name).alias("figure"), "value")
               for name, df in counted.items()]
    state = state_fingerprint(commute).select(F.lit("state").alias("figure"), F.col("state").alias("value"))
    return functools.reduce(DataFrame.unionByName, [*figures, state])


def check_delivery(figures: DataFrame, expected: Mapping[str, str]) -> None:
    """Fail at the first figure that is not the one expected. ``figures`` should be stored."""
    for figure, value in expected.items():
        assert_value(figures.filter(F.col("figure") == figure).select("value"), value, figure)
