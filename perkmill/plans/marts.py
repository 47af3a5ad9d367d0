"""The fact table, the two benefit marts and their impact per business unit."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from perkmill import vocabulary as V
from perkmill.functions.measures import exact_product, month_start, seconds_to_minutes
from perkmill.functions.rules import first_match
from perkmill.operators.aggregates import (
    filtered_counts, greatest_value, pivot_filtered_max, total_or_zero, trailing_counts,
)
from perkmill.operators.asof import versions_at
from perkmill.operators.joins import left_join_default
from perkmill.operators.projection import valid_rows
from perkmill.operators.ranking import latest_by_key
from perkmill.schemas import AMOUNT, MONEY, RATE, WHOLE

# The last column is an added tie-break: it makes equal versions resolve the same way each run.
PARAMETER_ORDER = ("valid_from", "source_row_number", "source_file")
ROUTE_ORDER = ("requested_at", "source_row_number", "source_file", "request_key")
WINDOW_MONTHS = 12


def activity_fact(activities: DataFrame) -> DataFrame:
    """``fct_sport_activities``: one row per valid activity."""
    start = F.col("activity_start_datetime")
    return valid_rows(activities).select(
        "activity_id", "employee_id", "activity_start_datetime", "activity_end_datetime",
        start.cast("date").alias("activity_date"),
        month_start(start).alias("activity_month"),
        "sport_type", "distance_meters", "elapsed_seconds",
        seconds_to_minutes(F.col("elapsed_seconds")).alias("elapsed_minutes"),
        "activity_comment", "source_system", "source_file", "source_row_number",
    )


def calculation_date(fact: DataFrame) -> Column:
    """The day benefits are computed for: the last day with an activity. Runs a job.

    One date goes through the driver and comes back as a literal. Filters on it are then
    known when the plan is made: they reach the files and skip partitions, and nothing
    has to be joined with a one-row relation.
    """
    return F.lit(greatest_value(fact, "activity_date")).cast("date")


def active_parameters(parameters: DataFrame, as_of: Column, names: Sequence[str]) -> DataFrame:
    """One row, one column per parameter in force on ``as_of``; NULL where there is none."""
    known = valid_rows(parameters).filter(F.col("parameter_name").isin(*names))
    newest = versions_at(known, as_of, "parameter_name", PARAMETER_ORDER)
    return pivot_filtered_max(newest, "parameter_name", "parameter_value", names)


def parameter_values(parameters: DataFrame, as_of: Column, names: Sequence[str]) -> dict[str, Column]:
    """The parameters in force as literals, NULL where there is none. Runs a job."""
    row = active_parameters(parameters, as_of, names).first()
    return {name: F.lit(row[name]).cast(RATE) for name in names}


def latest_routes(routes: DataFrame) -> DataFrame:
    """Latest valid route per employee."""
    return latest_by_key(valid_rows(routes), ["employee_id"], ROUTE_ORDER).select(
        "employee_id", "google_travel_mode", "route_distance_meters", "route_distance_km",
        "route_duration_seconds", F.col("requested_at").alias("route_requested_at"),
    )


def bonus_amount(salary: Column, rate: Column) -> Column:
    """Salary times rate in cents, rounded once."""
    return exact_product(salary, AMOUNT, rate, RATE, MONEY.scale)


def commute_bonus(
    employees: DataFrame, routes: DataFrame, parameters: DataFrame, fact: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """``mart_commute_bonus_eligibility``: reason and amount for every valid employee."""
    as_of = calculation_date(fact) if as_of is None else as_of
    values = parameter_values(parameters, as_of, V.COMMUTE_PARAMETERS)
    people = valid_rows(employees).select(
        "employee_id", "last_name", "first_name", "business_unit", "gross_salary", "commute_mode"
    )
    mode = F.col("commute_mode")
    base = left_join_default(
        people, latest_routes(routes), "employee_id", match_flag="has_valid_route"
    ).withColumns({
        "calculation_as_of_date": as_of,
        **values,
        "is_active_commute_declared": mode.isin(*V.TRAVEL_MODES),
        "maximum_authorized_distance_km":
            F.when(mode == V.WALKING_MODE, values[V.MAX_WALKING_KM])
            .when(mode == V.CYCLING_MODE, values[V.MAX_CYCLING_KM]),
    })
    reason = first_match(
        [
            (F.col(V.BONUS_RATE).isNull() | F.col(V.MAX_WALKING_KM).isNull() | F.col(V.MAX_CYCLING_KM).isNull(),
             V.PARAMETERS_NOT_AVAILABLE),
            (~F.col("is_active_commute_declared"), V.NOT_ACTIVE_COMMUTE_DECLARED),
            (~F.col("has_valid_route"), V.ROUTE_INVALID_OR_MISSING),
            (F.col("route_distance_km") > F.col("maximum_authorized_distance_km"), V.DISTANCE_ABOVE_LIMIT),
        ],
        default=V.ELIGIBLE,
    )
    eligible = F.col("eligibility_reason") == V.ELIGIBLE
    bonus = bonus_amount(F.col("gross_salary"), F.col(V.BONUS_RATE))
    return base.withColumn("eligibility_reason", reason).select(
        "employee_id", "last_name", "first_name", "business_unit", "gross_salary", "commute_mode",
        "calculation_as_of_date", *V.COMMUTE_PARAMETERS,
        "google_travel_mode", "route_distance_meters", "route_distance_km", "route_duration_seconds",
        seconds_to_minutes(F.col("route_duration_seconds")).alias("route_duration_minutes"),
        "route_requested_at", "is_active_commute_declared", "has_valid_route",
        "maximum_authorized_distance_km", "eligibility_reason",
        eligible.alias("is_commute_bonus_eligible"),
        F.when(eligible, bonus).otherwise(F.lit(Decimal(0))).cast(MONEY).alias("annual_commute_bonus_gross"),
    )


def wellbeing(
    employees: DataFrame, profiles: DataFrame, parameters: DataFrame, fact: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """``mart_wellbeing_eligibility``: activity count against the threshold.

    Profiles are joined as they are: an employee with two profile rows appears twice,
    which the uniqueness audit reports.
    """
    as_of = calculation_date(fact) if as_of is None else as_of
    values = parameter_values(parameters, as_of, V.WELLBEING_PARAMETERS)
    people = valid_rows(employees).select("employee_id", "last_name", "first_name", "business_unit")
    counts = trailing_counts(fact, "employee_id", "activity_date", as_of, WINDOW_MONTHS)
    counted = left_join_default(people, counts, "employee_id", {"row_count": 0})
    joined = left_join_default(
        counted, profiles.select("employee_id", "has_declared_sport"), "employee_id",
        {"has_declared_sport": False},
    )
    threshold, days = values[V.ACTIVITY_THRESHOLD], values[V.WELLBEING_DAYS]
    reached = F.col("row_count") >= threshold
    return joined.select(
        "employee_id", "last_name", "first_name", "business_unit", "has_declared_sport",
        F.col("row_count").alias("activity_count_last_12_months"),
        as_of.alias("calculation_as_of_date"),
        threshold.alias(V.ACTIVITY_THRESHOLD), days.alias(V.WELLBEING_DAYS),
        reached.alias("is_wellbeing_eligible"),
        F.when(reached, days).otherwise(F.lit(Decimal(0))).cast(RATE).alias("awarded_wellbeing_days"),
        F.col("first_day").alias("first_activity_date"), F.col("last_day").alias("last_activity_date"),
    )


def impact_by_unit(commute: DataFrame, wellbeing_mart: DataFrame) -> DataFrame:
    """``mart_benefits_impact_by_business_unit``: heads and amounts per date and unit.

    An employee listed m times in one mart and n times in the other counts m x n times,
    as a plain join would have it. Both sides are grouped before they meet, and counts
    are multiplied, so those m x n rows are never produced.
    """
    bonus_flags = ("is_active_commute_declared", "has_valid_route", "is_commute_bonus_eligible")
    left = commute.groupBy("employee_id", "calculation_as_of_date", "business_unit", *bonus_flags).agg(
        F.count(F.lit(1)).alias("left_rows"), F.sum("annual_commute_bonus_gross").alias("bonus")
    )
    right = wellbeing_mart.groupBy("employee_id", "is_wellbeing_eligible").agg(
        F.count(F.lit(1)).alias("right_rows"), F.sum("awarded_wellbeing_days").alias("days")
    )
    pairs = F.col("left_rows") * F.col("right_rows")
    bonus, well = F.col("is_commute_bonus_eligible"), F.col("is_wellbeing_eligible")

    def heads(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, pairs)), F.lit(0))

    return left.join(right, "employee_id").groupBy("calculation_as_of_date", "business_unit").agg(
        F.sum(pairs).alias("employee_count"),
        heads(F.col("is_active_commute_declared")).alias("active_commute_declared_employee_count"),
        heads(F.col("has_valid_route")).alias("employee_with_valid_route_count"),
        heads(bonus).alias("commute_bonus_eligible_employee_count"),
        total_or_zero(F.col("bonus") * F.col("right_rows"), 2).cast(MONEY).alias("annual_commute_bonus_gross"),
        heads(well).alias("wellbeing_eligible_employee_count"),
        total_or_zero(exact_product(F.col("days"), RATE, F.col("left_rows").cast(WHOLE), WHOLE, RATE.scale))
        .cast(RATE).alias("awarded_wellbeing_days"),
        heads(well | bonus).alias("employee_with_at_least_one_benefit_count"),
        heads(well & bonus).alias("employee_with_both_benefits_count"),
    )


def impact_report(commute: DataFrame) -> DataFrame:
    """Eligible heads and total bonus per calculation date and rate, by date."""
    return commute.groupBy("calculation_as_of_date", "bonus_rate").agg(
        *filtered_counts({"eligible_employee_count": F.col("is_commute_bonus_eligible")}),
        F.round(F.sum("annual_commute_bonus_gross"), 2).cast(MONEY).alias("annual_commute_bonus_gross"),
    ).orderBy("calculation_as_of_date")
