"""Hand-made employees with known answers, through all models."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perkmill import vocabulary as V
from perkmill.plans import marts, parameters, refresh, reports
from perkmill.operators.quality import is_true, not_null, tagged_failures
from perkmill.plans.audits import run_audits, stored_failures
from perkmill.sources.readers import initial_parameters
from perkmill.sources.snapshots import Snapshot, read_table

WALK, CYCLE = V.WALKING_MODE, V.CYCLING_MODE

EMPLOYEES = [(1, "30000", WALK), (2, "40000", WALK), (3, "35000.55", CYCLE), (4, "28000", "Voiture"),
             (5, "31000", CYCLE), (6, "0", WALK), (7, "33000", WALK)]
ROUTES = [(1, WALK, "14000", 1), (2, WALK, "15001", 1), (3, CYCLE, "25000", 1), (6, WALK, "1000", 1),
          (7, WALK, "9000", 1), (7, WALK, "16000", 2)]


def _employee(number, salary, mode):
    return {"employee_id": str(number), "last_name": "L", "first_name": "F", "birth_date": "1990-01-01",
            "business_unit": "Ops" if number < 4 else "Sales", "hire_date": "2020-01-01", "gross_salary": salary,
            "contract_type": "CDI", "paid_leave_days": "25", "home_address": f"{number} Street", "commute_mode": mode}


def _route(employee, mode, metres, hour, status="200"):
    return {"request_key": f"{employee}-{hour}", "employee_id": str(employee), "home_address": "h",
            "office_address": "o", "declared_commute_mode": mode, "google_travel_mode": V.TRAVEL_MODES[mode],
            "request_payload_json": "{}", "response_http_status": status,
            "response_payload_json": f'{{"routes":[{{"distanceMeters":{metres},"duration":"812s"}}]}}',
            "requested_at": f"2026-06-01T0{hour}:00:00+00:00"}


def _activities():
    """Employee 1: 15 in the window; 2: 14 and one a day too early; 5: two invalid ones."""
    days = [(1, "2025-06-21"), *[(1, f"2026-05-{d:02d}") for d in range(1, 14)], (1, "2026-06-21"),
            (2, "2025-06-20"), *[(2, f"2026-05-{d:02d}") for d in range(1, 15)]]
    rows = [{"activity_id": str(i), "employee_id": str(e), "activity_start_datetime": f"{d} 18:30:00",
             "activity_end_datetime": f"{d} 19:20:00", "sport_type": " RUNING ", "distance_meters": "",
             "elapsed_seconds": "3000", "source_system": "s"} for i, (e, d) in enumerate(days, start=1)]
    return rows + [{**rows[0], "activity_id": "900", "employee_id": "5", "elapsed_seconds": "0"},
                   {**rows[0], "activity_id": "901", "employee_id": "5", "distance_meters": "-1"}]


@pytest.fixture(scope="module")
def raw(spark):
    from perkmill.schemas import RAW

    def build(relation, rows):
        names = RAW[relation].names
        return spark.createDataFrame(
            [tuple({"source_file": "fixture", "source_row_number": str(i), **r}.get(n) for n in names)
             for i, r in enumerate(rows, start=2)], RAW[relation])

    profiles = [{"employee_id": "1", "declared_sport": "Runing"}, {"employee_id": "3", "declared_sport": "Tennis"},
                {"employee_id": "3", "declared_sport": "  "}]
    return {
        "hr_employees_txt": build("hr_employees_txt", [_employee(*e) for e in EMPLOYEES]),
        "employee_sport_profile_txt": build("employee_sport_profile_txt", profiles),
        "sport_activities_txt": build("sport_activities_txt", _activities()),
        "google_routes_responses_txt": build("google_routes_responses_txt", [
            *[_route(*r) for r in ROUTES], _route(5, CYCLE, "500", 1, "NO_ROUTE"),
            {**_route(4, WALK, "12.0", 1), "declared_commute_mode": WALK},
        ]),
        "benefit_parameters_txt": parameters.revise_parameter(
            initial_parameters(spark), V.BONUS_RATE, "0.06", "2026-06-21", "2026-06-20", "revision"),
    }


@pytest.fixture(scope="module")
def models(raw):
    staged = refresh.stage(raw)
    return {**staged, **refresh.build_marts(staged)}


def _by_employee(frame, *columns):
    return {r.employee_id: tuple(r[c] for c in columns) for r in frame.collect()}


def test_commute_reasons_and_amounts(models):
    found = _by_employee(models["mart_commute_bonus_eligibility"], "eligibility_reason", "annual_commute_bonus_gross")
    assert found == {
        1: (V.ELIGIBLE, Decimal("1800.00")), 2: (V.DISTANCE_ABOVE_LIMIT, Decimal("0.00")),
        3: (V.ELIGIBLE, Decimal("2100.03")), 4: (V.NOT_ACTIVE_COMMUTE_DECLARED, Decimal("0.00")),
        5: (V.ROUTE_INVALID_OR_MISSING, Decimal("0.00")), 7: (V.DISTANCE_ABOVE_LIMIT, Decimal("0.00"))}


def test_the_rate_is_that_of_the_calculation_date(models):
    day_before = F.lit("2026-06-20").cast("date")
    mart = marts.commute_bonus(models["stg_hr_employees"], models["stg_google_routes_responses"],
                               models["config_benefit_parameters"], models["fct_sport_activities"], day_before)
    assert _by_employee(mart, "annual_commute_bonus_gross")[1] == (Decimal("1500.00"),)
    ratio = Decimal("206979.00") / Decimal("172482.50")
    assert ratio == Decimal("0.06") / Decimal("0.05")


def test_without_a_rate_nobody_is_judged(models):
    lacking = models["config_benefit_parameters"].filter(F.col("parameter_name") != V.BONUS_RATE)
    mart = marts.commute_bonus(models["stg_hr_employees"], models["stg_google_routes_responses"], lacking,
                               models["fct_sport_activities"])
    assert set(_by_employee(mart, "eligibility_reason").values()) == {(V.PARAMETERS_NOT_AVAILABLE,)}


def test_wellbeing_counts_and_duplicates(models):
    rows = models["mart_wellbeing_eligibility"].collect()
    found = {r.employee_id: (r.activity_count_last_12_months, r.is_wellbeing_eligible, r.awarded_wellbeing_days,
                             r.has_declared_sport) for r in rows if r.employee_id != 3}
    assert found[1] == (15, True, Decimal(5), True) and found[2] == (14, False, Decimal(0), False)
    assert found[5] == (0, False, Decimal(0), False)
    assert sorted(r.has_declared_sport for r in rows if r.employee_id == 3) == [False, True]


def test_without_threshold_eligibility_is_unknown(models):
    lacking = models["config_benefit_parameters"].filter(F.col("parameter_name") != V.ACTIVITY_THRESHOLD)
    mart = marts.wellbeing(models["stg_hr_employees"], models["stg_employee_sport_profile"], lacking,
                           models["fct_sport_activities"])
    assert set(_by_employee(mart, "is_wellbeing_eligible", "awarded_wellbeing_days").values()) == {(None, Decimal(0))}
    failing = run_audits({"mart_wellbeing_eligibility": mart}, [
        a for a in refresh.MODEL_AUDITS if a.name == "mart_wellbeing_eligibility_matches_activity_threshold"])
    assert failing[0].failing_rows == mart.count()


def test_impact_equals_the_plain_join(models):
    commute, well = models["mart_commute_bonus_eligibility"], models["mart_wellbeing_eligibility"]
    plain = commute.join(well.select("employee_id", "is_wellbeing_eligible", "awarded_wellbeing_days"), "employee_id")
    for row in models["mart_benefits_impact_by_business_unit"].collect():
        part = [r for r in plain.collect() if r.business_unit == row.business_unit]
        assert row.employee_count == len(part)
        assert row.annual_commute_bonus_gross == sum(r.annual_commute_bonus_gross for r in part)
        assert row.awarded_wellbeing_days == sum(r.awarded_wellbeing_days for r in part)
        assert row.employee_with_at_least_one_benefit_count == sum(
            r.is_wellbeing_eligible or r.is_commute_bonus_eligible for r in part)
    # Employee 3 has two profile rows and counts twice.
    assert reports.unit_summary(models["mart_benefits_impact_by_business_unit"]).filter(
        "business_unit = 'Ops'").first().employees == 4
    assert marts.impact_report(commute).first().eligible_employee_count == 2
    assert reports.state_fingerprint(commute).first().state == "2026-06-21|0.06|2|3900.03"


def test_empty_activities(raw, spark):
    empty = {**raw, "sport_activities_txt": raw["sport_activities_txt"].limit(0)}
    built = refresh.build_marts(refresh.stage(empty))
    rows = built["mart_commute_bonus_eligibility"].collect()
    assert {(r.eligibility_reason, r.calculation_as_of_date) for r in rows} == {(V.PARAMETERS_NOT_AVAILABLE, None)}


def test_refresh_stores_marts_and_audits(spark, raw, models, tmp_path):
    root = str(tmp_path)
    result = refresh.refresh(spark, raw, root, register=True)
    for name in ("fct_sport_activities", "mart_commute_bonus_eligibility", "mart_wellbeing_eligibility",
                 "mart_benefits_impact_by_business_unit"):
        columns = models[name].columns
        assert sorted(map(str, read_table(spark, f"{root}/marts", name).select(columns).collect())) == sorted(
            map(str, models[name].collect())), name
    counts = {r.name: r.failing_rows for r in result.audits}
    assert len(counts) == 15
    assert {n: c for n, c in counts.items() if c} == {
        "stg_hr_employees_invalid_records": 1, "stg_sport_activities_invalid_records": 2,
        "mart_wellbeing_employee_id_unique": 1}
    assert spark.sql("SELECT count(*) FROM audit.stg_hr_employees_invalid_records").first()[0] == 1
    assert spark.sql("SELECT count(*) FROM marts.fct_sport_activities").first()[0] == 30
    assert refresh.refresh(spark, raw, root).version == result.version + 1


def test_revisions(spark):
    stored = initial_parameters(spark)
    args = (V.BONUS_RATE, "0.06", "2026-06-21", "2026-06-20", "revision")
    once = parameters.revise_parameter(stored, *args, only_version_from="2025-06-20")
    twice = parameters.revise_parameter(once, *args, only_version_from="2025-06-20")
    assert sorted(once.collect()) == sorted(twice.collect()) and once.count() == 6
    assert [(r.bonus_rate, r.valid_to) for r in parameters.parameter_history(once, V.BONUS_RATE).collect()] == [
        ("0.05", "2026-06-20"), ("0.06", None)]
    now = F.lit("2026-07-01 08:00:00").cast("timestamp")
    later = parameters.revise_rate_now(once, "0.07", "second revision", now)
    typed = refresh.staging.benefit_parameters(later)
    assert [r[0] for r in typed.filter("parameter_name = 'bonus_rate' and record_is_valid").select(
        F.coalesce("valid_to", F.lit(None)).alias("e")).orderBy("valid_from").collect()] == [
        dt.date(2026, 6, 20), dt.date(2026, 7, 1), None]
    assert marts.active_parameters(typed, F.lit("2026-07-01").cast("date"), [V.BONUS_RATE]).first()[0] == Decimal("0.07")
    for bad in ("0.001", "1.5"):
        with pytest.raises(ValueError):
            parameters.check_rate(bad)


def test_failing_rows_are_stored_in_one_pass_over_a_relation(spark, raw, models, tmp_path, monkeypatch):
    """Every typed relation is worked out by one plan, however many rules it has; rules without failing rows can be read."""
    root, plans = str(tmp_path), {}
    write = Snapshot.write

    def recorded(self, table, df, partition_by=()):
        plans[table] = df
        return write(self, table, df, partition_by)

    monkeypatch.setattr(Snapshot, "write", recorded)
    extra = raw["hr_employees_txt"].limit(1).withColumns(
        {"gross_salary": F.lit("1" + "0" * 39), "employee_id": F.lit("x"), "source_row_number": F.lit("999")})
    inputs = {**raw, "hr_employees_txt": raw["hr_employees_txt"].unionByName(extra)}
    result = refresh.refresh(spark, inputs, root, register=True)
    relations = {**refresh.stage(inputs), **result.tables}
    for relation in refresh.stage(inputs):
        written = [name for name in plans if name.startswith(relation)]
        assert written == ([] if relation == "stg_google_routes_responses" else [f"{relation}_failures"])
    counts = {r.name: r.failing_rows for r in (*result.audits, *result.range_audits)}
    for audit in refresh.ALL_AUDITS:
        found = stored_failures(spark, f"{root}/audit", audit, relations[audit.relation])
        expected = audit.failures(relations[audit.relation])
        assert found.columns == expected.columns, audit.name
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())), audit.name
        assert spark.table(f"audit.{audit.name}").count() == counts[audit.name] == found.count(), audit.name
    both = [spark.sql(f"SELECT source_row_number_raw FROM audit.stg_hr_employees_{n} WHERE source_row_number_raw = '999'").count()
            for n in ("invalid_records", "numbers_kept")]
    assert both == [1, 1]


def test_rows_tagged_by_broken_rules(spark):
    rows = spark.createDataFrame([(1, 1), (None, 5), (-1, None)], "a int, b int")
    rules = [not_null("a_given", "r", "a"), is_true("a_positive", "r", "a > 0"), is_true("b_small", "r", "b < 3")]
    tagged = tagged_failures(rows, rules)
    assert sorted((str(r.a), r.audit) for r in tagged.collect()) == [
        ("-1", "a_positive"), ("-1", "b_small"), ("None", "a_given"), ("None", "a_positive"), ("None", "b_small")]
    with pytest.raises(ValueError):
        tagged_failures(tagged, rules)
    assert tagged_failures(rows.limit(0), rules).count() == 0


def test_employees_are_typed_once_in_a_run(spark, raw, tmp_path):
    """Two marts and the audits share one pass; what is kept for them is released, also when a run fails."""
    employees, read = raw["hr_employees_txt"], spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    inputs = {**raw, "hr_employees_txt": spark.createDataFrame(employees.rdd.map(counted), employees.schema)}
    result = refresh.refresh(spark, inputs, str(tmp_path / "run"))
    assert read.value == employees.count()
    assert not refresh.stage(inputs)["stg_hr_employees"].is_cached
    assert {r.name: r.failing_rows for r in result.audits}["stg_hr_employees_invalid_records"] == 1
    failing = {**inputs, "google_routes_responses_txt": raw["google_routes_responses_txt"].withColumn(
        "employee_id", F.raise_error(F.lit("unreadable")).cast("string"))}
    with pytest.raises(Exception, match="unreadable"):
        refresh.refresh(spark, failing, str(tmp_path / "failed"))
    assert not refresh.stage(failing)["stg_hr_employees"].is_cached


def test_rules_are_tested_below_the_explode(spark, raw):
    """An explode is interpreted for every row it is given, so it is given tested rows that break a rule."""
    for model in ("stg_hr_employees", "stg_sport_activities"):
        rules = [a for a in refresh.ALL_AUDITS if a.relation == model and a.passes]
        tagged = tagged_failures(refresh.stage(raw)[model], rules)
        lines = tagged._jdf.queryExecution().optimizedPlan().toString().splitlines()
        explode, below = next((line, lines[i + 1:]) for i, line in enumerate(lines) if "Generate explode" in line)
        assert "RLIKE" not in explode and "regexp_extract" not in explode
        assert any("Filter" in line and "RLIKE" not in line for line in below)
