from __future__ import annotations

import datetime as dt
import hashlib
import json
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from perkmill.functions import announcement, casting, jsontext, keys, measures, responses, rules, text
from perkmill.schemas import AMOUNT, RATE
from perkmill.vocabulary import SPORT_SPELLINGS


def cast(target):
    return lambda c: casting.safe_cast(c, target)


def test_clean_text_strips_spaces_only(values):
    assert values(["  a ", "   ", "", None, "\ta"], text.clean_text) == ["a", None, None, None, "\ta"]


@pytest.mark.parametrize("given_text, expected", [
    (" 12 ", 12), ("+12", 12), ("-7", -7), ("1.5", None), ("1e3", None), ("99999999999", None), ("  ", None),
    ("0x10", None), ("1_000", None), ("\x0112", None), ("１２", None), (None, None), ("12abc", None),
])
def test_integer(values, given_text, expected):
    assert values([given_text], cast("integer")) == [expected]


def test_bigint(values):
    assert values(["99999999999", "x"], cast("bigint")) == [99999999999, None]


def test_numeric(values):
    texts = ["1e3", ".5", "5.", " 1.2345678 ", "NaN", "Infinity", "1000000000000", "１２", "1 2", "1e999999999"]
    assert values(texts, cast("numeric")) == [
        Decimal(1000), Decimal("0.5"), Decimal(5), Decimal("1.2345678"), None, None, Decimal(10) ** 12, None, None, None]


def test_numeric_uses_all_digits(values):
    texts = ["9" * 28, "1" + "0" * 28, "0.00000001", "0.00000000005", "1e27", "1e28", "-12345678901234567.0000000001"]
    assert values(texts, cast("numeric")) == [
        Decimal("9" * 28), None, Decimal("1e-8"), Decimal("1e-10"), Decimal(10) ** 27, None, Decimal("-12345678901234567.0000000001")]


def test_numbers_that_are_not_kept(values):
    kept = ["12", "-0.50", "1e27", "0.0000000001", "1000000000000e-22", "0e99", "0000000000000000000000000000000001", "abc", "", None,
            "5.10000000000000000", "0.00000000000000000001e10", "120e-11"]
    lost = ["1e28", "0.00000000001", "1" + "0" * 28, "1e-11", "12345e-15", "1e-9999", "0.1e-10"]
    assert values(kept, lambda c: casting.keeps_number(c, AMOUNT)) == [True] * len(kept)
    assert values(lost, lambda c: casting.keeps_number(c, AMOUNT)) == [False] * len(lost)


def test_only_long_numbers_have_their_digits_counted(values):
    """Digits at the edge of what fits, on both sides of the decimal point, with and without an exponent."""
    most, decimals = AMOUNT.precision - AMOUNT.scale, AMOUNT.scale
    kept = ["9" * most, "-" + "9" * most + "." + "1" * decimals, "0" * 40 + "1", "1." + "0" * 40, " .5 ", "5.", "", ".", "+", "x", None,
            "1" + "0" * most + "e-1", "0e99", "." + "0" * decimals + "1e1"]
    lost = ["1" + "0" * most, "+1" + "0" * most + ".5", "." + "0" * decimals + "1", "1e" + str(most), "1e-" + str(decimals + 1)]
    assert values(kept + lost, lambda c: casting.keeps_number(c, AMOUNT)) == [True] * len(kept) + [False] * len(lost)


def test_digits_are_counted_in_a_branch(spark):
    """Spark works out what ``|`` mentions twice for every row, and a cast of no exponent is an exception each time."""
    frame = spark.createDataFrame([("1",)], "t string").select(casting.keeps_number(F.col("t"), AMOUNT))
    plan = frame._jdf.queryExecution().analyzed().toString()
    assert plan.index("CASE WHEN RLIKE") < plan.index("regexp_extract")


def test_products_are_rounded_once(spark):
    cases = [("0.05", "0.0999999999999"), ("12345678901.1234567891", "0.00000000000001"), ("9999999999999999999999.9999999999", "3.5"),
             ("1e27", "0.00000000000001"), ("1e27", "1e9"), ("-2.5", "0.002"), ("0", "5"), ("100.1", "0.05"), ("0.0449999999", "0.11111111111111"),
             ("123456789012.9999999999", "99999999999.99999999999999")]
    rng = random.Random(3)
    cases += [(f"{rng.randrange(10 ** rng.randrange(1, 30))}e-10", f"{rng.randrange(10 ** rng.randrange(1, 26))}e-14") for _ in range(150)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, b string").select(
        "i", F.col("a").cast(AMOUNT).alias("a"), F.col("b").cast(RATE).alias("b"))
    found = rows.select("i", *[measures.exact_product(F.col("a"), AMOUNT, F.col("b"), RATE, s).alias(f"s{s}") for s in (2, 14)]).orderBy("i").collect()
    with localcontext() as context:
        context.prec = 120
        for row, (a, b) in zip(found, cases):
            for scale in (2, 14):
                exact = (Decimal(a) * Decimal(b)).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
                in_range = abs(exact) < Decimal(10) ** (37 - scale)
                assert row[f"s{scale}"] == (exact if in_range else None), (a, b, scale)


@pytest.mark.parametrize("given_text", [
    "2026/06/20", "2026.6.20", "06/20/2026", "6-20-2026", "06.20.2026", "6/20/26", "20260620", "260620", "June 20, 2026", "JUNE 20 2026",
    "jun 20,2026", "Jun-20-2026", "20 June 2026", "20-Jun-2026", "20 jun 26", "20Jun2026", "2026-Jun-20", "2026 June 20",
    "2026/06/20 10:00:00", "06/20/2026T10:00", "20260620 10:00:00+00", "  20-Jun-2026 10:00 UTC "])
def test_other_ways_to_write_a_day(values, given_text):
    found = values([given_text], cast("date"))[0]
    assert (found is None) == (given_text == "20Jun2026") and found in (None, dt.date(2026, 6, 20))
    moment = values([given_text], cast("timestamp"))[0]
    assert moment is None or moment == dt.datetime(2026, 6, 20, 10 if "10:00" in given_text else 0)


def test_days_that_are_none(values):
    texts = ["20/06/2026", "31 June 2026", "2026/13/01", "today", "tomorrow", "now", "epoch", "infinity", "2026-06/20", "2026171", "June 2026",
             "Juneteenth 20, 2026", "20 June", "00000620", "0000/06/20", "June June 20 2026", "06/20/026", "1/2/3/4", "\ue001\ue002-06-20"]
    assert values(texts, cast("date")) == [None] * len(texts)


def test_two_digit_and_long_years(values):
    as_text = lambda c: casting.safe_cast(c, "date").cast("string")
    assert values(["1/2/69", "1/2/70", "690102", "12026-06-20", "06/20/12026", "123456-01-02"], as_text) == [
        "2069-01-02", "1970-01-02", "2069-01-02", "+12026-06-20", "+12026-06-20", "+123456-01-02"]


def test_date(values):
    texts = ["2026-06-20", "2026-6-2", "2026-06-20 10:00:00+00", "2026-06-20 junk", "2026", "2026-06", "now",
             "20/06/2026", "2026-02-30", "2026-06-20 99:99", "12:00", "0000-01-01", "  "]
    assert values(texts, cast("date")) == [
        dt.date(2026, 6, 20), dt.date(2026, 6, 2), dt.date(2026, 6, 20), *[None] * 10]


def test_timestamp_ignores_the_offset(values):
    texts = ["2026-06-21 18:30:00", "2026-06-21", "2026-06-21 18:30:00+02", "2026-06-21 24:00:00", "12:00", "now"]
    assert values(texts, cast("timestamp")) == [
        dt.datetime(2026, 6, 21, 18, 30), dt.datetime(2026, 6, 21), dt.datetime(2026, 6, 21, 18, 30), None, None, None]


def test_zoned_timestamp_applies_the_offset(values):
    texts = ["2026-06-21T18:30:00.123456+00:00", "2026-06-21 18:30:00+02", "2026-06-21 18:30:00", "yesterday"]
    zoned = lambda c: casting.safe_cast(c, "timestamp with time zone").cast("timestamp_ntz")
    assert values(texts, zoned) == [
        dt.datetime(2026, 6, 21, 18, 30, 0, 123456), dt.datetime(2026, 6, 21, 16, 30),
        dt.datetime(2026, 6, 21, 18, 30), None]


GOOD_JSON = ['{"a":1}', '{"a":1,"a":2}', "[]", '{"a":"it\'s"}', '{\n "a": [1, {"b": null}]\n}', '{"a":"]} ["}']
BAD_JSON = ['{"a":1} x', '{"a":1} {"b":2}', '{"a":1},{"b":2}', '{"a":1}] [{"b":1}', '{"a":1}} {"b":{"c":1}',
            '{"a":1},"b":{"c":1}', "{'a':1}", '{"a":NaN}', '{"a":01}', "{bad", "1", '"text"', "null", "", None,
            '{"a":"tab\there"}']


def test_json_documents(values):
    assert values(GOOD_JSON, jsontext.is_json_document) == [True] * len(GOOD_JSON)
    assert values(BAD_JSON, jsontext.is_json_document) == [False] * len(BAD_JSON)


def test_json_values(values):
    scalars = ["1", '"text"', "null", " null ", "-0.5", "true"]
    pairs = [r'{"a":"\ud83d\ude00"}', r'{"a":"\\u0000"}', r'{"a":"\\ud800"}', r'"\u00e9"']
    assert values(GOOD_JSON + scalars + pairs, jsontext.is_json_value) == [True] * len(GOOD_JSON + scalars + pairs)
    bad = [b for b in BAD_JSON if b not in scalars] + [
        r'{"a":"\u0000"}', r'{"a":"\ud800"}', r'{"a":"\ud800 \udc00"}', r'{"a":"\udc00"}', r'"\\\u0000"', "null null", "nul", "1 2", " "]
    assert values(bad, jsontext.is_json_value) == [False] * len(bad)


def test_json_path_keeps_number_text(values):
    texts = ['{"routes":[{"distanceMeters":12.0}]}', '{"routes":[]}', '{"routes":[{"distanceMeters":null}]}']
    assert values(texts, lambda c: jsontext.json_path(c, "routes[0].distanceMeters")) == ["12.0", None, None]


def test_labels(values):
    assert values([" RuNing ", "Tennis", "  ", None], lambda c: text.normalise_label(c, SPORT_SPELLINGS)) == [
        "Course à pied", "Tennis", None, None]


def test_whitespace_is_that_of_unicode(values):
    texts = ["  a \t b\n", "x y z", "　a", ""]
    assert values(texts, text.collapse_whitespace) == [" ".join(t.split()) for t in texts]
    assert values(texts, text.strip_all) == [t.strip() for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_casts_never_fail_and_whitespace_agrees(values, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for target in ("integer", "bigint", "numeric", "date", "timestamp", "timestamp with time zone", "jsonb"):
        values(texts, lambda c: casting.safe_cast(c, target).cast("string"))
    assert values(texts, text.collapse_whitespace) == [" ".join(t.split()) for t in texts]


def test_distance_text_equals_float_formatting(values):
    metres = ["2675", "1005", "125", "375", "10000", "1234567", "0", None]
    expected = [f"{int(m) / 1000:.2f} km" if m else "non renseignée" for m in metres[:-1]] + ["non renseignée"]
    assert values(metres, lambda c: announcement.distance_text(c.cast("decimal(18,6)"))) == expected


def test_duration_text(values):
    assert values(["59", "60", "3599", "3600", "7384", "90000", None],
                  lambda c: announcement.duration_text(c.cast("int"))) == [
        "0 min 59 s", "1 min 00 s", "59 min 59 s", "1 h 00 min", "2 h 03 min", "25 h 00 min", "non renseignée"]


def test_request_key_and_document(spark):
    row = spark.createDataFrame([(" 7 ", ' 1 "A" Street\t')], "e string, h string").select(
        keys.request_key(F.col("e"), F.col("h"), F.lit("Office"), F.lit(" Marche/running"), F.lit("WALK")).alias("k"),
        keys.request_document(text.strip_all(F.col("h")), F.lit("Office"), F.lit("WALK")).alias("d"),
    ).first()
    assert row.k == hashlib.sha256('7|1 "A" Street|Office|Marche/running|WALK'.encode()).hexdigest()
    assert row.d == json.dumps({
        "origin": {"address": '1 "A" Street'}, "destination": {"address": "Office"}, "travelMode": "WALK",
        "languageCode": "fr-FR", "units": "METRIC"}, sort_keys=True)


def test_months_before_clamps(spark):
    row = spark.range(1).select(measures.months_before(F.lit("2024-02-29").cast("date"), 12).alias("d")).first()
    assert row.d == dt.date(2023, 2, 28)


def test_three_valued_rules(spark):
    frame = spark.createDataFrame([(1, None, 5), (2, 3, None), (3, 1, 9)], "i int, a int, b int")
    rows = frame.select(
        rules.holds(F.col("a") > 2).alias("known"),
        rules.absent_or(F.col("a"), F.col("b") > 0).alias("optional"),
        rules.covers(F.col("a"), F.col("b"), F.lit(4)).alias("inside"),
        rules.first_match([(F.col("a").isNull(), "none"), (F.col("b") > 6, "big")], "else").alias("choice"),
    ).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [
        (False, True, None, "none"), (True, False, True, "else"), (False, True, True, "big")]


def test_route_and_delivery_outcomes(spark):
    cases = [
        ("refused", None, None), (None, 200, '{"routes":[]}'), (None, 200, "<html>"), (None, 404, "{}"),
        (None, 200, '{"routes":[{"duration":"1s"}],"ok":true,"channel":"C","ts":"1.2"}'),
    ]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, e string, s int, b string")
    e, s, b = F.col("e"), F.col("s"), F.col("b")
    rows = frame.select(responses.route_status(e, s, b), responses.route_payload(e, b),
                        responses.delivery_outcome(e, s, b)).orderBy("i").collect()
    assert [r[0] for r in rows] == ["REQUEST_ERROR", "NO_ROUTE", "NO_ROUTE", "404", "200"]
    assert rows[0][1] == '{"request_error": "refused"}' and rows[2][1] == '{"raw_response": "<html>"}'
    assert [tuple(r[2]) for r in rows] == [
        (False, None, None, "REQUEST_ERROR: refused"), (False, None, None, "SLACK_ERROR: unknown_error"),
        (False, None, None, "INVALID_JSON_RESPONSE: HTTP 200"), (False, None, None, "SLACK_ERROR: unknown_error"),
        (True, "C", "1.2", None)]
