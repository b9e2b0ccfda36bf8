"""Boundary cases of encoders, rules and single-row features."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardlens.functions import scalar
from cardlens.operators import monitor, training

NUMBERS = [(None, None), ("", None), ("  ", None), ("abc", None), ("12x", None), ("inf", None), ("-Infinity", None), ("NaN", None), ("1d", None), ("0", 0.0), ("-0.5", -0.5), ("3.5", 3.5), ("2147483647", 2147483647.0), ("1e308", 1e308), (" 42 ", 42.0), ("true", 1.0)]


def test_to_number(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NUMBERS)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(scalar.to_number(F.col("t"))).collect()]
    assert got == [want for _, want in NUMBERS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.floats().map(str), st.integers(-(10**12), 10**12).map(str)), min_size=1, max_size=50))
def test_to_number_is_total_and_idempotent(spark, values):
    df = spark.createDataFrame([(v.replace("\x00", "") if v else v,) for v in values], "t string").select(scalar.to_number(F.col("t")).alias("x"))
    for r in df.select("x", scalar.to_number(F.col("x").cast("string")).alias("y")).collect():
        assert r.x is None or math.isfinite(r.x)
        assert r.x == r.y


def test_encode_categorical(spark):
    df = spark.createDataFrame([(0, None), (1, "WEB"), (2, "web"), (3, ""), (4, "pos"), (5, "other")], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(scalar.encode_categorical(F.col("v"), {"web": 0, "pos": 1})).collect()]
    assert got == [None, None, 0.0, None, 1.0, None]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in flags.select(scalar.encode_categorical(F.col("b"), {"False": 0, "True": 1}, "boolean")).collect()] == [1.0, 0.0, None]


@pytest.mark.parametrize(("score", "want"), [(0.0, 0), (0.35, 0), (0.799999, 0), (0.8, 1), (0.800001, 1), (1.0, 1)])
def test_threshold(spark, score, want):
    assert spark.range(1).select(scalar.decide(F.lit(score))).first()[0] == want


def test_request_rules(spark):
    good = {"request_id": "r", "user_id": "u", "card_id": "c", "merchant_category": "m", "merchant_risk_level": 3, "amount_usd": 1.0, "channel": "web", "billing_country_code": "VN", "ip_country_code": "VN", "email_purchaser": "a@b.co", "email_recipient": "a+t@b.co", "created_at": "2026-07-01T13:30:00Z"}
    cases = [({}, 0), ({"amount_usd": 0.0}, 1), ({"amount_usd": -0.01}, 1), ({"amount_usd": 0.001}, 0), ({"merchant_risk_level": -1}, 1), ({"merchant_risk_level": 11}, 1), ({"merchant_risk_level": 10}, 0), ({"user_id": ""}, 1), ({"user_id": "x" * 256}, 0), ({"email_purchaser": "a@@b.co"}, 1), ({"email_purchaser": ""}, 1), ({"email_recipient": "@b.co"}, 1), ({"email_recipient": None}, 1), ({"created_at": "no time"}, 1)]
    schema = "i int, request_id string, user_id string, card_id string, merchant_category string, merchant_risk_level int, amount_usd double, channel string, billing_country_code string, ip_country_code string, email_purchaser string, email_recipient string, created_at string"
    df = spark.createDataFrame([(i, *(good | change).values()) for i, (change, _) in enumerate(cases)], schema)
    marked = monitor.with_violations(df, monitor.request_rules())
    assert [len(r.violations) for r in marked.orderBy("i").collect()] == [n for _, n in cases]
    valid, bad = monitor.split_valid(marked)
    assert valid.count() == sum(n == 0 for _, n in cases) and bad.count() == sum(n > 0 for _, n in cases)


def test_zscore_from_moments(spark):
    df = spark.createDataFrame([(1, 50.0, 1, 50.0, 2500.0), (2, 50.0, 3, 150.0, 7500.0), (3, 50.0, 3, 150.0, 7700.0)], "i int, x double, n long, s double, q double")
    got = [r[0] for r in df.orderBy("i").select(scalar.zscore(F.col("x"), F.col("n"), F.col("s"), F.col("q"))).collect()]
    assert got[:2] == [None, None] and got[2] == pytest.approx(0.0)


def test_golden_times(spark):
    df = spark.createDataFrame([("2026-07-01T13:30:00Z",), ("2026-07-01T23:30:00Z",), ("2026-07-01T20:30:00+07:00",)], "t string").select(scalar.parse_iso_utc(F.col("t")).alias("t"))
    rows = df.select(scalar.hour_utc(F.col("t")), scalar.weekday(F.col("t")), scalar.is_night(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [(13, 2, 0), (23, 2, 1), (13, 2, 0)]


def test_encoders_of_nulls(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    assert training.fit_encoders(df, ["c"]) == {"c": {"a": 0, "b": 1, "missing": 2}}


def test_days_and_hours_are_utc_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        t = F.timestamp_seconds(F.lit(1_782_948_600))  # 2026-07-01T23:30:00Z
        row = spark.range(1).select(scalar.hour_utc(t), scalar.weekday(t), scalar.is_night(t), scalar.utc_date(t).cast("string"), F.unix_seconds(scalar.utc_hour_start(t)), scalar.is_weekend(t)).first()
        assert tuple(row) == (23, 2, 1, "2026-07-01", 1_782_946_800, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
