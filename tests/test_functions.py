"""Column helpers F1-F18 on tiny inputs, including the hazards H5, H6, H8."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from deskpulse import functions as fx


def one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,secs", [("01:05", 65), ("1:05", 65), ("99:59", 5999), ("120:00", 7200),
                                       ("00:00", 0), ("abc", None), (None, None), ("1:2:3", None)])
def test_mmss_to_seconds(spark, text, secs):
    assert one(spark, fx.mmss_to_seconds("x"), text, "x string") == secs


@pytest.mark.parametrize("text,out", [("123.0", "123"), ("123.9", "123"), ("-5.5", "-5"), ("42", "42"),
                                      ("junk", None), (None, None)])
def test_numeric_id_text(spark, text, out):
    assert one(spark, fx.numeric_id_text("x"), text, "x string") == out


def test_full_name_null_parts(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "b")], "f string, l string")
    assert [r[0] for r in df.select(fx.full_name("f", "l")).collect()] == ["a ", " b", "a b"]


@pytest.mark.parametrize("v,out", [(2.5, "3"), (-2.5, "-3"), (12.0, "12"), (float("nan"), "NaN"), (None, None)])
def test_round_avg_text(spark, v, out):
    assert one(spark, fx.round_avg_text("x"), v, "x double") == out


@pytest.mark.parametrize("v,out", [(2.5, "2"), (3.5, "4"), (-2.5, "-2"), (2.6, "3"), (float("nan"), "NaN"), (None, None)])
def test_round_avg_text_half_even(spark, v, out):
    assert one(spark, fx.round_avg_text("x", half_even=True), v, "x double") == out


@pytest.mark.parametrize("v,out", [(12.0, "12"), (12.5, "12.5"), (float("nan"), "NaN"), (None, None)])
def test_num_text(spark, v, out):
    assert one(spark, fx.num_text("x"), v, "x double") == out


def test_num_text_integral_type(spark):
    assert one(spark, fx.num_text("x"), 7, "x bigint") == "7"


@pytest.mark.parametrize("t,h", [("09:30:00", 9), ("9:30:00", 9), ("23:00:00", 23), ("x", None)])
def test_hour_of_time_text(spark, t, h):
    assert one(spark, fx.hour_of_time_text("x"), t, "x string") == h


def test_week_and_month_start(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 1),), (dt.date(2023, 12, 31),)], "d date")
    got = df.select(fx.week_start("d"), fx.month_start("d")).collect()
    assert [r[0] for r in got] == [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2023, 12, 25)]
    assert [r[1] for r in got] == [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2023, 12, 1)]


def test_us_formats(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 17, 45, 1),)], "ts timestamp_ntz")
    r = df.select(fx.us_date(F.to_date("ts")), fx.us_datetime_of_date("ts"),
                  fx.parse_us_date(F.lit("03/09/2024"))).first()
    assert r[0] == "03/09/2024" and r[1] == "03/09/2024 00:00:00" and r[2] == dt.date(2024, 3, 9)


def test_days_between(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 10), dt.date(2024, 1, 1))], "a date, b date")
    assert df.select(fx.days_between("a", "b")).first()[0] == 9


def test_true_divide_zero_is_null(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (5, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(fx.true_divide("a", "b")).collect()] == [None, None, 2.5]


def test_round2_half_away(spark):
    df = spark.createDataFrame([(2.345,), (2.344,), (-2.345,)], "x double")
    assert [r[0] for r in df.select(fx.round2("x")).collect()] == [2.35, 2.34, -2.35]


#: tracked seconds, manual seconds -> tickets per hour of 6 tickets (C10 as a truth table)
RATES = {
    (None, None): 6.0, (None, 0): 6.0, (0, None): 6.0, (0, 0): 6.0,
    (None, 1800): 12.0, (0, 1800): 12.0, (1800, None): 12.0, (1800, 0): 12.0,
    (7200, 1800): 3.0, (1800, 7200): 12.0,
}


def test_rate_or_count_truth_table(spark):
    df = spark.createDataFrame([(6, d, m) for d, m in RATES], "t bigint, d bigint, m bigint")
    got = df.select("d", "m", fx.rate_or_count("t", "d", "m").alias("r")).collect()
    assert {(r["d"], r["m"]): r["r"] for r in got} == RATES


def test_like_helpers(spark):
    df = spark.createDataFrame([("Ticket Active now",), ("Break",), (None,)], "a string")
    got = df.select(fx.like_any("a", ["%Ticket Active%", "%Zzz%"]), fx.not_like_all("a", ["%Break%"])).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (None, None)]


def test_numeric_id_text_of_long_and_negative_numbers(spark):
    df = spark.createDataFrame([("123.0",), ("1234567890123456789012345.9",), ("-7.9",), ("x1",), (None,)], "a string")
    got = [r[0] for r in df.select(fx.numeric_id_text("a")).collect()]
    assert got == ["123", "1234567890123456789012345", "-7", None, None]
