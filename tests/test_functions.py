import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import casts, temporal as tf


def one(spark, expr, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_float_to_int64_rounds_half_away_from_zero(spark):  # T1
    got = one(spark, casts.float_to_int64("x"), [(2.5,), (-2.5,), (3.5,), (2.4,), (None,)], "x double")
    assert got == [3, -3, 4, 2, None]


def test_text_to_int64_exact_and_fraction(spark):  # T2
    got = one(spark, casts.text_to_int64("x"), [("9007199254740993",), ("1.5",), ("-2.5",), ("",), (" 7 ",)])
    assert got == [9007199254740993, 2, -3, None, 7]


def test_text_to_boolean_strict(spark):  # T3
    assert one(spark, casts.text_to_boolean("x"), [("true",), ("FALSE",), ("",)]) == [True, False, None]
    with pytest.raises(Exception):
        one(spark, casts.text_to_boolean("x"), [("yes",)])


def test_parse_yymmdd_century_rule(spark):  # T6
    got = one(spark, tf.parse_yymmdd("x"), [(690101,), (680101,), (90101,), (991231,)], "x int")
    assert got == [dt.date(1969, 1, 1), dt.date(2068, 1, 1), dt.date(2009, 1, 1), dt.date(1999, 12, 31)]


def test_parse_temporal_fraction_digits_and_empty(spark):  # D4
    data = [("2024-01-05T10:11:12Z",), ("2024-01-05T10:11:12.123Z",), ("2024-01-05T10:11:12.123456Z",), ("",)]
    got = one(spark, tf.parse_temporal("x", "DATETIME"), data)
    assert got == [dt.datetime(2024, 1, 5, 10, 11, 12), dt.datetime(2024, 1, 5, 10, 11, 12, 123000),
                   dt.datetime(2024, 1, 5, 10, 11, 12, 123456), None]
    assert one(spark, tf.parse_temporal("x", "DATE"), data[:1]) == [dt.date(2024, 1, 5)]


def test_parse_temporal_required_empty_fails(spark):
    with pytest.raises(Exception):
        one(spark, tf.parse_temporal("x", "DATETIME", nullable=False), [("",)])


def test_parse_time_kind(spark):
    got = one(spark, tf.parse_temporal("x", "TIME").cast("string"), [("07:08:09",)])
    assert got == ["07:08:09"]


def test_local_date_bangkok(spark):  # T14: 22:50 UTC is the next day in Bangkok
    got = one(spark, tf.local_date(F.col("x")), [(dt.datetime(2024, 1, 5, 22, 50),)], "x timestamp_ntz")
    assert got == [dt.date(2024, 1, 6)]
    assert tf.local_run_dates(dt.datetime(2024, 1, 5, 22, 50)) == (dt.date(2024, 1, 5), dt.date(2024, 1, 6))


def test_epoch_round_trip(spark):
    got = one(spark, tf.utc_to_epoch_ms(tf.epoch_ms_to_utc(F.col("x"))), [(1704071029123,)], "x bigint")
    assert got == [1704071029123]
    got = one(spark, tf.epoch_s_to_utc(F.col("x")), [(86400,)], "x bigint")
    assert got == [dt.datetime(1970, 1, 2)]


def test_yymmdd_int_and_truncate_and_month_end(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 8, 1, 3, 4, 5, 678),)], "x timestamp_ntz")
    r = df.select(tf.yymmdd_int(F.to_date("x")).alias("a"), tf.truncate_to_second("x").alias("b"),
                  tf.month_end_of_digits(F.to_date("x")).alias("c")).first()
    assert (r.a, r.b, r.c) == (10801, dt.datetime(2001, 8, 1, 3, 4, 5), dt.date(2001, 8, 31))


def test_ddmmyyyy_prefix(spark):  # T7: first eight characters
    assert one(spark, tf.parse_ddmmyyyy_prefix("x"), [("05012024235959",)]) == [dt.date(2024, 1, 5)]


def test_text_to_int64_long_fractions(spark):
    got = one(spark, casts.text_to_int64("x"), [("0.4999999999",), ("-0.50000000001",), ("2.49999999999999999999",), (".5",)])
    assert got == [0, -1, 2, 1]
